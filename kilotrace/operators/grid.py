"""Sheets as tables of typed cells: headers, rows, cut-offs and types.

A grid has (archivo, hoja, fila, celdas array<struct<t:string,v:string>>). Positions start at 0, rows at 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilotrace.functions import clean as C

SHEET = ["archivo", "hoja"]
#: Thresholds of header rows. Fixed values.
TEXT_SHARE, CONTRAST, WIDTH, LOOK, LONGEST_NUMBER = 0.5, 0.25, 0.6, 20, 6


def cells(grid: DataFrame) -> DataFrame:
    return grid.select(*SHEET, "fila", F.posexplode("celdas").alias("pos", "c")).select(*SHEET, "fila", "pos", F.col("c.t").alias("t"), F.col("c.v").alias("v"))


def header_map(grid: DataFrame, row: int, titles: dict[str, str]) -> DataFrame:
    """(sheet, nombre, pos): the first position of each declared title (normalised) in the header row."""
    known = F.create_map(*[F.lit(x) for pair in titles.items() for x in pair])
    name = F.try_element_at(known, C.normal_header(F.col("v")))
    return cells(grid.filter(F.col("fila") == row)).withColumn("nombre", name).filter("nombre is not null").groupBy(*SHEET, "nombre").agg(F.min("pos").alias("pos"))


def missing_titles(grid: DataFrame, row: int, titles: dict[str, str]) -> DataFrame:
    """(sheet, faltan): declared names that a sheet's header row lacks."""
    want = F.array(*[F.lit(n) for n in sorted(set(titles.values()))])
    found = header_map(grid, row, titles).groupBy(*SHEET).agg(F.collect_set("nombre").alias("hay"))
    return grid.select(*SHEET).distinct().join(found, SHEET, "left").select(*SHEET, F.array_except(want, F.coalesce("hay", F.array().cast("array<string>"))).alias("faltan"))


def rows(grid: DataFrame, row: int, titles: dict[str, str]) -> DataFrame:
    """(sheet, fila, a column for each declared name) below the header; blank rows stay, with nulls."""
    heads = header_map(grid, row, titles).groupBy(*SHEET).agg(F.map_from_entries(F.collect_list(F.struct("nombre", "pos"))).alias("m"))
    at = lambda n: F.get("celdas", F.try_element_at("m", F.lit(n)))["v"]
    names = list(dict.fromkeys(titles.values()))
    raw = grid.filter(F.col("fila") > row).join(heads, SHEET).select(*SHEET, "fila", *[at(n).alias(n) for n in names])
    return raw.select(*SHEET, "fila", *[F.when(~C.blank(F.col(n)), F.col(n)).alias(n) for n in names])


def cut_empty(data: DataFrame, names: list[str], longest: int = 3000) -> DataFrame:
    """Rows up to the first run of ``longest`` blank ones in each sheet, blank rows left out.

    A blank row's number less its rank among blank rows is constant in a run (gaps and islands)."""
    full = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    blank = data.filter(~full).withColumn("run", F.col("fila") - F.row_number().over(Window.partitionBy(*SHEET).orderBy("fila")))
    ends = blank.groupBy(*SHEET, "run").agg(F.count("*").alias("n"), F.min("fila").alias("desde")).filter(F.col("n") >= longest)
    ends = ends.groupBy(*SHEET).agg(F.min("desde").alias("corte"))
    return data.filter(full).join(ends, SHEET, "left").filter(F.col("corte").isNull() | (F.col("fila") < F.col("corte"))).drop("corte")


def sheet_metadata(sheets: DataFrame, pattern: str, year: int | None) -> DataFrame:
    """Year, month and company of sheet names by groups 1 (month), 2 (year) and 3 (company) of ``pattern``."""
    part = lambda i: C.some(F.regexp_extract("hoja", pattern, i))
    found = sheets.filter(F.col("hoja").rlike(pattern))
    return found.withColumns({"_mes": C.month_number(part(1)), "_anio": F.coalesce(part(2).try_cast("int"), F.lit(year).cast("int")), "_empresa": F.upper(part(3))})


def discards(data: DataFrame, totals: list[str], titles: dict[str, str], required: list[str]) -> DataFrame:
    """``data`` with why a row is discarded: total, encabezado, incompleta, or null for rows that stay."""
    total = F.lit(False)
    for c in totals:
        total = total | C.is_total(F.col(c))
    heading = F.lit(False)
    for name in required:
        heading = heading | F.coalesce(C.normal_header(F.col(name)) == titles[name], F.lit(False))
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | C.blank(F.col(name))
    return data.withColumn("descarte", F.when(total, "total").when(heading, "encabezado").when(lacking, "incompleta"))


def control(data: DataFrame, effective: DataFrame, source: str, key: list[str], columns: list[str], reasons: list[str]) -> DataFrame:
    """What each source's control report says: rows read, effective and left, rows of repeated keys among what is left,
    discards by reason, and filled cells of each column. ``effective`` is ``data`` after the cut, with ``descarte``."""
    from kilotrace.operators.quality import repeated

    out = repeated(effective.filter("descarte is null"), [source, *key], "_rep").groupBy(source).agg(F.count("*").alias("filas_salida"), F.count_if("_rep").alias("filas_con_llave_repetida"))
    whole = effective.groupBy(source).agg(F.count("*").alias("filas_efectivas"), *[F.count_if(F.col("descarte") == r).alias(f"descarte_{r}") for r in reasons], *[F.count(c).alias(f"con_{c}") for c in columns])
    read = data.groupBy(source).agg(F.count("*").alias("filas_leidas"))
    report = read.join(whole, source, "left").join(out, source, "left").fillna(0)
    return report.withColumn("estado", F.when(F.col("filas_efectivas") > 0, "ok").otherwise("sin_filas"))


def profile(grid: DataFrame) -> DataFrame:
    """(sheet, fila, llenas, ratio): filled cells of each row and the share of them that is text."""
    kinds = F.transform("celdas", lambda c: C.cell_type(c["t"], c["v"]))
    n = F.size(F.filter("k", lambda x: x != "vacia"))
    text = F.size(F.filter("k", lambda x: x == "texto"))
    return grid.withColumn("k", kinds).select(*SHEET, "fila", n.alias("llenas"), F.when(n > 0, text / n).otherwise(0.0).alias("ratio"))


def pick_header(grid: DataFrame) -> DataFrame:
    """(sheet, fila, dudoso): the row that looks most like a header among the first ones of each sheet."""
    p = profile(grid.filter(F.col("fila") <= LOOK))
    each = Window.partitionBy(*SHEET)  # at most LOOK rows a sheet
    p = p.withColumns({"ancho": F.max("llenas").over(each), "sigue": F.lead("ratio").over(each.orderBy("fila"))})
    wide = F.col("llenas") >= F.greatest(F.lit(2), F.floor(F.col("ancho") * WIDTH))
    key = F.struct(wide.alias("w"), (wide & (F.col("ratio") >= TEXT_SHARE)).alias("a"), (wide & F.coalesce(F.col("ratio") - F.col("sigue") >= CONTRAST, F.lit(False))).alias("b"), F.col("llenas").alias("n"), (-F.col("fila")).alias("f"))
    best = p.groupBy(*SHEET).agg(F.max_by(F.struct("fila", "ratio", "ancho"), key).alias("m"))
    return best.select(*SHEET, F.when(F.col("m.ancho") > 0, F.col("m.fila")).otherwise(1).alias("fila"), (F.col("m.ratio") < TEXT_SHARE).alias("dudoso"))


def looks_identifying(c):
    """Whether a text holds a document number, a company's legal form, or is a plate."""
    t = C.strip(c)
    form = t.rlike(r"(?i)(\bS\.A\.C?\.?|\bE\.I\.R\.L\.?|\bS\.R\.L\.?|\sS\.?A\.?C?\.?\s*$)")
    plate = (F.length(t) <= 9) & t.rlike(r"^[A-Za-z0-9]{2,4}[-\s][A-Za-z0-9]{2,4}$") & t.rlike(r"\d") & t.rlike("[A-Za-z]")
    return F.coalesce(t.rlike(r"\d{8,}") | form | plate, F.lit(False))


def headers(grid: DataFrame) -> DataFrame:
    """(sheet, pos, nombre, omitido): the chosen header's publishable names, without trailing blanks."""
    h = cells(grid.join(pick_header(grid).select(*SHEET, "fila", "dudoso"), [*SHEET, "fila"]))
    kind, text = C.cell_type(F.col("t"), F.col("v")), C.squeeze(F.col("v"))
    fine = (kind == "texto") | ((kind == "numero") & (F.length(text) <= LONGEST_NUMBER) & ~F.contains(text, F.lit(".")))
    h = h.withColumns({"nombre": F.when(fine, text).otherwise(""), "omitido": ~fine & (kind != "vacia")})
    last = F.max(F.when((F.col("nombre") != "") | F.col("omitido"), F.col("pos"))).over(Window.partitionBy(*SHEET))
    return h.withColumn("last", last).filter(F.col("pos") <= F.col("last")).select(*SHEET, "pos", "nombre", "omitido")


def letters(pos):
    """The spreadsheet letters of a position from 0, up to ZZ."""
    a = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return F.concat(F.when(pos >= 26, F.substring(a, (pos / 26).cast("int"), F.lit(1))).otherwise(""), F.substring(a, pos % 26 + 1, F.lit(1)))


def header_warnings(heads: DataFrame) -> DataFrame:
    """(sheet, duplicadas, sin_nombre, omitidas): counts of repeated names, unnamed and withheld columns."""
    name = C.normal_name(F.col("nombre"))
    named = F.count(F.when(F.col("nombre") != "", 1))
    return heads.groupBy(*SHEET).agg((named - F.count_distinct(F.when(F.col("nombre") != "", name))).alias("duplicadas"), F.count_if((F.col("nombre") == "") & ~F.col("omitido")).alias("sin_nombre"), F.count_if("omitido").alias("omitidas"))


def contrast(grid: DataFrame, declared: list[str]) -> DataFrame:
    """(sheet, coincidencias, faltan, sobran, mejor): declared titles against those found in each sheet's header; the
    best sheet of a file recognises most of them, the first by name among equals."""
    title = F.explode(F.array(*[F.lit(d) for d in declared])).alias("titulo")
    want = grid.sparkSession.range(1).select(title).select("titulo", C.normal_name(F.col("titulo")).alias("clave"))
    names = want.agg(F.collect_set("clave").alias("claves"))
    found = headers(grid).filter("nombre <> ''").groupBy(*SHEET).agg(F.collect_set(C.normal_name(F.col("nombre"))).alias("hay"))
    each = grid.select(*SHEET).distinct().join(found, SHEET, "left").withColumn("hay", F.coalesce("hay", F.array().cast("array<string>"))).crossJoin(F.broadcast(names))  # one row
    each = each.select(*SHEET, F.size(F.array_intersect("hay", "claves")).alias("coincidencias"), F.array_except("claves", "hay").alias("faltan"), F.array_except("hay", "claves").alias("sobran"))
    best = each.groupBy("archivo").agg(F.min(F.struct((-F.col("coincidencias")).alias("n"), "hoja"))["hoja"].alias("_hoja"))
    return each.join(best, "archivo").withColumn("mejor", F.col("hoja") == F.col("_hoja")).drop("_hoja")


def inventory(files: DataFrame, grid: DataFrame, declared: list[str]) -> DataFrame:
    """Totals of a delivery: files, sheets, unreadable files, sheets without a clear header, files with and without a
    declared schema. files: (archivo, codigo, legible)."""
    heads = pick_header(grid).agg(F.count("*").alias("hojas"), F.count_if("dudoso").alias("hojas_sin_encabezado_claro"))
    known = F.coalesce(F.col("codigo").isin(declared), F.lit(False))
    totals = files.agg(F.count("*").alias("archivos"), F.count_if(~F.col("legible")).alias("ilegibles"), F.count_if(known).alias("con_esquema"), F.count_if(~known).alias("sin_esquema"))
    return totals.crossJoin(heads)  # single rows
