"""Queries over sheets. The sheets are orders, a sheet for each customer group and status, with titles, totals and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilotrace.operators import grid as R
from kilotrace.queries.registry import query
from kilotrace.sources.domain import sql

#: Cells a to d of each sheet's rows from the third on; blank rows are orders whose number is 0 to 2 modulo 40.
BASE = """SELECT concat('entrega', CAST(o_custkey % 3 AS string), '.xlsx') AS archivo, CASE o_orderstatus WHEN 'F' THEN 'ENERO 2020' WHEN 'O' THEN 'Feb 2021 SUR' ELSE 'Set' END AS hoja,
  CAST(row_number() OVER (PARTITION BY o_custkey % 3, o_orderstatus ORDER BY o_orderkey) + 2 AS int) AS fila, o_orderkey AS k,
  CASE WHEN o_orderkey % 40 < 3 THEN NULL WHEN o_orderkey % 31 = 5 THEN 'Total general' WHEN o_orderkey % 31 = 6 THEN 'CODIGO' ELSE CAST(o_orderkey AS string) END AS a,
  CASE WHEN o_orderkey % 40 < 3 OR o_orderkey % 17 = 9 THEN NULL ELSE CAST(CAST(o_orderdate AS date) AS string) END AS b, CASE WHEN o_orderkey % 40 < 3 THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS bigint) AS string) END AS c,
  CASE WHEN o_orderkey % 40 < 3 THEN NULL ELSE o_orderpriority END AS d FROM orders"""
TITLES = {"CODIGO": "codigo", "FECHA": "fecha", "TOTAL S": "total", "ESTADO": "estado"}
NAMES = ["codigo", "fecha", "total", "estado"]
PATTERN = r"(?i)^([A-Za-z]+)(?: (\d{4}))?(?: ([A-Z]+))?$"


def grid(spark, sf_dir):
    base = sql(spark, sf_dir, BASE)

    def cell(kind: str, value) -> F.Column:
        return F.struct(F.when(value.isNotNull(), F.lit(kind)).alias("t"), value.alias("v"))

    none = F.lit(None).cast("string")
    body = base.select("archivo", "hoja", "fila", F.array(cell("s", F.col("a")), cell("d", F.col("b")), cell("n", F.col("c")), cell("s", F.col("d")), cell("s", none)).alias("celdas"))
    sheets = base.select("archivo", "hoja").distinct()
    text = lambda *v: F.array(*[cell("s", none if x is None else F.lit(x)) for x in v])
    title = sheets.select("archivo", "hoja", F.lit(1).alias("fila"), text("Informe", None, None, None, None).alias("celdas"))
    head = sheets.select("archivo", "hoja", F.lit(2).alias("fila"), text("Código", "Fecha ", "Total S/", "Estado", "codigo").alias("celdas"))
    return title.unionByName(head).unionByName(body)


def varied(spark, sf_dir):
    """Sheets whose headers differ: entrega1 lacks a declared title and has one more; the sheet Set of entrega2 holds
    numbers alone, one of them too long to show."""
    g = grid(spark, sf_dir)
    cell = lambda t, v: F.struct(F.when(F.lit(v is not None), F.lit(t)).alias("t"), F.lit(v).cast("string").alias("v"))
    row = lambda t, *v: F.array(*[cell(t, x) for x in v])
    second, numbers = (F.col("archivo") == "entrega1.xlsx") & (F.col("fila") == 2), (F.col("archivo") == "entrega2.xlsx") & (F.col("hoja") == "Set")
    as_numbers = F.transform("celdas", lambda c: F.struct(F.when(c["v"].isNotNull(), "n").alias("t"), F.when(c["v"].isNotNull(), "7").alias("v")))
    cells = F.when(second, row("s", "Código", "Fecha ", None, "Estado", "Otra cosa")).when(numbers & (F.col("fila") == 2), row("n", "2019", "2020", "12345678", "2021", "2022")).when(numbers & (F.col("fila") > 2), as_numbers).otherwise(F.col("celdas"))
    return g.withColumn("celdas", cells)


#: Which header a sheet of ``varied`` has.
KIND = "CASE WHEN archivo = 'entrega1.xlsx' THEN 'corto' WHEN archivo = 'entrega2.xlsx' AND hoja = 'Set' THEN 'numeros' ELSE 'pleno' END"


def data(spark, sf_dir):
    return R.rows(grid(spark, sf_dir), 2, TITLES)


SHEETS = f"(SELECT DISTINCT archivo, hoja FROM ({BASE}))"


@query("grid_header_map", f"SELECT archivo, hoja, n AS nombre, p::INT AS pos FROM (SELECT *, {KIND} AS k FROM {SHEETS}), (SELECT unnest(['codigo', 'fecha', 'total', 'estado']) AS n, unnest([0, 1, 2, 3]) AS p) WHERE k = 'pleno' OR k = 'corto' AND n <> 'total'")
def grid_header_map(spark, sf_dir):
    return R.header_map(varied(spark, sf_dir), 2, TITLES)


@query("schema_contrast", f"""SELECT archivo, hoja, n AS coincidencias, 5 - n AS faltan, m AS sobran, hoja = first_value(hoja) OVER (PARTITION BY archivo ORDER BY n DESC, hoja) AS mejor FROM (
  SELECT archivo, hoja, CASE {KIND} WHEN 'pleno' THEN 4 WHEN 'corto' THEN 3 ELSE 0 END AS n, CASE {KIND} WHEN 'pleno' THEN 0 WHEN 'corto' THEN 1 ELSE 4 END AS m FROM {SHEETS})""")
def schema_contrast(spark, sf_dir):
    found = R.contrast(varied(spark, sf_dir), ["Código", "Fecha", "Total S/", "Estado", "Zona"])
    return found.select("archivo", "hoja", "coincidencias", F.size("faltan").alias("faltan"), F.size("sobran").alias("sobran"), "mejor")


@query("grid_rows", f"SELECT archivo, hoja, fila, a AS codigo, b AS fecha, c AS total, d AS estado FROM ({BASE}) WHERE coalesce(a, b, c, d) IS NOT NULL")
def grid_rows(spark, sf_dir):
    return R.cut_empty(data(spark, sf_dir), NAMES)


@query("grid_empty_cutoff", f"""SELECT archivo, hoja, count(*) AS efectivas FROM (SELECT b.*, cut FROM ({BASE}) b LEFT JOIN (SELECT archivo, hoja, min(desde) AS cut FROM (SELECT archivo, hoja, run, min(fila) AS desde FROM (
  SELECT archivo, hoja, fila, fila - row_number() OVER (PARTITION BY archivo, hoja ORDER BY fila) AS run FROM ({BASE}) WHERE a IS NULL AND b IS NULL AND c IS NULL AND d IS NULL) GROUP BY archivo, hoja, run HAVING count(*) >= 2) GROUP BY archivo, hoja) USING (archivo, hoja))
  WHERE coalesce(a, b, c, d) IS NOT NULL AND (cut IS NULL OR fila < cut) GROUP BY archivo, hoja""")
def grid_empty_cutoff(spark, sf_dir):
    return R.cut_empty(data(spark, sf_dir), NAMES, 2).groupBy("archivo", "hoja").agg(F.count("*").alias("efectivas"))


@query("sheet_metadata", f"SELECT archivo, hoja, CASE hoja WHEN 'ENERO 2020' THEN 1 WHEN 'Set' THEN 9 ELSE 2 END AS mes, CASE hoja WHEN 'ENERO 2020' THEN 2020 WHEN 'Set' THEN 1999 ELSE 2021 END AS anio, CASE WHEN hoja LIKE '%SUR' THEN 'SUR' END AS empresa FROM {SHEETS}")
def sheet_metadata(spark, sf_dir):
    return R.sheet_metadata(grid(spark, sf_dir).select("archivo", "hoja").distinct(), PATTERN, 1999).select("archivo", "hoja", F.col("_mes").alias("mes"), F.col("_anio").alias("anio"), F.col("_empresa").alias("empresa"))


WHY = f"(SELECT *, CASE WHEN a LIKE 'Total%' THEN 'total' WHEN a = 'CODIGO' THEN 'encabezado' WHEN a IS NULL OR b IS NULL THEN 'incompleta' END AS w FROM ({BASE}) WHERE coalesce(a, b, c, d) IS NOT NULL)"


def marked(spark, sf_dir):
    titles = {v: k for k, v in TITLES.items()}
    return R.discards(R.cut_empty(data(spark, sf_dir), NAMES), ["codigo"], titles, ["codigo", "fecha"])


@query("drop_total_rows", f"SELECT count(*) AS filas FROM {WHY} WHERE w IS DISTINCT FROM 'total'")
def drop_total_rows(spark, sf_dir):
    return marked(spark, sf_dir).filter("descarte is null or descarte <> 'total'").agg(F.count("*").alias("filas"))


@query("drop_repeated_headers", f"SELECT w AS descarte, count(*) AS filas FROM {WHY} WHERE w = 'encabezado' GROUP BY w")
def drop_repeated_headers(spark, sf_dir):
    return marked(spark, sf_dir).filter("descarte = 'encabezado'").groupBy("descarte").agg(F.count("*").alias("filas"))


@query("drop_missing_required", f"SELECT coalesce(w, 'queda') AS descarte, count(*) AS filas FROM {WHY} GROUP BY ALL")
def drop_missing_required(spark, sf_dir):
    return marked(spark, sf_dir).groupBy(F.coalesce("descarte", F.lit("queda")).alias("descarte")).agg(F.count("*").alias("filas"))


@query("control_metrics", f"""SELECT archivo, leidas AS filas_leidas, efectivas AS filas_efectivas, salida AS filas_salida, coalesce(repetidas, 0) AS filas_con_llave_repetida, t AS descarte_total, e AS descarte_encabezado, i AS descarte_incompleta, con_codigo, con_fecha, con_estado, 'ok' AS estado
  FROM (SELECT archivo, count(*) AS leidas FROM ({BASE}) GROUP BY archivo) JOIN (SELECT archivo, count(*) AS efectivas, count(*) FILTER (WHERE w IS NULL) AS salida, count(*) FILTER (WHERE w = 'total') AS t, count(*) FILTER (WHERE w = 'encabezado') AS e, count(*) FILTER (WHERE w = 'incompleta') AS i,
    count(a) AS con_codigo, count(b) AS con_fecha, count(d) AS con_estado FROM {WHY} GROUP BY archivo) USING (archivo)
  LEFT JOIN (SELECT archivo, sum(n) FILTER (WHERE n > 1)::BIGINT AS repetidas FROM (SELECT archivo, d, c, count(*) AS n FROM {WHY} WHERE w IS NULL GROUP BY archivo, d, c) GROUP BY archivo) USING (archivo)""")
def control_metrics(spark, sf_dir):
    return R.control(data(spark, sf_dir), marked(spark, sf_dir), "archivo", ["estado", "total"], ["codigo", "fecha", "estado"], ["total", "encabezado", "incompleta"])


@query("pick_header_row", f"SELECT archivo, hoja, 2 AS fila, {KIND} = 'numeros' AS dudoso FROM {SHEETS}")
def pick_header_row(spark, sf_dir):
    return R.pick_header(varied(spark, sf_dir))


@query("detect_identifier", """SELECT c_custkey, regexp_matches(t, '\\d{8,}') OR regexp_matches(t, '(?i)(\\bS\\.A\\.C?\\.?|\\bE\\.I\\.R\\.L\\.?|\\bS\\.R\\.L\\.?|\\sS\\.?A\\.?C?\\.?\\s*$)') OR (length(t) <= 9 AND regexp_full_match(t, '[A-Za-z0-9]{2,4}[-\\s][A-Za-z0-9]{2,4}') AND regexp_matches(t, '\\d') AND regexp_matches(t, '[A-Za-z]')) AS dudoso FROM (
  SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Gas S.A.C.' WHEN 1 THEN concat('T1A-', CAST(c_custkey AS string)) WHEN 2 THEN concat('2060', CAST(10000 + c_custkey AS string)) WHEN 3 THEN 'Código' ELSE c_name END AS t FROM customer)""")
def detect_identifier(spark, sf_dir):
    t = "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Gas S.A.C.' WHEN 1 THEN concat('T1A-', CAST(c_custkey AS string)) WHEN 2 THEN concat('2060', CAST(10000 + c_custkey AS string)) WHEN 3 THEN 'Código' ELSE c_name END AS t FROM customer"
    return sql(spark, sf_dir, t).select("c_custkey", R.looks_identifying(F.col("t")).alias("dudoso"))


HEADS = """(SELECT 'pleno' AS k, unnest(['Código', 'Fecha', 'Total S/', 'Estado', 'codigo']) AS nombre, unnest([0, 1, 2, 3, 4]) AS pos, false AS omitido UNION ALL SELECT 'corto', unnest(['Código', 'Fecha', '', 'Estado', 'Otra cosa']), unnest([0, 1, 2, 3, 4]), false
  UNION ALL SELECT 'numeros', unnest(['2019', '2020', '', '2021', '2022']), unnest([0, 1, 2, 3, 4]), unnest([false, false, true, false, false]))"""


@query("publishable_header", f"SELECT archivo, hoja, pos::INT AS pos, nombre, omitido, substr('ABCDE', pos + 1, 1) AS columna FROM (SELECT *, {KIND} AS k FROM {SHEETS}) JOIN {HEADS} USING (k)")
def publishable_header(spark, sf_dir):
    return R.headers(varied(spark, sf_dir)).withColumn("columna", R.letters(F.col("pos")))


@query("header_warnings", f"SELECT archivo, hoja, ({KIND} = 'pleno')::INT AS duplicadas, ({KIND} = 'corto')::INT AS sin_nombre, ({KIND} = 'numeros')::INT AS omitidas FROM {SHEETS}")
def header_warnings(spark, sf_dir):
    return R.header_warnings(R.headers(varied(spark, sf_dir)))


@query("inventory_summary", f"""SELECT count(DISTINCT archivo) + 1 AS archivos, 1::BIGINT AS ilegibles, count(DISTINCT archivo) - 1 AS con_esquema, 2::BIGINT AS sin_esquema, count(DISTINCT (archivo, hoja)) AS hojas, count(DISTINCT (archivo, hoja)) FILTER (WHERE {KIND} = 'numeros') AS hojas_sin_encabezado_claro FROM ({BASE})""")
def inventory_summary(spark, sf_dir):
    """One file more, that can't be read; of the others the first has no declared schema."""
    g = varied(spark, sf_dir)
    files = g.select("archivo").distinct().select("archivo", F.when(F.col("archivo") != "entrega0.xlsx", "aba_02").alias("codigo"), F.lit(True).alias("legible"))
    return R.inventory(files.union(spark.createDataFrame([("roto.xlsx", "otro", False)], files.schema)), g, ["aba_02", "com_19"])
