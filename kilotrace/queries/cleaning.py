"""Queries that apply the cleaning functions to identifiers, quantities, dates and text made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilotrace.functions import clean as C
from kilotrace.queries.registry import query
from kilotrace.sources.domain import sql, table

RAW_PLATE = """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7
  WHEN 0 THEN placa WHEN 1 THEN concat(substr(placa, 1, 3), '-', substr(placa, 4)) WHEN 2 THEN concat(lower(substr(placa, 1, 3)), ' ', substr(placa, 4), ' 15/07/2023')
  WHEN 3 THEN concat('  ', placa, ' ') WHEN 4 THEN concat(placa, ' CAMION (24/7/23)') WHEN 5 THEN 'PLANTA  norte' ELSE NULL END AS celda FROM lineas"""
_DATE = r"'\d{2}/\d{2}/\d{4}'"


@query("plate_v2", f"""SELECT l_orderkey, l_linenumber, CASE WHEN regexp_full_match(p, '[A-Z0-9]{{6}}') THEN p END AS placa, nullif(regexp_extract(upper(celda), {_DATE}), '') AS fecha_texto
  FROM (SELECT *, regexp_replace(regexp_replace(upper(celda), {_DATE}, '', 'g'), '[^A-Z0-9]', '', 'g') AS p FROM ({RAW_PLATE}))""")
def plate_v2(spark, sf_dir):
    placa, fecha = C.plate(F.col("celda"))
    return sql(spark, sf_dir, RAW_PLATE).select("l_orderkey", "l_linenumber", placa.alias("placa"), fecha.alias("fecha_texto"))


@query("plate_v6", rf"""SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN replace(tight, '-', '') END AS placa,
  CASE WHEN ok THEN nullif(regexp_extract(upper(celda), '\d{{1,2}}/\d{{1,2}}/\d{{2,4}}'), '') END AS fecha_texto,
  CASE WHEN NOT ok THEN nullif(trim(regexp_replace(loose, '\s+', ' ', 'g')), '') END AS centro_costo
  FROM (SELECT *, regexp_full_match(tight, '[A-Z0-9]{{3}}-?[0-9]{{3}}') AS ok FROM (
    SELECT *, regexp_replace(regexp_replace(loose, '\s+', '', 'g'), '{C.VEHICLES}$', '') AS tight FROM (
      SELECT *, regexp_replace(regexp_replace(trim(upper(celda)), '\(.*?\)', '', 'g'), '\d{{1,2}}/\d{{1,2}}/\d{{2,4}}', '', 'g') AS loose FROM ({RAW_PLATE}))))""")
def plate_v6(spark, sf_dir):
    placa, fecha, centro = C.plate6(F.col("celda"))
    return sql(spark, sf_dir, RAW_PLATE).select("l_orderkey", "l_linenumber", placa.alias("placa"), fecha.alias("fecha_texto"), centro.alias("centro_costo"))


DIGITS = r"regexp_replace(regexp_replace(trim(coalesce(documento_raw, '')), '^(\d+)\.0+$', '\1'), '\D', '', 'g')"
CHECK = "CASE WHEN length(d) = 11 THEN 11 - (" + " + ".join(f"try_cast(substr(d, {i + 1}, 1) AS INT) * {w}" for i, w in enumerate(C.RUC_WEIGHTS)) + ") % 11 END"
DOCUMENT = f"""SELECT card_code, documento_raw, d, coalesce(length(d) = 11 AND (CASE dv WHEN 10 THEN 0 WHEN 11 THEN 1 ELSE dv END) = try_cast(substr(d, 11, 1) AS INT), false) AS ruc_ok
  FROM (SELECT *, {CHECK} AS dv FROM (SELECT card_code, documento_raw, {DIGITS} AS d FROM maestro))"""


@query("digits_only", f"SELECT card_code, {DIGITS} AS digitos FROM maestro")
def digits_only(spark, sf_dir):
    return table(spark, sf_dir, "maestro").select("card_code", C.digits(F.col("documento_raw")).alias("digitos"))


@query("ruc_check", f"SELECT card_code, ruc_ok AS ruc_valido FROM ({DOCUMENT})")
def ruc_check(spark, sf_dir):
    return table(spark, sf_dir, "maestro").select("card_code", C.ruc_valid(F.col("documento_raw")).alias("ruc_valido"))


@query("dni_pad", f"SELECT card_code, CASE WHEN d <> '' AND length(d) <= 8 THEN lpad(d, 8, '0') END AS dni FROM ({DOCUMENT})")
def dni_pad(spark, sf_dir):
    return table(spark, sf_dir, "maestro").select("card_code", C.dni(F.col("documento_raw")).alias("dni"))


CLASSIFIED = f"""SELECT *, CASE WHEN clase = 'DNI' THEN lpad(d, 8, '0') WHEN clase <> 'VACIO' THEN d END AS documento_norm FROM (
  SELECT *, CASE WHEN d = '' THEN 'VACIO' WHEN ruc_ok THEN 'RUC' WHEN length(d) <= 8 THEN 'DNI' ELSE 'INVALIDO' END AS clase FROM ({DOCUMENT}))"""


@query("classify_document", f"SELECT card_code, documento_norm, clase AS clase_documento FROM ({CLASSIFIED})")
def classify_document(spark, sf_dir):
    doc, kind = C.document(F.col("documento_raw"))
    return table(spark, sf_dir, "maestro").select("card_code", doc.alias("documento_norm"), kind.alias("clase_documento"))


@query("pseudonymize", "SELECT c_custkey, substr(sha256(concat('sal', upper(trim(c_name)))), 1, 16) AS seudonimo FROM customer")
def pseudonymize(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", C.pseudonym(F.col("c_name"), "sal").alias("seudonimo"))


RAW_STATE = "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN ' atendida ' WHEN 1 THEN 'Anulado' WHEN 2 THEN 'baja  de oficio' WHEN 3 THEN 'no hábido' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'pendiente' ELSE o_orderpriority END AS celda FROM orders"


@query("status_catalog", "SELECT o_orderkey, CASE WHEN s = '' THEN NULL ELSE CASE s " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.STATES.items()) + rf" WHEN NULL THEN NULL ELSE CASE WHEN s IS NOT NULL THEN 'OTRO' END END END AS estado FROM (SELECT o_orderkey, upper(trim(regexp_replace(strip_accents(celda), '\s+', ' ', 'g'))) AS s FROM ({RAW_STATE}))")
def status_catalog(spark, sf_dir):
    return sql(spark, sf_dir, RAW_STATE).select("o_orderkey", C.state(F.col("celda")).alias("estado"))


RAW_KG = """SELECT l_orderkey, l_linenumber, CASE l_orderkey % 9 WHEN 0 THEN concat(CAST(l_partkey AS string), ' kg') WHEN 1 THEN concat('1,', lpad(CAST(l_partkey % 1000 AS string), 3, '0'), '.5')
  WHEN 2 THEN concat(CAST(l_partkey AS string), ',5') WHEN 3 THEN concat('1,', lpad(CAST(l_partkey % 1000 AS string), 3, '0')) WHEN 4 THEN 'FALSO' WHEN 5 THEN '5 000 kg' WHEN 6 THEN '1e3' WHEN 7 THEN 'n.d.' ELSE NULL END AS celda FROM lineas"""
KG = r"""CASE WHEN upper(trim(celda)) IN ('TRUE', 'FALSE', 'VERDADERO', 'FALSO', '') THEN NULL WHEN contains(k, ',') AND contains(k, '.') THEN try_cast(replace(k, ',', '') AS DOUBLE)
  WHEN length(k) - length(replace(k, ',', '')) = 1 AND length(split_part(k, ',', 2)) <> 3 THEN try_cast(replace(k, ',', '.') AS DOUBLE) ELSE try_cast(replace(k, ',', '') AS DOUBLE) END"""
CUT = r"(SELECT *, regexp_replace(upper(trim(celda)), '[A-Z\s]', '', 'g') AS k FROM ({}))"


@query("to_kg", f"SELECT l_orderkey, l_linenumber, {KG} AS kg FROM {CUT.format(RAW_KG)}")
def to_kg(spark, sf_dir):
    return sql(spark, sf_dir, RAW_KG).select("l_orderkey", "l_linenumber", C.to_kg(F.col("celda")).alias("kg"))


@query("numeric_strict", f"SELECT l_orderkey, l_linenumber, coalesce(try_cast(trim(celda) AS DOUBLE), {KG}) AS numero FROM {CUT.format(RAW_KG)}")
def numeric_strict(spark, sf_dir):
    return sql(spark, sf_dir, RAW_KG).select("l_orderkey", "l_linenumber", C.number_or_kg(F.col("celda")).alias("numero"))


RAW_BOOL = "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'sí' WHEN 1 THEN ' no' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'vencido' WHEN 5 THEN 'x' WHEN 6 THEN NULL ELSE 'quizá' END AS celda FROM orders"


@query("to_bool", f"SELECT o_orderkey, CASE WHEN s IN ('SI', 'S', 'TRUE', '1', 'X', 'VIGENTE') THEN true WHEN s IN ('NO', 'N', 'FALSE', '0', 'VENCIDO') THEN false END AS valor FROM (SELECT o_orderkey, upper(trim(strip_accents(celda))) AS s FROM ({RAW_BOOL}))")
def to_bool(spark, sf_dir):
    return sql(spark, sf_dir, RAW_BOOL).select("o_orderkey", C.to_bool(F.col("celda")).alias("valor"))


@query("is_adjustment_entry", "SELECT fecha, produccion < 0 AND abs(produccion + stock_inicial) < 1e-6 AS ajuste FROM produccion")
def is_adjustment_entry(spark, sf_dir):
    return table(spark, sf_dir, "produccion").select("fecha", C.adjustment(F.col("produccion"), F.col("stock_inicial")).alias("ajuste"))


RAW_BLANK = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' #n/a ' WHEN 1 THEN '  ' WHEN 2 THEN NULL WHEN 3 THEN '#REF!' ELSE o_orderstatus END AS celda FROM orders"


@query("blank_or_excel_error", f"SELECT o_orderkey, celda IS NULL OR trim(celda) = '' OR upper(trim(celda)) IN ('#VALUE!', '#N/A', '#REF!', '#DIV/0!', '#NAME?', '#NULL!', '#NUM!') AS vacia FROM ({RAW_BLANK})")
def blank_or_excel_error(spark, sf_dir):
    return sql(spark, sf_dir, RAW_BLANK).select("o_orderkey", C.blank(F.col("celda")).alias("vacia"))


RAW_CELL = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'n' WHEN 1 THEN 'd' WHEN 2 THEN 'b' ELSE 's' END AS t,
  CASE o_orderkey % 6 WHEN 0 THEN CASE WHEN o_orderkey % 12 = 0 THEN concat(CAST(o_custkey AS string), '.0') ELSE concat(CAST(o_custkey AS string), '.25') END
  WHEN 1 THEN CAST(CAST(o_orderdate AS date) AS string) WHEN 2 THEN 'true' WHEN 3 THEN concat('S/ ', CAST(o_custkey AS string), '.50') WHEN 4 THEN concat('  a   b ', o_orderstatus) ELSE '12/05/2020 x' END AS v FROM orders"""


@query("cell_text", rf"SELECT o_orderkey, CASE t WHEN 'n' THEN regexp_replace(v, '^(-?\d+)\.0+$', '\1') WHEN 'd' THEN strftime(CAST(v AS DATE), '%d/%m/%Y') ELSE trim(regexp_replace(v, '\s+', ' ', 'g')) END AS texto FROM ({RAW_CELL})")
def cell_text(spark, sf_dir):
    return sql(spark, sf_dir, RAW_CELL).select("o_orderkey", C.cell_text(F.col("t"), F.col("v")).alias("texto"))


@query("cell_type", rf"""SELECT o_orderkey, CASE WHEN trim(v) = '' THEN 'vacia' WHEN t = 'b' THEN 'texto' WHEN t = 'd' THEN 'fecha' WHEN t = 'n' THEN 'numero'
  WHEN try_cast(translate(trim(v), ' S/$%()'',', '') AS DOUBLE) IS NOT NULL THEN 'numero' WHEN regexp_matches(v, '^\d{{1,4}}[-/]\d{{1,2}}[-/]\d{{1,4}}') THEN 'fecha' ELSE 'texto' END AS tipo FROM ({RAW_CELL})""")
def cell_type(spark, sf_dir):
    return sql(spark, sf_dir, RAW_CELL).select("o_orderkey", C.cell_type(F.col("t"), F.col("v")).alias("tipo"))


RAW_MONTH = """SELECT o_orderkey, CASE o_orderkey % 16 WHEN 0 THEN '09' WHEN 1 THEN 'Setiembre' WHEN 2 THEN 'set' WHEN 3 THEN '13' WHEN 4 THEN 'ma' WHEN 5 THEN 'MAR' WHEN 6 THEN 'may' WHEN 7 THEN NULL
  WHEN 8 THEN 'ju' WHEN 9 THEN 'jul' WHEN 10 THEN 'Septiembre' WHEN 11 THEN 'sep' WHEN 12 THEN ' enero ' WHEN 13 THEN 'dic' WHEN 14 THEN '#N/A' ELSE CAST(month(o_orderdate) AS string) END AS celda FROM orders"""


@query("month_number", "SELECT o_orderkey, CASE WHEN celda IS NULL OR upper(trim(celda)) LIKE '#%' THEN NULL WHEN regexp_full_match(s, '[0-9]+') AND try_cast(s AS INT) BETWEEN 1 AND 12 THEN try_cast(s AS INT) "
    + " ".join(f"WHEN s = '{m}' OR (length(s) >= 3 AND starts_with('{m}', s)) THEN {n}" for m, n in C.MONTHS.items()) + f" END AS mes FROM (SELECT *, upper(trim(celda)) AS s FROM ({RAW_MONTH}))")
def month_number(spark, sf_dir):
    return sql(spark, sf_dir, RAW_MONTH).select("o_orderkey", C.month_number(F.col("celda")).alias("mes"))


RAW_DATE = """SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN 'n' ELSE 's' END AS t,
  CASE o_orderkey % 8 WHEN 0 THEN CAST(35000 + o_custkey AS string) WHEN 1 THEN concat(CAST(day(o_orderdate) AS string), '/', CAST(month(o_orderdate) AS string), '/', CAST(year(o_orderdate) AS string))
  WHEN 2 THEN concat(lpad(CAST(day(o_orderdate) AS string), 2, '0'), '/', lpad(CAST(month(o_orderdate) AS string), 2, '0'), '/', CASE WHEN o_orderkey % 16 = 2 THEN '95' ELSE '23' END)
  WHEN 3 THEN CAST(CAST(o_orderdate AS date) AS string) WHEN 4 THEN concat(CAST(CAST(o_orderdate AS date) AS string), ' 10:11:12') WHEN 5 THEN '31/02/2020' WHEN 6 THEN '44607'
  ELSE concat(lpad(CAST(day(o_orderdate) AS string), 2, '0'), '.', lpad(CAST(month(o_orderdate) AS string), 2, '0'), '.', CAST(year(o_orderdate) AS string)) END AS v FROM orders"""


@query("to_date_multi", f"""SELECT o_orderkey, CASE WHEN t = 'n' THEN CASE WHEN try_cast(v AS DOUBLE) > 20000 AND try_cast(v AS DOUBLE) < 80000 THEN DATE '1899-12-30' + CAST(v AS INT) END
  WHEN regexp_full_match(v, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN CAST(try_strptime(v, '%d/%m/%Y') AS DATE)
  WHEN regexp_full_match(v, '\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}') THEN CAST(try_strptime(v, '%d/%m/%y') AS DATE)
  WHEN regexp_full_match(v, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(try_strptime(v, '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match(v, '\\d{{4}}-\\d{{2}}-\\d{{2}} .*') THEN CAST(try_strptime(v, '%Y-%m-%d %H:%M:%S') AS DATE) ELSE CAST(try_strptime(v, '%d.%m.%Y') AS DATE) END AS fecha FROM ({RAW_DATE})""")
def to_date_multi(spark, sf_dir):
    return sql(spark, sf_dir, RAW_DATE).select("o_orderkey", C.to_date(F.col("t"), F.col("v")).alias("fecha"))


RAW_SWAP = "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS date) AS fecha, CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate) END AS int) AS a, CAST(CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN month(o_orderdate) WHEN 2 THEN day(o_orderdate) ELSE 12 END AS int) AS m FROM orders"


@query("fix_swapped_date", f"""SELECT o_orderkey, estado, CASE WHEN estado = 'invertida' THEN make_date(year(fecha), day(fecha), month(fecha)) ELSE fecha END AS fecha FROM (
  SELECT *, CASE WHEN fecha IS NULL THEN 'sin_fecha' WHEN m IS NULL OR (month(fecha) = m AND (a IS NULL OR a = year(fecha))) THEN 'ok'
  WHEN day(fecha) <= 12 AND day(fecha) = m AND (a IS NULL OR a = year(fecha)) THEN 'invertida' ELSE 'discrepa' END AS estado FROM ({RAW_SWAP}))""")
def fix_swapped_date(spark, sf_dir):
    date, how = C.unswapped(F.col("fecha"), F.col("a"), F.col("m"))
    return sql(spark, sf_dir, RAW_SWAP).select("o_orderkey", how.alias("estado"), date.alias("fecha"))


@query("fx_valid", "SELECT documento, linea, coalesce(t BETWEEN 3.2 AND 4.2, false) AS tc_valido FROM (SELECT documento, linea, CASE WHEN linea = 3 THEN NULL WHEN linea = 4 THEN 1 ELSE tipo_cambio END AS t FROM compras)")
def fx_valid(spark, sf_dir):
    t = F.when(F.col("linea") == 3, None).when(F.col("linea") == 4, F.lit(1.0)).otherwise(F.col("tipo_cambio"))
    return table(spark, sf_dir, "compras").select("documento", "linea", C.rate_valid(t).alias("tc_valido"))


RAW_UNIT = """SELECT p_partkey, p_retailprice AS cantidad, CASE p_partkey % 7 WHEN 0 THEN 'kilos' WHEN 1 THEN 'GALÓN' WHEN 2 THEN 'lt' WHEN 3 THEN 'Unidad' WHEN 4 THEN 'BAL' WHEN 5 THEN 'caja' ELSE NULL END AS unidad,
  CASE p_partkey % 5 WHEN 0 THEN 'GLP ENVASE DE 10 KLG' WHEN 1 THEN 'balón BL45' WHEN 2 THEN 'GLP 115 KG' WHEN 3 THEN 'glp 5 kilos' ELSE p_name END AS descripcion FROM part"""
PACKAGE = r"coalesce(try_cast(nullif(regexp_extract(upper(strip_accents(descripcion)), '(^|[^0-9])(5|10|15|45)\s*(KGS?|KLGS?|KILOS?)\b', 2), '') AS DOUBLE), try_cast(nullif(regexp_extract(upper(strip_accents(descripcion)), '\bBL?(05|10|15|45)\b', 1), '') AS DOUBLE))"


@query("package_kg", f"SELECT p_partkey, {PACKAGE} AS kg FROM ({RAW_UNIT})")
def package_kg(spark, sf_dir):
    return sql(spark, sf_dir, RAW_UNIT).select("p_partkey", C.package_kg(F.col("descripcion")).alias("kg"))


@query("units_to_kg", rf"SELECT p_partkey, CASE WHEN regexp_matches(u, '^(KILO|KG|KLG)') THEN cantidad WHEN u LIKE 'GAL%' THEN cantidad * 2.04 WHEN regexp_matches(u, '^(LITRO|LT)') THEN cantidad * 0.54 WHEN regexp_matches(u, '^(UNID|UND|BAL)') THEN cantidad * {PACKAGE} END AS kg FROM (SELECT *, upper(strip_accents(coalesce(unidad, ''))) AS u FROM ({RAW_UNIT}))")
def units_to_kg(spark, sf_dir):
    return sql(spark, sf_dir, RAW_UNIT).select("p_partkey", C.units_to_kg(F.col("unidad"), F.col("cantidad"), F.col("descripcion")).alias("kg"))


RAW_LINE = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ' Total general' WHEN 1 THEN 'Subtotal' WHEN 2 THEN 'GLP a granel' WHEN 3 THEN 'suma de GLPS' ELSE p_name END AS celda FROM part"


@query("is_total_row_is_lpg", rf"SELECT p_partkey, regexp_matches(upper(strip_accents(trim(celda))), '^(TOTAL|SUBTOTAL|SUMA )') AS total, regexp_matches(upper(strip_accents(celda)), '\bGLP\b') AS glp FROM ({RAW_LINE})")
def is_total_row_is_lpg(spark, sf_dir):
    return sql(spark, sf_dir, RAW_LINE).select("p_partkey", C.is_total(F.col("celda")).alias("total"), C.is_lpg(F.col("celda")).alias("glp"))


@query("is_total_row", f"SELECT p_partkey, regexp_matches(upper(strip_accents(trim(celda))), '^(TOTAL|SUBTOTAL|SUMA )') AS total FROM ({RAW_LINE})")
def is_total_row(spark, sf_dir):
    return sql(spark, sf_dir, RAW_LINE).select("p_partkey", C.is_total(F.col("celda")).alias("total"))


@query("is_lpg", rf"SELECT p_partkey, regexp_matches(upper(strip_accents(celda)), '\bGLP\b') AS glp FROM ({RAW_LINE})")
def is_lpg(spark, sf_dir):
    return sql(spark, sf_dir, RAW_LINE).select("p_partkey", C.is_lpg(F.col("celda")).alias("glp"))


RAW_NAME = "SELECT p_partkey, concat('Código  N° ', p_name, ' / ', lower(p_type), '#.v', CAST(p_size AS string)) AS celda FROM part"


@query("normalize_header", rf"SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(strip_accents(celda)), '[^A-Z0-9#]', ' ', 'g'), '\s+', ' ', 'g')) AS titulo FROM ({RAW_NAME})")
def normalize_header(spark, sf_dir):
    return sql(spark, sf_dir, RAW_NAME).select("p_partkey", C.normal_header(F.col("celda")).alias("titulo"))


@query("normalize_name", rf"SELECT p_partkey, upper(trim(regexp_replace(strip_accents(celda), '\s+', ' ', 'g'))) AS nombre FROM ({RAW_NAME})")
def normalize_name(spark, sf_dir):
    return sql(spark, sf_dir, RAW_NAME).select("p_partkey", C.normal_name(F.col("celda")).alias("nombre"))


RAW_FILE = "SELECT page_id, concat('entrega/', url, ' COMPRAS Ñandú (', CAST(page_id % 3 AS string), ').XLSX') AS archivo FROM pages"


@query("file_slug", rf"SELECT page_id, trim(regexp_replace(lower(strip_accents(regexp_replace(regexp_replace(archivo, '^.*/', ''), '\.[^.]*$', ''))), '[^a-z0-9]+', '_', 'g'), '_') AS codigo FROM ({RAW_FILE})")
def file_slug(spark, sf_dir):
    return sql(spark, sf_dir, RAW_FILE).select("page_id", C.file_slug(F.col("archivo")).alias("codigo"))


@query("year_month", "SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS anio, CAST(month(l_shipdate) AS INT) AS mes FROM lineitem")
def year_month(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("anio"), F.month("l_shipdate").alias("mes"))


@query("classify_texts", "SELECT doc_id, regexp_matches(lower(text), 'licensed|license') AS licencia, regexp_matches(lower(text), '[a-z0-9._]+@[a-z0-9.]+') AS correo, CASE WHEN regexp_matches(lower(text), 'worthless|idiot|stupid') THEN 'queja' ELSE 'otro' END AS tema FROM documents")
def classify_texts(spark, sf_dir):
    low = F.lower("text")
    theme = F.when(low.rlike("worthless|idiot|stupid"), "queja").otherwise("otro")
    return table(spark, sf_dir, "documents").select("doc_id", low.rlike("licensed|license").alias("licencia"), low.rlike("[a-z0-9._]+@[a-z0-9.]+").alias("correo"), theme.alias("tema"))
