"""Queries of quality rules, reports and baseline statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilotrace.functions import clean as C
from kilotrace.operators import gold as G
from kilotrace.operators import quality as Q
from kilotrace.queries.cleaning import CHECK, DIGITS, RAW_KG
from kilotrace.queries.registry import query
from kilotrace.sources.domain import YEARS, sql, table

SCOPE = (YEARS[0] + 1, YEARS[1] - 1)
IN_SCOPE = f"year(fecha) BETWEEN {SCOPE[0]} AND {SCOPE[1]}"


@query("rule_plate_valid", "SELECT count(*) AS filas, count(placa_cargada) AS cumplen FROM compras")
def rule_plate_valid(spark, sf_dir):
    return table(spark, sf_dir, "compras").agg(F.count("*").alias("filas"), F.count("placa_cargada").alias("cumplen"))


@query("rule_kg_range", "SELECT documento, linea, kg, kg > 0 AND (capacidad_kg IS NULL OR kg <= capacidad_kg) AS en_rango FROM compras LEFT JOIN flota ON placa_cargada = placa_norm")
def rule_kg_range(spark, sf_dir):
    cap = table(spark, sf_dir, "flota").select(F.col("placa_norm").alias("placa_cargada"), "capacidad_kg")
    c = table(spark, sf_dir, "compras").join(cap, "placa_cargada", "left")
    return c.select("documento", "linea", "kg", Q.kg_in_range(F.col("kg"), F.col("capacidad_kg")).alias("en_rango"))


@query("rule_date_scope", f"SELECT documento, linea, {IN_SCOPE} AS en_alcance FROM compras")
def rule_date_scope(spark, sf_dir):
    return table(spark, sf_dir, "compras").select("documento", "linea", Q.date_in_scope(F.col("fecha"), *SCOPE).alias("en_alcance"))


@query("scope_filter", f"SELECT count(*) AS filas, sum(kg) AS kg FROM compras WHERE {IN_SCOPE}")
def scope_filter(spark, sf_dir):
    return table(spark, sf_dir, "compras").filter(Q.date_in_scope(F.col("fecha"), *SCOPE)).agg(F.count("*").alias("filas"), F.sum("kg").alias("kg"))


@query("rule_fx_coherent", "SELECT c.documento, c.linea, t.tc_oficial IS NULL OR abs(tipo_cambio - tc_oficial) / tc_oficial <= 0.01 AS coherente FROM compras c LEFT JOIN tc t USING (fecha)")
def rule_fx_coherent(spark, sf_dir):
    c = table(spark, sf_dir, "compras").join(table(spark, sf_dir, "tc"), "fecha", "left")
    return c.select("documento", "linea", Q.rate_coherent(F.col("tipo_cambio"), F.col("tc_oficial")).alias("coherente"))


KG_AS_PRICE = "SELECT documento, linea, kg AS precio, CASE WHEN linea = 7 THEN NULL ELSE canal END AS canal, id_producto, anio, mes FROM ventas"


@query("rule_price_range", f"""SELECT documento, linea, precio, precio IS NULL OR (canal IS NOT NULL AND precio BETWEEN lo AND hi) AS en_rango FROM (
  SELECT *, quantile_cont(precio, 0.01) OVER w AS lo, quantile_cont(precio, 0.99) OVER w AS hi FROM ({KG_AS_PRICE}) WINDOW w AS (PARTITION BY canal, id_producto, anio, mes))""")
def rule_price_range(spark, sf_dir):
    return Q.price_in_range(sql(spark, sf_dir, KG_AS_PRICE), name="en_rango").select("documento", "linea", "precio", "en_rango")


ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax, fecha, l_returnflag"


@query("rule_unique", f"SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER}) = 1 AS unico FROM lineas")
def rule_unique(spark, sf_dir):
    return Q.first_of(table(spark, sf_dir, "lineas"), ["l_orderkey", "l_linenumber"], ORDER.split(", ")).select("l_orderkey", "l_linenumber", "l_partkey", "unico")


@query("dup_first_dup_all", f"SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER}) > 1 AS posterior, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS repetida FROM lineas")
def dup_first_dup_all(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    out = Q.repeated(Q.first_of(table(spark, sf_dir, "lineas"), key, ORDER.split(", ")), key, "repetida")
    return out.select(*key, "l_partkey", (~F.col("unico")).alias("posterior"), "repetida")


@query("dup_first", f"SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER}) AS r FROM lineas) WHERE r > 1")
def dup_first(spark, sf_dir):
    return Q.first_of(table(spark, sf_dir, "lineas"), ["l_orderkey", "l_linenumber"], ORDER.split(", ")).filter("not unico").select("l_orderkey", "l_linenumber", "l_partkey")


@query("dup_all", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineas) WHERE n > 1")
def dup_all(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    return Q.repeated(table(spark, sf_dir, "lineas"), key).filter("llave_repetida").select(*key, "l_partkey")


REGISTRY = f"SELECT DISTINCT {DIGITS} AS ruc FROM maestro WHERE CAST(card_code AS int) % 2 = 1"


def registry(spark, sf_dir):
    m = table(spark, sf_dir, "maestro").filter(F.col("card_code").cast("int") % 2 == 1)
    return m.select(C.digits(F.col("documento_raw")).alias("ruc")).distinct()


@query("rule_ruc_exists", f"SELECT card_code, d IN (SELECT ruc FROM ({REGISTRY})) AS existe FROM (SELECT card_code, {DIGITS} AS d FROM maestro)")
def rule_ruc_exists(spark, sf_dir):
    m = table(spark, sf_dir, "maestro").select("card_code", C.digits(F.col("documento_raw")).alias("ruc"))
    return m.join(registry(spark, sf_dir).withColumn("existe", F.lit(True)), "ruc", "left").select("card_code", F.coalesce("existe", F.lit(False)).alias("existe"))


@query("registry_semi", f"SELECT card_code FROM (SELECT card_code, {DIGITS} AS ruc FROM maestro) WHERE ruc IN (SELECT ruc FROM ({REGISTRY}))")
def registry_semi(spark, sf_dir):
    m = table(spark, sf_dir, "maestro").select("card_code", C.digits(F.col("documento_raw")).alias("ruc"))
    return m.join(registry(spark, sf_dir), "ruc", "left_semi").select("card_code")


OK_RUC = "coalesce(length(d) = 11 AND (CASE dv WHEN 10 THEN 0 WHEN 11 THEN 1 ELSE dv END) = try_cast(substr(d, 11, 1) AS INT), false)"


@query("maestro_con_sunat", f"SELECT card_code, CASE WHEN NOT {OK_RUC} THEN 'INVALIDO' WHEN d IN (SELECT ruc FROM ({REGISTRY})) THEN 'VALIDO' ELSE 'INEXISTENTE' END AS clase FROM (SELECT *, {CHECK} AS dv FROM (SELECT card_code, {DIGITS} AS d FROM maestro))")
def maestro_con_sunat(spark, sf_dir):
    m = table(spark, sf_dir, "maestro").select("card_code", C.digits(F.col("documento_raw")).alias("ruc"), C.ruc_valid(F.col("documento_raw")).alias("ok"))
    m = m.join(registry(spark, sf_dir).withColumn("hay", F.lit(True)), "ruc", "left")
    return m.select("card_code", F.when(~F.col("ok"), "INVALIDO").when(F.col("hay"), "VALIDO").otherwise("INEXISTENTE").alias("clase"))


@query("quality_report", f"""SELECT regla, cumplen, n - cumplen AS fallan, round_even(cumplen / n, 4) AS tasa, meta, cumplen / n >= meta AS cumple_meta FROM (
  SELECT 'placa_valida' AS regla, count(placa_cargada) AS cumplen, count(*) AS n, 0.98::DOUBLE AS meta FROM compras UNION ALL SELECT 'kg_en_rango', count(*) FILTER (WHERE kg > 3), count(*), 0.99 FROM compras
  UNION ALL SELECT 'fecha_coherente', count(*) FILTER (WHERE {IN_SCOPE}), count(*), NULL FROM compras)""")
def quality_report(spark, sf_dir):
    rules = {"placa_valida": F.col("placa_cargada").isNotNull(), "kg_en_rango": F.col("kg") > 3, "fecha_coherente": Q.date_in_scope(F.col("fecha"), *SCOPE)}
    return Q.report(table(spark, sf_dir, "compras"), rules)


@query("completeness", "SELECT 'codigo_scop' AS campo, round_even(count(codigo_scop) / count(*), 4) AS completitud FROM compras UNION ALL SELECT 'kg', round_even(count(kg) / count(*), 4) FROM compras")
def completeness(spark, sf_dir):
    return Q.completeness(table(spark, sf_dir, "compras"), ["codigo_scop", "kg"])


@query("conversion_report", f"SELECT 'celda' AS campo, count(celda) - count(try_cast(celda AS DOUBLE)) AS perdidas FROM ({RAW_KG})")
def conversion_report(spark, sf_dir):
    return Q.conversion_report(sql(spark, sf_dir, RAW_KG), {"celda": "double"})


@query("apply_declared_schema", f"SELECT l_orderkey AS orden, try_cast(celda AS DOUBLE) AS kg FROM ({RAW_KG})")
def apply_declared_schema(spark, sf_dir):
    return Q.declared(sql(spark, sf_dir, RAW_KG), {"l_orderkey": ("orden", "long"), "celda": ("kg", "double")})


@query("enforce_contract", "SELECT CAST(l_linenumber AS BIGINT) AS linea, CAST(l_orderkey AS string) AS documento FROM lineitem")
def enforce_contract(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("documento"), F.col("l_linenumber").alias("linea"))
    return Q.enforce(raw, {"linea": "long", "documento": "string"})


@query("split_rejects", f"SELECT CASE WHEN NOT ({IN_SCOPE}) THEN 'fecha_fuera_de_alcance' WHEN kg <= 3 THEN 'kg_bajo' END AS motivo, count(*) AS filas FROM compras WHERE NOT ({IN_SCOPE}) OR kg <= 3 GROUP BY ALL UNION ALL SELECT 'aceptada', count(*) FROM compras WHERE {IN_SCOPE} AND kg > 3")
def split_rejects(spark, sf_dir):
    good, bad = Q.split_rejects(table(spark, sf_dir, "compras"), [("fecha_fuera_de_alcance", Q.date_in_scope(F.col("fecha"), *SCOPE)), ("kg_bajo", F.col("kg") > 3)])
    return bad.groupBy("motivo").agg(F.count("*").alias("filas")).unionByName(good.agg(F.lit("aceptada").alias("motivo"), F.count("*").alias("filas")))


#: Records with what input conditions look for: odd dates, periods and flags.
INPUT = """SELECT l_orderkey, l_linenumber, scop, l_returnflag, CASE WHEN l_partkey % 11 = 0 THEN 'ayer' ELSE CAST(fecha AS string) END AS dia, CASE WHEN l_partkey % 7 = 0 THEN CAST(mes AS double) + 0.5e0 ELSE CAST(mes AS double) + 2e0 END AS mes,
  CASE WHEN l_partkey % 13 = 0 THEN 1e0 ELSE CAST(anio AS double) END AS anio, CASE l_suppkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN 'si' ELSE NULL END AS habilitada FROM lineas"""


@query("validate_input", f"""SELECT count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS claves_nulas, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS claves_repetidas,
  count(*) FILTER (WHERE scop IS NULL) AS identificadores_vacios, count(*) FILTER (WHERE mes NOT BETWEEN 1 AND 12) AS meses_invalidos, count(*) FILTER (WHERE l_returnflag NOT IN ('reparto', 'transporte')) AS roles_invalidos,
  count(*) FILTER (WHERE dia = 'ayer') AS fechas_invalidas, count(*) FILTER (WHERE mes % 1 <> 0 OR anio % 1 <> 0) AS no_enteros, count(*) FILTER (WHERE habilitada = 'si') AS banderas_invalidas, count(*) FILTER (WHERE anio < 1900) AS anios_invalidos FROM ({INPUT})""")
def validate_input(spark, sf_dir):
    return Q.violations(sql(spark, sf_dir, INPUT), ["l_orderkey", "l_linenumber"], ["scop"], "l_returnflag", ("dia",), ("mes", "anio"), ("habilitada",))


@query("mark_repeated_key", "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS llave_repetida FROM lineas")
def mark_repeated_key(spark, sf_dir):
    return Q.repeated(table(spark, sf_dir, "lineas"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "llave_repetida")


@query("catalog_frequencies", "SELECT columna, valor, n FROM (SELECT *, row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor NULLS FIRST) AS r FROM (SELECT 'p_type' AS columna, p_type AS valor, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY ALL)) WHERE r <= 40")
def catalog_frequencies(spark, sf_dir):
    return Q.frequencies(table(spark, sf_dir, "part"), ["p_type", "p_brand"])


# baseline statistics

@query("baseline_scop", f"SELECT count(*) AS compras, count(codigo_scop) AS con_scop, round_even(100.0 * count(codigo_scop) / count(*), 4) AS pct FROM compras WHERE {IN_SCOPE}")
def baseline_scop(spark, sf_dir):
    return Q.scop_baseline(table(spark, sf_dir, "compras"), *SCOPE)


TEXT = r"regexp_replace(trim(coalesce(documento_raw, '')), '^(\d+)\.0+$', '\1')"


@query("baseline_documents", rf"""SELECT count(*) AS total, count(*) FILTER (WHERE t <> '') AS informados, count(*) FILTER (WHERE t = '') AS vacios, count(*) FILTER (WHERE t <> '' AND length(t) NOT IN (8, 11)) AS longitud_invalida,
  count(*) FILTER (WHERE length(t) IN (8, 11) AND NOT regexp_full_match(t, '\d{{8}}|\d{{11}}')) AS formato_invalido, count(*) FILTER (WHERE regexp_full_match(t, '\d{{11}}') AND NOT {OK_RUC}) AS ruc_invalido,
  round_even(100.0 * count(*) FILTER (WHERE t <> '' AND length(t) NOT IN (8, 11)) / count(*), 4) AS pct_longitud_invalida FROM (SELECT *, {CHECK} AS dv FROM (SELECT {TEXT} AS t, {DIGITS} AS d FROM maestro))""")
def baseline_documents(spark, sf_dir):
    return Q.document_baseline(table(spark, sf_dir, "maestro"))


def _cases(source, table, key, controls):
    """SQL of a source's incidents: rows that fail each control, later rows of a key, and rows with either."""
    names = [*controls, "clave_unica", "filas_afectadas"]
    any_ = " OR ".join(f"({c})" for c in controls.values())
    counts = [*(f"count(*) FILTER (WHERE {c})" for c in controls.values()), "count(*) FILTER (WHERE r > 1)", f"count(*) FILTER (WHERE {any_} OR r > 1)"]
    return f"SELECT '{source}' AS fuente, unnest({names!r}) AS control, unnest([{', '.join(counts)}]) AS casos FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ({any_})) AS r FROM {table})"


@query("baseline_incidents", " UNION ALL ".join([
    _cases("aba_02", "compras", "documento", {"fecha": f"NOT ({IN_SCOPE})", "kg": "kg <= 3", "codigo_scop": "codigo_scop IS NULL"}),
    _cases("com_19", "ventas", "documento, linea", {"fecha": f"NOT ({IN_SCOPE})", "precio": "precio > 2000", "linea": "linea < 2"}),
    _cases("pro_01", "produccion", "fecha", {"fecha": f"NOT ({IN_SCOPE})", "produccion": "produccion < 0"}),
]))
def baseline_incidents(spark, sf_dir):
    late = ~Q.date_in_scope(F.col("fecha"), *SCOPE)
    a = Q.incidents(table(spark, sf_dir, "compras"), {"fecha": late, "kg": F.col("kg") <= 3, "codigo_scop": F.trim(F.coalesce("codigo_scop", F.lit(""))) == ""}, ["documento"], "aba_02")
    b = Q.incidents(table(spark, sf_dir, "ventas"), {"fecha": late, "precio": F.col("precio") > 2000, "linea": F.col("linea") < 2}, ["documento", "linea"], "com_19")
    c = Q.incidents(table(spark, sf_dir, "produccion"), {"fecha": late, "produccion": F.col("produccion") < 0}, ["fecha"], "pro_01")
    return a.unionByName(b).unionByName(c)


ZERO = "abs(stock_inicial + produccion - ventas - bonificaciones - stock_final) <= 1e-6"


@query("baseline_stock", f"""SELECT count(DISTINCT fecha) AS dias, count(*) AS dias_evaluables, count(*) FILTER (WHERE {ZERO}) AS dias_residuo_cero, count(*) FILTER (WHERE NOT {ZERO}) AS dias_con_residuo, 0::BIGINT AS filas_incompletas, 0::BIGINT AS dias_duplicados,
  count(*) FILTER (WHERE produccion < 0) AS producciones_negativas FROM produccion WHERE {IN_SCOPE}""")
def baseline_stock(spark, sf_dir):
    return Q.stock_baseline(table(spark, sf_dir, "produccion"), *SCOPE)


PRICES = "count(*) AS filas, round(min(kg), 2) AS min, round(max(kg), 2) AS max, round(quantile_cont(kg, 0.05), 2) AS p05, round(median(kg), 2) AS p50, round(quantile_cont(kg, 0.95), 2) AS p95 FROM ventas WHERE kg > 0"


@query("baseline_price", f"SELECT canal AS grupo, {PRICES} GROUP BY canal UNION ALL SELECT 'global', {PRICES}")
def baseline_price(spark, sf_dir):
    return Q.price_baseline(table(spark, sf_dir, "ventas"), value="kg")


@query("baseline_compare", f"""SELECT indicador, calculado, esperado, CASE WHEN calculado IS NULL THEN 'no_disponible' WHEN abs(calculado - esperado) <= 1e-8 + 1e-5 * abs(esperado) THEN 'coincide_numericamente' ELSE 'difiere' END AS estado, round_even(calculado - esperado, 4) AS diferencia
  FROM (SELECT 'dias' AS indicador, 1826.0::DOUBLE AS esperado UNION ALL SELECT 'minimo', 1.0 UNION ALL SELECT 'otro', 7.0) r LEFT JOIN (SELECT 'dias' AS indicador, count(DISTINCT fecha)::DOUBLE AS calculado FROM produccion WHERE {IN_SCOPE} UNION ALL SELECT 'minimo', min(kg) FROM ventas) USING (indicador)""")
def baseline_compare(spark, sf_dir):
    days = table(spark, sf_dir, "produccion").filter(IN_SCOPE).agg(F.lit("dias").alias("indicador"), F.count_distinct("fecha").cast("double").alias("calculado"))
    low = table(spark, sf_dir, "ventas").agg(F.lit("minimo").alias("indicador"), F.min("kg").alias("calculado"))
    references = spark.createDataFrame([("dias", 1826.0), ("minimo", 1.0), ("otro", 7.0)], "indicador string, esperado double")
    return Q.compare(days.unionByName(low), references)


@query("verify_counts", f"SELECT tabla, filas, placas, esperadas, filas = esperadas AS coincide FROM (SELECT 'compras' AS tabla, count(*) AS filas, count(DISTINCT placa_cargada) AS placas, 30000::BIGINT AS esperadas FROM compras UNION ALL SELECT 'ventas', count(*), count(DISTINCT placa_norm), NULL FROM ventas)")
def verify_counts(spark, sf_dir):
    a = table(spark, sf_dir, "compras").agg(F.lit("compras").alias("tabla"), F.count("*").alias("filas"), F.count_distinct("placa_cargada").alias("placas"), F.lit(30000).cast("long").alias("esperadas"))
    b = table(spark, sf_dir, "ventas").agg(F.lit("ventas").alias("tabla"), F.count("*").alias("filas"), F.count_distinct("placa_norm").alias("placas"), F.lit(None).cast("long").alias("esperadas"))
    return a.unionByName(b).withColumn("coincide", F.col("filas") == F.col("esperadas"))


