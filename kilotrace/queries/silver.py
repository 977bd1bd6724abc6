"""Queries of the Silver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilotrace.operators import silver as V
from kilotrace.queries.cleaning import CLASSIFIED
from kilotrace.queries.quality import IN_SCOPE, SCOPE
from kilotrace.queries.registry import query
from kilotrace.sources.domain import sql

DIRTY = "CASE l_linenumber % 4 WHEN 0 THEN {0} WHEN 1 THEN concat(substr({0}, 1, 3), '-', substr({0}, 4)) WHEN 2 THEN concat(lower(substr({0}, 1, 3)), ' ', substr({0}, 4), ' 15/07/2023') ELSE concat('  ', {0}, ' ') END"
OTHER = "concat('T1A', lpad(CAST((l_suppkey + 1) % 1000 AS string), 3, '0'))"
RAW_BUY = f"""SELECT CAST(l_orderkey AS string) AS documento, {DIRTY.format('placa')} AS placa_cargada_raw, CASE WHEN l_partkey % 13 = 0 THEN {DIRTY.format(OTHER)} WHEN l_partkey % 17 = 0 THEN '?' ELSE {DIRTY.format('placa')} END AS placa_facturada_raw,
  fecha, l_quantity AS kg, coalesce(scop, '') AS codigo_scop, CASE l_returnflag WHEN 'A' THEN 'atendida' WHEN 'N' THEN ' anulado' ELSE 'otra cosa' END AS estado, CONCAT_ORDER AS orden FROM lineas WHERE l_linestatus = 'O'"""
TOTAL = "concat(lpad(CAST(l_partkey AS string), 9, '0'), '|', CAST(l_suppkey AS string), '|', CAST(l_linenumber AS string), '|', CAST(CAST(l_extendedprice * 100 AS bigint) AS string), '|', CAST(fecha AS string), '|', CAST(l_quantity AS string), '|', CAST(l_tax AS string), '|', l_returnflag)"
RAW_BUY = RAW_BUY.replace("CONCAT_ORDER", TOTAL)
PLATE = r"regexp_replace(regexp_replace(upper({}), '\d{{2}}/\d{{2}}/\d{{4}}', '', 'g'), '[^A-Z0-9]', '', 'g')"
VALID = "CASE WHEN regexp_full_match({0}, '[A-Z0-9]{{6}}') THEN {0} END"
BUY = rf"""SELECT * EXCLUDE (p1, p2), coalesce(placa_cargada <> placa_facturada, false) AS flag_placa_divergente FROM (SELECT *, {VALID.format('p1')} AS placa_cargada, {VALID.format('p2')} AS placa_facturada FROM (
  SELECT *, {PLATE.format('placa_cargada_raw')} AS p1, {PLATE.format('placa_facturada_raw')} AS p2, row_number() OVER (PARTITION BY documento, {IN_SCOPE} ORDER BY orden) AS rn FROM ({RAW_BUY})))"""


@query("silver_aba_02", rf"""SELECT documento, placa_cargada, placa_facturada, nullif(regexp_extract(upper(placa_facturada_raw), '\d{{2}}/\d{{2}}/\d{{4}}'), '') AS fecha_en_placa, flag_placa_divergente, kg, nullif(codigo_scop, '') AS codigo_scop,
  CASE upper(trim(estado)) WHEN 'ATENDIDA' THEN 'ATENDIDO' WHEN 'ANULADO' THEN 'ANULADO' ELSE 'OTRO' END AS estado, fecha, year(fecha)::INT AS anio, month(fecha)::INT AS mes FROM ({BUY}) WHERE {IN_SCOPE} AND rn = 1""")
def silver_aba_02(spark, sf_dir):
    good, _ = V.purchases(sql(spark, sf_dir, RAW_BUY), SCOPE)
    return good.drop("orden")


@query("silver_rejects", f"SELECT motivo, count(*) AS filas FROM (SELECT CASE WHEN NOT ({IN_SCOPE}) THEN 'fecha_fuera_de_alcance' WHEN rn > 1 THEN 'duplicado' END AS motivo FROM ({BUY})) WHERE motivo IS NOT NULL GROUP BY motivo")
def silver_rejects(spark, sf_dir):
    _, bad = V.purchases(sql(spark, sf_dir, RAW_BUY), SCOPE)
    return bad.groupBy("motivo").agg(F.count("*").alias("filas"))


RAW_SELL = f"""SELECT CAST(l_orderkey AS string) AS documento, l_linenumber AS linea, {DIRTY.format('placa')} AS placa_raw, fecha, l_quantity AS kg, l_quantity AS precio, l_returnflag AS canal, p_type AS id_producto, coalesce(scop, '') AS codigo_scop, {TOTAL} AS orden
  FROM lineas JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'"""


@query("silver_com_19", f"""SELECT documento, linea, {VALID.format('p')} AS placa_norm, fecha, kg, precio, canal, id_producto, nullif(codigo_scop, '') AS codigo_scop, anio, mes,
  NOT (precio BETWEEN quantile_cont(precio, 0.01) OVER w AND quantile_cont(precio, 0.99) OVER w) AS flag_precio_atipico FROM (
  SELECT *, {PLATE.format('placa_raw')} AS p, year(fecha)::INT AS anio, month(fecha)::INT AS mes, row_number() OVER (PARTITION BY documento, linea ORDER BY orden) AS rn FROM ({RAW_SELL}) WHERE {IN_SCOPE}) WHERE rn = 1
  WINDOW w AS (PARTITION BY canal, id_producto, anio, mes)""")
def silver_com_19(spark, sf_dir):
    good, _ = V.sales(sql(spark, sf_dir, RAW_SELL), SCOPE)
    return good.drop("orden")


RAW_FLEET = "SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'sin placa' ELSE concat('t1a-', lpad(CAST(s_suppkey % 90 AS string), 3, '0')) END AS placa_raw, CAST(20 + s_suppkey % 5 * 7 AS double) AS capacidad_kg, s_acctbal >= 0 AS habilitada, s_name AS conductor, s_suppkey AS orden FROM supplier"


@query("silver_dis_01", f"SELECT upper(replace(placa_raw, '-', '')) AS placa_norm, capacidad_kg, habilitada, substr(sha256(concat('sal', upper(trim(conductor)))), 1, 16) AS conductor_hash FROM (SELECT *, row_number() OVER (PARTITION BY placa_raw ORDER BY orden) AS rn FROM ({RAW_FLEET}) WHERE placa_raw <> 'sin placa') WHERE rn = 1")
def silver_dis_01(spark, sf_dir):
    return V.fleet(sql(spark, sf_dir, RAW_FLEET), "sal")


RAW_CLIENT = "SELECT card_code, documento_raw, capacidad_kg, canal, CASE WHEN canal = 'BUILDING' THEN 'habido' ELSE ' activo ' END AS estado, card_code AS orden FROM maestro"


@query("silver_red_02", f"""SELECT card_code, CASE WHEN clase = 'RUC' THEN documento_norm END AS ruc, clase = 'RUC' AS ruc_valido, clase AS clase_documento, substr(sha256('sal' || documento_norm), 1, 16) AS documento_hash, capacidad_kg, canal,
  CASE WHEN canal = 'BUILDING' THEN 'HABIDO' ELSE 'ACTIVO' END AS estado FROM ({CLASSIFIED}) JOIN (SELECT card_code, capacidad_kg, canal FROM maestro) USING (card_code)""")
def silver_red_02(spark, sf_dir):
    return V.customers(sql(spark, sf_dir, RAW_CLIENT), "sal")


# the newer tables

RAW_INVOICE = """SELECT CAST(l_orderkey * 10 + l_linenumber AS string) AS numero, CAST(year(fecha) AS int) AS _anio, CAST(CASE WHEN l_partkey % 5 = 0 THEN day(fecha) ELSE month(fecha) END AS int) AS _mes, ' planta  norte ' AS proveedor, scop || '.0' AS nro_scop,
  concat(CAST(day(fecha) AS string), '/', CAST(month(fecha) AS string), '/', CAST(year(fecha) AS string)) AS fecha_factura, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_quantity AS string) END AS kg_glp_e, CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE concat(CAST(l_suppkey AS string), ' kg') END AS kg_glp_g,
  CASE WHEN l_linenumber = 1 THEN 'PLANTA' ELSE placa END AS placa, CASE WHEN l_linenumber = 2 THEN '1' ELSE '3.5' END AS tipo_cambio, l_returnflag AS conductor,
  CASE WHEN l_suppkey % 2 = 0 THEN CAST(100 + l_suppkey AS string) ELSE ' ' END AS codigo_osinergmin, concat('f00', CAST(l_linenumber AS string)) AS serie, 'glp-e' AS tipo, concat(' g-', CAST(l_orderkey AS string)) AS guia, concat(CAST(l_quantity AS string), ' usd') AS monto_usd,
  CAST(l_quantity * 3 AS string) AS monto_pagado, CASE WHEN l_suppkey % 3 = 0 THEN 'x' ELSE '2.5' END AS precio_unitario, CAST(l_quantity * 2 AS string) AS total, CASE WHEN l_partkey % 2 = 0 THEN 'pagado' ELSE NULL END AS estado,
  CAST(year(fecha) AS string) AS hoja, CAST(l_orderkey * 10 + l_linenumber AS bigint) AS fila FROM lineas WHERE l_linestatus = 'O'"""


INVOICE = f"""SELECT anio, mes, 'PLANTA NORTE' AS proveedor, nullif(trim(codigo_osinergmin), '') AS codigo_osinergmin, regexp_replace(nro_scop, '\\.0$', '') AS nro_scop, CASE WHEN estado_fecha = 'invertida' THEN make_date(year(f), day(f), month(f)) ELSE f END AS fecha_factura, estado_fecha,
  upper(serie) AS serie, numero, upper(tipo) AS tipo, e AS kg_glp_e, g AS kg_glp_g, CASE WHEN e IS NOT NULL OR g IS NOT NULL THEN coalesce(e, 0) + coalesce(g, 0) END AS kg, CASE WHEN placa <> 'PLANTA' THEN placa END AS placa_norm, CASE WHEN placa = 'PLANTA' THEN placa END AS centro_costo,
  trim(guia) AS guia, replace(monto_usd, ' usd', '')::DOUBLE AS monto_usd, tipo_cambio::DOUBLE AS tipo_cambio, tipo_cambio <> '1' AS tc_valido, monto_pagado::DOUBLE AS monto_pagado, try_cast(precio_unitario AS DOUBLE) AS precio_unitario, total::DOUBLE AS total, upper(estado) AS estado,
  substr(sha256(concat('sal', conductor)), 1, 16) AS conductor_hash, hoja, fila
  FROM (SELECT *, CASE WHEN month(f) = mes AND year(f) = anio THEN 'ok' WHEN day(f) <= 12 AND day(f) = mes AND year(f) = anio THEN 'invertida' ELSE 'discrepa' END AS estado_fecha FROM (
    SELECT *, _anio AS anio, _mes AS mes, CAST(strptime(fecha_factura, '%d/%m/%Y') AS DATE) AS f, kg_glp_e::DOUBLE AS e, replace(kg_glp_g, ' kg', '')::DOUBLE AS g FROM ({RAW_INVOICE})))"""


@query("silver_compras_glp", f"SELECT *, 'com_glp' AS origen, count(*) OVER (PARTITION BY proveedor, serie, numero) > 1 AS llave_repetida FROM ({INVOICE})")
def silver_compras_glp(spark, sf_dir):
    return V.contracted("compras_glp", V.invoices(sql(spark, sf_dir, RAW_INVOICE), "sal"), "com_glp")


def full(name, source, key):
    """SQL of a table with its source and the mark on repeated keys."""
    return f"SELECT *, count(*) OVER (PARTITION BY {key}) > 1 AS llave_repetida FROM (SELECT *, '{name}' AS origen FROM ({source}))"


ROW = "CAST(l_orderkey * 10 + l_linenumber AS int) AS fila"
RAW_ORDER = f"""SELECT CAST(fecha AS string) AS fecha, scop AS nro_scop, ' glp ' AS producto, concat('planta  ', CAST(l_suppkey % 7 AS string)) AS proveedor, CASE WHEN l_suppkey % 4 = 0 THEN ' ' ELSE ' callao ' END AS lugar_origen, concat(placa, ' CAMION') AS placa_cargada,
  CASE WHEN l_partkey % 13 = 0 THEN {OTHER} WHEN l_partkey % 7 = 0 THEN 'varios' ELSE concat(placa, ' 1/2/23') END AS placa_facturada, concat('f-', CAST(l_orderkey AS string)) AS factura, lower(l_returnflag) AS estado, 'SCOPS GENERADOS' AS hoja, {ROW} FROM lineas WHERE l_linestatus = 'O'"""


ORDER = f"""SELECT CAST(fecha AS DATE) AS fecha, nro_scop, 'GLP' AS producto, upper(replace(proveedor, '  ', ' ')) AS proveedor, CASE WHEN lugar_origen <> ' ' THEN 'CALLAO' END AS lugar_origen, replace(placa_cargada, ' CAMION', '') AS placa_cargada, CASE WHEN placa_facturada <> 'varios' THEN substr(placa_facturada, 1, 6) END AS placa_facturada,
  CASE WHEN placa_facturada LIKE '% 1/2/23' THEN '1/2/23' END AS fecha_en_placa, upper(factura) AS factura, upper(estado) AS estado, coalesce(replace(placa_cargada, ' CAMION', '') <> CASE WHEN placa_facturada <> 'varios' THEN substr(placa_facturada, 1, 6) END, false) AS flag_placa_divergente, hoja, fila FROM ({RAW_ORDER})"""


@query("silver_scop", full("scops_generados", ORDER, "nro_scop"))
def silver_scop(spark, sf_dir):
    return V.contracted("scop", V.orders(sql(spark, sf_dir, RAW_ORDER)), "scops_generados")


RAW_UNIT = """SELECT CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE ' norte ' END AS empresa, 'SUR' AS _empresa, CASE WHEN s_suppkey % 3 = 0 THEN 'zona  sur' ELSE '' END AS zonal, CASE WHEN s_suppkey % 9 = 0 THEN 'oficina' ELSE concat('t1a', lpad(CAST(s_suppkey % 1000 AS string), 3, '0'), ' cisterna') END AS placa, 'camión' AS clase,
  concat('marca ', CAST(s_nationkey AS string)) AS marca, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('m-', CAST(s_suppkey % 10 AS string)) END AS modelo, CASE WHEN s_suppkey % 6 = 0 THEN 's/n' ELSE CAST(2000 + s_suppkey % 20 AS string) END AS anio_fabricacion, concat(CAST(s_suppkey * 10 AS string), ' kg') AS capacidad_glp_kg,
  CASE WHEN s_suppkey % 4 = 0 THEN ' Vence  2021 ' ELSE NULL END AS cert_mercancias_peligrosas, 'carga' AS uso, CASE WHEN s_suppkey % 2 = 0 THEN 'vigente' ELSE 'vencido' END AS estado_soat, CASE s_suppkey % 3 WHEN 0 THEN 'sí' WHEN 1 THEN 'NO' ELSE 'x?' END AS traslada_gas, 'Hoja1' AS hoja, CAST(s_suppkey % 400 AS int) AS fila FROM supplier"""


UNIT = f"""SELECT CASE WHEN empresa IS NULL THEN 'SUR' ELSE 'NORTE' END AS empresa, CASE WHEN zonal <> '' THEN 'ZONA SUR' END AS zonal, upper(placa) AS placa_texto, CASE WHEN placa <> 'oficina' THEN upper(substr(placa, 1, 6)) END AS placa_norm, 'CAMIÓN' AS clase, upper(marca) AS marca, upper(modelo) AS modelo,
  try_cast(anio_fabricacion AS INT) AS anio_fabricacion, replace(capacidad_glp_kg, ' kg', '')::DOUBLE AS capacidad_glp_kg, CASE WHEN cert_mercancias_peligrosas IS NOT NULL THEN 'Vence 2021' END AS cert_mercancias_peligrosas, 'CARGA' AS uso, upper(estado_soat) AS estado_soat,
  CASE traslada_gas WHEN 'sí' THEN true WHEN 'NO' THEN false END AS traslada_gas, hoja, fila FROM ({RAW_UNIT})"""


@query("silver_unidades", full("soat_2020", UNIT, "origen, hoja, fila"))
def silver_unidades(spark, sf_dir):
    return V.contracted("unidades", V.units(sql(spark, sf_dir, RAW_UNIT)), "soat_2020")


MONTH_WORDS = "CASE month(fecha) WHEN 1 THEN 'Enero' WHEN 2 THEN 'feb' WHEN 9 THEN 'SET' ELSE CAST(month(fecha) AS string) END"
RAW_MONTHS = f"""SELECT CAST(year(fecha) AS int) AS _anio, {MONTH_WORDS} AS mes_texto, CASE WHEN l_linenumber = 1 THEN ' centro de costo' ELSE placa END AS proyecto, 'glp  10 kg' AS articulo, CASE WHEN l_suppkey % 2 = 0 THEN 'granel' ELSE ' ' END AS tipo, ' reparto' AS unidad_negocio, 'kg' AS unidad_medida,
  CAST(l_quantity AS string) AS cantidad, CASE WHEN l_partkey % 9 = 0 THEN 'FALSE' ELSE concat(CAST(l_linenumber AS string), ',5') END AS precio_promedio, CAST(l_quantity AS string) AS kg, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_suppkey AS string) END AS balones_galones, l_returnflag AS vendedor, 'VENTAS' AS hoja, {ROW} FROM lineas"""


UNIT_MONTHS = f"""SELECT _anio AS anio, CASE mes_texto WHEN 'Enero' THEN 1 WHEN 'feb' THEN 2 WHEN 'SET' THEN 9 ELSE mes_texto::INT END AS mes, upper(trim(proyecto)) AS proyecto, CASE WHEN proyecto LIKE 'T1A%' THEN proyecto END AS placa_norm,
  CASE WHEN proyecto NOT LIKE 'T1A%' THEN upper(trim(proyecto)) END AS centro_costo, 'GLP 10 KG' AS articulo, CASE WHEN tipo <> ' ' THEN 'GRANEL' END AS tipo, 'REPARTO' AS unidad_negocio, 'KG' AS unidad_medida, cantidad::DOUBLE AS cantidad,
  try_cast(replace(precio_promedio, ',', '.') AS DOUBLE) AS precio_promedio, kg::DOUBLE AS kg, balones_galones::DOUBLE AS balones_galones, substr(sha256(concat('sal', vendedor)), 1, 16) AS vendedor_hash, hoja, fila FROM ({RAW_MONTHS})"""


@query("silver_ventas_unidad_mes", full("ventas_flota_2020", UNIT_MONTHS, "anio, mes, proyecto, articulo, vendedor_hash"))
def silver_ventas_unidad_mes(spark, sf_dir):
    return V.contracted("ventas_unidad_mes", V.unit_months(sql(spark, sf_dir, RAW_MONTHS), "sal"), "ventas_flota_2020")


RAW_DETAIL = f"""SELECT CAST(fecha AS string) AS fecha, CASE WHEN l_partkey % 11 = 0 THEN 'planta sur' ELSE placa END AS proyecto, CAST(l_linenumber AS string) AS linea, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE concat('a', CAST(l_suppkey AS string)) END AS articulo_codigo,
  CASE l_linenumber % 3 WHEN 0 THEN 'GLP 10 KG' WHEN 1 THEN 'arroz 5 kg' ELSE 'glp granel' END AS articulo, CASE l_suppkey % 4 WHEN 0 THEN 'UNIDAD' WHEN 1 THEN 'galones' WHEN 2 THEN 'kg' ELSE 'caja' END AS unidad_medida,
  CAST(l_quantity AS string) AS cantidad, CAST(l_linenumber * 2 AS string) AS precio_unitario, CAST(l_partkey AS string) AS importe, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey AS string) ELSE NULL END AS kg, CAST(l_orderkey AS string) AS cliente_codigo,
  lower(l_returnflag) AS indicador, concat('b-', CAST(l_orderkey AS string)) AS documento, CASE WHEN l_suppkey % 5 = 0 THEN ' ' ELSE CAST(l_suppkey AS string) END AS vendedor, 'Hoja1' AS hoja, {ROW} FROM lineas WHERE l_linestatus = 'F'"""


DETAIL = f"""SELECT f AS fecha, upper(proyecto) AS proyecto, CASE WHEN proyecto LIKE 'T1A%' THEN proyecto END AS placa_norm, CASE WHEN proyecto NOT LIKE 'T1A%' THEN upper(proyecto) END AS centro_costo, linea::INT AS linea, upper(articulo_codigo) AS articulo_codigo, upper(articulo) AS articulo, upper(unidad_medida) AS unidad_medida, q AS cantidad,
  precio_unitario::DOUBLE AS precio_unitario, importe::DOUBLE AS importe, substr(sha256(concat('sal', cliente_codigo)), 1, 16) AS cliente_id, upper(indicador) AS indicador, upper(documento) AS documento, CASE WHEN vendedor <> ' ' THEN substr(sha256(concat('sal', vendedor)), 1, 16) END AS vendedor_hash,
  year(f)::INT AS anio, month(f)::INT AS mes, glp AS es_glp, coalesce(k, d) AS kg, CASE WHEN k IS NOT NULL THEN 'registrado' WHEN d IS NOT NULL THEN 'derivado' WHEN glp THEN 'sin_conversion' ELSE 'no_glp' END AS kg_origen, hoja, fila FROM (
  SELECT *, CASE WHEN glp THEN kg::DOUBLE END AS k, CASE WHEN glp THEN CASE unidad_medida WHEN 'kg' THEN q WHEN 'galones' THEN q * 2.04 WHEN 'UNIDAD' THEN CASE WHEN articulo LIKE '%10 KG' THEN q * 10 END END END AS d FROM (
    SELECT *, CAST(fecha AS DATE) AS f, upper(articulo) LIKE 'GLP%' AS glp, cantidad::DOUBLE AS q FROM ({RAW_DETAIL})))"""


@query("silver_ventas_detalle", full("ventas_por_proyecto", DETAIL, "origen, fila"))
def silver_ventas_detalle(spark, sf_dir):
    return V.contracted("ventas_detalle", V.sale_details(sql(spark, sf_dir, RAW_DETAIL), "sal"), "ventas_por_proyecto")


def _long(name, source, measures):
    """SQL of a table's measures, a row each."""
    return f"SELECT '{name}' AS tabla, unnest([{', '.join(repr(k) for k in measures)}]) AS metrica, unnest([{', '.join(f'({v})::DOUBLE' for v in measures.values())}]) AS valor FROM ({source})"


def _rate(cond):
    return f"round_even(avg(coalesce({cond}, false)::INT), 4)"


MEASURES = " UNION ALL ".join([
    _long("compras_glp", INVOICE, {"placa_valida": _rate("placa_norm IS NOT NULL"), "scop_presente": _rate("nro_scop IS NOT NULL"), "scop_11_digitos": _rate("length(nro_scop) = 11"), "scop_repetidos": "count(nro_scop) - count(DISTINCT nro_scop)",
        "fechas_invertidas": "count(*) FILTER (WHERE estado_fecha = 'invertida')", "fechas_que_discrepan": "count(*) FILTER (WHERE estado_fecha = 'discrepa')", "tc_registrados": "count(tipo_cambio)", "tc_fuera_de_rango": "count(*) FILTER (WHERE NOT tc_valido)", "kg_positivo": _rate("kg > 0")}),
    _long("scop", ORDER, {"ordenes_con_ambas_placas": "count(*) FILTER (WHERE placa_cargada IS NOT NULL AND placa_facturada IS NOT NULL)", "ordenes_con_placa_divergente": "count(*) FILTER (WHERE flag_placa_divergente)", "fecha_valida": _rate("fecha IS NOT NULL")}),
    _long("unidades", UNIT, {"placa_valida": _rate("placa_norm IS NOT NULL"), "con_capacidad": "count(capacidad_glp_kg)", "traslada_gas_si": "count(*) FILTER (WHERE traslada_gas)", "traslada_gas_si_con_placa_valida": "count(*) FILTER (WHERE traslada_gas AND placa_norm IS NOT NULL)",
        "placas_distintas": "count(DISTINCT placa_norm)", "traslada_gas_declarado": "count(traslada_gas)"}),
    _long("ventas_unidad_mes", UNIT_MONTHS, {"mes_reconocido": _rate("mes IS NOT NULL"), "filas_con_placa": _rate("placa_norm IS NOT NULL"), "kg_con_placa_valida": "round_even(sum(kg) FILTER (WHERE placa_norm IS NOT NULL) / sum(kg), 4)"}),
    _long("ventas_detalle", DETAIL, {"fecha_valida": _rate("fecha IS NOT NULL"), "lineas_glp": "count(*) FILTER (WHERE es_glp)", "lineas_no_glp": "count(*) FILTER (WHERE NOT es_glp)", "lineas_glp_convertibles_a_kg": "round_even(avg((kg IS NOT NULL)::INT) FILTER (WHERE es_glp), 4)",
        "kg_registrado": "count(*) FILTER (WHERE kg_origen = 'registrado')", "kg_derivado": "count(*) FILTER (WHERE kg_origen = 'derivado')", "filas_con_placa": _rate("placa_norm IS NOT NULL")}),
])


@query("silver_quality_metrics", MEASURES)
def silver_quality_metrics(spark, sf_dir):
    tables = {
        "compras_glp": (RAW_INVOICE, lambda raw: V.invoices(raw, "sal")), "scop": (RAW_ORDER, V.orders), "unidades": (RAW_UNIT, V.units),
        "ventas_unidad_mes": (RAW_MONTHS, lambda raw: V.unit_months(raw, "sal")), "ventas_detalle": (RAW_DETAIL, lambda raw: V.sale_details(raw, "sal")),
    }
    return reduce(DataFrame.unionByName, [V.cell_measures(n, sql(spark, sf_dir, text), made) for n, (text, made) in tables.items()])
