"""The business tables as views of the given tables.

Each view is one SQL text that Spark and DuckDB both run, so that a query and its SQL start from the same rows.
Purchases and sales are line items; plates come from suppliers, customers from orders, rates from order dates. All
views are projections, filters and key joins: they add no work that grows faster than the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    # a line with its order, part and plate
    "lineas": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_tax, l_returnflag, l_linestatus,
               CAST(l_shipdate AS date) AS fecha, CAST(year(l_shipdate) AS int) AS anio, CAST(month(l_shipdate) AS int) AS mes,
               concat('T1A', lpad(CAST(l_suppkey % 1000 AS string), 3, '0')) AS placa,
               CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE CAST(l_orderkey AS string) END AS scop
        FROM lineitem""",
    "compras": """
        SELECT CAST(l_orderkey AS string) AS documento, l_linenumber AS linea, placa AS placa_cargada,
               CASE WHEN l_partkey % 13 = 0 THEN concat('T1A', lpad(CAST((l_suppkey + 1) % 1000 AS string), 3, '0')) ELSE placa END AS placa_facturada,
               l_partkey % 13 = 0 AS flag_placa_divergente,
               fecha, p_type AS id_producto, l_quantity AS kg, 3.3e0 + (l_partkey % 100) / 1000e0 AS tipo_cambio,
               scop AS codigo_scop, l_returnflag AS estado, anio, mes
        FROM lineas JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O'""",
    "ventas": """
        SELECT CAST(l_orderkey AS string) AS documento, l_linenumber AS linea, placa AS placa_norm, fecha, p_type AS id_producto,
               l_quantity AS kg, l_extendedprice / l_quantity AS precio, l_returnflag AS canal, scop AS codigo_scop,
               CAST(o_custkey AS string) AS card_code, anio, mes
        FROM lineas JOIN part ON l_partkey = p_partkey LEFT JOIN (SELECT o_orderkey, min(o_custkey) AS o_custkey FROM orders GROUP BY o_orderkey) AS o ON l_orderkey = o_orderkey
        WHERE l_linestatus = 'F'""",
    # sales without their customer: no join with orders
    "ventas_precio": """
        SELECT placa AS placa_norm, fecha, p_type AS id_producto, l_quantity AS kg, l_extendedprice / l_quantity AS precio, l_returnflag AS canal, anio, mes
        FROM lineas JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'""",
    "mov": """
        SELECT 'compra' AS tipo_mov, documento, 0 AS linea, placa_cargada AS placa_norm, fecha, id_producto, kg AS kg_comprados,
               kg AS kg_despachados, CAST(0 AS double) AS kg_vendidos, codigo_scop, CAST(NULL AS string) AS card_code,
               CAST(NULL AS double) AS precio, CAST(NULL AS string) AS canal, anio, mes FROM compras
        UNION ALL
        SELECT 'venta', documento, linea, placa_norm, fecha, id_producto, CAST(0 AS double), CAST(0 AS double), kg, codigo_scop,
               card_code, precio, canal, anio, mes FROM ventas""",
    # movements without what only sales have: one scan of the lines, and no join with orders
    "mov_kg": """
        SELECT CASE WHEN l_linestatus = 'O' THEN 'compra' ELSE 'venta' END AS tipo_mov, CAST(l_orderkey AS string) AS documento,
               CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_linenumber END AS linea, placa AS placa_norm, fecha, p_type AS id_producto,
               CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE CAST(0 AS double) END AS kg_comprados,
               CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE CAST(0 AS double) END AS kg_despachados,
               CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE CAST(0 AS double) END AS kg_vendidos, scop AS codigo_scop, anio, mes
        FROM lineas JOIN part ON l_partkey = p_partkey WHERE l_linestatus IN ('O', 'F')""",
    "flota": """
        SELECT concat('T1A', lpad(CAST(s_suppkey % 1000 AS string), 3, '0')) AS placa_norm,
               CAST(max(20 + (s_suppkey % 5) * 7) AS double) AS capacidad_kg, min(s_acctbal) >= 0 AS habilitada
        FROM supplier GROUP BY s_suppkey % 1000""",
    "maestro": """
        SELECT CAST(c_custkey AS string) AS card_code, CAST(25 + (c_custkey % 6) * 5 AS double) AS capacidad_kg, c_mktsegment AS canal,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    WHEN c_custkey % 5 = 1 THEN concat('20', lpad(CAST(c_custkey * 7919 % 1000000000 AS string), 9, '0'))
                    WHEN c_custkey % 5 = 2 THEN concat(CAST(c_custkey * 31 AS string), '.0')
                    WHEN c_custkey % 5 = 3 THEN concat(' ', CAST(c_custkey * 104729 AS string), '-')
                    ELSE CAST(100000000 + c_custkey AS string) END AS documento_raw
        FROM customer""",
    "tc": """
        SELECT DISTINCT CAST(o_orderdate AS date) AS fecha, 3.3e0 + day(o_orderdate) * 3 / 1000e0 AS tc_oficial
        FROM orders WHERE day(o_orderdate) % 7 NOT IN (0, 6)""",
    # a unit's month, as the newer rules take it
    "unidad_mes6": """
        SELECT placa AS unidad_id, CASE WHEN l_suppkey % 2 = 0 THEN 'reparto' ELSE 'transporte' END AS rol, anio, mes,
               sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS kg_vendidos,
               sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS kg_transportados,
               sum(CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice * l_tax) AS double) ELSE 0 END) AS gasto_combustible,
               sum(CAST(floor(l_extendedprice * l_tax) AS double)) AS gasto_total
        FROM lineas GROUP BY placa, l_suppkey % 2, anio, mes""",
    "compras6": """
        SELECT concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string)) AS factura_id, min(fecha) AS fecha,
               min(l_suppkey) % 50 AS proveedor_id, min(placa) AS unidad_id, min(scop) AS codigo_scop, sum(l_quantity) AS kg,
               min(l_extendedprice) / min(l_quantity) AS precio_usd_kg,
               CASE WHEN min(l_partkey) % 3 = 0 THEN min(l_extendedprice) / min(l_quantity) * (0.9e0 + min(l_partkey) % 20 / 100e0) END AS precio_pactado_usd_kg,
               3.3e0 + (min(l_partkey) % 100) / 1000e0 AS tipo_cambio
        FROM lineas WHERE l_linestatus = 'O' GROUP BY l_orderkey, l_linenumber""",
    "unidades6": "SELECT placa_norm AS unidad_id, CASE WHEN capacidad_kg = 27 THEN NULL ELSE habilitada END AS habilitada FROM flota",
    # a day's stock: the closing is the balance, but for days whose number is a multiple of 5
    "produccion": """
        SELECT fecha, CAST(1000 AS double) AS stock_inicial, CASE WHEN day(fecha) = 23 THEN CAST(-1000 AS double) ELSE comprado END AS produccion,
               vendido AS ventas, CAST(5 AS double) AS bonificaciones,
               1000 + CASE WHEN day(fecha) = 23 THEN CAST(-1000 AS double) ELSE comprado END - vendido - 5 + CASE WHEN day(fecha) % 5 = 0 THEN 1 ELSE 0 END AS stock_final,
               CASE WHEN day(fecha) % 3 = 0 THEN NULL ELSE day(fecha) % 2 = 1 END AS stock_final_es_calculado
        FROM (SELECT fecha, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS comprado,
                     sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS vendido FROM lineas GROUP BY fecha) AS d""",
}

#: The years of the given tables, and the pilot year among them.
YEARS = (1995, 2001)
PILOT = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view of this module."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return sql(spark, sf_dir, VIEWS[name])


def named(text: str) -> list[str]:
    """The tables and views that ``text`` reads: names after FROM or JOIN."""
    found = re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)
    return [n for n in dict.fromkeys(found) if n in TABLES or n in VIEWS]


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """``text`` over given tables and views."""
    parts = {n: table(spark, sf_dir, n) for n in named(text)}
    for n in parts:
        text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **parts)
