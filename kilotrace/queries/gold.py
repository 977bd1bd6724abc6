"""Queries over the reconciliation, its joins and monthly features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilotrace.functions import clean as C

from kilotrace.operators import gold as G
from kilotrace.operators.ordering import running_sum
from kilotrace.operators.signals import CATALOGUE
from kilotrace.queries.registry import query
from kilotrace.sources.domain import PILOT, sql, table
from kilotrace.sources.lake import once

BY = "placa_norm, fecha, id_producto, anio, mes"
SUMS = f"SELECT {BY}, sum(kg_comprados) AS kg_comprados, sum(kg_despachados) AS kg_despachados, sum(kg_vendidos) AS kg_vendidos, count(*) AS n_operaciones FROM mov GROUP BY {BY}"
GOLD = f"""SELECT s.*, round(kg_comprados - kg_vendidos, 4) AS kg_diferencia,
  round(CASE WHEN kg_comprados > 0 THEN (kg_comprados - kg_vendidos) / kg_comprados END, 6) AS pct_diferencia,
  round((kg_comprados - kg_vendidos) * 2.1, 4) AS valor_ref_soles, f.capacidad_kg, f.habilitada
  FROM ({SUMS}) s LEFT JOIN flota f USING (placa_norm)"""
NUMBERS = {"kg_diferencia": 4, "pct_diferencia": 6, "valor_ref_soles": 4}


def rounded(df, places: dict[str, int]):
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def _gold(spark, sf_dir, **options):
    return G.reconcile(table(spark, sf_dir, "mov_kg"), table(spark, sf_dir, "flota"), **options)


@query("conciliacion", GOLD)
def conciliacion(spark, sf_dir):
    return rounded(_gold(spark, sf_dir), NUMBERS)


@query("conciliacion_salted", GOLD)
def conciliacion_salted(spark, sf_dir):
    return rounded(_gold(spark, sf_dir, salts=8), NUMBERS)


@query("conc_con_flota", GOLD)
def conc_con_flota(spark, sf_dir):
    return rounded(_gold(spark, sf_dir, broadcast=False), NUMBERS)


@query("conciliacion_mapreduce", "SELECT placa_norm, fecha, id_producto, sum(kg_comprados) AS kg_comprados, sum(kg_despachados) AS kg_despachados, sum(kg_vendidos) AS kg_vendidos FROM mov GROUP BY ALL")
def conciliacion_mapreduce(spark, sf_dir):
    return G.pair_sums(table(spark, sf_dir, "mov_kg"))


@query("scale_aggregate", SUMS)
def scale_aggregate(spark, sf_dir):
    return G.sums(table(spark, sf_dir, "mov_kg"))


@query("filter_years_product", SUMS.replace("FROM mov", f"FROM mov WHERE anio IN ({PILOT}) AND id_producto LIKE 'STANDARD%'"))
def filter_years_product(spark, sf_dir):
    mov = table(spark, sf_dir, "mov_kg").filter(F.col("anio").isin(PILOT) & F.col("id_producto").startswith("STANDARD"))
    return G.sums(mov)


@query("filter_years", f"SELECT documento, linea, anio, kg_comprados FROM mov WHERE anio IN ({PILOT - 1}, {PILOT})")
def filter_years(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").filter(F.col("anio").isin(PILOT - 1, PILOT)).select("documento", "linea", "anio", "kg_comprados")


@query("filter_product", "SELECT documento, linea, id_producto, kg_vendidos FROM mov WHERE id_producto = 'ECONOMY'")
def filter_product(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").filter(F.col("id_producto") == "ECONOMY").select("documento", "linea", "id_producto", "kg_vendidos")


@query("scan_declared_parquet", f"SELECT placa_norm, fecha, kg_comprados, kg_vendidos FROM mov WHERE anio IN ({PILOT}, {PILOT + 1})")
def scan_declared_parquet(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").filter(F.col("anio").isin(PILOT, PILOT + 1)).select("placa_norm", "fecha", "kg_comprados", "kg_vendidos")


@query("temporal_split", f"SELECT documento, linea, anio, CASE WHEN anio < {PILOT} THEN 'entrenamiento' WHEN anio = {PILOT} THEN 'piloto' ELSE 'estabilidad' END AS parte FROM mov")
def temporal_split(spark, sf_dir):
    part = F.when(F.col("anio") < PILOT, "entrenamiento").when(F.col("anio") == PILOT, "piloto").otherwise("estabilidad")
    return table(spark, sf_dir, "mov_kg").select("documento", "linea", "anio", part.alias("parte"))


@query("union_all", "SELECT tipo_mov, count(*) AS filas, sum(kg_comprados + kg_vendidos) AS kg FROM mov GROUP BY tipo_mov")
def union_all(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").groupBy("tipo_mov").agg(F.count("*").alias("filas"), F.sum(F.col("kg_comprados") + F.col("kg_vendidos")).alias("kg"))


@query("movimientos", "SELECT tipo_mov, documento, linea, placa_norm, fecha, id_producto, kg_comprados, kg_despachados, kg_vendidos, codigo_scop, card_code, precio, canal, anio, mes FROM mov WHERE placa_norm IS NOT NULL")
def movimientos(spark, sf_dir):
    from kilotrace.operators.silver import movements

    return movements(table(spark, sf_dir, "compras"), table(spark, sf_dir, "ventas"))


# joins

ORDERS = "SELECT CAST(o_orderkey AS string) AS codigo_scop, min(o_orderstatus) AS estado_orden, min(o_totalprice) AS monto FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_orderkey"


@query("compras_con_scop", f"SELECT c.documento, c.linea, c.kg, c.codigo_scop, o.estado_orden, o.monto FROM compras c LEFT JOIN ({ORDERS}) o USING (codigo_scop)")
def compras_con_scop(spark, sf_dir):
    return table(spark, sf_dir, "compras").join(sql(spark, sf_dir, ORDERS), "codigo_scop", "left").select("documento", "linea", "kg", "codigo_scop", "estado_orden", "monto")


@query("compras_sin_scop", f"SELECT documento, linea, kg, codigo_scop FROM compras WHERE codigo_scop IS NULL OR codigo_scop NOT IN (SELECT codigo_scop FROM ({ORDERS}))")
def compras_sin_scop(spark, sf_dir):
    return G.anti(table(spark, sf_dir, "compras"), sql(spark, sf_dir, ORDERS), ["codigo_scop"]).select("documento", "linea", "kg", "codigo_scop")


@query("compras_vs_ventas", """
    SELECT placa_norm, fecha, id_producto, coalesce(c.kg, 0) AS kg_comprados, coalesce(v.kg, 0) AS kg_vendidos
    FROM (SELECT placa_cargada AS placa_norm, fecha, id_producto, sum(kg) AS kg FROM compras GROUP BY ALL) c
    FULL JOIN (SELECT placa_norm, fecha, id_producto, sum(kg) AS kg FROM ventas GROUP BY ALL) v USING (placa_norm, fecha, id_producto)""")
def compras_vs_ventas(spark, sf_dir):
    return G.compare_purchases_sales(table(spark, sf_dir, "compras"), table(spark, sf_dir, "ventas"))


@query("ventas_sin_compra", "SELECT documento, linea, kg, codigo_scop FROM ventas v WHERE NOT EXISTS (SELECT 1 FROM compras c WHERE c.codigo_scop = v.codigo_scop)")
def ventas_sin_compra(spark, sf_dir):
    return G.anti(table(spark, sf_dir, "ventas"), table(spark, sf_dir, "compras"), ["codigo_scop"]).select("documento", "linea", "kg", "codigo_scop")


@query("ventas_con_maestro", "SELECT v.documento, v.linea, v.kg, v.card_code, m.capacidad_kg, m.canal AS canal_cliente FROM ventas v LEFT JOIN maestro m USING (card_code)")
def ventas_con_maestro(spark, sf_dir):
    master = table(spark, sf_dir, "maestro").select("card_code", "capacidad_kg", F.col("canal").alias("canal_cliente"))
    return table(spark, sf_dir, "ventas").join(master, "card_code", "left").select("documento", "linea", "kg", "card_code", "capacidad_kg", "canal_cliente")


@query("unidades_habilitadas", "SELECT documento, linea, placa_norm, kg FROM ventas WHERE placa_norm IN (SELECT placa_norm FROM flota WHERE habilitada)")
def unidades_habilitadas(spark, sf_dir):
    fleet = table(spark, sf_dir, "flota").filter("habilitada").select("placa_norm")
    return table(spark, sf_dir, "ventas").join(fleet, "placa_norm", "left_semi").select("documento", "linea", "placa_norm", "kg")


@query("compras_con_tc", "SELECT c.documento, c.linea, c.fecha, round(t.tc_oficial, 6) AS tc_oficial FROM compras c ASOF LEFT JOIN tc t ON c.fecha >= t.fecha")
def compras_con_tc(spark, sf_dir):
    return rounded(G.as_of(table(spark, sf_dir, "compras"), table(spark, sf_dir, "tc")).select("documento", "linea", "fecha", "tc_oficial"), {"tc_oficial": 6})


EVENTS = "SELECT CAST(year(ts) AS int) AS anio, CAST(month(ts) AS int) AS mes, CAST(max(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS int) AS evento_mercado FROM events GROUP BY year(ts), month(ts)"


@query("gold_con_eventos", f"SELECT g.placa_norm, g.fecha, g.id_producto, coalesce(e.evento_mercado, 0) AS evento_mercado FROM ({SUMS}) g LEFT JOIN ({EVENTS}) e USING (anio, mes)")
def gold_con_eventos(spark, sf_dir):
    out = G.sums(table(spark, sf_dir, "mov_kg")).join(sql(spark, sf_dir, EVENTS), ["anio", "mes"], "left")
    return out.select("placa_norm", "fecha", "id_producto", F.coalesce("evento_mercado", F.lit(0)).cast("int").alias("evento_mercado"))


@query("market_events", EVENTS)
def market_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.year("ts").alias("anio"), F.month("ts").alias("mes")).agg(F.max(F.when(F.col("value") > 100, 1).otherwise(0)).alias("evento_mercado"))


@query("anti_generic", "SELECT placa_norm, fecha, kg FROM ventas v WHERE NOT EXISTS (SELECT 1 FROM compras c WHERE c.placa_cargada = v.placa_norm AND c.fecha = v.fecha)")
def anti_generic(spark, sf_dir):
    c = table(spark, sf_dir, "compras").withColumnRenamed("placa_cargada", "placa_norm")
    return G.anti(table(spark, sf_dir, "ventas"), c, ["placa_norm", "fecha"]).select("placa_norm", "fecha", "kg")


@query("semi_generic", "SELECT placa_norm, fecha, kg FROM ventas v WHERE EXISTS (SELECT 1 FROM compras c WHERE c.placa_cargada = v.placa_norm AND c.fecha = v.fecha)")
def semi_generic(spark, sf_dir):
    c = table(spark, sf_dir, "compras").withColumnRenamed("placa_cargada", "placa_norm")
    return G.semi(table(spark, sf_dir, "ventas"), c, ["placa_norm", "fecha"]).select("placa_norm", "fecha", "kg")


@query("many_to_one_join", "SELECT c.documento, c.linea, round(t.tc_oficial, 6) AS tc_oficial FROM compras c LEFT JOIN tc t USING (fecha)")
def many_to_one_join(spark, sf_dir):
    return rounded(G.many_to_one(table(spark, sf_dir, "compras"), table(spark, sf_dir, "tc"), ["fecha"]).select("documento", "linea", "tc_oficial"), {"tc_oficial": 6})


# features

MONTHS = f"""SELECT placa_norm, anio, mes, sum(kg_comprados) AS kg_comprados, sum(kg_vendidos) AS kg_vendidos, sum(kg_comprados - kg_vendidos) AS kg_diferencia,
  sum(n_operaciones)::BIGINT AS n_operaciones, count(DISTINCT fecha) AS dias_operacion, max(capacidad_kg) AS capacidad_kg, max(kg_comprados) AS max_kg_dia,
  round(CASE WHEN sum(kg_comprados) > 0 THEN sum(kg_comprados - kg_vendidos) / sum(kg_comprados) END, 6) AS pct_diferencia,
  round(max(kg_comprados) / max(capacidad_kg), 6) AS ratio_carga_capacidad
  FROM ({SUMS}) s LEFT JOIN flota USING (placa_norm) GROUP BY placa_norm, anio, mes"""
DIVERGENCE = "SELECT placa_cargada AS placa_norm, anio, mes, round(avg(flag_placa_divergente::INT), 6) AS flag_placa_divergente FROM compras GROUP BY ALL"
DEVIATION = "SELECT placa_cargada AS placa_norm, c.anio, c.mes, round(avg(abs(tipo_cambio - tc_oficial) / tc_oficial), 9) AS desvio_tc FROM compras c ASOF LEFT JOIN tc t ON c.fecha >= t.fecha GROUP BY ALL"
PRICE = "SELECT placa_norm, anio, mes, round(avg(precio / mediana), 6) AS precio_vs_mediana_canal FROM (SELECT *, median(precio) OVER (PARTITION BY canal, id_producto, anio, mes) AS mediana FROM ventas WHERE precio IS NOT NULL) GROUP BY ALL"


@query("unidad_mes_base", MONTHS)
def unidad_mes_base(spark, sf_dir):
    return rounded(G.month_base(_gold(spark, sf_dir)), {"pct_diferencia": 6, "ratio_carga_capacidad": 6})


@query("feat_divergence", DIVERGENCE)
def feat_divergence(spark, sf_dir):
    return rounded(G.divergence(table(spark, sf_dir, "compras")), {"flag_placa_divergente": 6})


@query("feat_fx_deviation", DEVIATION)
def feat_fx_deviation(spark, sf_dir):
    return rounded(G.rate_deviation(table(spark, sf_dir, "compras"), table(spark, sf_dir, "tc")), {"desvio_tc": 9})


@query("feat_price_vs_median", PRICE)
def feat_price_vs_median(spark, sf_dir):
    return rounded(G.price_vs_median(table(spark, sf_dir, "ventas")), {"precio_vs_mediana_canal": 6})


COMPLAINTS = "SELECT CAST(year(ts) AS int) AS anio, CAST(month(ts) AS int) AS mes, value AS indice FROM events WHERE event_type = 'click'"
CALENDAR = f"""SELECT placa_norm, m.anio, m.mes, (m.anio = {PILOT})::INT AS es_pandemia_2020, coalesce(e.evento_mercado, 0) AS evento_mercado, round(coalesce(q.i, 0), 6) AS indice_quejas_marca
  FROM (SELECT DISTINCT placa_norm, anio, mes FROM mov) m LEFT JOIN ({EVENTS}) e ON m.anio = e.anio AND m.mes = e.mes
  LEFT JOIN (SELECT anio, mes, avg(indice) AS i FROM ({COMPLAINTS}) GROUP BY ALL) q ON m.anio = q.anio AND m.mes = q.mes"""


def _features(spark, sf_dir):
    bought = once(table(spark, sf_dir, "compras").select("placa_cargada", "fecha", "flag_placa_divergente", "tipo_cambio", "anio", "mes"), "compras")
    gold = G.reconcile(table(spark, sf_dir, "mov_kg"), table(spark, sf_dir, "flota"))
    return G.month_features(gold, bought, once(table(spark, sf_dir, "ventas_precio"), "ventas"), table(spark, sf_dir, "tc"), PILOT, sql(spark, sf_dir, EVENTS), sql(spark, sf_dir, COMPLAINTS))


@query("feat_calendar_events", CALENDAR)
def feat_calendar_events(spark, sf_dir):
    return rounded(_features(spark, sf_dir).select("placa_norm", "anio", "mes", "es_pandemia_2020", "evento_mercado", "indice_quejas_marca"), {"indice_quejas_marca": 6})


FEATURES = ["pct_diferencia", "ratio_carga_capacidad", "flag_placa_divergente", "desvio_tc", "precio_vs_mediana_canal", "es_pandemia_2020", "evento_mercado", "indice_quejas_marca", "n_operaciones"]
UNIT = f"""SELECT b.*, coalesce(d.flag_placa_divergente, 0) AS flag_placa_divergente, coalesce(t.desvio_tc, 0) AS desvio_tc, p.precio_vs_mediana_canal,
  c.es_pandemia_2020, c.evento_mercado, c.indice_quejas_marca
  FROM ({MONTHS}) b LEFT JOIN ({DIVERGENCE}) d USING (placa_norm, anio, mes) LEFT JOIN ({DEVIATION}) t USING (placa_norm, anio, mes)
  LEFT JOIN ({PRICE}) p USING (placa_norm, anio, mes) LEFT JOIN ({CALENDAR}) c USING (placa_norm, anio, mes)"""


@query("unidad_mes", UNIT)
def unidad_mes(spark, sf_dir):
    return rounded(_features(spark, sf_dir), {c: 6 for c in FEATURES[:5] + ["indice_quejas_marca"]} | {"desvio_tc": 9})


@query("period_join", f"SELECT b.placa_norm, b.anio, b.mes, b.kg_comprados, d.flag_placa_divergente FROM ({MONTHS}) b LEFT JOIN ({DIVERGENCE}) d USING (placa_norm, anio, mes)")
def period_join(spark, sf_dir):
    base = G.month_base(_gold(spark, sf_dir)).select(*G.MONTH, "kg_comprados")
    return rounded(base.join(G.divergence(table(spark, sf_dir, "compras")), G.MONTH, "left"), {"flag_placa_divergente": 6})


@query("feature_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS media, round(min({c}), 4) AS minimo, round(quantile_cont({c}, 0.25), 4) AS q1, round(median({c}), 4) AS mediana, round(quantile_cont({c}, 0.75), 4) AS q3, round(max({c}), 4) AS maximo, round(stddev_samp({c}), 4) AS desviacion FROM ({UNIT}) u"
    for c in FEATURES[:5]))
def feature_summary(spark, sf_dir):
    f = _features(spark, sf_dir)
    cells = f.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x")) for c in FEATURES[:5]])).alias("v")).select("v.*")
    x = F.col("x")
    out = cells.groupBy("variable").agg(F.count(x).alias("n"), F.avg(x).alias("media"), F.stddev_samp(x).alias("desviacion"), F.min(x).alias("minimo"), F.percentile(x, 0.25).alias("q1"), F.median(x).alias("mediana"), F.percentile(x, 0.75).alias("q3"), F.max(x).alias("maximo"))
    return rounded(out, {c: 4 for c in ("media", "desviacion", "minimo", "q1", "mediana", "q3", "maximo")})


@query("kpi_difference", f"""SELECT anio, mes, sum(kg_comprados) AS kg_comprados, sum(kg_vendidos) AS kg_vendidos,
  round((sum(kg_comprados) - sum(kg_vendidos) - 0.005 * sum(kg_comprados)) / nullif(sum(kg_comprados), 0), 6) AS pct_diferencia_no_explicada,
  round(sum((kg_comprados - kg_vendidos) * 2.1), 2) AS valor_diferencia_soles FROM ({SUMS}) GROUP BY anio, mes""")
def kpi_difference(spark, sf_dir):
    return rounded(G.kpi_difference(_gold(spark, sf_dir)), {"pct_diferencia_no_explicada": 6, "valor_diferencia_soles": 2})


@query("replicate_scale", """SELECT CASE WHEN i > 0 THEN concat(substr(placa_norm, 1, 5), CAST(i % 10 AS string), '_', CAST(i AS string)) ELSE placa_norm END AS placa_norm,
  CASE WHEN i > 0 THEN concat(documento, '_r', CAST(i AS string)) ELSE documento END AS documento, kg_comprados, kg_vendidos FROM mov, range(3) r(i)""")
def replicate_scale(spark, sf_dir):
    return G.replicate(table(spark, sf_dir, "mov_kg"), 3).select("placa_norm", "documento", "kg_comprados", "kg_vendidos")


# analysis over Gold

#: The dimensions and the SQL of their rows: dates, vehicles, drivers (hashes alone), products, customers and signals.
DIMENSIONS = {
    "fecha": "SELECT DISTINCT fecha FROM mov", "vehiculo": "SELECT placa_norm FROM flota", "conductor": "SELECT DISTINCT sha256(concat('sal', upper(trim(s_name)))) FROM supplier WHERE trim(s_name) <> ''",
    "producto": "SELECT DISTINCT id_producto FROM mov", "cliente": "SELECT DISTINCT card_code FROM maestro", "senal": f"SELECT unnest({list(CATALOGUE)!r})",
}


@query("dimensions", " UNION ALL ".join(f"SELECT '{n}' AS dimension, count(*) AS filas FROM ({q})" for n, q in DIMENSIONS.items()))
def dimensions(spark, sf_dir):
    mov = table(spark, sf_dir, "mov_kg").select("fecha", "id_producto")
    people = table(spark, sf_dir, "supplier").select(C.pseudonym(F.col("s_name"), "sal").alias("conductor_hash"))
    signals = spark.createDataFrame([(k, v[0]) for k, v in CATALOGUE.items()], "senal string, descripcion string")
    tables = {
        "fecha": mov.select("fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), F.dayofweek("fecha").alias("dia_semana")).distinct(), "vehiculo": table(spark, sf_dir, "flota"),
        "conductor": people.dropna().distinct(), "producto": mov.select("id_producto").distinct(), "cliente": table(spark, sf_dir, "maestro").select("card_code", "capacidad_kg", "canal").dropDuplicates(["card_code"]), "senal": signals,
    }
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("dimension"), F.count("*").alias("filas")) for n, df in tables.items()])


@query("referential_integrity", "SELECT 'flota' AS dimension, count(*) AS huerfanas FROM mov WHERE placa_norm NOT IN (SELECT placa_norm FROM flota) UNION ALL SELECT 'maestro', count(*) FROM ventas v WHERE NOT EXISTS (SELECT 1 FROM maestro m WHERE m.card_code = v.card_code)")
def referential_integrity(spark, sf_dir):
    a = G.anti(table(spark, sf_dir, "mov_kg"), table(spark, sf_dir, "flota"), ["placa_norm"]).agg(F.lit("flota").alias("dimension"), F.count("*").alias("huerfanas"))
    b = G.anti(table(spark, sf_dir, "ventas"), table(spark, sf_dir, "maestro"), ["card_code"]).agg(F.lit("maestro").alias("dimension"), F.count("*").alias("huerfanas"))
    return a.unionByName(b)


@query("bias_by_segment", "SELECT canal, estado_flota, count(*) AS filas, round(avg(caro::INT), 6) AS tasa FROM (SELECT canal, f.habilitada AS estado_flota, kg > 40 AS caro FROM ventas LEFT JOIN flota f USING (placa_norm)) GROUP BY GROUPING SETS ((canal), (estado_flota), ())")
def bias_by_segment(spark, sf_dir):
    v = table(spark, sf_dir, "ventas").join(table(spark, sf_dir, "flota").select("placa_norm", F.col("habilitada").alias("estado_flota")), "placa_norm", "left")
    v = v.select("canal", "estado_flota", (F.col("kg") > 40).cast("int").alias("caro"))
    out = v.groupingSets([[F.col("canal")], [F.col("estado_flota")], []], F.col("canal"), F.col("estado_flota")).agg(F.count("*").alias("filas"), F.round(F.avg("caro"), 6).alias("tasa"))
    return out.select("canal", "estado_flota", "filas", "tasa")


PLATES = f"SELECT placa_norm, sum(kg_comprados) AS total FROM ({SUMS}) GROUP BY placa_norm"


@query("eda_series", f"""SELECT 'pareto' AS serie, placa_norm AS clave, total AS valor, round(sum(total) OVER (ORDER BY total DESC, placa_norm ROWS UNBOUNDED PRECEDING) / sum(total) OVER (), 6) AS acumulado FROM ({PLATES})
  UNION ALL SELECT 'diferencia', concat(CAST(anio AS string), '-', lpad(CAST(mes AS string), 2, '0')), round(sum(kg_comprados - kg_vendidos), 2), NULL FROM ({SUMS}) GROUP BY anio, mes
  UNION ALL SELECT 's1', placa_cargada, round(avg(flag_placa_divergente::INT), 6), NULL FROM compras GROUP BY placa_cargada""")
def eda_series(spark, sf_dir):
    """The Pareto of plates, the monthly difference, and each plate's share of divergent purchases."""
    totals = G.sums(table(spark, sf_dir, "mov_kg"))
    plates = totals.groupBy("placa_norm").agg(F.sum("kg_comprados").alias("total"))  # one row a plate
    run = running_sum(plates, [F.desc("total"), F.col("placa_norm")], F.col("total"), "hasta")
    pareto = run.join(F.broadcast(run.agg(F.sum("total").alias("todo"))))  # one row
    pareto = pareto.select(F.lit("pareto").alias("serie"), F.col("placa_norm").alias("clave"), F.col("total").alias("valor"), F.round(F.col("hasta") / F.col("todo"), 6).alias("acumulado"))
    none = F.lit(None).cast("double")
    month = F.concat_ws("-", F.col("anio").cast("string"), F.lpad(F.col("mes").cast("string"), 2, "0"))
    difference = totals.groupBy("anio", "mes").agg(F.round(F.sum(F.col("kg_comprados") - F.col("kg_vendidos")), 2).alias("valor")).select(F.lit("diferencia"), month, "valor", none)
    s1 = table(spark, sf_dir, "compras").groupBy("placa_cargada").agg(F.round(F.avg(F.col("flag_placa_divergente").cast("int")), 6).alias("valor")).select(F.lit("s1"), "placa_cargada", "valor", none)
    return pareto.union(difference).union(s1)


@query("other_kpis", """SELECT round(avg(flag_placa_divergente::INT), 6) AS tasa_divergencia, round((SELECT avg((documento_raw IS NOT NULL)::INT) FROM maestro), 6) AS maestro_enlazable,
  round((SELECT avg((o_orderpriority LIKE '1%')::INT) FROM orders WHERE o_orderstatus <> 'P'), 6) AS alertas_confirmadas, round(avg((codigo_scop IS NOT NULL)::INT), 6) AS tasa_scop FROM compras""")
def other_kpis(spark, sf_dir):
    """Divergence rate, customers with a document to link by, confirmed among reviewed alerts, purchases with a code.

    Reviews are orders here: reviewed unless their status is P, confirmed where their priority is the first."""
    reviews = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority").startswith("1")).alias("confirmada"))
    return G.other_kpis(table(spark, sf_dir, "compras"), table(spark, sf_dir, "maestro"), reviews)


@query("dedupe", "SELECT DISTINCT placa_norm, anio, mes FROM mov")
def dedupe(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").select("placa_norm", "anio", "mes").dropDuplicates()


@query("top_n", "SELECT documento, linea, placa_norm, kg, fecha FROM (SELECT *, row_number() OVER (ORDER BY kg DESC, documento, linea, fecha, placa_norm, precio) AS n FROM ventas) WHERE n <= 20")
def top_n(spark, sf_dir):
    return table(spark, sf_dir, "ventas").orderBy(F.desc("kg"), "documento", "linea", "fecha", "placa_norm", "precio").limit(20).select("documento", "linea", "placa_norm", "kg", "fecha")


@query("inspect", "SELECT documento, linea, fecha, kg FROM ventas ORDER BY fecha, documento, linea, kg, precio LIMIT 5")
def inspect(spark, sf_dir):
    return table(spark, sf_dir, "ventas").orderBy("fecha", "documento", "linea", "kg", "precio").limit(5).select("documento", "linea", "fecha", "kg")


@query("price_notes", "SELECT CAST(year(ts) AS int) AS anio, CAST(month(ts) AS int) AS mes, event_type, count(*) AS notas, round(avg(value), 4) AS media FROM events GROUP BY ALL")
def price_notes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.year("ts").alias("anio"), F.month("ts").alias("mes"), "event_type").agg(F.count("*").alias("notas"), F.round(F.avg("value"), 4).alias("media"))


@query("valid_plate_only", "SELECT count(*) AS filas FROM mov WHERE placa_norm IS NOT NULL")
def valid_plate_only(spark, sf_dir):
    return table(spark, sf_dir, "mov_kg").filter("placa_norm is not null").agg(F.count("*").alias("filas"))
