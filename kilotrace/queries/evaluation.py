"""Queries of scores, priorities, metrics and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilotrace.operators import gold as G
from kilotrace.operators import models as M
from kilotrace.operators import score as K
from kilotrace.queries import rules as R
from kilotrace.queries.gold import FEATURES, MONTHS, UNIT, rounded, unidad_mes
from kilotrace.queries.gold import _gold as gold_of
from kilotrace.queries.registry import query
from kilotrace.sources.domain import PILOT, table
from kilotrace.sources.lake import once

MONTH = "placa_norm, anio, mes"
#: Of all models with chance in them.
SEED = 42
#: Unit-months with the figures that scores need.
SHORT = f"SELECT {MONTH}, kg_comprados, kg_vendidos, kg_diferencia, CASE WHEN kg_comprados > 0 THEN kg_diferencia / kg_comprados END AS pct FROM ({MONTHS})"


def months(spark, sf_dir):
    return G.month_base(gold_of(spark, sf_dir))


@query("group_median", "SELECT DISTINCT canal, id_producto, anio, mes, median(kg) OVER (PARTITION BY canal, id_producto, anio, mes) AS mediana FROM ventas")
def group_median(spark, sf_dir):
    return G.group_median(table(spark, sf_dir, "ventas"), "kg", G.GROUP).select(*G.GROUP, "mediana").distinct()


@query("group_percentiles", "SELECT canal, id_producto, anio, mes, round(quantile_cont(kg, 0.01), 4) AS p01, round(quantile_cont(kg, 0.99), 4) AS p99 FROM ventas GROUP BY ALL")
def group_percentiles(spark, sf_dir):
    p = table(spark, sf_dir, "ventas").groupBy(*G.GROUP).agg(F.percentile("kg", 0.01).alias("p01"), F.percentile("kg", 0.99).alias("p99"))
    return rounded(p, {"p01": 4, "p99": 4})


@query("ffill_window", "SELECT placa_norm, anio, mes, last_value(v IGNORE NULLS) OVER (PARTITION BY placa_norm ORDER BY anio, mes ROWS UNBOUNDED PRECEDING) AS ultimo FROM (SELECT placa_norm, anio, mes, CASE WHEN sum(kg_comprados) > 80 THEN sum(kg_comprados) END AS v FROM mov GROUP BY ALL)")
def ffill_window(spark, sf_dir):
    from pyspark.sql import Window

    m = table(spark, sf_dir, "mov_kg").groupBy(*G.MONTH).agg(F.sum("kg_comprados").alias("s"))
    w = Window.partitionBy("placa_norm").orderBy("anio", "mes").rowsBetween(Window.unboundedPreceding, 0)
    return m.select(*G.MONTH, F.last(F.when(F.col("s") > 80, F.col("s")), ignorenulls=True).over(w).alias("ultimo"))


@query("percentile_rank_in_signal", f"SELECT id_alerta, senal, round((rank() OVER (PARTITION BY senal ORDER BY puntaje) + (count(*) OVER (PARTITION BY senal, puntaje) - 1) / 2.0) / count(*) OVER (PARTITION BY senal), 6) AS percentil FROM ({R.V6_ALL})")
def percentile_rank_in_signal(spark, sf_dir):
    a = rounded(R.all_v6(spark, sf_dir), R.SHOWN)
    return rounded(K.average_percentile(a, "puntaje", "senal").select("id_alerta", "senal", "percentil"), {"percentil": 6})


@query("robust_z_v6", f"SELECT unidad_id, rol, anio, mes, round(0.6745 * (x - mid) / nullif(mad, 0), 6) AS z FROM {R.Z}")
def robust_z_v6(spark, sf_dir):
    return rounded(K.mad_score(table(spark, sf_dir, "unidad_mes6").filter(R.YEAR)).select("unidad_id", "rol", "anio", "mes", "z"), {"z": 6})


@query("mad_score_v6", f"""SELECT unidad_id, rol, anio, mes, kg_base_rol, round(z_abs, 6) AS puntaje, odd AS alerta_base, CASE WHEN x IS NULL THEN 'sin_combustible_o_volumen_positivo' WHEN z_abs IS NULL THEN 'mad_cero_o_sin_grupo_evaluable' ELSE 'evaluable' END AS estado_puntaje FROM {R.Z}""")
def mad_score_v6(spark, sf_dir):
    return rounded(K.mad_score(table(spark, sf_dir, "unidad_mes6").filter(R.YEAR)).select("unidad_id", "rol", "anio", "mes", "kg_base_rol", "puntaje", "alerta_base", "estado_puntaje"), {"puntaje": 6})


SCORED = f"""SELECT *, 0.6745 * (pct - mid) / CASE WHEN mad = 0 THEN 1e-9 ELSE mad END AS z FROM (SELECT *, median(abs(pct - mid)) OVER () AS mad FROM (SELECT *, median(pct) OVER () AS mid FROM ({SHORT})))"""
LABEL = f"SELECT DISTINCT {MONTH}, 1 AS y FROM ({R.V2['S1']} UNION ALL {R.V2['S8']})"
LABELLED = f"SELECT s.*, coalesce(l.y, 0) AS etiqueta, coalesce(s.z > 3.5, false) AS alerta_base FROM ({SCORED}) s LEFT JOIN ({LABEL}) l USING ({MONTH})"
BEST = f"(SELECT * FROM ({LABELLED}) ORDER BY z DESC NULLS LAST, {MONTH} LIMIT 20)"


def scored(spark, sf_dir):
    return K.mad_score_v2(months(spark, sf_dir))


def labelled(spark, sf_dir):
    return K.weak_label(scored(spark, sf_dir), R.all_v2(spark, sf_dir))


@query("robust_z_v2", f"SELECT {MONTH}, round(z, 6) AS z FROM ({SCORED})")
def robust_z_v2(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select(*G.MONTH, "z"), {"z": 6})


@query("mad_score_v2", f"SELECT {MONTH}, coalesce(z > 3.5, false) AS alerta_base FROM ({SCORED})")
def mad_score_v2(spark, sf_dir):
    return scored(spark, sf_dir).select(*G.MONTH, "alerta_base")


@query("weak_label", f"SELECT {MONTH}, etiqueta FROM ({LABELLED})")
def weak_label(spark, sf_dir):
    return labelled(spark, sf_dir).select(*G.MONTH, "etiqueta")


@query("top_k", f"SELECT {MONTH}, kg_diferencia FROM {BEST}")
def top_k(spark, sf_dir):
    return K.top_k(scored(spark, sf_dir), 20, "puntaje", *G.MONTH).select(*G.MONTH, "kg_diferencia")


@query("precision_at_k", f"SELECT 'v2' AS version, avg(etiqueta) AS precision FROM {BEST} UNION ALL SELECT 'v6', CASE WHEN count(*) = 20 THEN avg(etiqueta) END FROM {BEST} WHERE z IS NOT NULL")
def precision_at_k(spark, sf_dir):
    df = labelled(spark, sf_dir)
    a = K.precision_at_k(df, 20, "puntaje", "etiqueta", *G.MONTH).withColumn("version", F.lit("v2"))
    return a.unionByName(K.precision_at_k(df, 20, "puntaje", "etiqueta", *G.MONTH, strict=True).withColumn("version", F.lit("v6")))


@query("base_metrics", f"""SELECT (SELECT avg(etiqueta) FROM {BEST}) AS precision, round((SELECT coalesce(sum(greatest(kg_diferencia, 0)) FILTER (WHERE alerta_base) / nullif(sum(greatest(kg_diferencia, 0)), 0), 0) FROM ({LABELLED})), 6) AS pct_kg_cubiertos,
  (SELECT count(*) FROM ({LABELLED}) WHERE alerta_base) AS alertas_total, round((SELECT coalesce(avg(n), 0) FROM (SELECT count(*) AS n FROM ({LABELLED}) WHERE alerta_base GROUP BY anio, mes)), 6) AS alertas_por_mes_media,
  (SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM ({LABELLED}) WHERE alerta_base GROUP BY anio, mes)) AS alertas_por_mes_max""")
def base_metrics(spark, sf_dir):
    return rounded(K.base_metrics(once(labelled(spark, sf_dir), "etiquetas"), 20, *G.MONTH), {"pct_kg_cubiertos": 6, "alertas_por_mes_media": 6})


TOP = f"""(SELECT * FROM (SELECT *, (rank() OVER (PARTITION BY senal ORDER BY puntaje) + (count(*) OVER (PARTITION BY senal, puntaje) - 1) / 2.0) / count(*) OVER (PARTITION BY senal) AS p FROM ({R.V6_ALL}))
  ORDER BY CASE grado_evidencia WHEN 'alto' THEN 2 ELSE 1 END DESC, p DESC, fecha DESC, id_alerta LIMIT 20)"""


def top_alerts(spark, sf_dir):
    return K.prioritize(rounded(R.all_v6(spark, sf_dir), R.SHOWN), 20)


@query("prioritize", f"SELECT id_alerta, senal, fecha, puntaje FROM {TOP}")
def prioritize(spark, sf_dir):
    return top_alerts(spark, sf_dir).select("id_alerta", "senal", "fecha", "puntaje")


BLIND = "id_alerta, senal, resolucion, fecha, unidad_id, rol, factura_id, codigo_scop, kg, motivo, fuentes"


@query("blind_sample", f"""SELECT *, NULL::BOOLEAN AS confirmada, NULL::VARCHAR AS revisor_id, NULL::VARCHAR AS evidencia_ref FROM (SELECT {BLIND} FROM {TOP}
  UNION ALL (SELECT {BLIND} FROM ({R.V6_ALL}) WHERE id_alerta NOT IN (SELECT id_alerta FROM {TOP}) ORDER BY md5('42|' || id_alerta), id_alerta LIMIT 10))""")
def blind_sample(spark, sf_dir):
    return K.blind_sample(R.all_v6(spark, sf_dir), top_alerts(spark, sf_dir), 10, 42)


PERIODS = "SELECT DISTINCT anio, mes FROM unidad_mes6 UNION SELECT DISTINCT CAST(year(fecha) AS INT), CAST(month(fecha) AS INT) FROM compras6 UNION SELECT DISTINCT CAST(year(fecha) AS INT), CAST(month(fecha) AS INT) FROM produccion"


def periods(spark, sf_dir):
    out = table(spark, sf_dir, "unidad_mes6").select("anio", "mes")
    for n in ("compras6", "produccion"):
        out = out.union(table(spark, sf_dir, n).select(F.year("fecha"), F.month("fecha")))
    return out.distinct()


@query("observed_periods", PERIODS)
def observed_periods(spark, sf_dir):
    return periods(spark, sf_dir)


@query("alerts_per_month", f"SELECT p.anio, p.mes, coalesce(a.n, 0) AS alertas FROM ({PERIODS}) p LEFT JOIN (SELECT anio, mes, count(DISTINCT id_alerta) AS n FROM ({R.V6_ALL}) GROUP BY ALL) a ON p.anio = a.anio AND p.mes = a.mes")
def alerts_per_month(spark, sf_dir):
    return K.alerts_per_month(R.all_v6(spark, sf_dir), periods(spark, sf_dir))


REVIEWED = {
    "confirmada": "CASE WHEN ascii(id_alerta) % 3 = 0 THEN NULL ELSE ascii(id_alerta) % 2 = 0 END",
    "revisor_id": "CASE WHEN ascii(id_alerta) % 5 = 0 THEN 'Autora' ELSE 'revisor' END",
    "evidencia_ref": "CASE WHEN ascii(id_alerta) % 7 = 0 THEN ' ' ELSE 'acta' END",
}
REVIEW = ", ".join(f"{x} AS {c}" for c, x in REVIEWED.items())


@query("validate_reviews", f"""SELECT 0::BIGINT AS desconocidas, count(*) - count(DISTINCT id_alerta) AS repetidas, count(*) FILTER (WHERE confirmada IS NOT NULL AND revisor_id = 'Autora') AS revisor_invalido,
  count(*) FILTER (WHERE confirmada IS NOT NULL AND trim(evidencia_ref) = '') AS sin_evidencia FROM (SELECT id_alerta, {REVIEW} FROM ({R.V6_ALL}))""")
def validate_reviews(spark, sf_dir):
    a = R.all_v6(spark, sf_dir)
    return K.review_violations(a.select("id_alerta", *[F.expr(x).alias(c) for c, x in REVIEWED.items()]), a, "autora")


@query("documentary_metrics", f"""SELECT (SELECT avg((ascii(id_alerta) % 2)::DOUBLE) FROM {TOP}) AS precision, (SELECT count(*) FROM {TOP}) AS top_revisadas,
  round((SELECT avg((factura_id IN (SELECT factura_id FROM ({R.V6['S2']})))::INT) FROM compras6), 6) AS recuperacion, (SELECT count(*) FROM compras6) AS casos_conocidos,
  round((SELECT sum(kg) FILTER (WHERE factura_id IN (SELECT factura_id FROM ({R.V6['S2']}))) / sum(kg) FROM compras6), 6) AS pct_kg_cubiertos""")
def documentary_metrics(spark, sf_dir):
    s2 = R.v6(spark, sf_dir, "S2").select("factura_id", "id_alerta")
    cases = table(spark, sf_dir, "compras6").select(F.col("factura_id").alias("caso_id"), F.col("kg").alias("kg_diferencia")).join(s2.withColumnRenamed("factura_id", "caso_id"), "caso_id", "left")
    top = top_alerts(spark, sf_dir)
    reviews = top.select("id_alerta", (F.ascii("id_alerta") % 2 == 1).alias("confirmada"))
    return rounded(K.documentary_metrics(R.all_v6(spark, sf_dir), top, reviews, cases, cases, 20), {"recuperacion": 6, "pct_kg_cubiertos": 6})


FEATURE = list("abcdefghi")  # short names of the nine, in their order
NINE = ", ".join(f"{c} + 0.0 AS {x}" for c, x in zip(FEATURES, FEATURE, strict=True))
VECTOR = f"SELECT concat_ws('|', placa_norm, CAST(anio AS string), CAST(mes AS string)) AS id, anio, {NINE} FROM ({UNIT}) u WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}"
SCALE = f"SELECT v.id, v.anio, {', '.join(f'({x} - {x}2) / CASE WHEN {x}3 = {x}1 THEN 1 ELSE {x}3 - {x}1 END AS {x}' for x in FEATURE)} FROM vec v, (SELECT " + ", ".join(f"quantile_cont({x}, 0.25) AS {x}1, median({x}) AS {x}2, quantile_cont({x}, 0.75) AS {x}3" for x in FEATURE) + f" FROM vec WHERE anio < {PILOT})"


def vectors(spark, sf_dir):
    """Every unit-month that has all nine features, scaled by the years before the pilot."""
    m = unidad_mes(spark, sf_dir).select(F.concat_ws("|", *G.MONTH).alias("id"), "anio", *[F.col(c).cast("double").alias(x) for c, x in zip(FEATURES, FEATURE, strict=True)]).dropna(subset=FEATURE)
    m = once(m, "vectores")
    return K.robust_scale(m, m.filter(F.col("anio") < PILOT), FEATURE)


@query("robust_scale", f"WITH vec AS ({VECTOR}) SELECT id, {', '.join(f'round({x}, 6) AS {x}' for x in FEATURE)} FROM ({SCALE})")
def robust_scale(spark, sf_dir):
    return rounded(vectors(spark, sf_dir).select("id", *FEATURE), dict.fromkeys(FEATURE, 6))


def _sets(spark, sf_dir):
    """What is learned from, all years before the pilot; what is scored, the pilot year and all later ones; and all."""
    v = once(vectors(spark, sf_dir).select("id", "anio", F.array(*FEATURE).alias("v")), "escalados")
    return v.filter(F.col("anio") < PILOT).select("id", "v"), v.filter(F.col("anio") >= PILOT).select("id", "v"), v.select("id", "v")


APART = "sqrt(" + " + ".join(f"pow({{q}}.{x} - {{t}}.{x}, 2)" for x in FEATURE) + ")"
NEAR = f"SELECT {{q}}.id, {{t}}.id AS near, {APART} AS d, row_number() OVER (PARTITION BY {{q}}.id ORDER BY {APART}, {{t}}.id) AS r"


@query("lof_score", f"""WITH vec AS ({VECTOR}), s AS ({SCALE}), tr AS (SELECT * FROM s WHERE anio < {PILOT}), qu AS (SELECT * FROM s WHERE anio >= {PILOT}),
  nt AS (SELECT * FROM ({NEAR.format(q='x', t='y')} FROM tr x JOIN tr y ON x.id <> y.id) WHERE r <= 10), nq AS (SELECT * FROM ({NEAR.format(q='x', t='y')} FROM qu x, tr y) WHERE r <= 10),
  kd AS (SELECT id AS near, d AS kd FROM nt WHERE r = 10), lt AS (SELECT id AS near, 1 / (avg(greatest(d, kd)) + 1e-10) AS l FROM nt JOIN kd USING (near) GROUP BY id),
  lq AS (SELECT id, 1 / (avg(greatest(d, kd)) + 1e-10) AS l FROM nq JOIN kd USING (near) GROUP BY id)
  SELECT nq.id, round(avg(lt.l) / max(lq.l), 4) AS puntaje FROM nq JOIN lt USING (near) JOIN lq ON nq.id = lq.id GROUP BY nq.id""")
def lof_score(spark, sf_dir):
    train, queries, _ = _sets(spark, sf_dir)
    return rounded(M.lof(train, queries, 10), {"puntaje": 4})


@query("iforest_score")
def iforest_score(spark, sf_dir):
    train, queries, _ = _sets(spark, sf_dir)
    return M.iforest(train, queries, 100, 256, SEED)


def _grid(spark, sf_dir, train, queries):
    labels = once(labelled(spark, sf_dir), "etiquetas").select(F.concat_ws("|", *G.MONTH).alias("id"), "anio", "etiqueta")
    return M.model_grid(train, queries, labels, 20, SEED, PILOT)


@query("model_grid")
def model_grid(spark, sf_dir):
    """All 14 points, each with its precision on the pilot year and on later ones."""
    train, queries, _ = _sets(spark, sf_dir)
    return _grid(spark, sf_dir, train, queries)


@query("model_grid_lof", f"""WITH vec AS ({VECTOR}), s AS ({SCALE}), tr AS (SELECT * FROM s WHERE anio < {PILOT}), qu AS (SELECT * FROM s WHERE anio >= {PILOT}),
  nt AS (SELECT * FROM ({NEAR.format(q='x', t='y')} FROM tr x JOIN tr y ON x.id <> y.id) WHERE r <= 35), nq AS (SELECT * FROM ({NEAR.format(q='x', t='y')} FROM qu x, tr y) WHERE r <= 35),
  kd AS (SELECT id AS near, d AS kd, r AS k FROM nt WHERE r IN (10, 20, 35)), lt AS (SELECT k, id AS near, 1 / (avg(greatest(d, kd)) + 1e-10) AS l FROM nt JOIN kd USING (near) WHERE r <= k GROUP BY k, id),
  lq AS (SELECT k, id, 1 / (avg(greatest(d, kd)) + 1e-10) AS l FROM nq JOIN kd USING (near) WHERE r <= k GROUP BY k, id),
  sc AS (SELECT lt.k, nq.id, avg(lt.l) / max(lq.l) AS x FROM nq JOIN lt ON nq.near = lt.near AND nq.r <= lt.k JOIN lq ON lq.id = nq.id AND lq.k = lt.k GROUP BY lt.k, nq.id),
  lab AS (SELECT concat_ws('|', placa_norm, CAST(anio AS string), CAST(mes AS string)) AS id, anio, etiqueta FROM ({LABELLED})),
  best AS (SELECT k, anio = {PILOT} AS piloto, etiqueta, row_number() OVER (PARTITION BY k, anio = {PILOT} ORDER BY x DESC, id) AS n FROM sc JOIN lab USING (id))
  SELECT k AS n_neighbors, c.contamination, avg(etiqueta) FILTER (piloto) AS precision_piloto, avg(etiqueta) FILTER (NOT piloto) AS precision_estabilidad FROM best, (SELECT unnest([0.02::DOUBLE, 0.05::DOUBLE]) AS contamination) c WHERE n <= 20 GROUP BY ALL""")
def model_grid_lof(spark, sf_dir):
    """The grid's points without chance, which SQL can work out too."""
    train, queries, _ = _sets(spark, sf_dir)
    return _grid(spark, sf_dir, train, queries).filter("modelo = 'lof'").select("n_neighbors", "contamination", "precision_piloto", "precision_estabilidad")


@query("model_scores")
def model_scores(spark, sf_dir):
    """Every unit-month with all features, scored by the best point of the grid."""
    train, queries, every = _sets(spark, sf_dir)
    best = _grid(spark, sf_dir, train, queries).filter("mejor").first().asDict()
    scored = M.final_scores(train, every, best, SEED)
    name = F.concat_ws("_", *[F.lit(str(best[c])) for c in ("modelo", "n_estimators", "max_samples", "n_neighbors") if best[c] is not None])
    key = F.split("id", r"\|")
    return scored.select(key[0].alias("placa_norm"), key[1].cast("int").alias("anio"), key[2].cast("int").alias("mes"), name.alias("modelo"), "puntaje_modelo")


@query("synthetic_validation", f"SELECT avg(verdad) AS precision FROM (SELECT b.*, (EXISTS (SELECT 1 FROM compras c WHERE c.flag_placa_divergente AND c.placa_cargada = b.placa_norm AND c.anio = b.anio AND c.mes = b.mes))::INT AS verdad FROM {BEST} b)")
def synthetic_validation(spark, sf_dir):
    truth = table(spark, sf_dir, "compras").filter("flag_placa_divergente").select(F.col("placa_cargada").alias("placa_norm"), "anio", "mes").distinct().withColumn("verdad", F.lit(1))
    df = scored(spark, sf_dir).join(truth, G.MONTH, "left").fillna(0, ["verdad"])
    return K.precision_at_k(df, 20, "puntaje", "verdad", *G.MONTH)


