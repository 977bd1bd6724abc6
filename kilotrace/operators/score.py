"""Robust scores, priorities and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilotrace.operators.gold import group_values
from kilotrace.operators.ordering import running_sum
from kilotrace.operators.quantiles import exact_quantiles
from kilotrace.operators.signals import Z_LIMIT, role_volume
from kilotrace.sources.lake import once


def finite(c: str) -> Column:
    return F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c))


def robust_z(df: DataFrame, value: str, by: list[str], name: str = "z", least: float | None = None) -> DataFrame:
    """0.6745 (x - median) / MAD in each group. A MAD of 0 gives no score, or counts as ``least`` if given.

    Groups' medians are two aggregates joined back; those of the whole table are found by rounds of range histograms.
    """
    if by:
        df = group_values(df.withColumn("_x", finite(value)), by, F.median("_x").alias("_mid"))
        df = group_values(df.withColumn("_off", F.abs(F.col("_x") - F.col("_mid"))), by, F.median("_off").alias("_mad"))
    else:
        number = lambda x: F.lit(x).cast("double")
        df = once(df.withColumn("_x", finite(value)), "puntajes")  # read once a round
        df = df.withColumn("_mid", number(exact_quantiles(df, ["_x"], [0.5])["_x"][0]))
        df = df.withColumn("_off", F.abs(F.col("_x") - F.col("_mid")))
        df = df.withColumn("_mad", number(exact_quantiles(df, ["_off"], [0.5])["_off"][0]))
    mad = F.when(F.col("_mad") > 0, F.col("_mad"))
    return df.withColumn(name, 0.6745 * (F.col("_x") - F.col("_mid")) / (mad if least is None else F.coalesce(mad, F.lit(least)))).drop("_x", "_mid", "_off", "_mad")


def mad_score(months: DataFrame, limit: float = Z_LIMIT) -> DataFrame:
    """Fuel a tonne of the role's volume, its log's robust z by role, and why there may be none."""
    if not 0 < limit < float("inf"):
        raise ValueError("the limit must be positive and finite")
    fuel, volume = F.col("gasto_combustible"), F.col("kg_base_rol")
    ratio = F.when((volume > 0) & (fuel > 0), fuel / (volume / 1000))
    df = months.withColumn("kg_base_rol", role_volume()).withColumn("soles_comb_por_t", ratio).withColumn("log_combustible_por_t", F.ln("soles_comb_por_t"))
    df = robust_z(df, "log_combustible_por_t", ["rol"]).withColumn("puntaje", F.abs("z"))
    why = F.when(F.col("soles_comb_por_t").isNull(), "sin_combustible_o_volumen_positivo").when(F.col("z").isNull(), "mad_cero_o_sin_grupo_evaluable").otherwise("evaluable")
    return df.withColumns({"alerta_base": F.coalesce(F.col("puntaje") > limit, F.lit(False)), "estado_puntaje": why})


def mad_score_v2(months: DataFrame, value: str = "pct_diferencia", by: list[str] | None = None, limit: float = Z_LIMIT) -> DataFrame:
    """Shortages only: alerts where z, not its size, is over the limit."""
    df = robust_z(months, value, by or [], least=1e-9)
    return df.withColumns({"puntaje": F.col("z"), "alerta_base": F.coalesce(F.col("z") > limit, F.lit(False))})


def weak_label(months: DataFrame, alerts: DataFrame, signals: tuple[str, ...] = ("S1", "S8")) -> DataFrame:
    keys = ["placa_norm", "anio", "mes"]
    hit = alerts.filter(F.col("senal").isin(*signals)).select(*keys).distinct().withColumn("etiqueta", F.lit(1))
    return months.join(hit, keys, "left").fillna(0, ["etiqueta"])


def top_k(df: DataFrame, k: int, score: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(k)


def precision_at_k(df: DataFrame, k: int, score: str, label: str, *ties: str, strict: bool = False) -> DataFrame:
    """The mean label of the k best. Strict: null if fewer are scored or a label is missing."""
    best = top_k(df.filter(F.col(score).isNotNull()) if strict else df, k, score, *ties)
    mean = F.avg(F.col(label).cast("double"))
    return best.agg(F.when((F.count("*") == k) & (F.count(label) == k), mean).alias("precision") if strict else F.coalesce(mean, F.lit(0.0)).alias("precision"))


def base_metrics(df: DataFrame, k: int, *ties: str) -> DataFrame:
    """Precision, share of short kilos in alerts, alerts a month (mean and most), and all alerts."""
    short = F.greatest(F.col("kg_diferencia"), F.lit(0.0))
    share = df.agg(F.coalesce(F.sum(F.when(F.col("alerta_base"), short)) / F.nullif(F.sum(short), F.lit(0.0)), F.lit(0.0)).alias("pct_kg_cubiertos"), F.count_if("alerta_base").alias("alertas_total"))
    months = df.filter("alerta_base").groupBy("anio", "mes").count().agg(F.coalesce(F.avg("count"), F.lit(0.0)).alias("alertas_por_mes_media"), F.coalesce(F.max("count"), F.lit(0)).alias("alertas_por_mes_max"))
    return precision_at_k(df, k, "puntaje", "etiqueta", *ties).crossJoin(share).crossJoin(months)  # three single rows


def average_percentile(df: DataFrame, score: str, by: str) -> DataFrame:
    """``df`` with the average rank of ties, as a share of the group, in ``percentil``.

    Distinct scores are counted first; their counts are summed along (group, score) by ranges, so that a group with
    most of the scores fills many tasks, and what the groups before it have is taken away again.
    """
    each = df.groupBy(F.col(by).alias("_g"), F.col(score).alias("_s")).agg(F.count("*").alias("_n"))
    run = running_sum(each, [F.col("_g"), F.col("_s")], F.col("_n"), "_upto")
    groups = run.groupBy("_g").agg(F.min(F.col("_upto") - F.col("_n")).alias("_first"), F.sum("_n").alias("_all"))
    ranks = run.join(groups, "_g").withColumn("percentil", (F.col("_upto") - F.col("_n") - F.col("_first") + (F.col("_n") + 1) / 2) / F.col("_all"))
    return df.join(ranks.select("_g", "_s", "percentil"), (F.col(by) == F.col("_g")) & (F.col(score) == F.col("_s"))).drop("_g", "_s")


def prioritize(alerts: DataFrame, k: int) -> DataFrame:
    """By evidence, percentile within the signal, newest date, then identifier."""
    grade = F.when(F.col("grado_evidencia") == "alto", 2).when(F.col("grado_evidencia") == "medio", 1).otherwise(0)
    ranked = average_percentile(alerts, "puntaje", "senal")
    return ranked.orderBy(grade.desc(), F.desc("percentil"), F.desc("fecha"), "id_alerta").limit(k).drop("percentil")


def blind_sample(alerts: DataFrame, top: DataFrame, extra: int, seed: int) -> DataFrame:
    """The top and ``extra`` others chosen by hash, in hash order, without scores or grades."""
    place = lambda n: F.md5(F.concat_ws("|", F.lit(str(n)), "id_alerta"))
    rest = alerts.join(top.select("id_alerta"), "id_alerta", "left_anti").orderBy(place(seed), "id_alerta").limit(extra)
    fields = ["id_alerta", "senal", "resolucion", "fecha", "unidad_id", "rol", "factura_id", "codigo_scop", "kg", "motivo", "fuentes"]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("confirmada", "boolean"), ("revisor_id", "string"), ("evidencia_ref", "string"))]
    return top.select(*fields).unionByName(rest.select(*fields)).orderBy(place(seed + 1)).select(*fields, *none)


def alerts_per_month(alerts: DataFrame, periods: DataFrame) -> DataFrame:
    """Distinct alerts of every observed month, 0 where there are none."""
    counts = alerts.groupBy("anio", "mes").agg(F.count_distinct("id_alerta").alias("alertas"))
    return periods.select("anio", "mes").distinct().join(counts, ["anio", "mes"], "left").fillna(0, ["alertas"])


def review_violations(reviews: DataFrame, alerts: DataFrame, author: str) -> DataFrame:
    """How many reviews break each condition: known and unique identifiers, another reviewer, and evidence."""
    known = alerts.select("id_alerta").distinct().withColumn("_known", F.lit(True))
    r = reviews.join(known, "id_alerta", "left")
    done = F.col("confirmada").isNotNull()
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    own = F.lower(F.trim("revisor_id")) == author.strip().lower()
    return r.agg(
        F.count_if(F.col("_known").isNull()).alias("desconocidas"), (F.count("id_alerta") - F.count_distinct("id_alerta")).alias("repetidas"),
        F.count_if(done & (blank(F.col("revisor_id")) | F.coalesce(own, F.lit(False)))).alias("revisor_invalido"), F.count_if(done & blank(F.col("evidencia_ref"))).alias("sin_evidencia"),
    )


def documentary_metrics(alerts: DataFrame, top: DataFrame, reviews: DataFrame, cases: DataFrame, gaps: DataFrame, k: int) -> DataFrame:
    """Precision of the reviewed top, recall of known cases and share of attributable kilos; null without evidence."""
    ids = alerts.select("id_alerta").distinct().withColumn("_hit", F.lit(1))
    t = top.select("id_alerta").join(reviews.select("id_alerta", F.col("confirmada").cast("double").alias("c")), "id_alerta", "left")
    t = t.agg(F.when((F.count("*") == k) & (F.count("c") == k), F.avg("c")).alias("precision"), F.count("c").alias("top_revisadas"))
    c = cases.join(ids, "id_alerta", "left").agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("recuperacion"), F.count("*").alias("casos_conocidos"))
    kg = F.greatest(F.col("kg_diferencia"), F.lit(0.0))
    g = gaps.join(ids, "id_alerta", "left").agg((F.sum(F.when(F.col("_hit") == 1, kg).otherwise(0.0)) / F.nullif(F.sum(kg), F.lit(0.0))).alias("pct_kg_cubiertos"))
    return t.crossJoin(c).crossJoin(g)  # three single rows


def robust_scale(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """(x - median) / interquartile range, both of ``train``, found exactly by rounds of range histograms; a column
    that train has no value of scales to null."""
    fit = exact_quantiles(train, columns, [0.25, 0.5, 0.75])
    scaled = {}
    for c, (low, middle, high) in fit.items():
        wide = None if middle is None else 1.0 if high == low else high - low
        scaled[c] = (F.col(c) - F.lit(middle).cast("double")) / F.lit(wide).cast("double")
    return df.withColumns(scaled)
