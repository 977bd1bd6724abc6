"""The whole pipeline: Silver movements, Gold reconciliation, signals, features and base scores, each materialised once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.operators import gold as G
from kilotrace.operators import score as K
from kilotrace.operators import signals as S
from kilotrace.operators.silver import movements
from kilotrace.sources.lake import workspace, write_partitioned


def run(spark: SparkSession, purchases: DataFrame, sales: DataFrame, fleet: DataFrame, master: DataFrame, rates: DataFrame, pandemic_year: int, lake: str | None = None) -> dict[str, DataFrame]:
    """Writes movements, reconciliation, alerts and scored unit-months under ``lake``; returns the written tables."""
    lake = lake or workspace(spark, "lake")

    def keep(name: str, df: DataFrame) -> DataFrame:
        write_partitioned(df, f"{lake}/{name}")
        return spark.read.parquet(f"{lake}/{name}")

    mov = keep("silver/movimientos", movements(purchases, sales))
    gold = keep("gold/fact_conciliacion_unidad", G.reconcile(mov, fleet))
    alerts = keep("gold/fact_alerta", S.all_v2(purchases, sales, fleet, master))
    months = G.month_features(gold, purchases, sales, rates, pandemic_year)
    scored = keep("gold/unidad_mes", K.weak_label(K.mad_score_v2(months), alerts))
    return {"movimientos": mov, "conciliacion": gold, "alertas": alerts, "unidad_mes": scored}


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every written table, and the kilos that all stages must conserve."""
    out = None
    for name, df in tables.items():
        kilos = F.round(F.sum("kg_comprados"), 2) if "kg_comprados" in df.columns else F.lit(None).cast("double")
        part = df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"), kilos.alias("kg_comprados"))
        out = part if out is None else out.unionByName(part)
    return out
