"""Quality rules, rejects, reports and baseline statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilotrace.functions import clean as C
from kilotrace.operators.gold import GROUP, group_values

PRICE_LOW, PRICE_HIGH, RATE_TOLERANCE = 0.01, 0.99, 0.01
#: Rule to target share; None: no target.
TARGETS = {"placa_valida": 0.98, "kg_en_rango": 0.99, "fecha_coherente": None, "tc_coherente": None, "precio_en_rango": None, "unicidad": None}


def kg_in_range(kg: Column, capacity: Column | None = None) -> Column:
    ok = kg.isNotNull() & (kg > 0)
    return ok if capacity is None else ok & (capacity.isNull() | (kg <= capacity))


def date_in_scope(date: Column, first: int, last: int) -> Column:
    return F.coalesce(F.year(date).between(first, last), F.lit(False))


def rate_coherent(rate: Column, official: Column, tolerance: float = RATE_TOLERANCE) -> Column:
    off = F.abs(rate - official) / official
    return off.isNull() | (off <= tolerance)


def price_in_range(df: DataFrame, price: str = "precio", name: str = "precio_ok") -> DataFrame:
    """``df`` with a flag: the price is null, or within P1 and P99 of its group; a null group key has no bounds."""
    out = group_values(df, GROUP, F.percentile(price, F.array(F.lit(PRICE_LOW), F.lit(PRICE_HIGH))).alias("_q"))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in GROUP])
    return out.withColumn(name, F.col(price).isNull() | (keyed & F.coalesce(F.col(price).between(F.col("_q")[0], F.col("_q")[1]), F.lit(False)))).drop("_q")


def first_of(df: DataFrame, key: list[str], order: list[str], name: str = "unico") -> DataFrame:
    """``df`` with a flag on the first row of each key in ``order`` (which must be total); null keys are equal.

    The least row of each key is aggregated with map-side minima and joined back: a hot key is never sorted whole.
    """
    least = F.min(F.struct(*order)).alias("_first")
    out = group_values(df, key, least)
    return out.withColumn(name, F.struct(*order).eqNullSafe(F.col("_first"))).drop("_first")


def first_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order`` (which must be total); null keys are equal.

    Ranks are limited to the first before the shuffle as after it, so each task sends one row a key, however hot."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def repeats(df: DataFrame, key: list[str]) -> DataFrame:
    """The key of every row but the first of each key: counts, combined before the shuffle, and as many rows."""
    n = df.groupBy(*key).agg(F.count("*").cast("int").alias("_n")).filter("_n > 1")
    return n.select(*key, F.explode(F.sequence(F.lit(2), F.col("_n"))).alias("_i")).drop("_i")


def repeated(df: DataFrame, key: list[str], name: str = "llave_repetida") -> DataFrame:
    return group_values(df, key, F.count("*").alias("_n")).withColumn(name, F.col("_n") > 1).drop("_n")


def split_rejects(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all rules, and the others as text with the first broken rule's reason."""
    reason = reduce(lambda acc, r: acc.when(~F.coalesce(r[1], F.lit(False)), r[0]), rules, F.when(F.lit(False), ""))
    marked = df.withColumn("motivo", reason)
    out = marked.filter("motivo is not null")
    return marked.filter("motivo is null").drop("motivo"), out.select(*[F.col(c).cast("string") for c in df.columns], "motivo")


def report(df: DataFrame, rules: dict[str, Column], targets: dict[str, float | None] = TARGETS) -> DataFrame:
    """Each rule's passes, failures, share, target and whether it is met, in one aggregate."""
    sums = df.agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in rules.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("regla"), F.col(k).alias("cumplen"), F.lit(targets.get(k)).cast("double").alias("meta")) for k in rules]))
    share = F.when(F.col("n") > 0, F.col("cumplen") / F.col("n")).otherwise(1.0)
    out = sums.select("n", rows.alias("r")).select("n", "r.*")
    return out.select("regla", "cumplen", (F.col("n") - F.col("cumplen")).alias("fallan"), F.bround(share, 4).alias("tasa"), "meta", (share >= F.col("meta")).alias("cumple_meta"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    sums = df.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("x")) for c in columns]))
    return sums.select("n", rows.alias("r")).select("r.campo", F.when(F.col("n") > 0, F.bround(F.col("r.x") / F.col("n"), 4)).otherwise(0.0).alias("completitud"))


def conversion_report(raw: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cells that hold something and do not convert, for each column."""
    sums = raw.agg(*[(F.count(c) - F.count(F.col(c).try_cast(t))).alias(c) for c, t in casts.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("perdidas")) for c in casts])).alias("r")).select("r.*")


def declared(raw: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """The declared columns, renamed and cast; columns: original to (name, type). A missing one rejects the file."""
    if missing := sorted(set(columns) - set(raw.columns)):
        raise ValueError(f"columns missing: {missing}")
    return raw.select(*[F.col(f"`{c}`").try_cast(t).alias(n) for c, (n, t) in columns.items()])


def enforce(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Exactly the contract's columns, ordered and cast."""
    if set(df.columns) != set(contract):
        raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(contract))}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.items()])


def violations(df: DataFrame, key: list[str], present: list[str], roles: str | None = None, dates: tuple[str, ...] = (), whole: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """Counts of broken input conditions, in one aggregate: repeated or null keys, blank identifiers, dates that are
    none, periods that are not whole or impossible, unknown roles, and flags that are neither true nor false."""
    none = F.lit(False)
    any_of = lambda parts: reduce(lambda a, b: a | b, parts, none)
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    number = lambda c: F.col(c).try_cast("double")
    more = {
        "claves_nulas": any_of([F.col(k).isNull() for k in key]), "identificadores_vacios": any_of([text(c) == "" for c in present]),
        "fechas_invalidas": any_of([F.col(c).try_cast("date").isNull() for c in dates]),
        "no_enteros": any_of([F.coalesce(number(c) % 1 != 0, F.lit(True)) for c in whole]),
        "banderas_invalidas": any_of([F.col(c).isNotNull() & ~F.lower(text(c)).isin("true", "false") for c in flags]),
    }
    if "mes" in df.columns:
        more["meses_invalidos"] = ~F.coalesce(number("mes").between(1, 12), none)
    if "anio" in df.columns:
        more["anios_invalidos"] = ~F.coalesce(number("anio").between(1900, 9999), none)
    if roles:
        more["roles_invalidos"] = ~F.coalesce(F.col(roles).isin("reparto", "transporte"), none)
    return df.agg((F.count("*") - F.count_distinct(F.struct(*key))).alias("claves_repetidas"), *[F.count_if(v).alias(k) for k, v in more.items()])


def validated(df: DataFrame, columns: list[str], optional: list[str], key: list[str], present: list[str], **conditions) -> DataFrame:
    """The projected columns of ``df``, if all required ones are there and no condition is broken; else an error that
    names the conditions and how many rows break them, and shows no row."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"columns missing: {missing}")
    out = df.select(*columns, *[c for c in optional if c in df.columns])
    broken = {k: n for k, n in violations(out, key, present, **conditions).first().asDict().items() if n}
    if broken:
        raise ValueError(f"rows that break input conditions: {broken}")
    return out


# baseline statistics on raw deliveries

def scop_baseline(raw: DataFrame, first: int, last: int) -> DataFrame:
    inside = raw.filter(F.year("fecha").between(first, last))
    have = F.count_if(F.trim(F.coalesce("codigo_scop", F.lit(""))) != "")
    return inside.agg(F.count("*").alias("compras"), have.alias("con_scop"), F.bround(100 * have / F.count("*"), 4).alias("pct"))


def document_baseline(df: DataFrame, c: str = "documento_raw") -> DataFrame:
    text = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"^(\d+)\.0+\z", "$1")
    empty, short = text == "", ~F.length(text).isin(8, 11)
    bad_form = ~text.rlike(r"^(\d{8}|\d{11})\z")
    wrong = F.count_if(short & ~empty)
    return df.agg(
        F.count("*").alias("total"), F.count_if(~empty).alias("informados"), F.count_if(empty).alias("vacios"), wrong.alias("longitud_invalida"),
        F.count_if(bad_form & ~empty & ~short).alias("formato_invalido"), F.count_if(text.rlike(r"^\d{11}\z") & ~C.ruc_valid(text)).alias("ruc_invalido"),
        F.bround(100 * wrong / F.nullif(F.count("*"), F.lit(0)), 4).alias("pct_longitud_invalida"),
    )


def incidents(df: DataFrame, controls: dict[str, Column], key: list[str] | None = None, source: str | None = None) -> DataFrame:
    """(fuente, control, casos): failures of each control, later rows of a key (``clave_unica``), and rows with any.

    Rows of one key are counted together first, with as many of them clean as there are, so that nothing is sorted: of
    a key's rows all but one are repeats, and the one that is first counts as a clean row if the key has any."""
    flags = {k: F.coalesce(c, F.lit(False)) for k, c in controls.items()}
    each = [F.count_if(c).alias(f"_{k}") for k, c in flags.items()]
    fails = reduce(lambda a, b: a | b, flags.values())
    if key is None:
        sums = df.agg(*each, F.count_if(fails).alias("_filas_afectadas"))
    else:
        by = df.groupBy(*key).agg(*each, (F.count("*") - 1).alias("_clave_unica"), F.count("*").alias("_n"), F.max((~fails).cast("int")).alias("_clean"))
        sums = by.agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in [*flags, "clave_unica"]], F.sum(F.col("_n") - F.col("_clean")).alias("_filas_afectadas"))
    names = [*flags, *(["clave_unica"] if key else []), "filas_afectadas"]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("control"), F.coalesce(F.col(f"_{k}"), F.lit(0)).alias("casos")) for k in names]))
    out = sums.select(rows.alias("r")).select("r.*")
    return out if source is None else out.select(F.lit(source).alias("fuente"), "control", "casos")


def stock_baseline(days: DataFrame, first: int, last: int, tolerance: float = 1e-6) -> DataFrame:
    from kilotrace.operators.signals import STOCK, residual

    d = group_values(days.filter(F.year("fecha").between(first, last)), ["fecha"], F.count("*").alias("_n"))
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in STOCK])
    can, zero = full & (F.col("_n") == 1), F.coalesce(F.abs(residual()) <= tolerance, F.lit(False))
    distinct = lambda cond: F.count_distinct(F.when(cond, F.col("fecha")))
    return d.agg(
        F.count_distinct("fecha").alias("dias"), F.count_if(can).alias("dias_evaluables"), F.count_if(can & zero).alias("dias_residuo_cero"), F.count_if(can & ~zero).alias("dias_con_residuo"),
        F.count_if(~full).alias("filas_incompletas"), distinct(F.col("_n") > 1).alias("dias_duplicados"), F.count_if(F.col("produccion") < 0).alias("producciones_negativas"),
    )


def price_baseline(sales: DataFrame, by: str = "canal", value: str = "precio") -> DataFrame:
    """Rows, least, most, P5, P50 and P95 of positive prices for each channel and for all (``global``)."""
    ok = sales.filter(F.col(value) > 0)
    stats = [F.count("*").alias("filas"), F.round(F.min(value), 2).alias("min"), F.round(F.max(value), 2).alias("max"), F.round(F.percentile(value, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).getItem(0), 2).alias("p05")]
    stats += [F.round(F.percentile(value, q), 2).alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"))]
    each = ok.filter(F.trim(by) != "").groupBy(F.col(by).alias("grupo")).agg(*stats)
    return each.unionByName(ok.agg(F.lit("global").alias("grupo"), *stats))


def compare(values: DataFrame, references: DataFrame) -> DataFrame:
    """(indicador, calculado, esperado, estado, diferencia) of computed values against references."""
    both = references.join(values, "indicador", "left")
    close = F.abs(F.col("calculado") - F.col("esperado")) <= 1e-8 + 1e-5 * F.abs("esperado")
    state = F.when(F.col("calculado").isNull(), "no_disponible").when(close, "coincide_numericamente").otherwise("difiere")
    return both.select("indicador", "calculado", "esperado", state.alias("estado"), F.bround(F.col("calculado") - F.col("esperado"), 4).alias("diferencia"))


def frequencies(df: DataFrame, columns: list[str], most: int = 40) -> DataFrame:
    """The ``most`` frequent values of each catalogue column, nulls included."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in columns])).alias("c")).select("c.*")
    n = cells.groupBy("columna", "valor").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("columna").orderBy(F.desc("n"), F.asc_nulls_first("valor")))).filter(F.col("r") <= most).drop("r")
