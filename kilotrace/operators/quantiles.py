"""Exact quantiles of whole columns by rounds of range histograms.

A round counts the rows of each column in some hundred ranges, with a map-side sum, and keeps the range that holds a
wanted rank, until few rows or one value are left. So no task ever holds a column's values, however many differ.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges a round parts each wanted one into, and rows that are fetched rather than parted.
RANGES, FEW = 512, 2_000


def _steps(x: Column, low: float, high: float, curved: bool) -> Column:
    """A range's number, which never falls as x rises: of equal widths or, ``curved``, ever wider from the low end."""
    if math.isinf(high - low):  # too far apart for a difference: all halved
        x, low, high = x * 0.5, low / 2, high / 2
    if curved:
        far = math.log1p(1e15)
        place = F.log1p((x - low) / F.lit((high - low) / 1e15 or 5e-324)) / F.lit(far)
    else:
        place = (x - low) / F.lit(high - low)
    return F.least(F.floor(place * RANGES), F.lit(RANGES - 1)).cast("int")


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """The quantiles of each column at ``shares``, interpolated between neighbours as ``percentile`` does; None where a
    column has no value. Nulls are left out, and so are NaN and infinities.

    ``df`` is read once a round, so it should be a written table. A job a round over the columns still open; what comes to the driver are RANGES sums for each wanted rank, or FEW
    values at the end. A round that leaves most rows in one range is followed by one whose ranges are curved.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")), F.col(c).cast("double")) for c in columns}
    df = df.select(*[value[c].alias(f"x{i}") for i, c in enumerate(columns)])
    first = df.agg(*[f(f"x{i}").alias(f"{name}{i}") for i in range(len(columns)) for f, name in ((F.count, "n"), (F.min, "low"), (F.max, "high"))]).first()
    wanted: dict[tuple[int, int], float | None] = {}
    for i in range(len(columns)):
        if n := first[f"n{i}"]:
            for p in shares:
                at = p * (n - 1)
                wanted |= {(i, math.floor(at)): None, (i, math.ceil(at)): None}
    # (column, low, high): [rows before it, rows in it, ranks wanted in it, whether its ranges are curved]
    open_ = {(i, first[f"low{i}"], first[f"high{i}"]): [0, first[f"n{i}"], [r for j, r in wanted if j == i], False] for i in range(len(columns)) if first[f"n{i}"]}
    while open_:
        for (i, low, high), (_, _, ranks, _) in list(open_.items()):
            if low == high:
                wanted |= {(i, r): low for r in ranks}
                del open_[i, low, high]
        short = {k: v for k, v in open_.items() if v[1] <= FEW}
        cells, keys = [], list(open_)
        for number, key in enumerate(keys):
            i, low, high = key
            x = F.col(f"x{i}")
            inside = (x >= low) & (x <= high)
            step = x if key in short else _steps(x, low, high, open_[key][3]).cast("double")
            cells.append(F.when(inside, F.struct(F.lit(number).alias("of"), step.alias("step"), x.alias("x"))))
        if not cells:
            break
        rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.*")
        found = rows.groupBy("of", "step").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        by: dict[int, list] = {}
        for r in found:
            by.setdefault(r["of"], []).append(r)
        after = {}
        for number, key in enumerate(keys):
            before, total, ranks, curved = open_[key]
            for r in sorted(by[number], key=lambda r: r["step"]):
                inside = [k for k in ranks if before <= k < before + r["n"]]
                if inside and (key in short or r["low"] == r["high"]):
                    wanted |= {(key[0], k): r["low"] for k in inside}
                elif inside:
                    after[key[0], r["low"], r["high"]] = [before, r["n"], inside, not curved and r["n"] > total / 8]
                before += r["n"]
        open_ = after
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        n, out[c] = first[f"n{i}"], []
        for p in shares:
            at = p * (n - 1) if n else 0.0
            a, b = (wanted.get((i, f(at))) for f in (math.floor, math.ceil))
            out[c].append(None if not n else a if a == b else (math.ceil(at) - at) * a + (at - math.floor(at)) * b)
    return out
