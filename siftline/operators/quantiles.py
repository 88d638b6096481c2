"""Exact order statistics without holding the values: histograms of ranges, refined until one value is left."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges of a histogram: rows that a pass hands to the driver, at most.
BUCKETS = 4096


def _histogram(values: DataFrame, low: float, high: float) -> list[tuple[int, float, float]]:
    """Rows, smallest and largest value of the parts of low..high that have rows, in order. The ends are in different parts."""
    v = F.col("v")
    if math.isfinite(high - low):
        share = (v - F.lit(low)) / F.lit(high - low)
    else:  # halves do not overflow
        share = (v / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    part = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
    rows = values.where(v.between(low, high)).groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    return [(r["n"], r["low"], r["high"]) for r in sorted(rows.collect(), key=lambda r: r["part"])]


def order_statistics(df: DataFrame, value: str, ranks: Callable[[int], Sequence[int]]) -> list[float]:
    """The values at ranks(n), 0-based, of the n rows that have one, in Spark's order: NaN is the largest.

    A pass counts the rows of BUCKETS ranges and goes on with the range that holds the rank, between the values that are
    really in it; so each pass ends closer, and a range of one value, however often it occurs, is the end.
    """
    values = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    v, endless = F.col("v"), float("inf")
    finite = ~F.isnan(v) & (F.abs(v) < endless)
    at = values.agg(
        F.count("*").alias("n"), F.count_if(v == -endless).alias("below"), F.count_if(finite).alias("finite"), F.count_if(v == endless).alias("above"),
        F.min(F.when(finite, v)).alias("low"), F.max(F.when(finite, v)).alias("high"),
    ).first()
    wanted, found = list(ranks(at["n"])), {}
    open_: dict[tuple[float, float, int], set[int]] = {}
    for rank in wanted:
        if rank < at["below"]:
            found[rank] = -endless
        elif rank >= at["below"] + at["finite"]:
            found[rank] = endless if rank < at["below"] + at["finite"] + at["above"] else float("nan")
        else:
            open_.setdefault((at["low"], at["high"], at["below"]), set()).add(rank)
    while open_:
        (low, high, before), inside = open_.popitem()
        if low == high:
            found.update(dict.fromkeys(inside, low))
            continue
        for n, part_low, part_high in _histogram(values, low, high):
            here = {r for r in inside if before <= r < before + n}
            if here:
                open_[part_low, part_high, before] = here
            before += n
    return [found[r] for r in wanted]


def exact_median(df: DataFrame, value: str) -> float | None:
    """The middle value, or the mean of the middle two; None without values."""
    middle = order_statistics(df, value, lambda n: sorted({(n - 1) // 2, n // 2}) if n else [])
    return sum(middle) / len(middle) if middle else None
