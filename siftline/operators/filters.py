"""Filters that say why."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.operators.quantiles import exact_median

# Default bounds of the hard filter, inclusive.
HARD_BOUNDS = {
    "heavy_atoms": (10, 70), "mw": (180.0, 650.0), "clogp": (-1.5, 6.5), "tpsa": (15.0, 180.0),
    "hbd": (None, 7), "hba": (None, 14), "rotatable_bonds": (None, 15), "ring_count": (None, 10),
}
ALLOWED_ELEMENTS = [5, 6, 7, 8, 9, 14, 15, 16, 17, 35, 53]
MAX_CHARGE = 2


def reasons(checks: Sequence[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, in their order, joined by a bar; empty if none does."""
    named = [F.when(condition, F.lit(name)) for name, condition in checks]
    return F.array_join(F.array(*named), "|")


def bound_checks(bounds: Mapping[str, tuple]) -> list[tuple[str, Column]]:
    """name_low and name_high conditions; a bound itself passes."""
    out = []
    for name, (low, high) in bounds.items():
        if low is not None:
            out.append((f"{name}_low", F.col(name) < F.lit(low)))
        if high is not None:
            out.append((f"{name}_high", F.col(name) > F.lit(high)))
    return out


def hard_filter(df: DataFrame, bounds: Mapping[str, tuple] = HARD_BOUNDS, elements: str = "atomic_numbers", charge: str = "formal_charge") -> DataFrame:
    """Adds hard_filter_reasons and hard_filter_pass (1 without reasons)."""
    allowed = F.array(*[F.lit(e) for e in ALLOWED_ELEMENTS])
    checks = [("disallowed_element", F.size(F.array_except(elements, allowed)) > 0), *bound_checks(bounds), ("formal_charge_extreme", F.abs(charge) > MAX_CHARGE)]
    df = df.withColumn("hard_filter_reasons", reasons(checks))
    return df.withColumn("hard_filter_pass", (F.col("hard_filter_reasons") == "").cast("int"))


def rule_alerts(text: str | Column, rules: Mapping[str, str]) -> Column:
    """Names of the rules whose pattern matches, sorted, joined by a bar."""
    named = [F.when(F.rlike(F.col(text) if isinstance(text, str) else text, F.lit(pattern)), F.lit(name)) for name, pattern in sorted(rules.items())]
    return F.array_join(F.array(*named), "|")


def reason_counts(df: DataFrame, column: str = "hard_filter_reasons") -> DataFrame:
    """How often each reason occurs."""
    each = df.where(F.col(column) != "").select(F.explode(F.split(column, r"\|")).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n"))


def at_most_median(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is at most the exact median of all rows."""
    return df.where(F.col(value) <= F.lit(exact_median(df, value)))


def in_scope(df: DataFrame, channel: str, allowed: Sequence[str], parent: str, order: Sequence[str], max_parents: int = 0) -> DataFrame:
    """Rows of allowed channels ("*": all), of the first max_parents distinct parents by first appearance (0: all)."""
    if not allowed:
        raise ValueError("a scope needs channels")
    kept = df if "*" in allowed else df.where(F.col(channel).isin(*allowed))
    if max_parents:
        first = kept.groupBy(parent).agg(F.min(F.struct(*order)).alias("_first")).orderBy("_first").limit(max_parents)
        kept = kept.join(first.select(parent), parent, "left_semi")
    return kept


def feasible(df: DataFrame, status: str) -> DataFrame:
    return df.where(F.col(status).isin("ok", "feasible_only"))


def population_zscore(df: DataFrame, value: str, out: str) -> DataFrame:
    """(value - mean) / population deviation; a deviation below 1e-6 counts as 1."""
    stats = df.agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    row = F.broadcast(stats)  # one row
    sd = F.when(F.col("_s") < 1e-6, F.lit(1.0)).otherwise(F.col("_s"))
    return df.join(row).withColumn(out, (F.col(value) - F.col("_m")) / sd).drop("_m", "_s")
