"""Checks that stop a plan with a reason. Each is one aggregate; nothing is collected but the verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A check failed."""


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    if row := duplicates(df, keys).first():
        raise GateError(f"duplicate {what}: {[row[k] for k in keys]}")
    return df


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def require_subset(child: DataFrame, parent: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    if row := orphans(child, parent, keys).first():
        raise GateError(f"unknown {what}: {[row[k] for k in keys]}")
    return child


def require_same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str) -> None:
    require_subset(left, right, keys, f"{what} on the left")
    require_subset(right, left, keys, f"{what} on the right")


def coverage(df: DataFrame, covered: Column) -> DataFrame:
    """covered, total, coverage: the share of rows for which the condition holds; 0 of an empty table."""
    counts = df.agg(F.count_if(covered).alias("covered"), F.count("*").alias("total"))
    return counts.withColumn("coverage", F.when(F.col("total") > 0, F.col("covered") / F.col("total")).otherwise(0.0))


def require_coverage(df: DataFrame, covered: Column, least: float, what: str) -> DataFrame:
    """Fails below `least`; exactly `least` passes."""
    got = coverage(df, covered).first()
    if got["coverage"] < least:
        raise GateError(f"{what} coverage {got['coverage']:.4f} is below {least}")
    return df


def require_none(df: DataFrame, condition: Column, what: str) -> DataFrame:
    n = df.agg(F.count_if(condition).alias("n")).first()["n"]
    if n:
        raise GateError(f"{n} rows: {what}")
    return df


def require_contiguous(df: DataFrame, index: str, what: str) -> DataFrame:
    """Indexes must be 1..n, each once."""
    got = df.agg(F.count("*").alias("n"), F.count_distinct(index).alias("d"), F.min(index).alias("low"), F.max(index).alias("high")).first()
    if got["n"] and not (got["n"] == got["d"] == got["high"] and got["low"] == 1):
        raise GateError(f"{what} is no contiguous 1-based prefix")
    return df


def report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """A row per check: name, failures, passed. One pass over the table for all of them."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failures")) for name in checks])
    return counts.select(F.explode(rows).alias("r")).select("r.check_name", "r.failures", (F.col("r.failures") == 0).alias("passed"))
