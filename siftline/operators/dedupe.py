"""Deduplication with source precedence and running overlap flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: str, order: Sequence[str], eligible: Column, pool: str, active: str) -> DataFrame:
    """Adds dedup_status and resolved_pool.

    The first eligible row of a key in this order is unique_parent, later ones are exact_duplicate, others are
    not_in_parent_pool. A duplicate outside the active pool whose key an earlier active row has is resolved to it.
    """
    ok = F.coalesce(eligible, F.lit(False))
    df = df.withColumn("_ok", ok)
    w = Window.partitionBy(key, "_ok").orderBy(*order)
    place = F.row_number().over(w)
    seen_active = F.max((F.col(pool) == active).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    status = F.when(~F.col("_ok"), "not_in_parent_pool").when(place == 1, "unique_parent").otherwise("exact_duplicate")
    resolved = F.when(F.col("_ok") & (place > 1) & (F.coalesce(seen_active, F.lit(0)) == 1), F.lit(active)).otherwise(F.col(pool))
    return df.select("*", status.alias("dedup_status"), resolved.alias("resolved_pool")).drop("_ok")


def running_overlap(df: DataFrame, key: str, order: Sequence[str], marks: Column, out: str) -> DataFrame:
    """Adds 0/1: has an earlier row of the same key the mark? Rows with a null key have 0."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    flag = F.coalesce(F.max(F.coalesce(marks, F.lit(False)).cast("int")).over(w), F.lit(0))
    return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(0)).otherwise(flag))


def first_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key only, without sorting groups: the least order struct by partial aggregation."""
    best = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return df.withColumn("_first", F.struct(*order)).join(best, [key, "_first"], "left_semi").drop("_first")


def status_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))
