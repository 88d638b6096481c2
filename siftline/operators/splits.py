"""Splits by group that a row's copies cannot leak across."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.scalars import stable_hash_number
from siftline.operators.gates import GateError


def split_by_group(df: DataFrame, group: str, forced: DataFrame | None, validation: float, test: float, seed: int) -> DataFrame:
    """Adds split: test for forced groups, else train, validation or test by the group's hash in these shares. All rows
    of a group are in one split, whatever else the table holds."""
    share = stable_hash_number(group, seed).cast("double") / F.lit(float(1 << 64))
    by_hash = F.when(share < validation, "validation").when(share < validation + test, "test").otherwise("train")
    if forced is None:
        return df.withColumn("split", by_hash)
    named = forced.select(group).distinct().withColumn("_forced", F.lit(True))
    return df.join(named, group, "left").withColumn("split", F.when(F.col("_forced"), "test").otherwise(by_hash)).drop("_forced")


def require_disjoint(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    row = df.groupBy(group).agg(F.count_distinct(split).alias("n")).where("n > 1").first()
    if row:
        raise GateError(f"{group} {row[group]} is in {row['n']} splits")
    return df
