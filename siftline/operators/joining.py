"""Joins with their checks: filling a table in, wide packages, evidence per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators.gates import GateError, require_subset, require_unique


def fill_table(template: DataFrame, values: DataFrame, index: str, value: str, check: str | None = None, digits: int = 8) -> DataFrame:
    """The template with its value column filled in from `values` by index, as text of fixed digits; other columns and
    rows stay as they are. Both sides must have the same indexes, each once; where both have a check value they must agree."""
    right = values.select(F.col(index).alias("_index"), F.col(value).alias("_value"), *([F.col(check).alias("_check")] if check else []))
    both = template.join(right, template[index] == right["_index"], "full_outer")
    tests = {"rows without a value": F.col("_index").isNull(), "values without a row": F.col(index).isNull()}
    if check:
        blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
        tests["check values that disagree"] = ~blank(check) & ~blank("_check") & (F.col(check) != F.col("_check"))
    row = both.agg(F.count("*").alias("n"), F.count_distinct(index).alias("d"), *[F.count_if(t).alias(n) for n, t in tests.items()]).first()
    bad = [f"{row[n]} {n}" for n in tests if row[n]]
    if row["n"] != row["d"] and not bad:
        bad.append("an index occurs twice")
    if bad:
        raise GateError("; ".join(bad))
    filled = F.format_string(f"%.{digits}f", F.col("_value").cast("double"))
    return both.select(*[filled.alias(c) if c == value else template[c] for c in template.columns])


def wide_package(poses: DataFrame, parents: DataFrame, states: DataFrame, similarity: DataFrame | None, parent_key: str, state_key: str, pose_key: str) -> DataFrame:
    """poses with every column of their parent, state and similarity; each foreign key must resolve, and of columns with
    one name the pose's is kept, then the similarity's, then the parent's, then the state's."""
    require_unique(parents, [parent_key], parent_key)
    require_unique(states, [state_key], state_key)
    require_subset(poses, parents, [parent_key], parent_key)
    require_subset(poses, states, [state_key], state_key)
    out, have = poses, set(poses.columns)
    sides = [(similarity, pose_key, "left")] if similarity is not None else []
    for side, key, kind in [*sides, (parents, parent_key, "inner"), (states, state_key, "inner")]:
        extra = [c for c in side.columns if c not in have]
        out = out.join(side.select(key, *extra), key, kind)
        have.update(extra)
    return out


def matched(items: DataFrame, evidence: DataFrame, key: str, value: str) -> DataFrame:
    """Items that have evidence, with it. Evidence keys are unique and known."""
    require_unique(evidence, [key], f"evidence {key}")
    require_subset(evidence, items, [key], f"evidence {key}")
    return items.join(evidence.select(key, value), key)


def with_optional(items: DataFrame, side: DataFrame, key: str, value: str, status: str) -> DataFrame:
    """Items with a side value where its status is ok, 0.0 elsewhere."""
    right = side.select(key, F.when(F.col(status) == "ok", F.col(value)).alias(value))
    return items.join(right, key, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def set_differences(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, with a column `side`: missing or unexpected."""
    missing = expected.select(*keys).subtract(observed.select(*keys)).withColumn("side", F.lit("missing"))
    return missing.unionByName(observed.select(*keys).subtract(expected.select(*keys)).withColumn("side", F.lit("unexpected")))
