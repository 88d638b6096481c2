"""Ranks and numbers over ranges: one group is spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from siftline.operators import ranking


def rows(spark, n=500):
    rng = random.Random(4)
    return spark.createDataFrame([(rng.choice(["p", "p", "p", None]), rng.choice([None, 1.5, rng.random(), -rng.random()]), i) for i in range(n)], "g string, score double, i int")


def test_one_group_is_in_several_ranges(spark):
    one = rows(spark).where("g = 'p'")
    ranged = ranking.in_ranges(one, [F.col("g"), F.col("i")])
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * sum(sizes) / len(sizes)
    bounds = [(r["low"], r["high"]) for r in ranged.groupBy("_range").agg(F.min("i").alias("low"), F.max("i").alias("high")).orderBy("_range").collect()]
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:], strict=False))


@pytest.mark.parametrize("parts", ["1", "4", "50"])
def test_chunks_and_numbers(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        numbers(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def numbers(spark):
    df = rows(spark)
    by_group = {}
    for r in sorted(df.collect(), key=lambda r: r["i"]):
        by_group.setdefault(r["g"], []).append(r["i"])
    got = {r["i"]: r["chunk"] for r in ranking.chunk_numbers(df, ["g"], [F.col("i")], 7).collect()}
    assert got == {i: k // 7 + 1 for members in by_group.values() for k, i in enumerate(members)}
    order = lambda r: (r["score"] is not None, r["score"] or 0.0, r["i"])  # noqa: E731  nulls come first
    want = {r["i"]: k + 1 for k, r in enumerate(sorted(df.collect(), key=order))}
    assert {r["i"]: r["at"] for r in ranking.global_index(df, ["score", "i"], "at").collect()} == want
    assert ranking.global_index(df.limit(0), ["score", "i"], "at").count() == 0


def test_percentiles_of_ties(spark):
    df = spark.createDataFrame([("p", 1.0, 1), ("p", 1.0, 2), ("p", 3.0, 3), ("q", 5.0, 4), (None, 1.0, 5), (None, 2.0, 6)], "g string, score double, i int")
    got = {r["i"]: r["x"] for r in ranking.average_rank_percentile(df, ["g"], "score", "x").collect()}
    assert got == {1: 0.75, 2: 0.75, 3: 0.0, 4: 1.0, 5: 1.0, 6: 0.0}
