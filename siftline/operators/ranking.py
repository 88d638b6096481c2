"""Ranks, best rows, samples and capped selections, all by explicit order columns."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.scalars import stable_hash
from siftline.operators.storage import remove, written


def in_ranges(df: DataFrame, key: Sequence[Column]) -> DataFrame:
    """The rows in the order of the key, as a written table, with _range (as many as there are shuffle partitions, all rows
    of one key in the same) and _row, from 0, in it. The input is read twice: for the bounds, which Spark draws from a
    sample, and for its rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("_id", F.monotonically_increasing_id())
    table, _ = written(ordered, "ranges")
    # an id is the number of its partition and, in the lower 33 bits, of its row there
    return table.withColumns({"_range": F.shiftright("_id", 33).cast("int"), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")


def _with_starts(ranged: DataFrame, group: Sequence[str], size: Column) -> DataFrame:
    """Adds _start: the sizes of a group's earlier ranges, _total: those of all, and _first: where it begins in its range."""
    sizes = ranged.groupBy("_range", *group).agg(size.alias("_size"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_range").alias("_at"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_first",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"), F.sum("_size").over(Window.partitionBy(*group)).alias("_total"),
    )
    same = F.col("_range") == F.col("_at")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    # without groups a row per range; with them as many more as there are groups, so Spark decides by their size
    return ranged.join(starts if group else F.broadcast(starts), same).drop("_at", *[f"_g{i}" for i in range(len(group))])


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Adds the 1-based position of a row in its group in this order, which ends with a unique column. Ranges are counted,
    and each adds the counts of those before it: a single group is spread over tasks, and no row is sorted again."""
    ranged = _with_starts(in_ranges(df, [*[F.col(g) for g in group], *order]), group, F.count("*"))
    return ranged.withColumn(out, (F.col("_row") - F.col("_first") + F.col("_start") + 1).cast("long")).drop("_range", "_row", "_first", "_start", "_total")


def rank_percentiles(df: DataFrame, group: Sequence[str], score: str, out: str) -> DataFrame:
    """Per group and different score: 1 for the lowest score of a group, 0 for the highest; ties share their mean rank; a
    single row has 1.

    Scores are counted per group and value first; the distinct scores of a group are then ranked range by range.
    """
    values, path = written(df.groupBy(*group, score).agg(F.count("*").alias("_ties")), "values")
    ranged = _with_starts(in_ranges(values, [*[F.col(g) for g in group], F.col(score)]), group, F.sum("_ties"))
    remove(df.sparkSession, path)  # the ranges are written
    running = Window.partitionBy("_range", *group).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    before, n = F.col("_start") + F.coalesce(F.sum("_ties").over(running), F.lit(0)), F.col("_total")
    percentile = F.when(n == 1, F.lit(1.0)).otherwise(F.lit(1.0) - (before + (F.col("_ties") - 1) / F.lit(2.0)) / (n - 1))
    return ranged.select(*group, score, percentile.alias(out))


def with_percentiles(df: DataFrame, found: DataFrame, group: Sequence[str], score: str, out: str) -> DataFrame:
    """Adds the percentiles of `rank_percentiles` to rows."""
    keyed = found.select(*[F.col(g).alias(f"_{g}") for g in group], F.col(score).alias("_score"), out)
    same = df[score].eqNullSafe(keyed["_score"])
    for g in group:
        same = same & df[g].eqNullSafe(keyed[f"_{g}"])
    return df.join(keyed, same).drop("_score", *[f"_{g}" for g in group])


def average_rank_percentile(df: DataFrame, group: Sequence[str], score: str, out: str) -> DataFrame:
    """df with the percentiles of its scores."""
    return with_percentiles(df, rank_percentiles(df, group, score, out), group, score, out)


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in this order."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def best_values(df: DataFrame, group: Sequence[str], order: Sequence[Column], values: Sequence[str], *more: Column) -> DataFrame:
    """The named values of the first row of each group, by partial aggregation: no sort of whole groups. The order
    columns must be ascending in what comes first. `more` are aggregates of the group."""
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*group).agg(F.min_by(F.struct(*values), key).alias("_best"), *more)
    return best.select(*group, *[F.col(f"_best.{v}").alias(v) for v in values], *best.columns[len(group) + 1 :])


def cut_points(df: DataFrame, scores: Mapping[str, Column], n: int) -> dict[str, float | None]:
    """For each named score a value that at least n rows reach, and few more than twice as many (ties apart); None where
    all rows are needed. One pass; sketches of bounded size, whose error of 1 / 10000 of the rows is allowed for."""
    shares = [2.0**-i for i in range(1, 14)]
    found = df.agg(*[a for name, s in scores.items() for a in (F.count(s).alias(f"{name}_n"), F.percentile_approx(s, [1 - x for x in shares], 10_000).alias(f"{name}_q"))]).first()
    out: dict[str, float | None] = dict.fromkeys(scores)
    for name in scores:
        total = found[f"{name}_n"]
        for share, value in zip(shares, found[f"{name}_q"] or [], strict=False):
            if total * (share - 2e-4) >= n:
                out[name] = value
    return out


def head(df: DataFrame, score: Column, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in an order that begins with the score from the highest down. Rows that cannot be among them are
    filtered by a cut point before any row is moved."""
    least = cut_points(df, {"s": score}, n)["s"]
    return (df if least is None else df.where(score >= F.lit(least))).orderBy(*order).limit(n)


def hash_score(value: str, seed: int) -> Column:
    """A number that falls as the stable hash grows: its first 32 bits, negative."""
    return -F.conv(F.substring(stable_hash(value, seed), 1, 8), 16, 10).cast("long")


def with_hash(df: DataFrame, key: str, seed: int, out: str = "_hash") -> DataFrame:
    return df.withColumn(out, stable_hash(key, seed))


def bottom_k(df: DataFrame, key: str, seed: int, k: int, tie: str) -> DataFrame:
    """The k rows of smallest stable hash, in that order. TakeOrderedAndProject keeps k rows per task."""
    return with_hash(df, key, seed).orderBy("_hash", tie).limit(k).drop("_hash")


def stratified_bottom_k(df: DataFrame, stratum: str, key: str, seed: int, total: int, tie: str) -> DataFrame:
    """`total` rows dealt evenly to strata (the first ones in order take the rest), each the smallest hashes of its own
    seed, seed + the stratum's 1-based number."""
    names = df.select(stratum).distinct().withColumn("_no", F.row_number().over(Window.orderBy(stratum)))  # a row per stratum
    sized = names.withColumn("_strata", F.max("_no").over(Window.partitionBy()))
    quota = F.floor(F.lit(total) / F.col("_strata")) + (F.col("_no") <= F.lit(total) % F.col("_strata")).cast("int")
    joined = df.join(F.broadcast(sized.withColumn("_quota", quota)), stratum)
    text = F.concat((F.lit(seed) + F.col("_no")).cast("string"), F.lit("|"), F.col(key).cast("string")).cast("binary")
    hashed = joined.withColumn("_hash", F.substring(F.sha2(text, 256), 1, 16))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_hash", tie))
    # no quota is above the total: said as a number, it lets tasks drop rows before they are moved
    return hashed.withColumn("_place", place).where(F.col("_place") <= total).where("_place <= _quota").select(*df.columns, F.col("_no").alias("stratum_no"), F.col("_place").cast("int").alias("stratum_rank"))


def largest_remainder(fractions: dict[str, float], size: int) -> dict[str, int]:
    """Whole quotas that sum to size: floors, then one more each by (remainder, name) from the largest down."""
    whole = {name: int(size * share) for name, share in fractions.items()}
    lifted = heapq.nlargest(size - sum(whole.values()), fractions, key=lambda name: (size * fractions[name] % 1, name))
    return {name: n + (name in lifted) for name, n in whole.items()}


def largest_remainder_table(df: DataFrame, name: str, fraction: str, size: int) -> DataFrame:
    """The same for a small table of names and fractions: adds quota."""
    floors = df.withColumn("_floor", F.floor(F.lit(size) * F.col(fraction)).cast("long"))
    left = F.lit(size) - F.sum("_floor").over(Window.partitionBy())
    rest = F.lit(size) * F.col(fraction) - F.col("_floor")
    place = F.row_number().over(Window.orderBy(rest.desc(), F.desc(name)))
    return floors.withColumn("quota", F.col("_floor") + (place <= left).cast("long")).drop("_floor")


def capped_take(df: DataFrame, group: str, order: Sequence[Column], target: int, cap: int, taken: DataFrame | None = None) -> DataFrame:
    """What a walk in this order accepts while a group has room: at most cap rows of a group, counting `taken` (group, n),
    and target rows in all. Adds take_rank. Equal to the greedy walk, since a rejected row uses no room."""
    if taken is not None:
        df = df.join(taken.select(F.col(group), F.col("n").alias("_taken")), group, "left")
    else:
        df = df.withColumn("_taken", F.lit(0))
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    # the plain bound lets tasks drop rows of a full group before they are moved
    fits = df.withColumn("_place", place).where(F.col("_place") <= cap).where(F.col("_place") + F.coalesce("_taken", F.lit(0)) <= cap)
    chosen = fits.orderBy(*order).limit(target)
    return chosen.withColumn("take_rank", F.row_number().over(Window.orderBy(*order))).drop("_place", "_taken")  # target rows


def chunk_numbers(df: DataFrame, group: Sequence[str], order: Sequence[Column], size: int) -> DataFrame:
    """Adds chunk: 1 for the first `size` rows of a group in this order, and so on."""
    placed = numbered(df, group, order, "_place")
    return placed.withColumn("chunk", (F.floor((F.col("_place") - 1) / size) + 1).cast("long")).drop("_place")


def global_index(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """A 1-based position over the whole table; no single task sees all rows."""
    return numbered(df, [], [F.col(c) for c in order], out)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows with their 1-based rank."""
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
