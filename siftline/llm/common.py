"""Helpers shared by the corpus operators: tables, shared storage, Arrow mapping and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor and the driver can reach. Where none is set, a local master gets one of its own
    (one machine shares its folders with itself); a cluster gets an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = _own_dirs.setdefault(spark.sparkContext.applicationId, "")
        if not path:
            path = _own_dirs[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="siftline-")
    return path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/siftline/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage is cut and lost executors cost nothing."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._siftline_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by `materialize` once nothing reads it any more."""
    path = getattr(df, "_siftline_path", None)
    if path:
        spark = df.sparkSession
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


#: Bytes of an Arrow batch, about. Texts may be long, so rows alone do not bound what a worker holds.
BATCH_BYTES = 4 << 20
_memos: dict[str, Callable[[], None]] = {}


def own_memory(name: str, clear: Callable[[], None]) -> None:
    """In a worker process: drop what other operators' tasks have kept in memory, and register how to drop this one's."""
    for other in [n for n in _memos if n != name]:
        _memos.pop(other)()
    _memos[name] = clear


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None]], schema: str) -> DataFrame:
    """mapInArrow with per-task state: `make()` runs once in each task and returns the function for a batch, which
    returns a batch or yields several."""

    name = f"{make.__module__}"
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _memos and name not in _memos:
            own_memory(name, lambda: None)
        each = make()
        for batch in batches:
            if batch.num_rows:
                out = each(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out

    return df.mapInArrow(run, schema)


#: A key is hot if it holds more than 1 / HOT of all rows; there are at most HOT of them.
HOT = 1 << 14


def join_skewed(rows: DataFrame, info: DataFrame, on: list[str], weight: str) -> DataFrame:
    """rows joined to info, a table with a row per key and the rows that the key has (column `weight`, which is dropped).

    Hot keys (HOT at most, so their table has a bound) are told to every task, whose rows stay where they are; all
    others are few rows each and merge. Both inputs are read twice: written tables, best.
    """
    total = info.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT >= total
    hot, cold = info.where(is_hot).drop(weight), info.where(~is_hot).drop(weight)
    met = rows.join(F.broadcast(hot), on)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold.hint("merge"), on)
    return met.unionByName(others)


def fresh_ids(keys: DataFrame, taken: DataFrame) -> DataFrame:
    """key, id: for the distinct column `key` of keys, an id each that is no `id` of taken. Drawn by hash; those that
    meet another one are drawn again, so all are different."""
    done, left, seed = None, keys, 0
    while True:
        drawn = materialize(left.select("key", F.xxhash64("key", F.lit(seed)).alias("id")), "drawn-ids")
        free = drawn.groupBy("id").agg(F.min("key").alias("key")).join(taken.select("id"), "id", "left_anti")
        if done is not None:
            free = free.join(done.select("id"), "id", "left_anti")
        free = materialize(free.select("key", "id"), "fresh-ids")
        done = free if done is None else done.unionByName(free)
        left, seed = drawn.join(free.select("key"), "key", "left_anti").select("key"), seed + 1
        if left.isEmpty():
            return done


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of df but those that an operator is about to add; Spark's names ignore letter case."""
    return [c for c in df.columns if c.lower() not in names]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def _measured(links: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """The links as a written table, with their count and a sum of their hashes, both taken while writing."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("hashes")
    written = materialize(links.observe(seen, F.count(F.lit(1)).alias("n"), hashes), label)
    return written, (seen.get["n"], seen.get["hashes"])


def components(edges: DataFrame, label: str = "components", partitions: int | None = None) -> DataFrame:
    """Connected components of undirected links, by alternating large-star and small-star steps.

    edges: columns a, b (long); loops, nulls and repeats are ignored. Returns node, component_id (the smallest node
    reachable) for every node that has a link. Each round is a written table, so a lost executor repeats one round
    at most. Long paths shrink by half each round; a hub's links are dealt by their other end before they meet it.
    """
    links = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    links, size = _measured(links, label)
    while True:
        # large-star: each larger neighbour of a node is linked to the smallest one around the node
        both = links.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            links.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("low"))
        large = both.where("m > n").join(least, "n").select(F.col("m").alias("hi"), F.col("low").alias("lo")).distinct()
        # small-star: each smaller neighbour and the node itself are linked to the smallest one
        low = large.groupBy("hi").agg(F.min("lo").alias("low"))
        to_low = F.array(F.struct(F.col("lo").alias("hi"), F.col("low").alias("lo")), F.struct("hi", F.col("low").alias("lo")))
        small = large.join(low, "hi").select(F.explode(to_low).alias("e")).select("e.hi", "e.lo").where("hi <> lo").distinct()
        new, new_size = _measured(small, label)
        discard(links)
        done, links, size = new_size == size, new, new_size
        if done:
            break
    nodes = links.select(F.col("hi").alias("node"), F.col("lo").alias("component_id"))
    return nodes.unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("component_id")).distinct())
