"""Results that grow part by part: a part counts once a manifest entry names it.

A run that ends anywhere leaves whole parts or none. What was written without its entry is not read and is redone, and
nothing that has an entry is computed again. Entries are small files that appear whole, one for each part, numbered; two
runs that write the same part cannot both commit it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siftline.operators.gates import GateError, require_subset
from siftline.operators.storage import names, put, remove


class Parts:
    """Rows 1..n of an index, in parts below a folder of shared storage."""

    def __init__(self, spark: SparkSession, folder: str, index: str = "ligand_record_index", key: str = "pose_id"):
        self.spark, self.folder, self.index, self.key = spark, folder.rstrip("/"), index, key

    def entries(self) -> list[dict]:
        """Manifest entries in order. They must follow on each other from 1."""
        found = [n for n in names(self.spark, f"{self.folder}/manifest") if n.endswith(".json")]
        rows = self.spark.read.schema("part string, first long, last long").json(f"{self.folder}/manifest/*.json").orderBy("first").collect() if found else []
        at = 0
        for r in rows:
            if r["first"] != at + 1 or r["last"] < r["first"]:
                raise GateError(f"part {r['part']} begins at {r['first']}; {at + 1} is next")
            at = r["last"]
        return [r.asDict() for r in rows]

    def reached(self) -> int:
        return max([0, *(e["last"] for e in self.entries())])

    def table(self) -> DataFrame | None:
        """All committed rows; None before the first part."""
        paths = [f"{self.folder}/{e['part']}" for e in self.entries()]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, rows: DataFrame, first: int, last: int) -> dict:
        """Write rows first..last, each there once, and return the entry that would commit them."""
        part = f"part-{first:012d}-{uuid.uuid4().hex}"
        seen, i = Observation(), F.col(self.index)
        counted = rows.observe(seen, F.count("*").alias("n"), F.min(i).alias("low"), F.max(i).alias("high"), F.sum(i.cast("decimal(38,0)")).alias("sum"))
        counted.write.parquet(f"{self.folder}/{part}")
        got, n = seen.get, last - first + 1
        if (got["n"], got["low"], got["high"], got["sum"]) != (n, first, last, (first + last) * n // 2):
            remove(self.spark, f"{self.folder}/{part}")
            raise GateError(f"{got['n']} rows from {got['low']} to {got['high']} are not {first} to {last}")
        return {"part": part, "first": first, "last": last}

    def commit(self, entry: dict) -> None:
        try:
            put(self.spark, f"{self.folder}/manifest/{entry['first']:012d}.json", (json.dumps(entry) + "\n").encode())
        except FileExistsError as e:
            raise GateError(f"another run has committed rows from {entry['first']}") from e

    def complete(self, todo: DataFrame, work: Callable[[DataFrame], DataFrame], step: int) -> DataFrame:
        """Work through rows 1..n of todo, `step` rows a part, from where the committed ones end. `work` keeps index and
        key. Committed rows must be rows of todo, with their keys."""
        n = todo.count()
        done = self.table()
        if done is not None:
            require_subset(done.where(F.col(self.key).isNotNull()), todo, [self.index, self.key], f"{self.index} and {self.key}")
        first = self.reached() + 1
        if first > n + 1:
            raise GateError(f"{first - 1} rows are committed, {n} are there")
        while first <= n:
            last = min(first + step - 1, n)
            self.commit(self.write(work(todo.where(F.col(self.index).between(first, last))), first, last))
            first = last + 1
        out = self.table()
        return out if out is not None else work(todo)

    def sweep(self) -> list[str]:
        """Remove parts that no entry names. Only while no run is at work."""
        known = {e["part"] for e in self.entries()}
        left = [x for x in names(self.spark, self.folder) if x.startswith("part-") and x not in known]
        for x in left:
            remove(self.spark, f"{self.folder}/{x}")
        return left
