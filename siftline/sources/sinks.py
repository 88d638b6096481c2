"""Writers. Stage tables are Parquet; text formats are for what leaves the engine."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.operators.gates import GateError
from siftline.sources.molecular import receptor_counts, sdf_record


def write_text(path: str, text: str) -> None:
    """On the driver, by a partial file that is renamed when whole."""
    partial = Path(f"{path}.partial")
    partial.parent.mkdir(parents=True, exist_ok=True)
    partial.write_text(text, encoding="utf-8")
    os.replace(partial, path)


def write_json(path: str, value: dict) -> None:
    write_text(path, json.dumps(value, indent=2, sort_keys=True, default=str) + "\n")


def copy_whole(source: str, target: str) -> str:
    """A copy under its final name only once it is whole; returns the target."""
    partial = Path(f"{target}.partial")
    partial.parent.mkdir(parents=True, exist_ok=True)
    shutil.copyfile(source, partial)
    os.replace(partial, target)
    return target


def blank_nulls(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, order: Sequence[str | Column] = (), sep: str = ",", compression: str | None = None) -> None:
    """Delimited text with a header, blank for null, in this order across its part files."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    blank_nulls(out).write.mode("errorifexists").csv(path, header=True, sep=sep, compression=compression, emptyValue="", quoteAll=False)


def write_tsv(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    write_csv(df, path, order, sep="\t")


def write_smi(df: DataFrame, path: str, smiles: str, name: str, rank: str) -> None:
    """"<smiles> <id>" lines in rank order."""
    df.repartitionByRange(rank).sortWithinPartitions(rank).select(F.concat_ws(" ", smiles, name).alias("value")).write.text(path)


def write_sdf(df: DataFrame, path: str, molblock: str, props: Sequence[str], order: Sequence[str]) -> None:
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).select(sdf_record(molblock, props).alias("value"))
    rows.write.option("lineSep", "$$$$\n").text(path)


def write_receptor(subset: DataFrame, path: str) -> DataFrame:
    """The included lines of `receptor_subset` in order, then END, as text across part files; returns the counts of all
    lines. A selection without atoms is an error."""
    counts = receptor_counts(subset)
    if counts.where("reason = 'included'").isEmpty():
        raise GateError("the receptor selection has no atoms")
    kept = subset.where("reason = 'included'").select("ord", "value")
    end = subset.sparkSession.createDataFrame([((1 << 63) - 1, "END")], kept.schema)
    kept.unionByName(end).repartitionByRange("ord").sortWithinPartitions("ord").select("value").write.text(path)
    return counts


def write_by_source(df: DataFrame, path: str, order: Sequence[str], pool: str = "source_pool", source: str = "source_index") -> None:
    """Compressed CSV with a header in a folder per pool and source, each in order over its part files. A large source is
    written by several tasks."""
    ranged = df.repartitionByRange(pool, source, *order).sortWithinPartitions(pool, source, *order)
    text = ranged.select(pool, source, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns if c not in (pool, source)])
    text.write.mode("errorifexists").partitionBy(pool, source).csv(path, header=True, compression="gzip", emptyValue="")


def write_chunks(df: DataFrame, path: str, protocol: str = "protocol_id", chunk: str = "chunk") -> None:
    """A folder per protocol and chunk, each written by one task."""
    df.repartition(protocol, chunk).write.mode("errorifexists").partitionBy(protocol, chunk).parquet(path)


def install(staged: str, target: str) -> str | None:
    """Put a staged file in place of the target; the first original is kept as .backup and its path returned."""
    backup = f"{target}.backup"
    kept = None
    if os.path.exists(target) and not os.path.exists(backup):
        shutil.copy2(target, backup)
        kept = backup
    os.replace(staged, target)
    return kept
