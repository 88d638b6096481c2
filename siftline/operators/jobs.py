"""Chunked jobs: numbering, seeds, signatures, the ledger of finished work, and results in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.scalars import job_seed, pose_id
from siftline.operators.gates import require_none, require_subset
from siftline.operators.ranking import chunk_numbers, global_index
from siftline.sources.listing import identities


def plan_jobs(states: DataFrame, protocol: str, order: Sequence[str], chunk_size: int, seed: int) -> DataFrame:
    """A row per (protocol, chunk): states, seed."""
    chunked = chunk_numbers(states, [protocol], [F.col(c) for c in order], chunk_size)
    return chunked.groupBy(protocol, "chunk").agg(F.count("*").alias("states")).withColumn("seed", job_seed(protocol, "chunk", seed))


def signatures(jobs: DataFrame, ignore: Sequence[str] = ("output", "log"), version: int = 1, files: Sequence[str] = (), program: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Adds signature: SHA-256 of the job's fields in name order as compact JSON, without where its results go. `files`
    are columns of paths; with them and the program, the length and time of what lies there count too, so a changed file
    is new work. `listed` says what lies where (`listing.files`)."""
    names = sorted(c for c in jobs.columns if c not in ignore)
    what = [F.lit(version).alias("version"), *names]
    if files or program:
        if listed is None:
            raise ValueError("files need a listing")
        paths = {f"_file_{c}": F.col(c) for c in files} | ({"_file_program": F.lit(program)} if program else {})
        jobs = identities(jobs, listed, paths)
        what.append(F.struct(*[F.col(c).alias(c.removeprefix("_file_")) for c in paths]).alias("files"))
    signed = jobs.withColumn("signature", F.sha2(F.to_json(F.struct(*what)).cast("binary"), 256))
    return signed.drop(*[c for c in signed.columns if c.startswith("_file_")])


def outstanding(jobs: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Jobs to run: all without a valid ledger entry of the same signature. An entry without a signature (a valid output
    whose mark was lost) counts as done."""
    valid = ledger.where("valid").select(*keys, F.col("signature").alias("_done"))
    same = (F.col("_done").isNull()) | (F.col("_done") == F.col("signature"))
    done = jobs.join(valid, list(keys)).where(same).select(*keys)
    return jobs.join(done, list(keys), "left_anti")


def outcomes(jobs: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per job: skipped (valid, same signature), recovered (valid, no mark) or run."""
    entries = ledger.select(*keys, F.col("signature").alias("_mark"), "valid", F.lit(True).alias("_known"))
    joined = jobs.join(entries, list(keys), "left")
    skipped = F.col("_known") & F.col("valid") & (F.col("_mark") == F.col("signature"))
    recovered = F.col("_known") & F.col("valid") & F.col("_mark").isNull()
    return joined.withColumn("outcome", F.when(skipped, "skipped").when(recovered, "recovered").otherwise("run")).drop("_mark", "valid", "_known")


def rank_poses(records: DataFrame, protocol: str, state: str, order: Sequence[str]) -> DataFrame:
    """Adds pose_rank, pose_id and ligand_record_index (1-based over protocols, the given order, states, ranks)."""
    w = Window.partitionBy(protocol, state).orderBy(*order)
    ranked = records.withColumn("pose_rank", F.row_number().over(w).cast("long"))
    ranked = ranked.withColumn("pose_id", pose_id(protocol, state, "pose_rank"))
    return global_index(ranked, [protocol, *order, state, "pose_rank"], "ligand_record_index")


def require_complete(records: DataFrame, scheduled: DataFrame, protocol: str, state: str, modes: int) -> None:
    """Every scheduled state has 1..modes records, and no record is of an unscheduled one."""
    keys = [protocol, state]
    require_subset(records, scheduled, keys, "scheduled state")
    require_subset(scheduled, records, keys, "state with a pose")
    counts = records.groupBy(*keys).agg(F.count("*").alias("n"))
    require_none(counts, F.col("n") > modes, f"states with more than {modes} poses")
