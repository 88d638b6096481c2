"""Command line: python -m siftline COMMAND. Tables are Parquet folders."""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from siftline.operators import conformers, external, jobs, selection
from siftline.plans import config as configuration
from siftline.plans import final_score, handoff, qc, screening
from siftline.sources import fetch, sinks, tabular


def _final_score(spark: SparkSession, a: argparse.Namespace) -> None:
    read = spark.read.parquet
    ranked = final_score.run(read(a.parents), read(a.poses), read(a.affinity), read(a.similarity) if a.similarity else None, final_score.Settings(required=a.required))
    ranked.write.mode("errorifexists").parquet(f"{a.out}/ranked_parents")
    sinks.write_tsv(final_score.top_hits(spark.read.parquet(f"{a.out}/ranked_parents"), a.top_n), f"{a.out}/top_{a.top_n}_hits", ["Rank"])


def _standardize(spark: SparkSession, a: argparse.Namespace) -> None:
    screening.mapping(tabular.read_sources(spark, a.data)).write.mode("errorifexists").parquet(f"{a.out}/mapping")
    screening.parents(spark.read.parquet(f"{a.out}/mapping")).write.mode("errorifexists").parquet(f"{a.out}/parents")


def _score2d(spark: SparkSession, a: argparse.Namespace) -> None:
    screening.scored2d(spark.read.parquet(a.parents), a.reference).write.mode("errorifexists").parquet(a.out)


def _pool3d(spark: SparkSession, a: argparse.Namespace) -> None:
    c = configuration.validate(configuration.load(a.config))
    pool = c["prescreen_3d_pool"]
    out = selection.prescreen_pool(spark.read.parquet(a.scored), pool["channel_fractions"], int(pool["size"]), int(c["final_selection"]["unlabeled_count"]), int(c["seed"]))
    out.write.mode("errorifexists").parquet(a.out)


def _select(spark: SparkSession, a: argparse.Namespace) -> None:
    c = configuration.validate(configuration.load(a.config))
    f, rows = c["final_selection"], spark.read.parquet(a.scored)
    picked = selection.final_selection(
        rows, f["unlabeled_channel_counts"], int(c["seed"]), "bits", float(f["min_structure3d_score"]), float(f["min_diversity_qed"]), targeted_cap=int(f["targeted_scaffold_cap"]),
        diverse_cap=int(f["default_scaffold_cap"]), global_cap=int(f["global_scaffold_cap"]), oversample=int(f["diversity_oversample_factor"]),
    )
    rows.join(picked, "structure_key").write.mode("errorifexists").parquet(a.out)


def _jobs(spark: SparkSession, a: argparse.Namespace) -> None:
    c = configuration.validate(configuration.load(a.config))
    table, members = screening.job_table(spark.read.parquet(a.states), c["docking"]["protocols"], int(c["docking"]["chunk_size"]), int(c["seed"]))
    table.write.mode("errorifexists").parquet(f"{a.out}/jobs")
    members.write.mode("errorifexists").parquet(f"{a.out}/job_states")


def _select_failures(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_csv(selection.activity_failures(spark.read.parquet(a.scored)), a.out, ["structure_key"])


def _collect(spark: SparkSession, a: argparse.Namespace) -> None:
    read = spark.read.parquet
    screening.collected(read(a.records), read(a.states), read(a.job_states), int(a.modes)).write.mode("errorifexists").parquet(a.out)


def _handoff(spark: SparkSession, a: argparse.Namespace) -> None:
    read = spark.read.parquet
    handoff.package(spark, a.out, read(a.poses), read(a.parents), read(a.states), read(a.similarity), a.receptor, a.ligands)


def _qc(spark: SparkSession, a: argparse.Namespace) -> None:
    """A run's folder has a Parquet folder for each table of qc.Run that there is."""
    tables = {n: spark.read.parquet(f"{a.run}/{n}") for n in ("mapping", "scored", "pool", "scored3d", "selected", "states", "failures", "jobs", "job_states") if os.path.isdir(f"{a.run}/{n}")}
    c = configuration.validate(configuration.load(a.config))
    final, protocols = c["final_selection"], [p["protocol_id"] for p in c["docking"]["protocols"] if p.get("enabled")]
    settings = {"pool_size": int(c["prescreen_3d_pool"]["size"]), "unlabeled_count": int(final["unlabeled_count"]), "channel_counts": final["unlabeled_channel_counts"], "scaffold_cap": int(final.get("global_scaffold_cap", 6)), "protocols": protocols}
    found = qc.write(spark, qc.Run(settings, **tables), a.run)
    if found["failed"]:
        raise SystemExit(f"{found['failed']} checks failed, see {a.run}/QC_REPORT.md")


def _kernel(name: str):
    """A function named module:function, which brings an outside toolkit."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _score3d(spark: SparkSession, a: argparse.Namespace) -> None:
    conformers.structure_scores(spark.read.parquet(a.pool), _kernel(a.embed), _kernel(a.align)).write.mode("errorifexists").parquet(a.out)


def _ligands(spark: SparkSession, a: argparse.Namespace) -> None:
    good, failed = screening.states(spark.read.parquet(a.selected), _kernel(a.embed))
    good.write.mode("errorifexists").parquet(f"{a.out}/states")
    failed.write.mode("errorifexists").parquet(f"{a.out}/failures")


def _smina(spark: SparkSession, a: argparse.Namespace) -> None:
    """Jobs are rows with receptor, ligands, output and log on storage that executors mount."""
    rows = jobs.signatures(spark.read.parquet(a.jobs), ignore=("output", "log"))
    program = a.program
    done = external.run_jobs(rows, lambda job, out, log: external.docking_command(program, job, out, log), external.check_docking, ["protocol_id", "chunk"])
    done.write.mode("errorifexists").parquet(a.out)


def _postdock3d(spark: SparkSession, a: argparse.Namespace) -> None:
    conformers.pose_similarities(spark.read.parquet(a.poses), _kernel(a.align), a.least).write.mode("errorifexists").parquet(a.out)


def _references(spark: SparkSession, a: argparse.Namespace) -> None:
    """A JSON list of {url, file, sha256}: each is read once and checked."""
    for item in json.loads(Path(a.list).read_text(encoding="utf-8")):
        fetch.fetch(item["url"], os.path.join(a.out, item["file"]), item.get("sha256"))


def _path(spark: SparkSession, a: argparse.Namespace) -> None:
    print(configuration.load(a.config)["output_dir"])


def _integrated(spark: SparkSession, a: argparse.Namespace) -> None:
    read = spark.read.parquet
    final_score.run(read(a.parents), read(a.poses), read(a.affinity), read(a.similarity)).write.mode("errorifexists").parquet(a.out)


COMMANDS = {
    "standardize": (_standardize, ["data", "out"]),
    "score2d": (_score2d, ["parents", "reference", "out"]),
    "pool3d": (_pool3d, ["config", "scored", "out"]),
    "select": (_select, ["config", "scored", "out"]),
    "references": (_references, ["list", "out"]),
    "score3d": (_score3d, ["pool", "embed", "align", "out"]),
    "ligands": (_ligands, ["selected", "embed", "out"]),
    "smina": (_smina, ["jobs", "program", "out"]),
    "postdock3d": (_postdock3d, ["poses", "align", "out"]),
    "prepare-jobs": (_jobs, ["config", "states", "out"]),
    "activity-failures": (_select_failures, ["scored", "out"]),
    "collect-docking": (_collect, ["records", "states", "job-states", "modes", "out"]),
    "prepare-affinity": (_handoff, ["poses", "parents", "states", "similarity", "receptor", "ligands", "out"]),
    "integrated-score": (_integrated, ["parents", "poses", "affinity", "similarity", "out"]),
    "qc": (_qc, ["config", "run"]),
    "path": (_path, ["config"]),
    "final-score": (_final_score, ["parents", "poses", "affinity", "out"]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siftline", description="Staged selection, scoring and ranking on Spark")
    commands = top.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        p = commands.add_parser(name)
        for option in options:
            p.add_argument(f"--{option}", required=True)
        if name == "postdock3d":
            p.add_argument("--least", type=float)
        if name == "final-score":
            p.add_argument("--similarity")
            p.add_argument("--required", action="append", default=[])
            p.add_argument("--top-n", type=int, default=100)
    return top


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    COMMANDS[a.command][0](SparkSession.builder.appName("siftline").getOrCreate(), a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
