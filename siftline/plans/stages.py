"""Stages with manifests: a finished stage is read, an unfinished folder is refused or cleared, a changed one runs anew."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftline.sources.sinks import write_json


class StageError(RuntimeError):
    """A stage folder cannot be used."""


def fingerprint(settings: dict, inputs: list[str]) -> str:
    """SHA-256 of settings and of the inputs' names, sizes and times."""
    files = []
    for path in inputs:
        for at, _, names in sorted(os.walk(path)) if os.path.isdir(path) else [(os.path.dirname(path), [], [os.path.basename(path)])]:
            files += [(os.path.join(at, n), os.stat(os.path.join(at, n)).st_size, os.stat(os.path.join(at, n)).st_mtime_ns) for n in sorted(names)]
    return hashlib.sha256(json.dumps([settings, files], sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def run_stage(spark: SparkSession, folder: str, settings: dict, inputs: list[str], build: Callable[[], DataFrame], force: bool = False) -> tuple[DataFrame, dict]:
    """The stage's table and manifest; `build` runs only if no manifest of the same settings and inputs is there."""
    manifest, data, mark = os.path.join(folder, "summary.json"), os.path.join(folder, "table"), fingerprint(settings, inputs)
    if os.path.exists(manifest) and not force:
        with open(manifest, encoding="utf-8") as f:
            summary = json.load(f)
        if summary["fingerprint"] == mark:
            return spark.read.parquet(data), summary
    elif os.path.isdir(folder) and os.listdir(folder) and not force:
        raise StageError(f"{folder} is not empty and has no summary")
    if os.path.isdir(folder):
        shutil.rmtree(folder)
    os.makedirs(folder)
    began = time.time()
    build().write.parquet(data)
    table = spark.read.parquet(data)
    summary = {"fingerprint": mark, "rows": table.count(), "elapsed_seconds": round(time.time() - began, 3), "settings": settings}
    write_json(manifest, summary)
    return table, summary
