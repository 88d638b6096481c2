"""Work by outside programs: one task per job, output installed only when it is valid, and a mark beside it."""

from __future__ import annotations

import json
import os
import subprocess
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators.gates import GateError, require_contiguous, require_subset
from siftline.sources.molecular import parse_sdf_record

# Properties that hold a docking score, first match wins.
AFFINITY_PROPERTIES = ["minimizedAffinity", "smina_affinity", "affinity"]


def docking_command(binary: str, job: dict, output: str, log: str) -> list[str]:
    """The docking program's arguments for a job row."""
    plain = ["center_x", "center_y", "center_z", "size_x", "size_y", "size_z", "cpu", "exhaustiveness", "num_modes", "seed"]
    args = [binary, "--receptor", job["receptor"], "--ligand", job["ligands"]]
    for name in plain:
        args += [f"--{name}", str(job[name])]
    return [*args, "--out", output, "--log", log]


def sdf_records(path: str) -> list[dict]:
    parts = Path(path).read_text(encoding="utf-8").replace("\r\n", "\n").split("$$$$\n")
    return [parse_sdf_record(p) for p in parts if p.strip()]


def record_state(record: dict) -> str:
    return (record["props"].get("state_id") or record["title"]).strip()


def affinity_of(record: dict) -> float:
    for name in AFFINITY_PROPERTIES:
        if name in record["props"]:
            return float(record["props"][name])
    raise GateError(f"no affinity property among {sorted(record['props'])}")


def check_docking(job: dict, output: str) -> dict:
    """Every input state has 1..num_modes poses with a numeric affinity and nothing else is there; else GateError."""
    states = [record_state(r) for r in sdf_records(job["ligands"])]
    if "" in states or len(states) != len(set(states)):
        raise GateError("input states are blank or repeated")
    if not os.path.exists(output) or not os.path.getsize(output):
        raise GateError("no output")
    seen: Counter[str] = Counter()
    for record in sdf_records(output):
        state = record_state(record)
        if state not in states:
            raise GateError(f"unexpected state {state!r}")
        try:
            affinity_of(record)
        except ValueError as e:
            raise GateError(f"state {state}: {e}") from e
        seen[state] += 1
    if missing := sorted(set(states) - set(seen)):
        raise GateError(f"{len(missing)} states without a pose, first {missing[0]}")
    if over := sorted(s for s, n in seen.items() if n > int(job["num_modes"])):
        raise GateError(f"state {over[0]} has more than {job['num_modes']} poses")
    return {"states": len(states), "poses": sum(seen.values())}


def run_job(job: dict, command: Callable[[dict, str, str], list[str]], check: Callable[[dict, str], dict]) -> str:
    """skipped, recovered or completed. A failed run leaves earlier files as they were and raises GateError."""
    mark, output = Path(f"{job['output']}.done.json"), job["output"]

    def valid(path: str) -> dict | None:
        try:
            return check(job, path)
        except (GateError, OSError, ValueError):
            return None

    def sign(found: dict) -> None:
        part = mark.with_name(f"{mark.name}.{uuid.uuid4().hex}.partial")
        part.write_text(json.dumps({"signature": job["signature"], **found}), encoding="utf-8")
        os.replace(part, mark)

    if mark.exists():
        known = json.loads(mark.read_text(encoding="utf-8")).get("signature")
        if known == job["signature"] and valid(output):
            return "skipped"
    elif found := valid(output):
        sign(found)
        return "recovered"
    token = uuid.uuid4().hex
    partial, log = f"{output}.{token}.partial", f"{job['log']}.{token}.partial"
    done = subprocess.run(command(job, partial, log), capture_output=True, text=True, check=False)
    try:
        if done.returncode:
            raise GateError(f"the program failed: {done.stderr[-500:]}")
        found = check(job, partial)
    except (GateError, OSError, ValueError) as e:
        for path in (partial, log):
            Path(path).unlink(missing_ok=True)
        raise GateError(f"job {job.get('chunk')}: {e}") from e
    if os.path.exists(log):
        os.replace(log, job["log"])
    os.replace(partial, output)
    sign(found)
    return "completed"


def run_jobs(jobs: DataFrame, command: Callable[[dict, str, str], list[str]], check: Callable[[dict, str], dict], keys: Sequence[str]) -> DataFrame:
    """keys and outcome: a row per job, each job a partition of its own. Paths are on storage that executors share."""
    kinds = dict(jobs.dtypes)
    n = jobs.count()

    def run(batches):
        for pdf in batches:
            rows = pdf.to_dict("records")
            yield pd.DataFrame({**{k: pdf[k] for k in keys}, "outcome": [run_job({a: str(b) for a, b in r.items()}, command, check) for r in rows]})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", outcome string"
    return jobs.repartition(max(n, 1), *keys).mapInPandas(run, schema)


def converted(df: DataFrame, key: str, text: str, command: Sequence[str], out: str) -> DataFrame:
    """Adds out: what a line-by-line program makes of "text key" lines, one process per partition. Every row must come back."""
    kind = dict(df.dtypes)
    command = list(command)

    def run(batches):
        for pdf in batches:
            lines = "".join(f"{t} {k}\n" for t, k in zip(pdf[text], pdf[key], strict=True))
            done = subprocess.run(command, input=lines, capture_output=True, text=True, check=False)
            if done.returncode:
                raise GateError(f"conversion failed: {done.stderr[-500:]}")
            got = {parts[1]: parts[0] for line in done.stdout.splitlines() if len(parts := line.split()) >= 2}
            if set(got) != set(map(str, pdf[key])):
                raise GateError(f"{len(got)} of {len(pdf)} rows converted")
            yield pdf.assign(**{out: [got[str(k)] for k in pdf[key]]})

    return df.mapInPandas(run, ", ".join(f"`{c}` {k}" for c, k in kind.items()) + f", `{out}` string")


def predicted(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], Sequence[float]]], out: str) -> DataFrame:
    """Adds out: a model's number per row. `load` runs once per task; a number that is not finite is an error."""
    kind = dict(df.dtypes)

    def run(batches):
        model = load()
        for pdf in batches:
            values = pd.Series(list(model(pdf)), index=pdf.index, dtype=float)
            if not (values.abs() < float("inf")).all():
                raise GateError("a prediction is not finite")
            yield pdf.assign(**{out: values})

    return df.mapInPandas(run, ", ".join(f"`{c}` {k}" for c, k in kind.items()) + f", `{out}` double")


def resumed(todo: DataFrame, done: DataFrame, index: str, key: str) -> DataFrame:
    """Rows still to predict. Finished ones must be known rows with the same key, their indexes 1..n."""
    require_contiguous(done, index, "finished predictions")
    require_subset(done.where(F.col(key) != ""), todo, [index, key], f"{index} and {key}")
    return todo.join(done.select(index), index, "left_anti")
