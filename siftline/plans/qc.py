"""Quality gates over a run's tables. All checks are reported; raising comes after."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.operators.gates import GateError
from siftline.sources.sinks import write_json, write_text


@dataclass
class Run:
    """Tables and settings of a finished preparation. Missing parts are None and their checks are left out."""

    settings: dict
    raw_records: int | None = None
    mapping: DataFrame | None = None
    scored: DataFrame | None = None
    pool: DataFrame | None = None
    scored3d: DataFrame | None = None
    selected: DataFrame | None = None
    states: DataFrame | None = None
    failures: DataFrame | None = None
    jobs: DataFrame | None = None
    job_states: DataFrame | None = None
    reference: dict | None = None
    ligand_records: int | None = None


def key_counts(run: Run) -> dict:
    """What the tables of a run say of its keys, by one pass over them: each row becomes flags, flags are added up by
    key, and the keys are counted."""
    active, ok3d = F.col("source_pool") == "activity_recorded", F.col("structure3d_status").isin("ok", "feasible_only")
    zero = F.lit(0)
    flags = {
        "pool": (run.pool, "structure_key", {"pool": F.lit(True)}),
        "scored": (run.scored, "structure_key", {"wanted": (F.col("hard_filter_pass") == 1) & active}),
        "scored3d": (run.scored3d, "structure_key", {"success": F.col("structure3d_status") == "ok", "feasible": active & ok3d}),
        "selected": (run.selected, "structure_key", {"selected": F.lit(True)}),
        "states": (run.states, "parent_structure_key", {"states": F.lit(True)}),
        "failures": (run.failures, "parent_structure_key", {"failures": F.lit(True)}),
    }
    names = [n for _, _, own in flags.values() for n in own]
    rows = [t.select(F.col(key).alias("key"), *[F.coalesce(own[n].cast("int"), zero).alias(n) if n in own else zero.alias(n) for n in names]) for t, key, own in flags.values() if t is not None]
    if not rows:
        return {}
    by_key = reduce(DataFrame.unionByName, rows).groupBy("key").agg(*[F.sum(n).alias(n) for n in names])
    col, has = F.col, lambda n: F.col(n) > 0
    lost = has("selected") & ~has("states")
    return by_key.agg(
        *[F.coalesce(F.sum(n), zero).alias(n) for n in names],
        F.count_if(col("pool") > 1).alias("pool_repeated"), F.coalesce(F.sum(F.when(~has("pool"), col("wanted"))), zero).alias("wanted_left_out"),
        F.coalesce(F.sum(F.when(~has("selected"), col("feasible"))), zero).alias("feasible_left_out"),
        F.count_if(col("states") > 1).alias("states_repeated"), F.coalesce(F.sum(F.when(lost & ~has("failures"), col("selected"))), zero).alias("unreported"),
    ).first().asDict()


def selection_counts(selected: DataFrame) -> tuple[dict[str, int], int]:
    """Rows by channel, and the most of one group, of rows that are not active; both by one pass."""
    others = selected.where(F.col("source_pool") != "activity_recorded").select("selection_channel", "murcko_scaffold")
    entry = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("name"))
    each = others.select(F.inline(F.array(entry("channel", "selection_channel"), entry("group", "murcko_scaffold"))))
    counts = each.groupBy("kind", "name").agg(F.count("*").alias("n"))
    channels = F.collect_list(F.when(F.col("kind") == "channel", F.struct("name", "n")))  # a few channels
    got = counts.agg(channels.alias("channels"), F.max(F.when(F.col("kind") == "group", F.col("n"))).alias("most")).first()
    return {r["name"]: r["n"] for r in got["channels"]}, got["most"] or 0


def state_counts(states: DataFrame, entered: DataFrame) -> dict:
    """States that entered jobs, the embedded ones, those that entered without being embedded, and different ones."""
    embedded = states.where("embed_status like 'ok%'").select("state_id", F.lit(1).alias("embedded"), F.lit(0).alias("entered"))
    by = embedded.unionByName(entered.select("state_id", F.lit(0).alias("embedded"), F.lit(1).alias("entered"))).groupBy("state_id").agg(F.sum("embedded").alias("embedded"), F.sum("entered").alias("entered"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by.agg(total("embedded").alias("embedded"), total("entered").alias("entered"), total(F.when(F.col("embedded") == 0, F.col("entered"))).alias("others"), F.count_if(F.col("entered") > 0).alias("kinds")).first().asDict()


def job_counts(jobs: DataFrame, protocols: Sequence[str]) -> dict:
    bad = F.coalesce((F.col("seed") < 0) | (F.col("seed") >= 2147483647), F.lit(True))
    by = jobs.groupBy("seed").agg(F.count("*").alias("n"), F.count_if(~F.col("protocol_id").isin(*protocols)).alias("others"), F.count_if(bad).alias("bad"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return by.agg(total("n"), total("others"), total("bad"), F.count_if(F.col("n") > 1).alias("repeated")).first().asDict()


def layout_problems(settings: dict, wanted: dict) -> dict:
    """Settings of the machines that are not as wanted: name -> (is, wanted). Names are paths joined by dots."""
    found = {}
    for path, value in wanted.items():
        at = settings
        for part in path.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at != value:
            found[path] = (at, value)
    return found


def checks(run: Run):
    """(name, passed, detail) in order. A pass over the tables by key, and one each over the selection, the states that
    entered jobs, the jobs and the mapping; nothing is read for a check whose tables are missing."""
    s, ref = run.settings, run.reference or {}
    if "layout" in s:
        odd = layout_problems(s, s["layout"])
        yield "machine_layout", not odd, ", ".join(f"{k} is {a}, not {b}" for k, (a, b) in odd.items()) or "as wanted"
    if ref:
        yield "reference_bound_instance", ref.get("bound_heavy_atoms") == ref.get("expected_heavy_atoms"), f"{ref.get('bound_heavy_atoms')} heavy atoms"
        yield "target_structures_known", set(ref.get("targets", [])) <= set(ref.get("known_targets", [])), str(ref.get("targets"))
        yield "single_rigid_receptor", ref.get("rigid_receptors") == 1, f"{ref.get('rigid_receptors')} rigid receptors"
        yield "2d_self_score", abs(ref.get("self_2d", 0.0) - 1) <= 1e-9, str(ref.get("self_2d"))
        yield "3d_reference_self", ref.get("self_3d", 0.0) >= 0.80, str(ref.get("self_3d"))
    if run.mapping is not None and run.raw_records is not None:
        n = run.mapping.count()
        if s.get("sample"):
            yield "sample_input_count", run.raw_records == s["sample"], f"{run.raw_records} records"
        yield "mapping_traceability", n == run.raw_records, f"{n} rows for {run.raw_records} records"
    k = key_counts(run)
    if run.pool is not None:
        yield "3d_pool_size", k["pool"] == s["pool_size"], f"{k['pool']} rows"
        yield "3d_pool_exact_unique", k["pool_repeated"] == 0, f"{k['pool_repeated']} repeated keys"
        if run.scored is not None:
            yield "all_active_in_pool", k["wanted_left_out"] == 0, f"{k['wanted_left_out']} left out"
    if run.scored3d is not None:
        yield "3d_has_success", k["success"] > 0, f"{k['success']} rows"
    if run.selected is not None:
        counts, most = selection_counts(run.selected)
        if run.scored3d is not None:
            yield "dynamic_final_size", k["selected"] == k["feasible"] + s["unlabeled_count"], f"{k['selected']} rows"
            yield "all_feasible_active_included", k["feasible_left_out"] == 0, f"{k['feasible_left_out']} left out"
        yield "fixed_unlabeled_quota", (n := sum(counts.values())) == s["unlabeled_count"], f"{n} rows"
        yield "unlabeled_channel_quotas", counts == s["channel_counts"], str(dict(sorted(counts.items(), key=str)))
        yield "unlabeled_scaffold_cap", most <= s["scaffold_cap"], f"{most} of one group"
    if run.states is not None and run.selected is not None:
        total = k["states"] + k["failures"]
        yield "selected_parent_ligand_accounting", total == k["selected"], f"{total} states and failures for {k['selected']} parents"
        yield "one_state_per_parent", k["states_repeated"] == 0, f"{k['states_repeated']} parents with several"
        yield "failures_are_reported", k["unreported"] == 0, f"{k['unreported']} unreported"
        if run.ligand_records is not None:
            yield "ligand_record_count", run.ligand_records == k["states"], f"{run.ligand_records} records for {k['states']} states"
    kinds = 0
    if run.job_states is not None and run.states is not None:
        j = state_counts(run.states, run.job_states)
        kinds = j["kinds"]
        yield "only_embedded_states_enter", j["others"] == 0, f"{j['others']} others"
        yield "job_input_state_count", j["entered"] == j["embedded"], f"{j['entered']} states"
    if run.jobs is not None:
        j = job_counts(run.jobs, s["protocols"])
        yield "has_scheduled_protocols", j["n"] > 0, f"{j['n']} jobs"
        yield "only_enabled_protocols", j["others"] == 0, f"{j['others']} jobs of others"
        yield "reproducible_seeds", j["bad"] == 0 and j["repeated"] == 0, "seeds are distinct and in range"
        if s.get("max_parents"):
            if run.job_states is not None and run.states is None:
                kinds = run.job_states.select("state_id").distinct().count()
            yield "scope_bounded", kinds <= s["max_parents"], f"{kinds} parents"


def report(spark: SparkSession, run: Run) -> DataFrame:
    return spark.createDataFrame([(name, bool(ok), detail) for name, ok, detail in checks(run)], "check_name string, passed boolean, detail string")


def require(spark: SparkSession, run: Run) -> DataFrame:
    """The report; an error names every check that failed."""
    out = report(spark, run)
    if failed := [r["check_name"] for r in out.where("not passed").collect()]:
        raise GateError(f"failed: {', '.join(failed)}")
    return out


def write(spark: SparkSession, run: Run, folder: str, production_ready: bool = False) -> dict:
    """The report as QC_REPORT.json and QC_REPORT.md in a folder that the driver reaches; returns the JSON's content."""
    rows = [r.asDict() for r in report(spark, run).collect()]
    failed = [r["check_name"] for r in rows if not r["passed"]]
    status = "FAIL" if failed else "PASS" if production_ready else "PRE_DOCKING_PASS_PRODUCTION_BLOCKED"
    found = {"status": status, "passed": len(rows) - len(failed), "failed": len(failed), "production_ready": production_ready, "checks": rows}
    write_json(f"{folder}/QC_REPORT.json", found)
    lines = ["# Quality report", "", f"Status: **{status}**", "", "| check | result | detail |", "|-|-|-|"]
    lines += [f"| {r['check_name']} | {'pass' if r['passed'] else 'FAIL'} | {r['detail']} |" for r in rows]
    write_text(f"{folder}/QC_REPORT.md", "\n".join(lines) + "\n")
    return found
