import copy
import json

import pytest
from pyspark.sql import functions as F

from siftline.operators.gates import GateError
from siftline.plans import config, qc, stages
from siftline.streaming import events

BOX = {"center": [1.0, 2.0, 3.0], "size": [24.0, 24.0, 28.0]}
GOOD = {
    "prescreen_3d_pool": {"size": 200, "include_all_activity_recorded": True, "channel_fractions": {"a": 0.5, "b": 0.5}},
    "final_selection": {"activity_recorded_policy": "all_3d_feasible", "require_all_activity_recorded_3d": False, "unlabeled_count": 10, "unlabeled_channel_counts": {"a": 4, "b": 6}},
    "ligand_states": {"states_per_parent": 1, "conformers_per_state": 1, "tautomer_method": "rdkit_canonical", "embedding_failure_policy": "exclude_with_report"},
    "docking": {"production_required_protocols": ["p"], "protocols": [{"protocol_id": "p", "enabled": True, "mutant_id": "WT", "box": BOX, "scope": {"selection_channels": ["*"]}}]},
    "postdock_3d": {"minimum_pose_coverage": 0.95},
    "integrated_scoring": {
        "excluded_protocols": [], "required_protocols": ["p"], "minimum_postdock_3d_pose_coverage": 0.95, "predocking": {"weights": {"x": 0.65, "y": 0.35}}, "affinity": {"minimum_pose_coverage": 0.95, "minimum_parent_coverage": 1.0},
        "profiles": {"wt": {"weights": {"wt_affinity": 0.55, "postdock_3d_similarity": 0.20, "docking_consensus": 0.15, "qed": 0.10}}},
    },
}


@pytest.mark.parametrize(
    "path, value, message",
    [
        (("prescreen_3d_pool", "channel_fractions", "a"), 0.6, "channel_fractions"),
        (("prescreen_3d_pool", "size"), 10, "larger than unlabeled_count"),
        (("final_selection", "unlabeled_channel_counts", "a"), 5, "unlabeled_channel_counts"),
        (("final_selection", "require_all_activity_recorded_3d"), "no", "boolean"),
        (("ligand_states", "states_per_parent"), 2, "one state"),
        (("docking", "protocols", 0, "mutant_id"), "M1", "reference variant"),
        (("docking", "protocols", 0, "box", "size"), [1, 0, 1], "positive sizes"),
        (("docking", "protocols", 0, "scope"), {}, "scope"),
        (("integrated_scoring", "required_protocols"), ["q"], "required protocols are known"),
        (("integrated_scoring", "excluded_protocols"), ["p"], "both required and excluded"),
        (("integrated_scoring", "affinity", "minimum_pose_coverage"), 0.0, "affinity coverages"),
        (("integrated_scoring", "profiles", "wt", "weights", "qed"), 0.2, "profile weights"),
        (("postdock_3d", "minimum_pose_coverage"), 0.9, "agree"),
    ],
)
def test_rules(path, value, message):
    broken = copy.deepcopy(GOOD)
    at = broken
    for step in path[:-1]:
        at = at[step]
    at[path[-1]] = value
    with pytest.raises(ValueError, match=message):
        config.validate(broken)
    assert config.validate(GOOD) is GOOD


def test_inheritance(tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"a": {"x": 1, "y": [1, 2]}, "b": 1}))
    (tmp_path / "own.json").write_text(json.dumps({"extends": "base.json", "a": {"y": [3]}}))
    assert config.load(str(tmp_path / "own.json")) == {"a": {"x": 1, "y": [3]}, "b": 1}


def test_stages(spark, tmp_path):
    source, folder, runs = tmp_path / "in", str(tmp_path / "stage"), []
    spark.range(5).write.parquet(str(source))

    def build():
        runs.append(1)
        return spark.read.parquet(str(source)).where("id > 1")

    for _ in range(2):
        table, summary = stages.run_stage(spark, folder, {"k": 1}, [str(source)], build)
        assert table.count() == summary["rows"] == 3
    assert len(runs) == 1
    stages.run_stage(spark, folder, {"k": 2}, [str(source)], build)
    assert len(runs) == 2
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "x").write_text("")
    with pytest.raises(stages.StageError):
        stages.run_stage(spark, str(tmp_path / "odd"), {}, [], build)
    stages.run_stage(spark, str(tmp_path / "odd"), {}, [], build, force=True)


def test_quality_report_names_every_failure(spark):
    keys = spark.range(6).selectExpr("cast(id as string) as structure_key", "if(id < 2, 'activity_recorded', 'unlabeled') as source_pool", "'ok' as structure3d_status", "1 as hard_filter_pass", "'s' as murcko_scaffold", "if(id < 2, 'activity_recorded_all', 'a') as selection_channel")
    states = keys.selectExpr("structure_key as parent_structure_key", "concat('t', structure_key) as state_id", "'ok' as embed_status")
    run = qc.Run({"pool_size": 6, "unlabeled_count": 4, "channel_counts": {"a": 4}, "scaffold_cap": 4, "protocols": ["p"]}, 6, keys, keys, keys, keys, keys, states, job_states=states.select("state_id"), jobs=spark.createDataFrame([("p", 1)], "protocol_id string, seed long"))
    assert qc.require(spark, run).where("passed").count() == qc.report(spark, run).count() >= 16
    run.settings = run.settings | {"scaffold_cap": 3, "pool_size": 7}
    with pytest.raises(GateError, match="3d_pool_size, unlabeled_scaffold_cap"):
        qc.require(spark, run)


def test_quality_checks_see_each_fault_in_a_few_jobs(spark):
    keys = spark.range(8).selectExpr("cast(id as string) as structure_key", "if(id < 3, 'activity_recorded', 'unlabeled') as source_pool", "if(id = 7, 'failed', 'ok') as structure3d_status", "1 as hard_filter_pass", "concat('s', id % 4) as murcko_scaffold", "if(id < 3, 'activity_recorded_all', if(id % 2 = 0, 'a', 'b')) as selection_channel").cache()
    chosen = keys.where("structure_key <> '7'")
    states = chosen.where("structure_key <> '6'").selectExpr("structure_key as parent_structure_key", "concat('t', structure_key) as state_id", "if(structure_key = '5', 'failed', 'ok') as embed_status")
    gone = spark.createDataFrame([("6",)], "parent_structure_key string")
    jobs = spark.createDataFrame([("p", 1), ("p", 2)], "protocol_id string, seed long")
    entered = states.where("embed_status = 'ok'").select("state_id")
    settings = {"pool_size": 8, "unlabeled_count": 4, "channel_counts": {"a": 2, "b": 2}, "scaffold_cap": 2, "protocols": ["p"], "max_parents": 6, "nodes": 2, "docking": {"jobs": 64}, "layout": {"nodes": 2, "docking.jobs": 64}}
    whole = dict(settings=settings, raw_records=8, mapping=keys, scored=keys, pool=keys, scored3d=keys, selected=chosen, states=states, failures=gone, jobs=jobs, job_states=entered, ligand_records=6)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quality", "")
    failed = lambda **change: {name for name, ok, _ in qc.checks(qc.Run(**(whole | change))) if not ok}
    try:
        assert failed() == set()
    finally:
        n_jobs = len(tracker.getJobIdsForGroup("quality"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n_jobs <= 16  # shuffles of five passes; adaptive plans count each of their stages as a job
    assert failed(settings=settings | {"nodes": 1}) == {"machine_layout"}
    assert failed(pool=keys.unionByName(keys.limit(1))) == {"3d_pool_size", "3d_pool_exact_unique"}
    assert failed(pool=keys.where("structure_key <> '1'")) == {"3d_pool_size", "all_active_in_pool"}
    assert failed(selected=chosen.where("structure_key <> '1'")) == {"dynamic_final_size", "all_feasible_active_included", "selected_parent_ligand_accounting"}
    assert failed(selected=chosen.where("structure_key <> '4'")) == {"dynamic_final_size", "fixed_unlabeled_quota", "unlabeled_channel_quotas", "selected_parent_ligand_accounting"}
    assert failed(failures=None) == {"selected_parent_ligand_accounting", "failures_are_reported"}
    assert failed(states=states.unionByName(states.limit(1))) >= {"one_state_per_parent", "ligand_record_count"}
    assert failed(job_states=states.select("state_id")) == {"only_embedded_states_enter", "job_input_state_count"}
    assert failed(jobs=spark.createDataFrame([("p", 1), ("q", 1)], jobs.schema)) == {"only_enabled_protocols", "reproducible_seeds"}
    assert failed(jobs=spark.createDataFrame([("p", -1)], jobs.schema)) == {"reproducible_seeds"} and failed(jobs=jobs.limit(0)) == {"has_scheduled_protocols"}
    assert failed(settings=settings | {"max_parents": 3, "scaffold_cap": 1}) == {"scope_bounded"} | ({"unlabeled_scaffold_cap"} if qc.selection_counts(chosen)[1] > 1 else set())


def test_streaming_counts_equal_batch(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"), table.schema)
    events.run_available(events.first_seen(stream, "event_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == table.select("event_id").distinct().count()
    counts = events.windowed_counts(events.event_stream(spark, str(tmp_path / "in"), table.schema), "event_type")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == table.count()
