import pytest
from pyspark.sql import functions as F

from siftline import __main__ as cli
from siftline.operators.gates import GateError
from siftline.plans import screening

FILES = {"activity_2w.csv": [("a", "CCO")], "candidate_1.csv": [("u1", "OCC"), ("u2", "CCN")], "candidate_2.csv": [("u3", "NCC"), ("u4", "CCC")], "candidate_3.csv": [("u5", "c1ccccc1"), ("u6", "CCO")], "candidate_4.csv": [("u7", "CCCl"), ("u8", "CCC")]}


@pytest.fixture
def library(tmp_path):
    for name, rows in FILES.items():
        (tmp_path / name).write_text("ID,SMILES\n" + "".join(f"{i},{s}\n" for i, s in rows))
    return str(tmp_path)


def test_five_sources_to_scores(spark, library, tmp_path):
    assert cli.main(["standardize", "--data", library, "--out", str(tmp_path / "std")]) == 0
    mapped, parents = spark.read.parquet(str(tmp_path / "std" / "mapping")), spark.read.parquet(str(tmp_path / "std" / "parents"))
    assert mapped.count() == 9 and parents.count() == 5
    ethanol = {r["compound_id"]: (r["dedup_status"], r["resolved_source_pool"], r["active_exact_overlap"]) for r in mapped.where("compound_id in ('a', 'u1', 'u6', 'u3')").collect()}
    assert ethanol == {"a": ("unique_parent", "activity_recorded", 0), "u1": ("exact_duplicate", "activity_recorded", 1), "u6": ("exact_duplicate", "activity_recorded", 1), "u3": ("exact_duplicate", "unlabeled", 0)}
    assert sorted(r["compound_id"] for r in parents.where("source_pool = 'unlabeled'").collect()) == ["u2", "u4", "u5", "u7"]
    cli.main(["score2d", "--parents", str(tmp_path / "std" / "parents"), "--reference", "CCO", "--out", str(tmp_path / "scored")])
    scored = {r["compound_id"]: r for r in spark.read.parquet(str(tmp_path / "scored")).collect()}
    assert len(scored) == 5 and scored["a"]["pnu_ecfp_similarity"] == 1.0 and scored["a"]["pnu_consensus"] == pytest.approx(0.55)
    assert scored["u5"]["hard_filter_reasons"] == "heavy_atoms_low|mw_low"


def test_sample_is_dealt_to_files(spark, library):
    from siftline.sources.tabular import read_sources

    got = screening.sampled(read_sources(spark, library), 1, 6, 3).groupBy("source_file").count().collect()
    assert {r["source_file"]: r["count"] for r in got} == {"activity_2w.csv": 1, "candidate_1.csv": 2, "candidate_2.csv": 2, "candidate_3.csv": 1, "candidate_4.csv": 1}


def test_states_jobs_and_poses(spark):
    selected = spark.createDataFrame([(f"{i}" * 40, f"c{i}", "unlabeled", "a", "C[C@H](O)N" if i else "CC") for i in range(5)], "structure_key string, compound_id string, source_pool string, selection_channel string, standardized_smiles string")
    embed = lambda df: df.withColumns({"embed_status": F.when(F.col("compound_id") == "c4", "embed_failed").otherwise("ok"), "embedding_method": F.lit("x"), "molblock": F.lit("m")})
    good, failed = screening.states(selected, embed, 7.4)
    assert (good.count(), failed.count()) == (4, 1)
    assert good.where("compound_id = 'c1'").first()["state_origin"] == "openbabel_pH_7.4;rdkit_canonical_tautomer;source_stereochemistry_preserved"
    box = {"center": [1, 2, 3], "size": [4, 5, 6]}
    protocol = {"protocol_id": "p", "enabled": True, "receptor_id": "r", "box_id": "b", "exhaustiveness": 12, "num_modes": 2, "box": box, "scope": {"selection_channels": ["*"], "max_parents": 0}}
    table, members = screening.job_table(good, [protocol, protocol | {"protocol_id": "off", "enabled": False}], 3, 5)
    assert sorted((r["chunk"], r["states"], r["size_z"]) for r in table.collect()) == [(1, 3, 6.0), (2, 1, 6.0)]
    records = members.select("protocol_id", "state_id", F.col("chunk").alias("file_ord"), F.lit(1).alias("record_index"), F.create_map(F.lit("minimizedAffinity"), F.lit("-7.25")).alias("props"))
    poses = screening.collected(records, good, members, 2)
    assert poses.count() == 4 and poses.where("smina_score = -7.25 and pose_rank = 1").count() == 4
    with pytest.raises(GateError, match="affinity"):
        screening.collected(records.withColumn("props", F.create_map(F.lit("x"), F.lit("1"))), good, members, 2)


def test_final_score_command(spark, tmp_path):
    rows = {
        "parents": spark.createDataFrame([("k1", "id1", "CCO", 1, 0.7)], "structure_key string, compound_id string, standardized_smiles string, row_ord int, qed double"),
        "poses": spark.createDataFrame([("a", "k1", "s", "p", "WT", -8.0, 1)], "pose_id string, parent_structure_key string, state_id string, protocol_id string, mutant_id string, smina_score double, pose_ord int"),
        "affinity": spark.createDataFrame([("a", 8.0)], "pose_id string, predicted_paffinity double"),
    }
    for name, df in rows.items():
        df.write.parquet(str(tmp_path / name))
    args = [x for name in rows for x in (f"--{name}", str(tmp_path / name))]
    cli.main(["final-score", *args, "--out", str(tmp_path / "out"), "--top-n", "1", "--required", "p"])
    hits = spark.read.csv(str(tmp_path / "out" / "top_1_hits"), sep="\t", header=True).collect()
    assert [tuple(h)[:3] for h in hits] == [("id1", "CCO", "1")]
