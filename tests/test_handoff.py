"""Reference checks, file identities, 3D statuses and the package for an affinity model."""

import json

import pytest
from pyspark.sql import functions as F

from siftline import __main__ as cli
from siftline.operators import conformers, geometry, jobs
from siftline.operators.gates import GateError
from siftline.plans import handoff, qc, reference
from siftline.sources import fetch, listing, molecular, sinks
from test_sources import PDB, atom, record

DBREF = "DBREF  1ABC A    1   999  UNP    P12345   X_HUMAN          1    999\n"


def test_reference_structures(spark, tmp_path):
    (tmp_path / "lig.sdf").write_text(record("lig", [atom("C", 0.0), atom("H", 1.0)], [(1, 2, 1)], {}))
    (tmp_path / "complex.pdb").write_text(DBREF + PDB)
    sums = {name: fetch.sha256(str(tmp_path / name)) for name in ("lig.sdf", "complex.pdb")}
    ligand = {"file": "lig.sdf", "heavy_atoms": 1, "resname": "LIG", "chain": "C", "resseq": 301}
    targets = [{"file": "complex.pdb", "chain": "A", "accession": "P12345", "residues": {10: "ALA"}}]
    found = reference.validate(spark, str(tmp_path), sums, ligand, "complex.pdb", targets)
    assert found["bound_heavy_atoms"] == found["expected_heavy_atoms"] == 1 and found["residues"]["complex.pdb"] == {10: "ALA"}
    for change, message in ((({"lig.sdf": "0" * 64}, ligand, targets), "changed"), ((sums, ligand | {"heavy_atoms": 2}, targets), "2 heavy"), ((sums, ligand | {"resseq": 9}, targets), "bound instance"), ((sums, ligand, [targets[0] | {"accession": "Q1"}]), "does not name"), ((sums, ligand, [targets[0] | {"residues": {10: "GLY"}}]), "not GLY")):
        with pytest.raises(GateError, match=message):
            reference.validate(spark, str(tmp_path), change[0], change[1], "complex.pdb", change[2])
    assert molecular.rigid_atoms("REMARK\nATOM 1\nHETATM 2\n") == 2
    for text in ("ROOT\nATOM 1\n", "REMARK\n"):
        with pytest.raises(ValueError):
            molecular.rigid_atoms(text)


def test_files_of_complexes(spark, tmp_path):
    for code, names in (("1abc", ["1abc_ligand.mol2", "1ABC_ligand.sdf", "1abc_pocket.pdb"]), ("2abc", ["2ABC_pocket.pdb"])):
        (tmp_path / code).mkdir()
        for name in names:
            (tmp_path / code / name).write_text("x")
    (tmp_path / "2abc" / "2abc_ligand.sdf").write_text("")  # an empty file is none
    got = {r["complex_id"]: [p and p.rsplit("/", 1)[1] for p in (r["ligand_path"], r["pocket_path"])] for r in molecular.located(spark.createDataFrame([("1abc",), ("2abc",), ("3abc",)], "complex_id string"), str(tmp_path)).collect()}
    assert got == {"1abc": ["1ABC_ligand.sdf", "1abc_pocket.pdb"], "2abc": [None, "2ABC_pocket.pdb"], "3abc": [None, None]}


def test_changed_files_change_signatures(spark, tmp_path):
    receptor, program = tmp_path / "r.pdb", tmp_path / "dock"
    receptor.write_text("a"), program.write_text("b")
    df = spark.createDataFrame([(1, str(receptor), "/out/1")], "chunk int, receptor string, output string")
    sign = lambda d=df: jobs.signatures(d, files=["receptor"], program=str(program), listed=listing.files(spark, str(tmp_path))).first()["signature"]
    first = sign()
    assert first == sign() == sign(df.withColumn("output", F.lit("/elsewhere")))
    receptor.write_text("longer")
    second = sign()
    program.write_text("other one")
    assert len({first, second, sign()}) == 3
    assert jobs.signatures(df, files=["receptor"], listed=listing.files(spark, str(tmp_path))).columns == ["chunk", "receptor", "output", "signature"]
    receptor.unlink()
    assert sign() not in (first, second)


def test_structure_statuses(spark):
    rows = [(1, "pnu_2d", None, [(0, "0.2"), (1, "0.9"), (2, "0.9")]), (2, "pharm2d", None, [(0, "-1")]), (3, "exploration", None, [(5, "0.9")]), (4, "pnu_2d", None, []), (5, "pnu_2d", "invalid_smiles", None), (6, "pnu_2d", "embed_error:ValueError", None)]
    df = spark.createDataFrame(rows, "structure_key int, prescreen_channel string, embed_error string, conformers array<struct<conformer_id:int,molblock:string>>")
    parents = df.select("structure_key", "prescreen_channel")
    embed = lambda d: d.join(df.drop("prescreen_channel"), "structure_key").withColumn("embedding_method", F.lit("m"))
    align = lambda d: d.withColumns({"combined": F.col("molblock").cast("double"), "feature": F.lit(0.4), "shape": F.lit(0.3), "clash": F.lit(0.5)})
    got = {r["structure_key"]: r for r in conformers.structure_scores(parents, embed, align).collect()}
    assert {k: r["structure3d_status"] for k, r in got.items()} == {1: "ok", 2: "alignment_failed", 3: "feasible_only", 4: "embed_failed", 5: "invalid_smiles", 6: "embed_error:ValueError"}
    assert (got[1]["structure3d_best_conformer"], got[1]["structure3d_conformer_count"]) == (1, 3) and got[1]["structure3d_score"] == pytest.approx(0.54)
    assert (got[3]["structure3d_best_conformer"], got[3]["structure3d_score"]) == (5, 0.0) and got[5]["structure3d_score"] is None


def test_pose_statuses(spark):
    poses = spark.createDataFrame([("a", "0.5"), ("b", "-1"), ("c", None)], "pose_id string, molblock string")
    align = lambda d: d.withColumns({"combined": F.col("molblock").cast("double"), "feature": F.lit(0.4), "shape": F.lit(0.3), "o3a": F.lit(7.0)})
    got = {r["pose_id"]: (r["postdock_3d_status"], r["postdock_3d_similarity"], r["postdock_o3a_score"]) for r in conformers.pose_similarities(poses, align).collect()}
    assert got == {"a": ("ok", 0.5, 7.0), "b": ("alignment_failed", 0.0, 7.0), "c": ("invalid_pose", 0.0, 0.0)}
    with pytest.raises(GateError, match="coverage"):
        conformers.pose_similarities(poses, align, 0.95)
    with pytest.raises(GateError, match="duplicate"):
        conformers.pose_similarities(poses.unionByName(poses.limit(1)), align)


def tables(spark):
    return {
        "poses": spark.createDataFrame([("p|s1|1", "k1", "s1", "p", -8.0, 1), ("p|s1|2", "k1", "s1", "p", -7.0, 2)], "pose_id string, parent_structure_key string, state_id string, protocol_id string, smina_score double, ligand_record_index long"),
        "parents": spark.createDataFrame([("k1", "c1", 0.5)], "structure_key string, compound_id string, qed double"),
        "states": spark.createDataFrame([("s1", "CC")], "state_id string, state_smiles string"),
        "similarity": spark.createDataFrame([("p|s1|1", "ok", 0.5), ("p|s1|2", "invalid_pose", 0.0)], "pose_id string, postdock_3d_status string, postdock_3d_similarity double"),
    }


def test_package(spark, tmp_path):
    (tmp_path / "r.pdb").write_text(PDB)
    (tmp_path / "poses.sdf").write_text(record("s1", [atom("C", 0.0)], [], {}) * 2)
    t, out = tables(spark), tmp_path / "out"
    for name, df in t.items():
        df.write.parquet(str(tmp_path / name))
    args = [x for name in t for x in (f"--{name}", str(tmp_path / name))]
    assert cli.main(["prepare-affinity", *args, "--receptor", str(tmp_path / "r.pdb"), "--ligands", str(tmp_path / "poses.sdf"), "--out", str(out)]) == 0
    assert json.loads((out / "summary.json").read_text())["poses"] == 2 and (out / "receptor" / "r.pdb").read_text() == PDB and "ligand_record_index" in (out / "README.md").read_text()
    rows = spark.read.csv(str(out / "affinity_predictions"), header=True).orderBy("ligand_record_index").collect()
    assert [(r["pose_id"], r["docking_percentile"], r["predicted_paffinity"], r["compound_id"]) for r in rows] == [("p|s1|1", "1.0", None, "c1"), ("p|s1|2", "0.0", None, "c1")]
    (tmp_path / "poses.sdf").write_text(record("s1", [atom("C", 0.0)], [], {}))
    with pytest.raises(GateError, match="1 ligand records for 2"):
        handoff.package(spark, str(tmp_path / "again"), t["poses"], t["parents"], t["states"], t["similarity"], str(tmp_path / "r.pdb"), str(tmp_path / "poses.sdf"))
    with pytest.raises(GateError, match="similarity"):
        handoff.package(spark, str(tmp_path / "again"), t["poses"], t["parents"], t["states"], t["similarity"].limit(1), str(tmp_path / "r.pdb"), str(tmp_path / "poses.sdf"))


def embedded(df):
    block = F.array(F.struct(F.lit(0).alias("conformer_id"), F.lit("block").alias("molblock")))
    return df.withColumns({"embed_error": F.lit(None).cast("string"), "embedding_method": F.lit("m"), "conformers": block, "embed_status": F.when(F.col("compound_id") == "c2", "failed").otherwise("ok") if "compound_id" in df.columns else F.lit("ok")})


def aligned(df):
    return df.withColumns({n: F.lit(v) for n, v in (("combined", 0.9), ("feature", 0.5), ("shape", 0.5), ("clash", 0.0), ("o3a", 1.0))})


def test_commands_with_outside_kernels(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    spark.createDataFrame([("k1", "pnu_2d"), ("k2", "exploration")], "structure_key string, prescreen_channel string").write.parquet(at("pool"))
    assert cli.main(["score3d", "--pool", at("pool"), "--embed", "test_handoff:embedded", "--align", "test_handoff:aligned", "--out", at("scored")]) == 0
    assert {(r["structure_key"], r["structure3d_status"]) for r in spark.read.parquet(at("scored")).collect()} == {("k1", "ok"), ("k2", "feasible_only")}
    names = "structure_key string, compound_id string, source_pool string, selection_channel string, standardized_smiles string"
    spark.createDataFrame([("0" * 40, "c1", "unlabeled", "a", "CCO"), ("1" * 40, "c2", "unlabeled", "a", "CCN")], names).write.parquet(at("selected"))
    assert cli.main(["ligands", "--selected", at("selected"), "--embed", "test_handoff:embedded", "--out", at("ligands")]) == 0
    assert [spark.read.parquet(at(f"ligands/{t}")).first()["compound_id"] for t in ("states", "failures")] == ["c1", "c2"]
    spark.createDataFrame([("p1", "b"), ("p2", None)], "pose_id string, molblock string").write.parquet(at("poses"))
    args = ["postdock3d", "--poses", at("poses"), "--align", "test_handoff:aligned"]
    assert cli.main([*args, "--out", at("similarity")]) == 0 and spark.read.parquet(at("similarity")).where("postdock_3d_status = 'ok'").count() == 1
    with pytest.raises(GateError, match="post-docking"):
        cli.main([*args, "--least", "0.95", "--out", at("strict")])
    (tmp_path / "x").write_text("here")
    (tmp_path / "list.json").write_text(json.dumps([{"url": f"file://{tmp_path}/x", "file": "y", "sha256": fetch.sha256(at("x"))}]))
    assert cli.main(["references", "--list", at("list.json"), "--out", at("refs")]) == 0 and (tmp_path / "refs" / "y").read_text() == "here"


def test_receptor_needs_atoms_and_pockets_need_residues(spark, tmp_path):
    (tmp_path / "r.pdb").write_text(PDB)
    subset = molecular.receptor_subset(spark, str(tmp_path / "r.pdb"), ["A"], [])
    counts = sinks.write_receptor(subset, str(tmp_path / "out"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == counts.where("reason = 'included'").agg(F.sum("n")).first()[0] + 1 and "END" in lines
    with pytest.raises(GateError, match="no atoms"):
        sinks.write_receptor(molecular.receptor_subset(spark, str(tmp_path / "r.pdb"), ["Q"], []), str(tmp_path / "none"))
    atoms = spark.createDataFrame([("g", 1, 1, 5.0, 0.0, 0.0), ("g", 1, 2, 30.0, 0.0, 0.0), ("g", 2, 3, 9.0, 0.0, 0.0)], "g string, unit int, i int, x double, y double, z double")
    ligand = spark.createDataFrame([("g", 0.0, 0.0, 0.0), ("h", 0.0, 0.0, 0.0)], "g string, x double, y double, z double")
    args = "g", ["unit"], "i", ["x", "y", "z"]
    assert sorted(map(tuple, geometry.pocket_summary(atoms, ligand, *args, 6.0).collect())) == [("g", 2, 1, 5.0), ("h", 0, 0, None)]
    far = geometry.pocket_summary(atoms, ligand.where("g = 'g'"), *args, 2.0)
    with pytest.raises(GateError, match="nearest atom is 5.0"):
        geometry.require_pockets(far, "g", 2.0)


def test_quality_report_files(spark, tmp_path):
    states = spark.createDataFrame([("k", "s", "ok")], "parent_structure_key string, state_id string, embed_status string")
    selected = spark.createDataFrame([("k", "unlabeled", "a", "g")], "structure_key string, source_pool string, selection_channel string, murcko_scaffold string")
    run = qc.Run({"unlabeled_count": 1, "channel_counts": {"a": 1}, "scaffold_cap": 1}, selected=selected, states=states, ligand_records=1)
    assert qc.write(spark, run, str(tmp_path), True)["status"] == "PASS"
    run.ligand_records = 2
    found = qc.write(spark, run, str(tmp_path))
    assert found["status"] == "FAIL" and json.loads((tmp_path / "QC_REPORT.json").read_text()) == json.loads(json.dumps(found))
    assert "| ligand_record_count | FAIL | 2 records for 1 states |" in (tmp_path / "QC_REPORT.md").read_text()
