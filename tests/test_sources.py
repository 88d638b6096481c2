import zipfile

import pytest
from pyspark.sql import functions as F

from siftline.operators import committed, external, jobs
from siftline.operators.gates import GateError
from siftline.sources import fetch, molecular, sinks, tabular

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def xlsx(path):
    sheet = f'<worksheet {NS}><sheetData><row r="1"/><row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="inlineStr"><is><t>SMILES</t></is></c></row><row r="3"><c r="A3"><v>7</v></c><c r="B3" t="s"><v>1</v></c></row><row r="5"><c r="B5" t="inlineStr"><is><t>CCN</t></is></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}><si><t>ID</t></si><si><r><t>CC</t></r><r><t>O</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)


def test_sources_by_content_and_alias(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    xlsx(tmp_path / "sub" / "z.csv")  # a workbook in spite of its name
    (tmp_path / "lib_2w.csv").write_text("﻿TS ID,smiles , CAS\nx1, CCO ,\nx2,,1\n", encoding="utf-8")
    (tmp_path / "a.csv").write_text('HITId,Smile,name\nu1,CCC,"a, ""b"""\n')
    rows = tabular.read_sources(spark, str(tmp_path)).orderBy("source_index", "source_row").collect()
    got = [(r["source_index"], r["source_file"], r["source_row"], r["source_pool"], r["compound_id"], r["original_smiles"], r["name"]) for r in rows]
    assert got == [
        (0, "lib_2w.csv", "2", "activity_recorded", "x1", "CCO", ""), (0, "lib_2w.csv", "3", "activity_recorded", "x2", "", ""),
        (1, "a.csv", "2", "unlabeled", "u1", "CCC", 'a, "b"'), (2, "sub/z.csv", "3", "unlabeled", "7", "CCO", ""), (2, "sub/z.csv", "5", "unlabeled", "", "CCN", ""),
    ]


def test_discovery_needs_one_active_and_a_candidate(spark, tmp_path):
    (tmp_path / "a_2w.csv").write_text("ID\n")
    with pytest.raises(ValueError, match="no candidate"):
        tabular.discover(spark, str(tmp_path))
    (tmp_path / "b_2w.csv").write_text("ID\n")
    with pytest.raises(ValueError, match="exactly one"):
        tabular.discover(spark, str(tmp_path))


def atom(element, x, code=0):
    return f"{x:10.4f}{0.0:10.4f}{0.0:10.4f} {element:<3}{0:2d}{code:3d}  0  0  0  0  0  0  0  0  0  0"


def record(title, atoms, bonds, props):
    lines = [title, "", "", f"{len(atoms):3d}{len(bonds):3d}  0  0  0  0  0  0  0  0999 V2000", *atoms, *[f"{a:3d}{b:3d}{o:3d}  0" for a, b, o in bonds], "M  END"]
    return "\n".join(lines) + "\n" + "".join(f">  <{k}>\n{v}\n\n" for k, v in props.items()) + "$$$$\n"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_sdf_file_in_several_tasks(spark, tmp_path, end):
    path = tmp_path / "in.sdf"
    records = [record(f"s{i}" if i % 7 else "", [atom("C", float(i % 50))] * (1 + i % 5), [], {"n": str(i), "note": "x $$$$ inside\nsecond"} if i % 3 else {}) for i in range(400)]
    text = "".join(records[:200]) + "$$$$\n" + "".join(records[200:])  # a blank record in between
    path.write_bytes(text.replace("\n", end).encode())
    (tmp_path / "other.sdf").write_bytes(records[0].replace("\n", end).encode().rstrip())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = molecular.read_sdf(spark, str(tmp_path / "*.sdf"))
        blocks = spark.read.text(str(path), lineSep="\n$$$$").select("_metadata.file_block_start").distinct().count()
        got = df.orderBy("file", "record_index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    mine = [r for r in got if r["file"].endswith("in.sdf")]
    assert blocks > 5 and len(got) == len(mine) + 1
    assert [(r["record_index"], r["title"], r["props"].get("n"), len(r["atoms"])) for r in mine] == [(i + 1, f"s{i}" if i % 7 else "", str(i) if i % 3 else None, 1 + i % 5) for i in range(400)]
    assert mine[1]["props"]["note"] == "x $$$$ inside\nsecond"


def test_parts_survive_an_end_between_write_and_commit(spark, tmp_path, monkeypatch):
    rows = spark.range(1, 11).selectExpr("cast(id as int) as i", "concat('p', id) as pose_id")
    worked = []

    def work(run):
        return lambda part: worked.append((run, part.agg(F.min("i"), F.max("i")).first()[:])) or part.withColumn("run", F.lit(run))

    def dies(self, entry):
        if entry["first"] == 7:
            raise KeyboardInterrupt
        return commit(self, entry)

    commit = committed.Parts.commit
    done = committed.Parts(spark, str(tmp_path / "parts"), "i")
    monkeypatch.setattr(committed.Parts, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        done.complete(rows, work("first"), 3)
    monkeypatch.undo()
    assert done.reached() == 6 and done.table().count() == 6
    out = committed.Parts(spark, str(tmp_path / "parts"), "i").complete(rows, work("second"), 3)
    assert sorted((r["i"], r["run"]) for r in out.collect()) == [(i, "first" if i <= 6 else "second") for i in range(1, 11)]
    assert worked == [("first", (1, 3)), ("first", (4, 6)), ("first", (7, 9)), ("second", (7, 9)), ("second", (10, 10))]
    assert len(done.sweep()) == 1 and done.sweep() == [] and done.table().count() == 10
    assert done.complete(rows, work("third"), 3).where("run = 'third'").count() == 0
    with pytest.raises(GateError, match="another run"):
        done.commit({"part": "x", "first": 4, "last": 6})
    with pytest.raises(GateError, match="unknown i and pose_id"):
        done.complete(rows.where("i < 5"), work("x"), 3)
    with pytest.raises(GateError, match="unknown i and pose_id"):
        done.complete(rows.withColumn("pose_id", F.lit("z")), work("x"), 3)
    other = committed.Parts(spark, str(tmp_path / "odd"), "i")
    with pytest.raises(GateError, match="are not 1 to 5"):
        other.complete(rows, lambda part: part.where("i <> 2"), 5)
    assert other.reached() == 0 and other.table() is None


def test_sdf_round_trip(spark, tmp_path):
    path = tmp_path / "in.sdf"
    path.write_text(record("s1", [atom("C", 0.0), atom("H", 1.0), atom("O", 2.0, 5)], [(1, 2, 1), (1, 3, 1)], {"state_id": "s1", "minimizedAffinity": "-7.25"}) + record("s2", [atom("C", 0.0)], [], {}))
    df = molecular.read_sdf(spark, str(path))
    rows = df.orderBy("record_index").collect()
    assert [(r["record_index"], r["title"], r["props"]) for r in rows] == [(1, "s1", {"state_id": "s1", "minimizedAffinity": "-7.25"}), (2, "s2", {})]
    assert [a["charge"] for a in rows[0]["atoms"]] == [0, 0, -1]
    graph = molecular.ligand_graph({k: [x.asDict() for x in rows[0][k]] for k in ("atoms", "bonds")})
    assert graph["x"] == [1, 3] and graph["edge_index"] == [[0, 1], [1, 0]] and graph["edge_attr"] == [0, 0]
    out = tmp_path / "out"
    sinks.write_sdf(df.withColumn("score", F.col("record_index") * 1.5), str(out), "molblock", ["score"], ["record_index"])
    again = molecular.read_sdf(spark, str(out)).collect()
    assert sorted((r["title"], r["props"]["score"]) for r in again) == [("s1", "1.5"), ("s2", "3.0")]
    with pytest.raises(ValueError, match="cut short|malformed"):
        molecular.parse_sdf_record("t\n\n\n  2  0  0\n" + atom("C", 0.0))


def test_bond_repairs():
    sulfoxide = {"atoms": [{"element": e, "charge": c} for e, c in (("S", 1), ("O", -1), ("C", 0), ("C", 0))], "bonds": [{"a": 0, "b": 1, "order": 2}, {"a": 0, "b": 2, "order": 1}, {"a": 0, "b": 3, "order": 1}]}
    fixed, repairs = molecular.repair_bonds(sulfoxide)
    assert repairs == ["charged_sulfoxide_double_to_single"] and fixed["bonds"][0]["order"] == 1
    ketone = {"atoms": [{"element": "C", "charge": 0}, {"element": "O", "charge": 0}], "bonds": [{"a": 0, "b": 1, "order": 2}]}
    assert molecular.repair_bonds(ketone) == (ketone, [])


PDB = (
    "ATOM      1  CA  ALA A  10      10.000  10.000  10.000  1.00  0.00           C\n"
    "ATOM      2  CB BALA A  10      11.000  10.000  10.000  1.00  0.00           C\n"
    "ATOM      3  HA  ALA A  10      12.000  10.000  10.000  1.00  0.00           H\n"
    "HETATM    4 ZN    ZN A 200      13.000  10.000  10.000  1.00  0.00\n"
    "HETATM    5  O   HOH B 300      14.000  10.000  10.000  1.00  0.00           O\n"
    "HETATM    6 1C1  LIG C 301      15.000  10.000  10.000  1.00  0.00\n"
)


def test_pdb_atoms(spark, tmp_path):
    path = tmp_path / "r.pdb"
    path.write_text(PDB)
    atoms = molecular.read_pdb_atoms(spark, str(path))
    got = [(r["element"], r["x"], r["chain"], r["resseq"], r["resname"], r["residue_type"]) for r in atoms.orderBy("ord").collect()]
    assert got == [("C", 10.0, "A", "10", "ALA", 0), ("Zn", 13.0, "A", "200", "ZN", 20), ("O", 14.0, "B", "300", "HOH", 20), ("C", 15.0, "C", "301", "LIG", 20)]
    assert molecular.pocket_atoms(atoms, "LIG").count() == 2
    assert [tuple(r) for r in molecular.residue_instances(atoms, "LIG").collect()] == [("C", "301", 1)]
    counts = {r["reason"]: r["count"] for r in molecular.receptor_subset(spark, str(path), ["A"], ["ZN"]).groupBy("reason").count().collect()}
    assert counts == {"included": 3, "removed_residue": 1, "other_chain": 2}


def test_affinity_index(spark, tmp_path):
    path = tmp_path / "INDEX"
    path.write_text("# note\n1ABC 2.0 2001 Kd=10uM // x\n2abc 2.0 2001 Ki<5nM // y\n3abc 2.0\n4abc 2.0 2001 IC50=2nM // z\n")
    rows = {r["complex_id"]: (round(r["pk"], 6), r["kind"]) for r in molecular.read_affinity_index(spark, str(path)).collect()}
    assert rows == {"1abc": (5.0, "KD"), "4abc": (8.69897, "IC50")}
    assert molecular.read_affinity_index(spark, str(path), ["kd"]).count() == 1


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 0.5)], "rank int, name string, v double")
    sinks.write_smi(df, str(tmp_path / "smi"), "name", "rank", "rank")
    assert [r[0] for r in spark.read.text(str(tmp_path / "smi")).collect()] == ["a 1", "b 2"]
    sinks.write_tsv(df, str(tmp_path / "tsv"), ["rank"])
    assert spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).count() == 2
    sinks.write_json(str(tmp_path / "x.json"), {"a": 1})
    (tmp_path / "new").write_text("new"), (tmp_path / "old").write_text("old")
    kept = sinks.install(str(tmp_path / "new"), str(tmp_path / "old"))
    assert (tmp_path / "old").read_text() == "new" and open(kept).read() == "old"


def docking_job(tmp_path, script):
    ligands, program = tmp_path / "in.sdf", tmp_path / "dock.sh"
    ligands.write_text(record("s1", [atom("C", 0.0)], [], {}))
    pose = tmp_path / "pose.sdf"
    pose.write_text(record("s1", [atom("C", 1.0)], [], {"minimizedAffinity": "-7.25"}))
    program.write_text(f"#!/bin/sh\n{script.format(pose=pose)}\n")
    program.chmod(0o755)
    job = {"chunk": 1, "ligands": str(ligands), "output": str(tmp_path / "out.sdf"), "log": str(tmp_path / "log"), "num_modes": 9, "signature": "s", "receptor": "r"}
    return job | {f"{a}_{b}": 1.0 for a in ("center", "size") for b in "xyz"} | {"cpu": 1, "exhaustiveness": 8, "seed": 3}, str(program)


def test_job_runs_once_and_failures_leave_results(spark, tmp_path):
    copy = 'while [ "$1" != --out ]; do shift; done; cp {pose} "$2"'
    job, program = docking_job(tmp_path, copy)
    command = lambda j, out, log: external.docking_command(program, j, out, log)
    run = lambda j: external.run_job(j, command, external.check_docking)
    assert run(job) == "completed" and run(job) == "skipped"
    (tmp_path / "out.sdf.done.json").unlink()
    assert run(job) == "recovered"
    before = (tmp_path / "out.sdf").read_bytes()
    (tmp_path / "dock.sh").write_text("#!/bin/sh\nexit 3\n")
    with pytest.raises(GateError, match="failed"):
        run(job | {"signature": "changed"})
    assert (tmp_path / "out.sdf").read_bytes() == before
    (tmp_path / "dock.sh").write_text("#!/bin/sh\nexit 0\n")
    with pytest.raises(GateError, match="no output"):
        run(job | {"signature": "changed"})


def test_jobs_as_tasks(spark, tmp_path):
    job, program = docking_job(tmp_path, 'while [ "$1" != --out ]; do shift; done; cp {pose} "$2"')
    df = spark.createDataFrame([{k: str(v) for k, v in job.items()}])
    out = external.run_jobs(df, lambda j, o, log: external.docking_command(program, j, o, log), external.check_docking, ["chunk"])
    assert [tuple(r) for r in out.collect()] == [("1", "completed")]


def test_ledger(spark):
    planned = jobs.signatures(spark.range(5).selectExpr("id", "id * 2 as x"))
    ledger = planned.selectExpr("id", "case when id = 0 then signature when id = 1 then null when id = 2 then 'old' else signature end as signature", "id <> 3 as valid").where("id < 4")
    got = {r["id"]: r["outcome"] for r in jobs.outcomes(planned, ledger, ["id"]).collect()}
    assert got == {0: "skipped", 1: "recovered", 2: "run", 3: "run", 4: "run"}
    assert sorted(r["id"] for r in jobs.outstanding(planned, ledger, ["id"]).collect()) == [2, 3, 4]


def test_pose_collection(spark):
    records = spark.createDataFrame([("p", "s2", 1, 1), ("p", "s1", 1, 2), ("p", "s1", 2, 1)], "protocol string, state string, file int, record int")
    got = jobs.rank_poses(records, "protocol", "state", ["file", "record"]).orderBy("ligand_record_index").collect()
    assert [(r["pose_id"], r["ligand_record_index"]) for r in got] == [("p|s2|1", 1), ("p|s1|1", 2), ("p|s1|2", 3)]
    scheduled = spark.createDataFrame([("p", "s1"), ("p", "s2"), ("p", "s3")], "protocol string, state string")
    with pytest.raises(GateError, match="state with a pose"):
        jobs.require_complete(records, scheduled, "protocol", "state", 9)
    with pytest.raises(GateError, match="scheduled state"):
        jobs.require_complete(records, scheduled.where("state = 's1'"), "protocol", "state", 9)
    with pytest.raises(GateError, match="more than 1"):
        jobs.require_complete(records, scheduled.where("state <> 's3'"), "protocol", "state", 1)
    jobs.require_complete(records, scheduled.where("state <> 's3'"), "protocol", "state", 2)


def test_conversion_and_prediction(spark):
    df = spark.createDataFrame([("k1", "CC"), ("k2", "CO")], "key string, smiles string")
    out = external.converted(df, "key", "smiles", ["sed", "s/C/c/g"], "changed").collect()
    assert {r["key"]: r["changed"] for r in out} == {"k1": "cc", "k2": "cO"}
    with pytest.raises(Exception, match="rows converted"):
        external.converted(df, "key", "smiles", ["head", "-n", "0"], "changed").collect()
    got = external.predicted(df, lambda: lambda pdf: pdf["smiles"].str.len() * 1.0, "p").collect()
    assert {r["p"] for r in got} == {2.0}
    with pytest.raises(Exception, match="not finite"):
        external.predicted(df, lambda: lambda pdf: [float("nan")] * len(pdf), "p").collect()


def test_resume_needs_a_prefix(spark):
    todo = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, pose_id string")
    assert [r["i"] for r in external.resumed(todo, todo.where("i < 3"), "i", "pose_id").collect()] == [3]
    with pytest.raises(GateError, match="contiguous 1-based prefix"):
        external.resumed(todo, todo.where("i = 2"), "i", "pose_id")
    with pytest.raises(GateError, match="unknown"):
        external.resumed(todo, todo.where("i = 1").withColumn("pose_id", F.lit("z")), "i", "pose_id")


def test_fetch_checks_before_installing(tmp_path):
    path, calls = str(tmp_path / "d" / "x.sdf"), []

    def read(url):
        calls.append(url)
        if len(calls) == 1:
            raise OSError("busy")
        return b"a\n>  <WHEN>\n2026\n\n>  <KEEP>\n1\n\n$$$$\n"

    clean = lambda data: fetch.without_properties(data, ["WHEN"])
    digest = fetch.fetch("u", path, read=read, clean=clean, pause=0)
    assert open(path, "rb").read() == b"a\n>  <KEEP>\n1\n\n$$$$\n" and len(calls) == 2
    assert fetch.fetch("u", path, digest, read=read) == digest and len(calls) == 2
    assert fetch.verify({"x.sdf": digest, "y": digest}, str(tmp_path / "d")) == {"x.sdf": True, "y": False}
    with pytest.raises(fetch.ChecksumError):
        fetch.fetch("u", str(tmp_path / "z"), "0" * 64, read=lambda url: b"other")
    assert not (tmp_path / "z").exists()
