import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.functions import chemistry as chem
from siftline.operators import geometry, standardize


@pytest.mark.parametrize(
    "smiles, status, kind",
    [
        ("CC(=O)Oc1ccccc1C(=O)O.[Cl-]", "valid_parent", "simple_salt_or_solvate"),
        ("c1ccccc1.Cc1ccccc1", "quarantine_ambiguous_components", "ambiguous_multi_component"),
        ("CC(=O)[O-].[Na+]", "valid_parent", "simple_salt_or_solvate"),
        ("C[Mg]Br", "quarantine_special_element", "metal_or_special"),
        ("C[N+](C)(C)CCc1ccccc1.[Cl-]", "valid_parent", "simple_salt_or_solvate"),
        ("CCO", "valid_parent", "single_component"),
        ("NCCc1ccccc1.OC(=O)c1ccccc1", "valid_parent", "organic_counterion_salt"),
        ("O", "quarantine_no_organic_parent", "no_organic_parent"),
        ("C[Se]C", "quarantine_special_element", "single_component"),
        ("", "empty_smiles", ""),
        ("C(", "invalid_smiles", ""),
    ],
)
def test_status_machine(smiles, status, kind):
    got = standardize.standardize_one(smiles, standardize._listed())
    assert (got["status"], got["component_class"]) == (status, kind)
    if status == "valid_parent":
        assert "." not in got["standardized_smiles"] and got["model_eligible"] == 1
    if smiles.startswith("C[N+]"):
        assert got["formal_charge"] == 1 and got["has_permanent_charge"] == 1


def test_identity_does_not_depend_on_spelling():
    for spellings in (["OC(=O)c1ccccc1OC(C)=O", "CC(=O)Oc1ccccc1C(=O)O"], ["C1CCCCC1N", "NC1CCCCC1"], ["c1cc[nH]c1", "[nH]1cccc1"]):
        assert len({chem.write(chem.parse(s)) for s in spellings}) == 1
    for s in ("C1CC2CCC1CC2", "C[N+](C)(C)C", "N#Cc1ccccc1/C=C/C", "[13CH4]", "OS(=O)(=O)c1ccc(Cl)cc1"):
        assert chem.write(chem.parse(chem.write(chem.parse(s)))) == chem.write(chem.parse(s))


def test_counts_and_scaffold():
    p = chem.properties(chem.parse("CC(=O)Oc1ccccc1C(=O)O"))
    assert (p["heavy_atoms"], p["ring_count"], p["rotatable_bonds"], p["hbd"], p["hba"]) == (13, 1, 3, 1, 4)
    assert p["mw"] == pytest.approx(180.159, abs=0.01)
    assert chem.scaffold(chem.parse("Cc1ccc(CCN2CCOCC2)cc1")) == chem.scaffold(chem.parse("Oc1cccc(CCN2CCOCC2)c1")) != ""
    assert chem.scaffold(chem.parse("CCO")) == ""


def test_standardize_table(spark):
    df = spark.createDataFrame([(1, "CCO"), (2, None), (3, "CC(=O)[O-].[Na+]")], "id int, original_smiles string")
    got = {r["id"]: (r["status"], r["removed_component_smiles"]) for r in standardize.standardize(df).collect()}
    assert got == {1: ("valid_parent", ""), 2: ("empty_smiles", ""), 3: ("valid_parent", "[Na+]")}
    def broken(smiles, listed):
        raise KeyError(smiles)

    assert {r["status"] for r in standardize.standardize(df, kernel=broken).collect()} == {"standardization_error:KeyError"}


def test_fragment_status_in_sql(spark):
    part = lambda carbon, metal, known: (carbon, metal, known)
    cases = [[part(True, False, True)], [part(True, False, False), part(False, False, True)], [part(True, False, False)] * 2, [part(True, True, False)], [part(True, False, False), part(True, False, True)], [part(False, False, True)]]
    df = spark.createDataFrame([(i, [(f"s{j}", *p) for j, p in enumerate(ps)]) for i, ps in enumerate(cases)], "id int, parts array<struct<smiles:string,has_carbon:boolean,has_metal:boolean,known_counterion:boolean>>")
    got = [tuple(r["s"]) for r in df.select("id", standardize.fragment_status(F.col("parts")).alias("s")).orderBy("id").collect()]
    assert got == [("valid_parent", "single_component", 1), ("valid_parent", "simple_salt_or_solvate", 1), ("quarantine_ambiguous_components", "ambiguous_multi_component", None), ("quarantine_special_element", "metal_or_special", None), ("valid_parent", "organic_counterion_salt", 1), ("quarantine_no_organic_parent", "no_organic_parent", None)]


def test_scores_against_a_reference(spark):
    reference = chem.circular_bits(chem.parse("CCOc1ccccc1"))
    df = spark.createDataFrame([("k1", "CCOc1ccccc1"), ("k2", "CCCC"), ("k3", "x")], "structure_key string, smiles string")
    rows = {r["structure_key"]: r for r in standardize.score_structures(df, "smiles", "structure_key", reference).collect()}
    assert set(rows) == {"k1", "k2"} and rows["k1"]["similarity"] == 1.0 and rows["k2"]["similarity"] < 0.5
    assert rows["k2"]["murcko_scaffold"] == "ACYCLIC:k2"


def test_feature_matching_prefers_larger_indexes_on_ties():
    reference = [{"family": "Donor", "position": (0, 0, 0), "tolerance": 1.0, "weight": 1.0}, {"family": "Donor", "position": (0, 0, 0), "tolerance": 1.0, "weight": 3.0}]
    one = [{"family": "Donor", "position": (1, 0, 0)}]
    assert geometry.match_features(reference, one) == pytest.approx(3 * math.exp(-0.5) / 4)
    assert geometry.match_features([], one) == 0.0
    assert geometry.match_features(reference, [{"family": "Acceptor", "position": (0, 0, 0)}]) == 0.0


def test_radius_is_inclusive_and_clash_is_not(spark):
    a = spark.createDataFrame([("g", 1, 0.0, 0.0, 0.0)], "g string, i int, x double, y double, z double")
    b = spark.createDataFrame([("g", 7, 1.25, 0.0, 0.0), ("h", 8, 0.0, 0.0, 0.0)], "g string, j int, x double, y double, z double")
    assert geometry.radius_pairs(a, b, "g", "i", "j", ["x", "y", "z"], 1.25).count() == 1
    assert geometry.clash_fraction(a, b, "g", "i", ["x", "y", "z"], 1.25).first()["clash"] == 0.0
    assert geometry.clash_fraction(a, b, "g", "i", ["x", "y", "z"], 1.26).first()["clash"] == 1.0


def test_radius_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    p, q = rng.normal(size=(60, 3)) * 2, rng.normal(size=(80, 3)) * 2
    frame = lambda x, name: spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(x)], f"g string, {name} int, x double, y double, z double")
    got = {(r["i"], r["j"]) for r in geometry.radius_pairs(frame(p, "i"), frame(q, "j"), "g", "i", "j", ["x", "y", "z"], 1.0).collect()}
    d = np.linalg.norm(p[:, None] - q[None], axis=2)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(d <= 1.0)), strict=True))


def test_neighbours_flag_the_only_far_one_and_bound_pairs(spark):
    a = spark.createDataFrame([("g", 1, 0.0, 0.0, 0.0), ("g", 2, 50.0, 0.0, 0.0)], "g string, i int, x double, y double, z double")
    b = spark.createDataFrame([("g", j, float(j), 0.0, 0.0) for j in range(1, 5)], "g string, j int, x double, y double, z double")
    got = sorted((r["i"], r["j"], r["valid"]) for r in geometry.neighbours(a, b, "g", "i", "j", ["x", "y", "z"], 2.5, 8, 100).collect())
    assert got == [(1, 1, True), (1, 2, True), (2, 4, False)]
    assert sorted((r["i"], r["j"]) for r in geometry.neighbours(a, b, "g", "i", "j", ["x", "y", "z"], 2.5, 8, 2).collect()) == [(1, 1), (1, 2)]


def plain_neighbours(a, b, cutoff, k, most):
    out = []
    for g in {p[0] for p in a} & {q[0] for q in b}:
        mine = []
        for _, i, *x in sorted(p for p in a if p[0] == g):
            d = sorted((math.dist(x, q[2:]), q[1]) for q in b if q[0] == g)
            near = [(e, j, True) for e, j in d if e < cutoff][:k] or [(*d[0], False)]
            mine += [(not valid, e, i, j) for e, j, valid in near]
        out += [(g, i, j, round(e, 9), not far) for far, e, i, j in sorted(mine)[:most]]
    return sorted(out)


@pytest.mark.parametrize("most", [10**6, 40])
def test_neighbours_equal_brute_force(spark, most):
    rng = np.random.default_rng(5)
    frame = lambda rows, name: spark.createDataFrame(rows, f"g string, {name} int, x double, y double, z double").repartition(4)
    cloud = lambda g, n, at, size, first: [(g, first + i, *map(float, at + rng.normal(size=3) * size)) for i in range(n)]
    a = cloud("hot", 120, np.zeros(3), 3, 0) + cloud("hot", 30, np.array([90.0, -40, 5]), 9, 500) + cloud("b", 5, np.zeros(3), 1, 0) + cloud("left only", 3, np.zeros(3), 1, 0)
    b = cloud("hot", 150, np.ones(3), 4, 0) + cloud("hot", 4, np.array([-300.0, 0, 0]), 1, 900) + cloud("b", 1, np.ones(3) * 50, 1, 0) + cloud("right only", 3, np.zeros(3), 1, 0)
    b += [("hot", 2000 + i, *b[i][2:]) for i in range(20)]  # ties
    got = geometry.neighbours(frame(a, "i"), frame(b, "j"), "g", "i", "j", ["x", "y", "z"], 1.5, 4, most)
    assert sorted((r["g"], r["i"], r["j"], round(r["distance"], 9), r["valid"]) for r in got.collect()) == plain_neighbours(a, b, 1.5, 4, most)


@pytest.mark.parametrize("repeated", [False, True])
def test_radius_graph_equals_brute_force(spark, repeated):
    rng = np.random.default_rng(8)
    cloud = lambda g, n, at, size, first: [(g, first + i, *map(float, at + rng.normal(size=3) * size)) for i in range(n)]
    rows = cloud("hot", 250, np.zeros(3), 1, 0) + cloud("hot", 60, np.array([1.0, 0, 0]), 1e-3, 1000) + cloud("b", 3, np.zeros(3), 1, 0)
    rows += [("hot", 2000 + i, *rows[i % 7][2:]) for i in range(60)] + [("edge", i, 0.8 * i, -0.0, 0.0) for i in range(12)] + [("one", 1, 0.0, 0.0, 0.0)]
    rows += [("b", 50, None, 0.0, 0.0), ("b", 51, float("nan"), 0.0, 0.0), ("b", None, 0.0, 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0)]
    rows += [("b", 0, 0.1, 0.0, 0.0), ("b", 1, *rows[311][2:])] if repeated else []
    want = []
    for g, i in sorted({r[:2] for r in rows if None not in r[:2]}):
        here = [q for q in rows if q[0] == g and q[1] is not None and q[2] is not None and q[2] == q[2]]
        d = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(p[2:], q[2:], strict=True))), q[1]) for p in here if p[1] == i for q in here if q[1] != i)
        want += [(g, i, j, round(e, 12)) for e, j in [x for x in d if x[0] <= 0.8][:4]]
    frame = spark.createDataFrame(rows, "g string, i int, x double, y double, z double").repartition(4)
    got = geometry.radius_graph(frame, "g", "i", ["x", "y", "z"], 0.8, 4)
    assert got.columns == ["g", "i", "neighbour", "distance"]
    assert sorted((r["g"], r["i"], r["neighbour"], round(r["distance"], 12)) for r in got.collect()) == sorted(want)


def test_radius_graph_does_not_make_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    n = 3000
    frame = spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(rng.normal(size=(n, 3)))], "g string, i int, x double, y double, z double")
    monkeypatch.setattr(geometry, "radius_pairs", None)  # 9,000,000 pairs at this cutoff
    assert geometry.radius_graph(frame, "g", "i", ["x", "y", "z"], 100.0, 4).count() == 4 * n


def test_neighbours_without_points(spark):
    a = spark.createDataFrame([("g", 1, 0.0, 0.0, 0.0), ("g", 2, None, 0.0, 0.0)], "g string, i int, x double, y double, z double")
    b = a.withColumnRenamed("i", "j")
    args = "g", "i", "j", ["x", "y", "z"], 1.5, 4, 10
    assert geometry.neighbours(a, b.limit(0), *args).count() == geometry.neighbours(a.limit(0), b, *args).count() == 0
    assert geometry.neighbours(a, b, *args).count() == 1


def test_a_hot_group_of_neighbours_is_spread(spark):
    points = spark.range(3000).select(F.lit("g").alias("g"), F.col("id").alias("i"), *[(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 50.0).alias(c) for s, c in enumerate("xyz")])
    pairs = geometry.radius_pairs(points, points.withColumnRenamed("i", "j"), "g", "i", "j", ["x", "y", "z"], 1.0)
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_feature_scores_equal_the_plain_matching(spark):
    rng = np.random.default_rng(6)
    reference = [{"family": f, "position": tuple(map(float, rng.normal(size=3))), "tolerance": float(t), "weight": float(w)} for f, t, w in (("Donor", 1.5, 1), ("Donor", 1.5, 2), ("Donor", 2.0, 0.5), ("Acceptor", 1.0, 1), ("Aromatic", 2.2, 0.8))]
    reference.append(dict(reference[0], weight=0.7))  # equal places: the larger index comes first
    rows = [(f"g{i % 9}", str(rng.choice(["Donor", "Acceptor", "Other"])), *map(float, rng.normal(size=3)), i) for i in range(200)]
    rows += [("g1", "Donor", *rows[1][2:5], 900 + i) for i in range(4)] + [("none", "Other", 0.0, 0.0, 0.0, 1), ("null", None, 0.0, 0.0, 0.0, 2), ("null", "Donor", None, 0.0, 0.0, 3)]
    df = spark.createDataFrame(rows, "g string, family string, x double, y double, z double, ord int").repartition(3)
    got = {r["g"]: r["feature_score"] for r in geometry.feature_scores(df, reference, "g").collect()}
    for g in {r[0] for r in rows}:
        own = [{"family": r[1], "position": r[2:5]} for r in sorted(rows, key=lambda r: r[5]) if r[0] == g and None not in r]
        assert got[g] == pytest.approx(geometry.match_features(reference, own)), g
    assert {r["feature_score"] for r in geometry.feature_scores(df, [], "g").collect()} == {0.0}


def test_contact_features_and_penalties(spark):
    features = spark.createDataFrame([("Donor", 0.0, 0.0, 0.0), ("Donor", 9.0, 0.0, 0.0), ("Aromatic", 0.0, 5.0, 0.0)], "family string, x double, y double, z double")
    pocket = spark.createDataFrame([(0.0, 0.0, 4.2), (0.0, 5.0, 5.5)], "x double, y double, z double")
    got = geometry.contact_features(features, pocket, ["x", "y", "z"], {"Donor": 4.2, "Aromatic": 5.5}, {"Donor": 1.8, "Aromatic": 2.2}, {"Donor": 1.0, "Aromatic": 0.8}).collect()
    assert sorted((r["family"], r["x"], r["tolerance"], r["weight"]) for r in got) == [("Aromatic", 0.0, 2.2, 0.8), ("Donor", 0.0, 1.8, 1.0)]
    row = spark.createDataFrame([(0.8, 0.5)], "s double, c double").select(geometry.clash_penalty("s", "c").alias("p"), geometry.combined_similarity("s", "c").alias("m")).first()
    assert row["p"] == pytest.approx(0.48) and row["m"] == pytest.approx(0.68)
    assert geometry.coordinates([1, 2, 3, 4, 5, 6]).shape == (2, 3) and geometry.coordinates([1, 2]) is None and geometry.coordinates("x") is None
