import math

import pytest

from siftline.functions import scalars as S
from siftline.operators import gates, joining, ranking
from siftline.plans import final_score


def tables(spark, predictions, similarity=None, mutant="WT", parents=2):
    parent = spark.createDataFrame([(f"p{i}", f"id{i}" if i == 1 else "", "CCO", i, 0.7) for i in range(1, parents + 1)], "structure_key string, compound_id string, standardized_smiles string, row_ord int, qed double")
    poses = spark.createDataFrame([(k, f"p{i}", f"s{i}", "proto", mutant, score, i) for i, (k, score) in enumerate((("a", -8.0), ("b", -7.0)), start=1) if i <= parents], "pose_id string, parent_structure_key string, state_id string, protocol_id string, mutant_id string, smina_score double, pose_ord int")
    affinity = spark.createDataFrame(predictions, "pose_id string, predicted_paffinity double")
    side = spark.createDataFrame(similarity, "pose_id string, postdock_3d_status string, postdock_3d_similarity double") if similarity else None
    return parent, poses, affinity, side


def test_ranking_values_and_top_hit(spark):
    ranked = final_score.run(*tables(spark, [("a", 8.0), ("b", 6.0)]))
    rows = ranked.orderBy("rank").collect()
    sigma2 = 1 / (1 + math.exp(-2))
    assert [r["structure_key"] for r in rows] == ["p1", "p2"]
    assert rows[0]["integrated_score"] == pytest.approx(100 * (0.55 * sigma2 + 0.15 + 0.07))
    assert rows[1]["integrated_score"] == pytest.approx(34.5)
    hit = final_score.top_hits(ranked, 1).collect()
    assert [tuple(h) for h in hit] == [("id1", "CCO", 1, f"{rows[0]['integrated_score']:.8f}")]


def test_similarity_decides_between_equals(spark):
    got = final_score.run(*tables(spark, [("a", 7.0), ("b", 7.0)], [("a", "ok", 0.1), ("b", "ok", 0.9)])).orderBy("rank").collect()
    assert got[0]["postdock_3d_similarity"] == pytest.approx(0.9)
    assert got[0]["structure_key"] == "p2"


@pytest.mark.parametrize(
    "predictions, mutant, settings, message",
    [
        ([("a", 8.0), ("x", 6.0)], "WT", {}, "unknown pose_id"),
        ([("a", 8.0), ("a", 7.0)], "WT", {}, "duplicate affinity"),
        ([("a", 8.0), ("b", None)], "WT", {}, "blank predictions"),
        ([("a", 8.0)], "WT", {"pose_coverage": 0.5}, "parent coverage"),
        ([("a", 8.0)], "WT", {}, "pose coverage"),
        ([("a", 8.0), ("b", 6.0)], "M1", {}, "WT-only"),
        ([("a", 8.0), ("b", 6.0)], "WT", {"required": ("other",)}, "required protocols"),
    ],
)
def test_gates(spark, predictions, mutant, settings, message):
    with pytest.raises(gates.GateError, match=message):
        final_score.run(*tables(spark, predictions, mutant=mutant), final_score.Settings(**settings))


def test_coverage_boundary_passes(spark):
    df = spark.range(20).selectExpr("id", "id < 19 as hit")
    gates.require_coverage(df, df["hit"], 0.95, "x")
    with pytest.raises(gates.GateError):
        gates.require_coverage(df, df["hit"], 0.951, "x")


def test_percentile_shares_ties_and_single_rows(spark):
    df = spark.createDataFrame([("a", -3.0), ("a", -2.0), ("a", -2.0), ("a", -1.0), ("b", 5.0)], "g string, s double")
    got = sorted((r["g"], r["s"], r["p"]) for r in ranking.average_rank_percentile(df, ["g"], "s", "p").collect())
    assert got == [("a", -3.0, 1.0), ("a", -2.0, 0.5), ("a", -2.0, 0.5), ("a", -1.0, 0.0), ("b", 5.0, 1.0)]


def test_quotas():
    fractions = {"pnu_2d": 0.20, "pharm2d": 0.15, "scaffold_diversity": 0.45, "exploration": 0.20}
    assert ranking.largest_remainder(fractions, 14837) == {"pnu_2d": 2967, "pharm2d": 2226, "scaffold_diversity": 6677, "exploration": 2967}
    assert ranking.largest_remainder(fractions, 185163) == {"pnu_2d": 37033, "pharm2d": 27774, "scaffold_diversity": 83323, "exploration": 37033}
    assert ranking.largest_remainder({"a": 0.5, "b": 0.5}, 3) == {"a": 1, "b": 2}


def test_capped_take_is_the_greedy_walk(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [(i, f"g{rng.randrange(9)}", rng.random()) for i in range(200)]
    taken = {"g1": 2, "g2": 1}
    counts, walk = dict(taken), []
    for i, g, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        if counts.get(g, 0) < 3 and len(walk) < 15:
            counts[g] = counts.get(g, 0) + 1
            walk.append(i)
    df = spark.createDataFrame(rows, "id int, g string, s double")
    used = spark.createDataFrame(list(taken.items()), "g string, n int")
    got = ranking.capped_take(df, "g", [F.desc("s"), F.col("id")], 15, 3, used).orderBy("take_rank").collect()
    assert [r["id"] for r in got] == walk


def test_global_index_is_gapless(spark):
    df = spark.range(1000).selectExpr("id % 7 as a", "cast(id as string) as b")
    rows = ranking.global_index(df, ["a", "b"], "k").orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(1, 1001))
    assert [(r["a"], r["b"]) for r in rows] == sorted((r["a"], r["b"]) for r in rows)


def test_scalars(spark):
    import hashlib
    import zlib

    row = spark.range(1).select(
        S.stable_hash("id", 7).alias("h"), S.stable_hash_number("id", 7).alias("n"), S.scaled_affinity(S.F.lit(6.0)).alias("half"), S.scaled_affinity(S.F.lit(-1e9)).alias("low"),
        S.job_seed(S.F.lit("proto"), S.F.lit(3), 5).alias("seed"), S.state_origin(7.4, S.F.lit(True), S.F.lit(False)).alias("origin"), S.jaccard(S.F.array().cast("array<int>"), S.F.array().cast("array<int>")).alias("none"),
        S.blank_to_zero(S.F.lit(" ")).alias("zero"), S.lenient_flag(S.F.lit(" Yes ")).alias("yes"), S.first_property(S.F.create_map(S.F.lit("affinity"), S.F.lit("-7.25")), ["minimizedAffinity", "affinity"]).alias("aff"),
    ).first()
    digest = hashlib.sha256(b"7|0").digest()[:8]
    assert row["h"] == digest.hex() and int(row["n"]) == int.from_bytes(digest, "big")
    assert (row["half"], row["low"], row["none"], row["zero"], row["yes"], row["aff"]) == (0.5, 0.0, 0.0, 0.0, 1, -7.25)
    assert row["seed"] == (5 + zlib.crc32(b"proto") + 3) % 2147483647
    assert row["origin"] == "openbabel_pH_7.4;rdkit_canonical_tautomer"
    with pytest.raises(Exception, match="blank or no number"):
        spark.range(1).select(S.strict_number(S.F.lit(""), "x")).collect()


def test_fill_table(spark):
    template = spark.createDataFrame([("a", 1, "", "k1"), ("b", 2, "", "k2")], "pose_id string, ligand_record_index int, predicted_paffinity string, keep string")
    values = spark.createDataFrame([("a", 1, 5.25), ("b", 2, 6.5)], "pose_id string, ligand_record_index int, predicted_paffinity double")
    got = joining.fill_table(template, values, "ligand_record_index", "predicted_paffinity", "pose_id").orderBy("ligand_record_index").collect()
    assert [(r["predicted_paffinity"], r["keep"]) for r in got] == [("5.25000000", "k1"), ("6.50000000", "k2")]
    with pytest.raises(gates.GateError, match="disagree"):
        joining.fill_table(template, values.withColumn("pose_id", S.F.lit("z")), "ligand_record_index", "predicted_paffinity", "pose_id")
    with pytest.raises(gates.GateError, match="without a value"):
        joining.fill_table(template, values.where("pose_id = 'a'"), "ligand_record_index", "predicted_paffinity")
    with pytest.raises(gates.GateError, match="contiguous"):
        gates.require_contiguous(values.where("ligand_record_index = 2"), "ligand_record_index", "checkpoint")
