"""The flagship plan: evidence tables to an integrated, stable ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.scalars import or_aggregate, percent_score, scaled_affinity
from siftline.operators.gates import GateError, require_coverage, require_none, require_subset, require_unique
from siftline.operators.ranking import best_values, global_index, rank_percentiles, top_n, with_percentiles

# Components of the integrated score and their weights.
WEIGHTS = {"wt_affinity": 0.55, "postdock_3d_similarity": 0.20, "docking_consensus": 0.15, "qed": 0.10}


@dataclass(frozen=True)
class Settings:
    midpoint: float = 6.0
    scale: float = 1.0
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    excluded: Sequence[str] = ()
    required: Sequence[str] = ()
    pose_coverage: float = 0.95
    parent_coverage: float = 0.95
    similarity_coverage: float = 0.95
    reference_variant: str = "WT"


def check(parents: DataFrame, poses: DataFrame, affinity: DataFrame, similarity: DataFrame | None, s: Settings) -> None:
    """Every reason not to rank, in the order in which they are looked for."""
    require_unique(parents, ["structure_key"], "structure_key")
    require_unique(poses, ["pose_id"], "pose_id")
    require_none(poses, F.col("mutant_id") != s.reference_variant, f"not {s.reference_variant}-only")
    require_subset(poses.select(F.col("parent_structure_key").alias("structure_key")), parents, ["structure_key"], "structure_key")
    require_unique(affinity, ["pose_id"], "affinity pose_id")
    require_subset(affinity, poses, ["pose_id"], "pose_id")
    require_none(affinity, F.col("predicted_paffinity").isNull(), "blank predictions")
    used = poses.where(~F.col("protocol_id").isin(*s.excluded)) if s.excluded else poses
    states = used.groupBy("parent_structure_key").agg(F.count_distinct("state_id").alias("n"))
    require_none(states, F.col("n") != 1, "parents with several states")
    covered = used.join(affinity.select("pose_id", F.lit(True).alias("_hit")), "pose_id", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    require_coverage(covered, F.col("_hit"), s.pose_coverage, "pose")
    by_parent = covered.groupBy("parent_structure_key").agg(F.max("_hit").alias("_hit"))
    require_coverage(by_parent, F.col("_hit"), s.parent_coverage, "parent")
    if similarity is not None:
        require_unique(similarity, ["pose_id"], "similarity pose_id")
        require_subset(similarity, poses, ["pose_id"], "similarity pose_id")
        usable = used.join(similarity.select("pose_id", (F.col("postdock_3d_status") == "ok").alias("_ok")), "pose_id", "left")
        require_coverage(usable, F.coalesce(F.col("_ok"), F.lit(False)), s.similarity_coverage, "similarity")
    if s.required:
        have = {r[0] for r in used.select("protocol_id").where(F.col("protocol_id").isin(*s.required)).distinct().collect()}
        if missing := sorted(set(s.required) - have):
            raise GateError(f"required protocols without poses: {missing}")


def with_evidence(poses: DataFrame, affinity: DataFrame, similarity: DataFrame | None) -> DataFrame:
    """The poses that have a prediction, with predicted_paffinity and postdock_3d_similarity (null unless its status is ok)."""
    matched = poses.join(affinity.select("pose_id", "predicted_paffinity"), "pose_id")
    if similarity is None:
        return matched.withColumn("postdock_3d_similarity", F.lit(None).cast("double"))
    side = similarity.select("pose_id", F.when(F.col("postdock_3d_status") == "ok", F.col("postdock_3d_similarity")).alias("postdock_3d_similarity"))
    return matched.join(side, "pose_id", "left")


def best_per_parent(poses: DataFrame, matched: DataFrame, s: Settings, order: Sequence[str]) -> DataFrame:
    """Per parent: wt_affinity, docking_consensus, postdock_3d_similarity, protocol and pose counts. `matched` are poses
    with their evidence, as `with_evidence` gives them.

    Percentiles are over all poses of a protocol. Per parent and protocol one pose counts, the first of highest affinity
    evidence in pose order, for all three kinds of evidence; only these look up the percentile of their score.
    """
    evidence = scaled_affinity("predicted_paffinity", s.midpoint, s.scale).alias("evidence")
    keys = ["parent_structure_key", "protocol_id"]
    matched = matched.select(*keys, "smina_score", evidence, F.coalesce("postdock_3d_similarity", F.lit(0.0)).alias("similarity"), *order)
    first = best_values(matched, keys, [-F.col("evidence"), *[F.col(o) for o in order]], ["evidence", "smina_score", "similarity"], F.count("*").alias("_poses"))
    percentiles = rank_percentiles(poses, ["protocol_id"], "smina_score", "docking_percentile")
    best = with_percentiles(first, percentiles, ["protocol_id"], "smina_score", "docking_percentile")
    totals = [or_aggregate("evidence").alias("wt_affinity"), or_aggregate("docking_percentile").alias("docking_consensus"), or_aggregate("similarity").alias("postdock_3d_similarity")]
    return best.groupBy("parent_structure_key").agg(*totals, F.count("*").alias("wt_protocol_count"), F.sum("_poses").alias("affinity_pose_count"))


def per_parent(poses: DataFrame, affinity: DataFrame, similarity: DataFrame | None, s: Settings, order: Sequence[str]) -> DataFrame:
    """`best_per_parent` of poses without the excluded protocols and their evidence."""
    used = poses.where(~F.col("protocol_id").isin(*s.excluded)) if s.excluded else poses
    return best_per_parent(used, with_evidence(used, affinity, similarity), s, order)


def integrated(parents: DataFrame, evidence: DataFrame, s: Settings) -> DataFrame:
    """Parents that have evidence, with integrated_score."""
    joined = parents.join(evidence.withColumnRenamed("parent_structure_key", "structure_key"), "structure_key")
    return joined.withColumn("integrated_score", percent_score(s.weights))


def ranked_parents(scored: DataFrame, tie: Sequence[str], limit: int | None = None) -> DataFrame:
    """Ranks by score, then affinity, then the parents' own order. With a limit, only the top rows."""
    if limit is not None:
        return top_n(scored, [F.desc("integrated_score"), F.desc("wt_affinity"), *[F.col(t) for t in tie]], limit)
    falling = scored.withColumns({"_score": -F.col("integrated_score"), "_affinity": -F.col("wt_affinity")})
    return global_index(falling, ["_score", "_affinity", *tie], "rank").drop("_score", "_affinity")


def top_hits(ranked: DataFrame, n: int) -> DataFrame:
    """hit_id, SMILES, Rank, score of the first n. A missing structure is an error."""
    smiles = F.nullif(F.col("standardized_smiles"), F.lit(""))
    smiles = F.when(smiles.isNotNull(), smiles).otherwise(F.raise_error("a hit has no SMILES").cast("string"))
    hit = F.coalesce(F.nullif(F.col("compound_id").cast("string"), F.lit("")), F.col("structure_key").cast("string"))
    return ranked.where(F.col("rank") <= n).select(hit.alias("hit_id"), smiles.alias("SMILES"), F.col("rank").alias("Rank"), F.format_string("%.8f", "integrated_score").alias("score"))


def run(parents: DataFrame, poses: DataFrame, affinity: DataFrame, similarity: DataFrame | None, s: Settings = Settings(), pose_order: Sequence[str] = ("pose_ord",), parent_order: Sequence[str] = ("row_ord",)) -> DataFrame:
    check(parents, poses, affinity, similarity, s)
    return ranked_parents(integrated(parents, per_parent(poses, affinity, similarity, s, pose_order), s), parent_order)
