"""Scores of three-dimensional structures, with embedding and alignment as functions.

Both functions take and return a DataFrame. `embed` adds embed_error (null if it went well), embedding_method and
conformers, an array of struct(conformer_id int, molblock string). `align` gets a row per conformer or pose with molblock
and adds combined (negative if nothing could be aligned), feature, shape and clash or whatever else it names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.operators.gates import require_coverage, require_unique

Step = Callable[[DataFrame], DataFrame]
# Channels whose members are aligned to the reference; others are only embedded.
ALIGNED = ("pnu_2d", "pharm2d")


def penalised(combined: Column, clash: Column) -> Column:
    """A similarity less what its clashes cost; failures (negative) stay."""
    return F.when(combined < 0, combined).otherwise(combined * F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(0.80) * clash))


def best_conformers(scored: DataFrame, key: str) -> DataFrame:
    """key, best: the conformer of highest score, the first of equals, by partial aggregation."""
    values = F.struct("score", "feature", "shape", "clash", "conformer_id")
    return scored.groupBy(key).agg(F.max_by(values, F.struct("score", -F.col("place"))).alias("best"))


def structure_scores(parents: DataFrame, embed: Step, align: Step, key: str = "structure_key", channel: str = "prescreen_channel", aligned: Sequence[str] = ALIGNED) -> DataFrame:
    """All columns of parents and structure3d_status, _score, _feature_score, _shape_similarity, _clash_fraction,
    _best_conformer, _conformer_count and _embedding_method.

    Statuses: invalid_smiles and embed_error:<type> as `embed` says, embed_failed without conformers, feasible_only for
    channels that are not aligned (scores 0, first conformer), then ok or alignment_failed by the best conformer.
    """
    done = embed(parents)
    n = F.coalesce(F.size("conformers"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    usable = F.col("embed_error").isNull() & (n > 0)
    wanted = F.coalesce(F.col(channel).isin(*aligned), F.lit(False))
    each = done.where(usable & wanted).select(key, F.posexplode("conformers").alias("place", "c")).select(key, "place", F.col("c.conformer_id").alias("conformer_id"), F.col("c.molblock").alias("molblock"))
    scored = align(each).withColumn("score", penalised(F.col("combined"), F.col("clash")))
    rows = done.join(best_conformers(scored, key), key, "left")
    status = F.when(F.col("embed_error").isNotNull(), F.col("embed_error")).when(n == 0, "embed_failed").when(~wanted, "feasible_only").when(F.col("best.score") >= 0, "ok").otherwise("alignment_failed")
    number = lambda c: F.when(usable, F.coalesce(F.when(wanted, c), F.lit(0.0)))
    first = F.element_at(F.col("conformers.conformer_id"), 1)
    return rows.select(
        *parents.columns, status.alias("structure3d_status"), number(F.greatest(F.col("best.score"), F.lit(0.0))).alias("structure3d_score"),
        number(F.col("best.feature")).alias("structure3d_feature_score"), number(F.col("best.shape")).alias("structure3d_shape_similarity"), number(F.col("best.clash")).alias("structure3d_clash_fraction"),
        F.when(usable, F.when(wanted, F.col("best.conformer_id")).otherwise(first)).alias("structure3d_best_conformer"), F.when(usable, n).alias("structure3d_conformer_count"),
        F.col("embedding_method").alias("structure3d_embedding_method"),
    )


def pose_similarities(poses: DataFrame, align: Step, least: float | None = None) -> DataFrame:
    """pose_id, postdock_3d_status, postdock_3d_similarity and the scores that `align` adds (feature, shape, o3a), 0 where
    a pose has no readable structure. Pose ids are unique; with `least`, that share of poses must be ok."""
    require_unique(poses, ["pose_id"], "pose_id")
    scored = align(poses.where("molblock is not null").select("pose_id", "molblock"))
    rows = poses.select("pose_id").join(scored.select("pose_id", "combined", "feature", "shape", "o3a"), "pose_id", "left")
    status = F.when(F.col("combined").isNull(), "invalid_pose").when(F.col("combined") >= 0, "ok").otherwise("alignment_failed")
    value = lambda c, name: F.coalesce(F.col(c), F.lit(0.0)).alias(name)
    out = rows.select(
        "pose_id", status.alias("postdock_3d_status"), F.greatest(F.coalesce("combined", F.lit(0.0)), F.lit(0.0)).alias("postdock_3d_similarity"),
        value("feature", "postdock_3d_feature_score"), value("shape", "postdock_3d_shape_similarity"), value("o3a", "postdock_o3a_score"),
    )
    return out if least is None else require_coverage(out, F.col("postdock_3d_status") == "ok", least, "post-docking similarity")
