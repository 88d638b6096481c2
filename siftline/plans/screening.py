"""The preparation stages in order, each from tables to a table: raw records, standardized parents, scores, pool,
selection, states, jobs. What needs outside programs or a full toolkit comes in as functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import chemistry as chem
from siftline.functions import scalars as S
from siftline.operators import dedupe, filters, jobs, ranking, selection, standardize
from siftline.operators.gates import require_none, require_unique
from siftline.sources import tabular

ORDER = ["source_index", "_row"]
ACTIVE = "activity_recorded"
# Weights of similarity kinds in the consensus, and of consensus and quality in the evidence.
CONSENSUS = {"pnu_ecfp_similarity": 0.55, "pnu_fcfp_similarity": 0.20, "pharm2d_similarity": 0.25}
EVIDENCE = {"pnu_consensus": 0.65, "quality_score": 0.35}


def sampled(raw: DataFrame, active: int, candidates: int, seed: int) -> DataFrame:
    """A hash sample: so many active records, and candidates dealt evenly to their files."""
    raw = raw.withColumn("_sample_key", F.concat_ws("|", "source_file", "source_row", "original_smiles")).withColumn("_tie", F.concat_ws("|", "source_file", "source_row"))
    a = ranking.bottom_k(raw.where(F.col("source_pool") == ACTIVE), "_sample_key", seed, active, "_tie")
    b = ranking.stratified_bottom_k(raw.where(F.col("source_pool") != ACTIVE), "source_file", "_sample_key", seed, candidates, "_tie")
    return a.unionByName(b.select(*a.columns)).drop("_sample_key", "_tie")


def mapping(raw: DataFrame, kernel: Callable = standardize.standardize_one) -> DataFrame:
    """A row per raw record: its status, keys, what became of it as a duplicate, and whether an active record before it
    has the same structure or the same connectivity."""
    rows = standardize.standardize(raw, kernel=kernel).withColumn("_row", F.col("source_row").cast("long"))
    eligible = (F.col("status") == "valid_parent") & (F.col("model_eligible") == 1)
    out = dedupe.first_wins(rows, "structure_key", ORDER, eligible, "source_pool", ACTIVE).withColumnRenamed("resolved_pool", "resolved_source_pool")
    is_active = (F.col("source_pool") == ACTIVE) & eligible
    for key, flag in (("structure_key", "active_exact_overlap"), ("connectivity_key", "active_connectivity_overlap")):
        out = dedupe.running_overlap(out, key, ORDER, is_active, flag)
    return out


def parents(mapped: DataFrame) -> DataFrame:
    """Unique parents with row_ord, their order over all sources."""
    kept = mapped.where("dedup_status = 'unique_parent'")
    columns = ["compound_id", "standardized_smiles", "charged_parent_smiles", "structure_key", "connectivity_key", "source_pool", "source_file", "source_row", "component_class", "has_permanent_charge", "active_connectivity_overlap"]
    return ranking.global_index(kept.select(*columns, *ORDER), ORDER, "row_ord").select(*columns, "row_ord")


def scored2d(parent_rows: DataFrame, reference: str, describe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Counts, hard filter, similarity, consensus, quality and evidence. `describe` adds what a toolkit computes (clogp,
    tpsa, qed, alerts, other similarities); without it those are null, which no bound rejects, or 0."""
    bits = chem.circular_bits(chem.parse(reference))
    out = standardize.score_structures(parent_rows, "standardized_smiles", "structure_key", bits).withColumnRenamed("similarity", "pnu_ecfp_similarity")
    out = describe(out) if describe else out
    for name, default in (("clogp", None), ("tpsa", None), ("qed", 0.0), ("pains_alert", ""), ("brenk_alert", ""), ("pnu_fcfp_similarity", 0.0), ("pharm2d_similarity", 0.0)):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(default).cast("string" if default == "" else "double"))
    out = filters.hard_filter(out).withColumn("soft_alert_count", S.alert_count("pains_alert", "brenk_alert"))
    out = out.withColumn("pnu_consensus", S.weighted_sum(CONSENSUS)).withColumn("quality_score", S.quality_score("qed", "soft_alert_count"))
    return out.withColumn("library_evidence_score", S.weighted_sum(EVIDENCE))


def states(selected: DataFrame, embed: Callable[[DataFrame], DataFrame], ph: float | None = None) -> tuple[DataFrame, DataFrame]:
    """One state per selected parent, and those that did not embed. `embed` adds embed_status, embedding_method and
    molblock to state_id, state_smiles and embed_seed."""
    rows = selected.select(F.col("structure_key").alias("parent_structure_key"), "compound_id", "source_pool", "selection_channel", S.state_id("structure_key").alias("state_id"), F.lit(1).alias("state_rank"), F.col("standardized_smiles").alias("state_smiles"), S.state_origin(ph, F.lit(True), F.col("standardized_smiles").contains("@")).alias("state_origin"), S.embed_seed("structure_key", 1).alias("embed_seed"))
    done = embed(rows)
    require_unique(done, ["parent_structure_key"], "state of parent")
    good = F.col("embed_status").startswith("ok")
    return done.where(good), done.where(~good)


def job_table(state_rows: DataFrame, protocols: list[dict], chunk_size: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Jobs (a row per protocol and chunk, with box and effort) and which state is in which chunk."""
    parts = None
    for p in protocols:
        if not p.get("enabled"):
            continue
        scope = p["scope"]
        rows = filters.in_scope(state_rows, "selection_channel", scope["selection_channels"], "parent_structure_key", ["state_id"], int(scope.get("max_parents", 0)))
        box = dict(zip(("center_x", "center_y", "center_z", "size_x", "size_y", "size_z"), [*p["box"]["center"], *p["box"]["size"]], strict=True))
        fixed = {"protocol_id": p["protocol_id"], "receptor_id": p["receptor_id"], "box_id": p["box_id"], "mutant_id": p.get("mutant_id", "WT"), "exhaustiveness": int(p["exhaustiveness"]), "num_modes": int(p["num_modes"])} | {k: float(v) for k, v in box.items()}
        rows = rows.select("state_id", "parent_structure_key", *[F.lit(v).alias(k) for k, v in fixed.items()])
        parts = rows if parts is None else parts.unionByName(rows)
    if parts is None:
        raise ValueError("no protocol is enabled")
    chunked = ranking.chunk_numbers(parts, ["protocol_id"], [F.col("state_id")], chunk_size)
    keys = [c for c in chunked.columns if c not in ("state_id", "parent_structure_key")]
    table = chunked.groupBy(*keys).agg(F.count("*").alias("states")).withColumn("seed", S.job_seed("protocol_id", "chunk", seed))
    return table, chunked.select("protocol_id", "chunk", "state_id", "parent_structure_key")


def collected(records: DataFrame, state_rows: DataFrame, job_states: DataFrame, modes: int) -> DataFrame:
    """Poses of docked records (protocol_id, state_id, file_ord, record_index, props): ids, ranks, scores."""
    jobs.require_complete(records, job_states, "protocol_id", "state_id", modes)
    poses = jobs.rank_poses(records, "protocol_id", "state_id", ["file_ord", "record_index"])
    scored = poses.withColumn("smina_score", S.first_property("props", ["minimizedAffinity", "smina_affinity", "affinity"]))
    require_none(scored, F.col("smina_score").isNull(), "poses without an affinity property")
    return scored.join(state_rows.select("state_id", "parent_structure_key"), "state_id")


def prepare(spark: SparkSession, folder: str, config: dict, reference: str, describe: Callable | None = None) -> dict[str, DataFrame]:
    """raw, mapping, parents, scored and pool of a library folder."""
    raw = tabular.read_sources(spark, folder)
    sample = config.get("sample", {})
    if sample.get("enabled"):
        raw = sampled(raw, int(sample["active_records"]), int(sample["candidate_records"]), int(config["seed"]))
    mapped = mapping(raw)
    parent_rows = parents(mapped)
    scored = scored2d(parent_rows, reference, describe)
    pool = config["prescreen_3d_pool"]
    pooled = selection.prescreen_pool(scored, pool["channel_fractions"], int(pool["size"]), int(config["final_selection"]["unlabeled_count"]), int(config["seed"]))
    return {"raw": raw, "mapping": mapped, "parents": parent_rows, "scored": scored, "pool": pooled}
