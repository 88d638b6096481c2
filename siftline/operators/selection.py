"""Channel selection: ranked quotas, group-diverse picks, backfill, and the final capped selection.

Steps depend on what earlier ones took, so each channel's choice is small, written, and taken out by an anti-join; and it
is settled on rows that were kept beforehand because no others can matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.scalars import stable_hash
from siftline.operators.gates import GateError
from siftline.operators import ranking
from siftline.operators.quantiles import exact_median
from siftline.operators.ranking import best_per_group, capped_take, largest_remainder, numbered
from siftline.operators.storage import cut, remove, written

#: Fixed value: candidates of a diverse channel, at most.
MOST_CANDIDATES = 30_000
#: Farthest rows that the driver picks among before distances are brought up to date.
BESIDE = 1024


@dataclass(frozen=True)
class Columns:
    """Names of the columns a selection works on."""

    key: str = "structure_key"
    ord: str = "row_ord"
    group: str = "murcko_scaffold"
    evidence: str = "library_evidence_score"
    pharm: str = "pharm2d_similarity"
    consensus: str = "pnu_consensus"
    quality: str = "quality_score"
    alerts: str = "soft_alert_count"


def representatives(df: DataFrame, seed: int, c: Columns) -> DataFrame:
    """The best row of each group: no alerts first, then quality, then the smaller hash."""
    order = [(F.col(c.alerts) == 0).desc(), F.desc(c.quality), stable_hash(c.key, seed), F.col(c.ord)]
    return best_per_group(df, [c.group], order)


def fill_channels(df: DataFrame, quotas: dict[str, int], seed: int, c: Columns = Columns(), min_quality: float = 0.35) -> DataFrame:
    """key, prescreen_channel, prescreen_source_rank of the rows that four channels take, in their declared order:
    pnu_2d, pharm2d, scaffold_diversity, exploration. Channels left short are filled by quality afterwards.

    Each channel's choice is settled on a bounded head of the table. Whatever is chosen is fewer rows than all quotas
    together, so the first that many rows of a ranked channel are enough, and one pass keeps them for both. Another one
    keeps the best row of each group, and the two best that pass the gate: the diversity channel takes one row of a group
    at most. Backfilling needs as many rows by quality as are lacking, which is a third pass if any are.
    """
    rows = df.select(c.key, c.ord, c.group, c.evidence, c.pharm, c.consensus, c.quality, c.alerts)
    size = sum(quotas.values())
    gate = (F.col(c.alerts) == 0) & (F.col(c.quality) >= min_quality) & (F.col(c.consensus) <= F.lit(exact_median(df, c.consensus)))
    scores = {channel: F.col(name) for channel, name in (("pnu_2d", c.evidence), ("pharm2d", c.pharm)) if channel in quotas}
    picks: list[DataFrame] = []
    short: dict[str, int] = {}

    def keys() -> DataFrame | None:
        out = None
        for p in picks:
            out = p.select(c.key) if out is None else out.unionByName(p.select(c.key))
        return out

    def left(table: DataFrame) -> DataFrame:
        taken = keys()
        return table if taken is None else table.join(taken, c.key, "left_anti")

    def take(channel: str, no: int, table: DataFrame, score: Column, order: Sequence[Column], n: int) -> None:
        first = ranking.head(table, score, order, n).withColumn("_pick", F.row_number().over(Window.orderBy(*order)))  # n rows
        chosen = cut(first.select(c.key, F.lit(channel).alias("prescreen_channel"), F.lit(no).alias("_round"), "_pick"))
        picks.append(chosen)
        short[channel] = n - chosen.count()

    ranked = rows
    if scores:
        least = ranking.cut_points(rows, scores, size)
        if all(v is not None for v in least.values()):
            ranked = rows.where(reduce(or_, [s >= F.lit(least[channel]) for channel, s in scores.items()]))
        ranked = cut(ranked)
    best: DataFrame | None = None
    for no, (channel, quota) in enumerate(quotas.items()):
        if channel in scores:
            take(channel, no, left(ranked), scores[channel], [scores[channel].desc(), F.desc(c.quality), F.col(c.ord)], quota)
            continue
        if best is None:
            entry = lambda tag, s: F.struct(F.lit(tag).alias("tag"), stable_hash(c.key, s).alias("hash"))
            each = F.array_compact(F.array(entry("any", seed + 1), F.when(gate, entry("calm", seed + 11))))
            place = F.row_number().over(Window.partitionBy("tag", c.group).orderBy((F.col(c.alerts) == 0).desc(), F.desc(c.quality), "hash", c.ord))
            tagged = left(rows).select(c.key, c.ord, c.group, c.alerts, c.quality, F.inline(F.array_distinct(each))).withColumn("place", place)
            best = cut(tagged.where("place <= 2"))
        tag, shift = ("any", 2) if channel == "scaffold_diversity" else ("calm", 12)
        again = F.row_number().over(Window.partitionBy(c.group).orderBy("place"))
        firsts = left(best.where(F.col("tag") == tag)).withColumn("again", again).where("again = 1")
        take(channel, no, firsts, ranking.hash_score(c.key, seed + shift), [stable_hash(c.key, seed + shift), F.col(c.ord)], quota)
    lacking = sum(short.values())
    if lacking:
        rest = left(rows)
        least = ranking.cut_points(rest, {"quality": F.col(c.quality)}, lacking)["quality"]
        rest = cut(rest if least is None else rest.where(F.col(c.quality) >= F.lit(least)))
        for no, (channel, n) in enumerate(list(short.items())):
            if n:
                taken = keys()
                order = [F.desc(c.quality), stable_hash(c.key, seed + 100 + no), F.col(c.ord)]
                take(channel, 10 + no, rest.join(taken, c.key, "left_anti"), F.col(c.quality), order, n)
    out = reduce(DataFrame.unionByName, picks)
    rank = F.row_number().over(Window.orderBy(F.col("_round") % 10, "_round", "_pick"))  # rows of the pool only
    return out.select(c.key, "prescreen_channel", rank.alias("prescreen_source_rank"))


def prescreen_pool(df: DataFrame, fractions: dict[str, float], size: int, unlabeled: int, seed: int, pool: str = "source_pool", active: str = "activity_recorded", c: Columns = Columns()) -> DataFrame:
    """All active rows that pass and the rest of `size` from the others, each source through its own channels."""
    if size <= unlabeled:
        raise GateError("the pool leaves no room beyond the unlabeled selection")
    passed = df.where("hard_filter_pass = 1")
    counts = {r[0]: r[1] for r in passed.groupBy((F.col(pool) == active).alias("a")).count().collect()}
    n_active, n_other = counts.get(True, 0), size - counts.get(True, 0)
    if n_other < unlabeled or counts.get(False, 0) < n_other:
        raise GateError("too few rows for the pool")
    parts = []
    for is_active, n, shift in ((True, n_active, 0), (False, n_other, 100)):
        rows = passed.where((F.col(pool) == active) == F.lit(is_active))
        parts.append(fill_channels(rows, largest_remainder(fractions, n), seed + shift, c))
    chosen = parts[0].unionByName(parts[1])
    return passed.join(chosen, c.key)


def _distances(rows: Sequence[np.ndarray], picked: Sequence[np.ndarray]) -> np.ndarray:
    """Jaccard distances of integer sets, a row for each of `rows`."""
    words, owner = np.concatenate([np.zeros(0, np.int64), *picked]), np.repeat(np.arange(len(picked)), [len(p) for p in picked])
    order = np.argsort(words, kind="stable")
    words, owner = words[order], owner[order]
    flat, row = np.concatenate([np.zeros(0, np.int64), *rows]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    first, last = np.searchsorted(words, flat, "left"), np.searchsorted(words, flat, "right")
    n = last - first
    meets = owner[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    both = np.bincount(np.repeat(row, n) * len(picked) + meets, minlength=len(rows) * len(picked)).reshape(len(rows), len(picked))
    either = np.array([len(r) for r in rows])[:, None] + np.array([len(p) for p in picked])[None] - both
    return 1 - np.where(either > 0, both / np.maximum(either, 1), 1.0)


def maxmin_pick(df: DataFrame, key: str, vector: str, order: Sequence[Column], n: int, beside: int = BESIDE) -> DataFrame:
    """Greedy max-min diversity by Jaccard distance of integer sets: the first row in order, then always the row farthest
    from all picked ones, ties to the earlier row. Adds pick_rank. A null vector is an empty set. Order columns ascend.

    Distances to the picked rows are kept in a written table. They only shrink as more is picked, so an old distance is a
    bound: the `beside` farthest rows go to the driver, which picks among them as long as the best of them comes before
    the farthest row that was left behind. Then every task brings its rows' distances up to date with these picks. Each
    such round makes one pick at least; the picks are those of the plain greedy walk.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    sets = F.array_distinct(F.coalesce(F.transform(vector, lambda x: x.cast("long")), F.array().cast("array<bigint>")))
    rows = numbered(df.withColumn("_set", sets), [], order, "_at").select(F.col(key).alias("_key"), "_at", "_set", F.lit(float("inf")).alias("_far"))
    state, path = written(rows, "maxmin")
    picks: list[tuple] = []
    while len(picks) < n:
        top = state.orderBy(F.desc("_far"), "_at").limit(beside + 1).collect()
        edge = (top[-1]["_far"], -top[-1]["_at"]) if len(top) > beside else (-1.0, 0)  # what others reach at most
        top = top[:beside]
        own = [np.array(r["_set"], np.int64) for r in top]
        far, at = np.array([r["_far"] for r in top]), np.array([r["_at"] for r in top])
        new: list[int] = []
        while len(top) and len(picks) + len(new) < n:
            best = int(np.lexsort((at, -far))[0])
            if far[best] < 0 or (far[best], -at[best]) < edge:
                break
            new.append(best)
            far = np.minimum(far, _distances(own, [own[best]])[:, 0])
            far[new] = -1
        if not new:
            break
        picks += [top[i]["_key"] for i in new]
        if len(picks) < n and len(top) == beside:
            after, next_path = written(_nearer(state, [own[i] for i in new], [int(at[i]) for i in new]), "maxmin")
            remove(spark, path)
            state, path = after, next_path
    remove(spark, path)
    return spark.createDataFrame([(k, i) for i, k in enumerate(picks, start=1)], f"`{key}` {kind}, pick_rank long")


def _nearer(state: DataFrame, picked: list[np.ndarray], at: list[int]) -> DataFrame:
    """The rows that were not picked, with distances that take the picked ones into account."""
    sent = state.sparkSession.sparkContext.broadcast(picked)  # BESIDE sets at most

    def run(batches):
        for pdf in batches:
            for begin in range(0, len(pdf), 256):
                part = pdf.iloc[begin : begin + 256].copy()
                d = _distances([np.asarray(v, np.int64) for v in part["_set"]], sent.value).min(1)
                part["_far"] = np.minimum(part["_far"], d)
                yield part

    return state.where(~F.col("_at").isin(at)).mapInPandas(run, state.schema)


def diverse_candidates(firsts: DataFrame, vectors: DataFrame, vector: str, target: int, seed: int, oversample: int, c: Columns) -> DataFrame:
    """Of one row per group, those first in hash order, cut to the picker's pool; picked by max-min beyond the target.
    Adds pick_rank. vectors: key and vector of all rows."""
    order = [stable_hash(c.key, seed + 1), F.col(c.ord)]
    limit = max(target, min(target * oversample, MOST_CANDIDATES))
    pool = cut(ranking.head(firsts, ranking.hash_score(c.key, seed + 1), order, limit))
    if pool.count() <= target:
        return pool.withColumn("pick_rank", F.row_number().over(Window.orderBy(*order)))
    picked = maxmin_pick(pool.join(vectors, c.key), c.key, vector, order, max(target, int(1.25 * target)))
    return pool.join(picked, c.key)


# Channels of the final selection in order.
RANKED = {"pnu_structure3d_enrichment": "structure3d_score", "pnu_2d_enrichment": "library_evidence_score", "pnu_pharm2d_enrichment": "pharm2d_similarity"}
DIVERSE = {"h9e937_pocket_discovery": 103, "diversity": 104, "exploration": 105}


def activity_failures(df: DataFrame, pool: str = "source_pool", active: str = "activity_recorded", status: str = "structure3d_status", c: Columns = Columns()) -> DataFrame:
    """Active rows without a usable 3D structure, by key: what the final selection leaves out."""
    usable = F.coalesce(F.col(status).isin("ok", "feasible_only"), F.lit(False))
    names = [n for n in ("compound_id", c.key, "standardized_smiles", status, "structure3d_embedding_method") if n in df.columns]
    return df.where((F.col(pool) == active) & ~usable).select(*names).orderBy(c.key)


def final_selection(df: DataFrame, targets: dict[str, int], seed: int, vector: str, min_score: float = 0.0, min_qed: float = 0.35, exploration_qed: float = 0.45, targeted_cap: int = 6, diverse_cap: int = 3, global_cap: int = 6, oversample: int = 8, pool: str = "source_pool", active: str = "activity_recorded", status: str = "structure3d_status", c: Columns = Columns(), require_all_active: bool = False) -> DataFrame:
    """key, selection_channel, selection_rank: every feasible active row by key, then six channels over the others, each
    under a cap per group that counts what earlier channels took (active rows use no room). A short channel is filled by
    quality under the same cap; one that stays short is an error. With require_all_active, so is an active row without a
    usable 3D structure.

    Channels are settled on heads of their groups, kept in one pass for all ranked channels and one for all diverse ones.
    No more than global_cap rows of a group are ever chosen, and a walk passes over a row only if it is chosen already or
    its group is full. So of a ranked order the first 2 * global_cap rows of a group are enough, and of the order of
    representatives the first global_cap + 1.
    """
    if require_all_active and (n := activity_failures(df, pool, active, status, c).count()):
        raise GateError(f"{n} active rows have no usable 3D structure")
    ok = df.where(F.col(status).isin("ok", "feasible_only"))
    actives = ok.where(F.col(pool) == active).select(c.key, F.lit("activity_recorded_all").alias("selection_channel"), F.lit(0).alias("_no"), F.col(c.key).alias("_at"))
    others = ok.where(F.col(pool) != active)
    have = others.count()
    if have < sum(targets.values()):
        raise GateError(f"other rows are short: {have} usable ones for {sum(targets.values())}")
    calm, qed = F.col(c.alerts) == 0, F.col("qed")
    gates = {"h9e937_pocket_discovery": calm & (qed >= min_qed), "diversity": qed >= min_qed}
    if "exploration" in targets:
        gates["exploration"] = (F.col(c.consensus) <= F.lit(exact_median(others, c.consensus))) & calm & (qed >= exploration_qed)
    enough = (F.col(status) == "ok") & (F.col("structure3d_score") >= min_score)
    heads: dict[str, DataFrame] = {}

    def head(kind: str) -> DataFrame:
        """channel, key, ord, group, score, quality, hash of the rows that can matter; kind: ranked, diverse or fill."""
        if kind not in heads:
            entry = lambda channel, score, hash: F.struct(F.lit(channel).alias("channel"), score.cast("double").alias("score"), hash.alias("hash"))
            none = F.lit("")
            if kind == "ranked":
                each = [F.when(enough if channel == "pnu_structure3d_enrichment" else F.lit(True), entry(channel, F.col(score), none)) for channel, score in RANKED.items() if channel in targets]
                order, most = [F.desc("score"), F.desc(c.quality), F.col(c.ord)], 2 * global_cap
            elif kind == "diverse":
                each = [F.when(gate, entry(channel, calm.cast("int"), stable_hash(c.key, seed + DIVERSE[channel]))) for channel, gate in gates.items() if channel in targets]
                order, most = [F.desc("score"), F.desc(c.quality), F.col("hash"), F.col(c.ord)], global_cap + 1
            else:
                each = [entry("", F.col(c.quality), stable_hash(c.key, seed + 999))]
                order, most = [F.desc("score"), F.col("hash"), F.col(c.ord)], 2 * global_cap
            place = F.row_number().over(Window.partitionBy("channel", c.group).orderBy(*order))
            tagged = others.select(c.key, c.ord, c.group, c.quality, F.inline(F.array_compact(F.array(*each))))
            heads[kind] = cut(tagged.withColumn("_near", place).where(F.col("_near") <= most))
        return heads[kind]

    chosen: DataFrame | None = None
    left = lambda rows: rows if chosen is None else rows.join(chosen.select(c.key), c.key, "left_anti")
    for no, (channel, target) in enumerate(targets.items(), start=1):
        cap = min(targeted_cap if channel in RANKED else diverse_cap, global_cap)

        def walk(rows: DataFrame, order: Sequence[Column], n: int, after: int = 0) -> DataFrame:
            used = None if chosen is None else chosen.groupBy(c.group).agg(F.count("*").alias("n"))
            got = capped_take(rows, c.group, order, n, cap, used)
            return got.select(c.key, c.group, F.lit(channel).alias("selection_channel"), F.lit(no).alias("_no"), F.format_string("%012d", F.col("take_rank") + after).alias("_at"))

        if channel in RANKED:
            got = cut(walk(left(head("ranked").where(F.col("channel") == channel)), [F.desc("score"), F.desc(c.quality), F.col(c.ord)], target))
        else:
            mine = left(head("diverse").where(F.col("channel") == channel))
            firsts = mine.withColumn("_first", F.row_number().over(Window.partitionBy(c.group).orderBy("_near"))).where("_first = 1").drop("_first")
            picked = diverse_candidates(firsts, others.select(c.key, vector), vector, target, seed + DIVERSE[channel], oversample, c)
            got = cut(walk(picked, [F.col("pick_rank")], target))
        n = got.count()
        chosen = got if chosen is None else chosen.unionByName(got)
        if n < target:
            more = walk(left(head("fill")), [F.desc("score"), F.col("hash"), F.col(c.ord)], target - n, n)
            chosen = cut(chosen.unionByName(more))
            if chosen.where(F.col("_no") == no).count() < target:
                raise GateError(f"channel {channel} is short")
    everything = actives.unionByName(chosen.drop(c.group)) if chosen is not None else actives
    rank = F.row_number().over(Window.orderBy("_no", "_at"))
    return everything.select(c.key, "selection_channel", rank.alias("selection_rank"))
