"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct w-word shingles; its sketch is the k smallest. Documents with equal
sets are one class. Two sets of Jaccard similarity >= t share at least `need` of the k smallest values of their union
(all but one pair in some ten million at k = 32, t = 0.8; surely, when the sets have at most k values). So a sketch may
leave out its need - 1 most frequent values and still meet: only the rarer ones enter the inverted lists, and documents
with too few values that occur elsewhere enter none.

Lists generate overlaps in rounds. Each member meets the hub of its list, the member whose values are in the most
lists, which in a group of near copies is what they were made from; pairs that the union sketch allows are compared on full sets, and what differs from the hub is kept for members near it.
From these differences the exact similarity of any two members of a hub follows, so members in different components
are compared in blocks without their texts. A settled member, closer still, is done in that list: what is similar to it is near the
hub, by the triangle inequality of Jaccard distance (an estimate misses such a pair with chance below 2e-7). What is not goes through a second hub; what is left then meets in blocks of sketches, and pairs
that the union sketch allows are verified on full sets. No list is cut or dropped.

Defined results: texts are lower-cased in A-Z; null texts and texts without words have the empty set and link with
nothing; fewer than w words are one shingle; repeated rows are copies and share their links; rows with a null id are
linked like others, so two documents meet through one, but name no component (one of nameless rows alone is null); rows of one id are one node of the components; only
the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import components, discard, fresh_ids, map_batches, materialize, own_memory, texts_of

K = 32
BLOCK = 128
#: Similarity (percent) to a hub from which on a member is done with its list, at least.
SETTLED = 65
_words: dict[bytes, int] = {}


def settled_and_near(percent: int) -> tuple[int, int]:
    """Similarities to a hub: from the first on a member is done with its list, from the second on its differences are
    kept. What is similar to a settled member is near the hub: distances add up to no more than 100 - near."""
    settled = max(SETTLED, 101 - percent)
    return settled, settled + percent - 100


@lru_cache
def needed(k: int, percent: int) -> int:
    """The most values that sketches of sets of at least this similarity fall short of with chance below 2e-7."""
    t, below = percent / 100, 0.0
    for x in range(k + 1):
        below += math.comb(k, x) * t**x * (1 - t) ** (k - x)
        if below > 2e-7:
            return max(x, 1)
    return k


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), 1) >> 1], np.int64)
    if len(_words) > 300_000:
        _words.clear()
    if not _words:
        own_memory(__name__, _words.clear)
    get, h = _words.get, []
    for w in words:
        x = get(w)
        if x is None:
            x = _words[w] = xxhash.xxh3_64_intdigest(w)
        h.append(x)
    h = np.array(h, np.uint64)
    s = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        s = _mix(s) + h[i : len(h) - width + 1 + i]
    return np.unique(_mix(s) >> np.uint64(1)).astype(np.int64)


def sets(docs: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, n, key (128 bits of the set; null if empty), sketch."""

    def make():
        def each(b):
            found = [shingles(t, width) for t in texts_of(b)]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found]
            return pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(keys, pa.binary()), pa.array([s[:k] for s in found], pa.list_(pa.int64()))], ["doc_id", "n", "key", "sketch"])

        return each

    return map_batches(docs, make, "doc_id long, n long, key binary, sketch array<long>")


def _enough(shared, union, k: int, percent: int):
    """Can a union sketch of this size with so many shared values belong to a similar pair? For columns and arrays."""
    return (shared * 100 >= union * percent) | ((union >= k) & (shared >= needed(k, percent)))


def _lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """value, rep, weight: inverted lists of the rarer retained values, those with two members or more. The weight of a
    document grows with the documents that its values are in."""
    each = materialize(classes.select("rep", F.size("sketch").alias("size"), F.explode("sketch").alias("value")), "values")
    often = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "value")
    least = F.least(F.ceil(F.col("size") * percent / 100), F.when(F.col("size") >= k, needed(k, percent)).otherwise(F.col("size")))
    by_rarity = Window.partitionBy("rep").orderBy("df", "value")
    alone = F.col("size") - F.count("*").over(Window.partitionBy("rep"))
    weight = F.sum("df").over(Window.partitionBy("rep")).alias("weight")
    kept = shared.select("rep", "value", weight, (F.row_number().over(by_rarity) + alone).alias("place"), (F.col("size") - least + 1).alias("room")).where("place <= room").select("value", "rep", "weight")
    out = materialize(kept, "lists")
    discard(each)
    return out


def _texts(lists: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, text of documents in lists. Ids grow with the input, so they are merged with texts, never broadcast."""
    ids = lists.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    return materialize(docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")


def _compared(pairs: DataFrame, texts: DataFrame, width: int, least: int) -> DataFrame:
    """a, b, n_a, n_b, both (sizes of the full sets and their intersection), diff (what only one has): pairs with
    100 * intersection >= least * union."""
    side = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")

    def make():
        last: list = [None, None]

        def each(batch):
            out: tuple[list, ...] = tuple([] for _ in range(6))
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if last[0] != ta:
                    last[:] = [ta, shingles(ta or "", width)]
                one, two = last[1], shingles(tb or "", width)
                diff = np.setxor1d(one, two, assume_unique=True)
                both = (len(one) + len(two) - len(diff)) // 2
                if both and 100 * both >= least * (both + len(diff)):
                    for column, value in zip(out, (a, b, len(one), len(two), both, diff), strict=True):
                        column.append(value)
            kinds = (*[pa.int64()] * 5, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["a", "b", "n_a", "n_b", "both", "diff"])

        return each

    return materialize(map_batches(rows, make, "a long, b long, n_a long, n_b long, both long, diff array<long>"), "compared")


def _similarity_at_least(percent: int):
    return F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent


def _meet_hub(lists: DataFrame, classes: DataFrame, texts: DataFrame, width: int, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The hub round: compared pairs (a the hub), and the lists that are not done."""
    settled, near = settled_and_near(percent)
    heads = lists.groupBy("value").agg(F.max_by("rep", F.struct("weight", F.negate("rep"))).alias("a"), F.count("*").alias("m")).where("m > 1").select("value", "a")
    placed = materialize(lists.join(heads, "value").where("rep <> a").select("value", "a", F.col("rep").alias("b"), "weight"), "placed")
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("sketch").alias(f"sketch_{s}"))
    both = placed.select("a", "b").distinct().join(side("b"), "b").join(side("a"), "a")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    compared = _compared(both.where(_enough(shared, F.size(union), k, near)).select("a", "b"), texts, width, near)
    known = compared.select("a", "b", _similarity_at_least(settled).alias("settled"))
    found = placed.join(known, ["a", "b"], "left").where("not coalesce(settled, false)")
    found = materialize(found.select("value", F.col("b").alias("rep"), "weight", F.col("settled").isNull().alias("far")), "left")
    # where all that are left are near the hub, their differences decide
    undecided = found.groupBy("value").agg(F.count_if("far").alias("far")).where("far > 0").select("value")
    discard(placed)
    return compared, found.join(undecided, "value", "left_semi").drop("far")


def _across(placed: DataFrame, payload: list[str]) -> DataFrame:
    """Groups of rows that must meet: m, an array of (rep, comp, *payload), two blocks at most.

    placed: key, rep, comp and the payload. Rows of a key meet block by block unless they are in one component.
    A large component fills blocks of its own; small ones share blocks.
    """
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    spread = sizes.groupBy("key").agg(F.count("*").alias("comps"), F.sum(F.when(F.col("n") <= BLOCK, F.col("n")).otherwise(0)).alias("small")).where("comps > 1").select("key", "small")
    sizes = sizes.join(spread, "key")
    blocks_of = F.when(F.col("n") > BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(F.ceil(F.col("small") / BLOCK))
    sizes = sizes.select("key", "comp", F.coalesce(F.when(F.col("n") > BLOCK, F.col("comp")), F.lit(-(1 << 63))).alias("pure"), blocks_of.alias("blocks"))
    spot = F.pmod(F.xxhash64(F.when(F.col("pure") == F.col("comp"), F.col("rep")).otherwise(F.col("comp"))), F.col("blocks"))
    members = materialize(placed.join(sizes, ["key", "comp"]).select("key", "rep", "comp", *payload, F.struct("pure", spot.cast("int").alias("spot")).alias("block")), "members")
    blocks = members.select("key", "block").distinct()
    other = blocks.select("key", F.col("block").alias("right"))
    both_pure = (F.col("block.pure") == F.col("right.pure")) & (F.col("block.pure") > F.lit(-(1 << 63)))
    meets = blocks.join(other, "key").where((F.col("block") <= F.col("right")) & ~both_pure)
    roles = meets.select("key", F.explode(F.array_distinct(F.array("block", "right"))).alias("block"), F.xxhash64("key", "block", "right").alias("meet"))
    dealt = members.join(roles, ["key", "block"])
    return dealt.groupBy("meet").agg(F.collect_list(F.struct("rep", "comp", *payload)).alias("m")).select("m")


def _shared(arrays: list[np.ndarray]) -> np.ndarray:
    """How many values each two of these duplicate-free arrays share."""
    if not sum(map(len, arrays)):
        return np.zeros((len(arrays), len(arrays)), np.float32)
    _, where, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    often = counts[where] > 1
    place = np.cumsum(counts > 1) - 1
    has = np.zeros((len(arrays), max(int(place[-1]) + 1, 1)), np.float32)
    has[row[often], place[where[often]]] = 1
    return has @ has.T


def _pairs_out(found: dict) -> pa.RecordBatch:
    cols = list(zip(*found.values(), strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])


def _hub_links(compared: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Links between members of one hub in different components, exact from their differences to the hub."""
    placed = compared.select(F.col("a").alias("key"), F.col("b").alias("rep"), F.col("n_b").alias("n"), "diff")
    placed = placed.join(comp.select(F.col("node").alias("rep"), "component_id"), "rep", "left").withColumn("comp", F.coalesce("component_id", "rep"))

    def make():
        def each(batch):
            found: dict = {}  # one link for each two components is enough
            for m in batch.column(0).to_pylist():
                reps, comps, n = (np.array([x[c] for x in m]) for c in ("rep", "comp", "n"))
                diffs = [np.array(x["diff"], np.int64) for x in m]
                d = np.array([len(x) for x in diffs])
                both = (n[:, None] + n - d[:, None] - d + 2 * _shared(diffs).astype(np.int64)) // 2
                hit = (100 * both >= percent * (n[:, None] + n - both)) & (comps[:, None] < comps) & (both > 0)
                for x, y in zip(*np.nonzero(hit), strict=True):
                    found[int(comps[x]), int(comps[y])] = (int(reps[x]), int(reps[y]))
            return _pairs_out(found)

        return each

    return materialize(map_batches(_across(placed.select("key", "rep", "comp", "n", "diff"), ["n", "diff"]), make, "a long, b long"), "hub-links")


def _list_links(lists: DataFrame, compared: DataFrame, comp: DataFrame, texts: DataFrame, width: int, k: int, percent: int) -> DataFrame:
    """Links within lists between components and not near one hub, candidates from blocks of sketches eight times as long: few documents are left."""
    left = texts.join(lists.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")
    k *= 8
    classes = materialize(sets(left, width, k).select(F.col("doc_id").alias("rep"), "sketch"), "long-sketches")
    hubs = compared.groupBy(F.col("b").alias("rep")).agg(F.collect_set("a").alias("hubs"))  # a member has as many as it has lists
    placed = lists.join(comp.select(F.col("node").alias("rep"), "component_id"), "rep", "left").join(classes.select("rep", "sketch"), "rep").join(hubs, "rep", "left")
    placed = placed.select(F.col("value").alias("key"), "rep", F.coalesce("component_id", "rep").alias("comp"), "sketch", F.coalesce("hubs", F.array().cast("array<bigint>")).alias("hubs"))

    def make():
        def each(batch):
            found: dict = {}
            for m in batch.column(0).to_pylist():
                reps, comps = (np.array([x[c] for x in m]) for c in ("rep", "comp"))
                sketches = [np.array(x["sketch"], np.int64) for x in m]
                least = np.minimum(needed(k, percent), np.ceil(np.array([len(x) for x in sketches]) * percent / 100))
                near = _shared([np.array(x["hubs"], np.int64) for x in m]) > 0
                may = ~near & (_shared(sketches) >= np.minimum(least[:, None], least)) & (comps[:, None] != comps) & (reps[:, None] < reps)
                for x, y in zip(*np.nonzero(may), strict=True):
                    union = np.union1d(sketches[x], sketches[y])[:k]
                    both = np.intersect1d(np.intersect1d(sketches[x], sketches[y], assume_unique=True), union, assume_unique=True)
                    if _enough(len(both), len(union), k, percent):
                        found[int(reps[x]), int(reps[y])] = (int(reps[x]), int(reps[y]))
            return _pairs_out(found)

        return each

    pairs = map_batches(_across(placed, ["sketch", "hubs"]), make, "a long, b long").distinct()
    return _compared(pairs, texts, width, percent).select("a", "b")


def link(df: DataFrame, width: int = 5, percent: int = 80, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Links: 100 * intersection >= percent * union of shingle sets."""
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    content = F.xxhash64("text")
    several = docs.where("doc_id is not null").groupBy("doc_id").agg((F.min(content) != F.max(content)).alias("differ")).where("differ").select("doc_id")
    several = materialize(several, "shared-ids")
    strange = docs.where("doc_id is null and text is not null").unionByName(docs.where("text is not null").join(several, "doc_id", "left_semi"))
    ids = None
    if not strange.isEmpty():  # texts without an id, and texts of an id that has others too, get an id of their own for the time being
        key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text")).cast("binary"))
        strange = strange.withColumn("key", key)
        ids = fresh_ids(strange.select("key").distinct(), docs.select(F.col("doc_id").alias("id")).distinct())
        lent = strange.withColumnRenamed("doc_id", "own").join(ids, "key").select(F.col("id").alias("doc_id"), "text", "own")
        docs = docs.where("doc_id is not null or text is null").join(several, "doc_id", "left_anti").unionByName(docs.where("text is null").join(several, "doc_id", "left_semi")).unionByName(lent.select("doc_id", "text"))
        ids = materialize(lent.select("doc_id", "own").distinct(), "lent-ids")
    whole = materialize(sets(docs, width, k), "sets")
    classes = whole.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.any_value("sketch").alias("sketch"))
    classes = materialize(classes, "set-classes")
    lists = _lists(classes, k, percent)
    texts = _texts(lists, docs)
    first, lists = _meet_hub(lists, classes, texts, width, k, percent)
    second, lists = _meet_hub(lists, classes, texts, width, k, percent)
    compared = first.unionByName(second)
    links = compared.where(_similarity_at_least(percent)).select("a", "b")
    # members linked to one hub are connected; labels that say no more than that need no rounds, and a hub has its own id
    comp = materialize(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component_id")), "labels")
    more = _hub_links(compared, comp, percent).unionByName(_list_links(lists, compared, comp, texts, width, k, percent))
    links = links.unionByName(more)
    if ids is not None:  # the texts of one id are one node
        of_one = whole.join(ids.where("own is not null"), "doc_id").join(classes.select("key", "rep"), "key").select("own", "rep").distinct()
        links = links.unionByName(of_one.join(of_one.groupBy("own").agg(F.min("rep").alias("a")), "own").select("a", F.col("rep").alias("b")))
    comp = components(links, "components")
    named = classes.select("key", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component_id", "rep").alias("_component"))
    whole = whole.select("doc_id", "n", "key")
    if ids is not None:
        whole = whole.join(ids.withColumn("_lent", F.lit(True)), "doc_id", "left").select(F.when(F.col("_lent"), F.col("own")).otherwise(F.col("doc_id")).alias("doc_id"), "n", "key")
        smallest = named.join(whole.groupBy("key").agg(F.min("doc_id").alias("own")), "key").groupBy("_component").agg(F.min("own").alias("_name"))
        named = named.join(smallest, "_component").select("key", F.col("_name").alias("_component"))
    out = whole.join(named, "key", "left")
    if ids is not None:  # and so are its rows without words
        of_one = whole.join(several, "doc_id", "left_semi").join(named, "key").groupBy("doc_id").agg(F.min("_component").alias("_own"))
        out = out.join(of_one, "doc_id", "left").withColumn("_component", F.coalesce("_component", "_own"))
    component = F.when(F.col("key").isNull(), F.coalesce("_component", "doc_id")).otherwise(F.col("_component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
