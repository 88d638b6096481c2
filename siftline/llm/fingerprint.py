"""I-Match document fingerprints, in DataFrame and SQL functions only.

A term is a run of letters and digits in lower case. Terms whose inverse document frequency lies in a band form the
lexicon; a document keeps its distinct lexicon terms, sorted, and hashes those of several randomised subsets of the
lexicon (a subset takes a term by some bits of the term's hash, a share of 1/32 to 1/1024 of all), and all of them
together. Likeness of two fingerprints is the share of equal hashes among the subsets in which either has a term.

The band bounds the lexicon: a term in it occurs in at least `low` of all documents, so there are at most (mean number
of distinct terms of a document) / low of them. It becomes one constant array of slots in the plan.

Defined results: a null text is an empty one; a document without a term in the band keeps all its terms instead; texts
without terms have the empty fingerprint and are alike to each other; repeated rows have equal fingerprints; null ids
come last in descending order; rows of one id, or of none, come in the order of a hash of their texts; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of documents that a lexicon term occurs in: idf from ln 5 to ln 256.
LOW, HIGH = 1 / 256, 1 / 5
SLOTS = 1 << 13
#: Subsets of the lexicon: first bit of the term's hash, number of bits, the value they must have. Shares of 1/32 to
#: 1/1024, as many of each: the large ones serve short texts, the small ones texts of which only a part is the same.
SUBSETS = [((11 * k) % (64 - bits), bits, (40503 * (k + 1)) % (1 << bits)) for k in range(48) for bits in (5 + k % 6,)]
#: Ranges of ids for each shuffle partition, and ranges at most.
RANGES, MOST_RANGES = 8, 1 << 16
GROUP = 256


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> Column:
    """A constant: an array of SLOTS arrays of term hashes. Document frequencies are counted over all documents."""
    spark = docs.sparkSession
    counts = docs.select(F.explode(terms(F.col(text_col))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    total = docs.agg(F.count("*").alias("total")).scalar()
    kept = counts.where((F.col("df") >= total * F.lit(low)) & (F.col("df") <= total * F.lit(high)))
    by_slot = kept.groupBy(F.col("t").bitwiseAND(SLOTS - 1).alias("slot")).agg(F.collect_list("t").alias("ts"))
    empty = F.array().cast("array<bigint>")
    every = spark.range(SLOTS).withColumnRenamed("id", "slot").join(by_slot, "slot", "left").select("slot", F.coalesce("ts", empty).alias("ts"))
    slots = F.transform(F.sort_array(F.collect_list(F.struct("slot", "ts"))), lambda s: s["ts"])
    return F.from_json(F.lit(every.agg(F.to_json(slots)).first()[0]), "array<array<bigint>>")


def fingerprint(text: Column, slots: Column) -> Column:
    """array<bigint>: a hash per subset (null where no term is in it) and one of all kept terms."""
    found = terms(text)
    known = F.filter(found, lambda t: F.array_contains(F.element_at(slots, t.bitwiseAND(SLOTS - 1).cast("int") + 1), t))
    kept = F.array_sort(F.when(F.size(known) > 0, known).otherwise(found))

    def digest(some: Column) -> Column:
        return F.when(F.size(some) > 0, F.xxhash64(some))

    def part(shift: int, bits: int, value: int):
        return lambda t: F.shiftrightunsigned(t, shift).bitwiseAND((1 << bits) - 1) == value

    # transform over an array of one binds the sorted terms, so that they are computed once
    bound = F.transform(F.array(kept), lambda k: F.array(*[digest(F.filter(k, part(*s))) for s in SUBSETS], digest(k)))
    return F.element_at(bound, 1)


def as_string(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 16, "0"), F.lit("-"))), ".")


def likeness(a: Column, b: Column) -> Column:
    count = lambda test: F.size(F.filter(F.zip_with(a, b, test), lambda hit: hit))
    either = count(lambda x, y: x.isNotNull() | y.isNotNull())
    return F.when(either > 0, count(lambda x, y: F.coalesce(x == y, F.lit(False))) / either).otherwise(1.0)


def _constant(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def _range_of(order: Column, tie: Column, bounds: list[int]) -> Column:
    """struct(at, sub): which range a row is in, ascending with (order, tie). `bounds` is sorted; one that occurs k times
    stands for as many ranges' worth of rows, which are dealt to k parts by their tie, a hash."""
    cuts = sorted(set(bounds))
    times = {v: n for v, n in Counter(bounds).items() if n > 1}
    if not cuts:
        return F.struct(F.lit(0).alias("at"), F.lit(0).alias("sub"))
    groups = [cuts[i : i + GROUP] for i in range(0, len(cuts), GROUP)]
    below = lambda values: F.size(F.filter(values, lambda b: b < order))
    group = below(_constant([g[-1] for g in groups], "array<bigint>"))
    within = F.when(group < len(groups), below(F.element_at(_constant(groups, "array<array<bigint>>"), F.least(group + 1, F.lit(len(groups))))))
    at = group * GROUP + F.coalesce(within, F.lit(0))
    if not times:
        return F.struct(at.alias("at"), F.lit(0).alias("sub"))
    heavy = F.array_position(_constant(list(times), "array<bigint>"), order).cast("int")
    parts = F.element_at(_constant(list(times.values()), "array<bigint>"), F.greatest(heavy, F.lit(1)))
    sub = F.shiftright((F.shiftright(tie, 33) + (1 << 30)) * parts, 31).cast("int") + 1
    return F.struct(at.alias("at"), F.when(heavy > 0, sub).otherwise(0).alias("sub"))


def with_next(rows: DataFrame, id_col: str, carried: list[str], tie: Column) -> DataFrame:
    """Adds next_<c> for carried columns: those of the next row in descending id, of the first after the last.

    Rows go to ranges of ids, several to a shuffle partition so that these even out. The first row of a range is also
    dealt to the range before it, as a guest behind the last row there, so no row needs another range.
    """
    n = min(RANGES * max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8), MOST_RANGES)
    order = F.coalesce(F.bitwise_not(F.col(id_col)), F.lit((1 << 63) - 1))  # ascending where ids descend, nulls last
    keyed = rows.withColumn("_order", order).withColumn("_tie", tie)
    shares = ",".join(f"{i / n:.9g}D" for i in range(1, n))
    bounds = keyed.agg(F.expr(f"percentile_approx(_order, array({shares}), {max(10_000, 4 * n)})").alias("b")).first()["b"] or []
    keyed = keyed.withColumn("_range", _range_of(F.col("_order"), F.col("_tie"), sorted(bounds)))
    heads = keyed.groupBy("_range").agg(F.min(F.struct("_order", "_tie")).alias("_head"))
    by_range = Window.orderBy("_range")  # a row per range
    heads = heads.select("_head", F.coalesce(F.lag("_range").over(by_range), F.max("_range").over(Window.partitionBy())).alias("_guest_of"))
    # a row per range, 2 * MOST_RANGES at most
    joined = keyed.withColumn("_head", F.struct("_order", "_tie")).join(F.broadcast(heads), "_head", "left")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_guest_of").alias("r"), F.lit(True).alias("guest"))
    dealt = joined.withColumn("_place", F.explode(F.when(F.col("_guest_of").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    w = Window.partitionBy("_place.r").orderBy("_place.guest", "_order", "_tie")
    out = dealt.select(*rows.columns, "_place", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return out.where("not _place.guest").drop("_place")


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of texts whose last half is replaced by the beginning of the next one's."""
    slots = lexicon(docs, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("prints", fingerprint(F.col("text"), slots))
    pairs = with_next(rows, "doc_id", ["text", "prints"], F.xxhash64("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "prints", "next_prints")
    pairs = pairs.withColumn("edited_prints", fingerprint(F.col("edited"), slots))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("prints")).alias("fingerprint"), as_string(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"), likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )
