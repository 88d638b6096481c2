r"""Substring deduplication by hashed lines, cut at sentence ends.

A line is what stands between newlines; a unit is a piece of a line up to and with a run of sentence marks (. ! ?).
Units are normalised (lower case, every run of other characters than letters and digits one space, trimmed) and hashed
to 128 bits; units without letters and digits are no units. Digests are grouped globally, whatever their length; the
earliest occurrence of each, by document id, then place, is its original and all others repeat it.

Units are alike by chance, passages are not: what goes is a run of repeated units in a row that has `min_words` words
or more, from the first unit's beginning to the last one's end. A passage that lies in the middle of sentences loses
its first and last sentence to them, some five words each on average, so the default of 40 words is for passages of 50. Offsets
are those in the original text, in code points.

A digest that many units share is not met in one task: occurrences are counted before they are shuffled, and the few
digests that hold more than 1 / HOT of all units are told to every task instead.

Defined results: a null text is an empty one with no units; rows that share id and text are one document; null ids come
first in order; only the named columns are read; an empty table gives an empty result; texts are read whole, and their
length is bounded only by a row's.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import discard, join_skewed, map_batches, materialize, without

OTHER = regex.compile(r"[^\p{L}\p{N}]+")
UNIT = regex.compile(r"[^\n.!?]+[.!?]*|[.!?]+")
MIN_WORDS = 40


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, past the end, normalised) of each unit."""
    found = ((m.start(), m.end(), normalised(m[0])) for m in UNIT.finditer(text))
    return [u for u in found if u[2]]


def normalised(piece: str) -> str:
    return OTHER.sub(" ", piece.lower()).strip(" ")


def runs(found: list[tuple[int, int, str]], repeated: set[int], min_words: int) -> list[tuple[int, int, int]]:
    """(start, past the end, units) of the runs to remove; `repeated` holds where repeated units begin."""
    out, words, n, begin, end = [], 0, 0, 0, 0
    for start, stop, plain in [*found, (-1, -1, "")]:
        if start in repeated:
            begin = begin if n else start
            words, n, end = words + plain.count(" ") + 1, n + 1, stop
        else:
            if n and words >= min_words:
                out.append((begin, end, n))
            words = n = 0
    return out


def _digests(docs: DataFrame) -> DataFrame:
    def make():
        def each(b):
            for at in range(0, b.num_rows, 256):
                out: tuple[list, ...] = ([], [], [], [])
                for doc, rid, text in zip(*(b.column(c).slice(at, 256).to_pylist() for c in range(3)), strict=True):
                    for start, _, plain in units(text or ""):
                        for column, value in zip(out, (xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass")), doc, rid, start), strict=True):
                            column.append(value)
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["digest", "doc_id", "rid", "start"])

        return each

    return map_batches(docs, make, "digest binary, doc_id long, rid long, start int")


def repeated_units(docs: DataFrame) -> DataFrame:
    """doc_id, rid, starts: where units begin that an earlier one repeats, a row per document that has any."""
    each = materialize(_digests(docs), "units")
    first = F.min(F.struct("doc_id", "rid", "start")).alias("first")
    repeated = materialize(each.groupBy("digest").agg(F.count("*").alias("n"), first).where("n > 1"), "repeated-digests")
    met = join_skewed(each, repeated, ["digest"], "n")
    gone = met.where(~F.struct("doc_id", "rid", "start").eqNullSafe(F.col("first")))
    out = materialize(gone.groupBy("doc_id", "rid").agg(F.collect_set("start").alias("starts")), "repeated-units")
    discard(each)
    discard(repeated)
    return out


def remove_repeated_lines(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """All columns of df with the text replaced by what is kept, and n_units, n_removed, removed (array of start, past
    the end), which replace columns of these names. With digests only doc_id, n_units, n_removed, removed_chars, removed
    (text "start-end" joined by commas), kept_sha256 and text."""
    rid = F.xxhash64(F.coalesce(df[text_col], F.lit("")))
    docs = df.select(df[id_col].cast("long").alias("doc_id"), rid.alias("rid"), df[text_col].alias("text"))
    found = repeated_units(docs).toDF("_siftline_id", "_siftline_rid", "_siftline_starts")
    columns = [id_col] if digests else without(df, "n_units", "n_removed", "removed")
    rows = df.select(*[df[c] for c in columns], df[text_col].alias("_siftline_text"), df[id_col].cast("long").alias("_siftline_doc"), rid.alias("_siftline_own"))
    same = F.col("_siftline_doc").eqNullSafe(F.col("_siftline_id")) & (F.col("_siftline_own") == F.col("_siftline_rid"))
    rows = rows.join(found.hint("merge"), same, "left").select(*columns, "_siftline_text", "_siftline_starts")
    kinds, at = dict(df.dtypes), len(columns)

    def make():
        def each(b):
            n, removed, spans, kept = [], [], [], []
            for text, starts in zip(b.column(at).to_pylist(), b.column(at + 1).to_pylist(), strict=True):
                own = units(text or "")
                cut = runs(own, set(starts or ()), min_words)
                edges = [0, *(v for s, e, _ in cut for v in (s, e)), len(text or "")]
                left = "".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)) if cut else text
                n.append(len(own)), removed.append(sum(k for *_, k in cut)), spans.append([(s, e) for s, e, _ in cut]), kept.append(left)
            counts = [pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
            if digests:
                chars = [sum(e - s for s, e in cut) for cut in spans]
                listed = [",".join(f"{s}-{e}" for s, e in cut) for cut in spans]
                shas = [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() for t in kept]
                return pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(chars, pa.int64()), pa.array(listed), pa.array(shas), pa.array([t or "" for t in kept])], ["doc_id", "n_units", "n_removed", "removed_chars", "removed", "kept_sha256", "text"])
            own = [pa.array(kept, pa.string()) if c == text_col else b.column(i) for i, c in enumerate(columns)]
            return pa.RecordBatch.from_arrays([*own, *counts, pa.array([[v for cut in c for v in cut] for c in spans], pa.list_(pa.int64()))], [*columns, "n_units", "n_removed", "removed"])

        return each

    if digests:
        return map_batches(rows, make, f"doc_id {kinds[id_col]}, n_units long, n_removed long, removed_chars long, removed string, kept_sha256 string, text string")
    return map_batches(rows, make, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", n_units long, n_removed long, removed array<long>")
