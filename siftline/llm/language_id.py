"""Language identification by rank-order n-gram profiles.

A profile lists a language's most frequent letter n-grams (n = 1..3, word boundaries marked) by rank. A document's own
list is compared with each profile by out-of-place distance: the sum of rank differences, the list's length for an
n-gram that the profile lacks. The language with the smallest distance is predicted; ties go to the first name.

Defined results: null texts and texts without a letter are `und` with score 0; without any learnable row everything is
`und`; repeated rows are predicted each; only the named columns are read; whole texts are profiled, however long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import map_batches, without

TOP = 300
EDGE = 1
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str) -> np.ndarray | None:
    """Codes of the 1-, 2- and 3-grams of a text, lower-cased, each run of other characters one boundary; None without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    symbols = np.where(is_letter, points, np.uint32(EDGE)).astype(np.uint64)
    before = np.empty_like(is_letter)
    before[0], before[1:] = True, is_letter[:-1]
    kept = symbols[is_letter | before]
    edge = np.array([EDGE], np.uint64)
    s = np.concatenate((edge, kept[int(kept[0] == EDGE) :], edge[: int(kept[-1] != EDGE)]))
    two = s[:-1] | s[1:] << np.uint64(21)
    return np.concatenate((s[s != EDGE], two, two[:-1] | s[2:] << np.uint64(42)))


def top_codes(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:top]]


@dataclass
class Profiles:
    """languages: names in order. codes: all n-grams of any profile, sorted. ranks[l, i]: rank in profile l, or -1."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    top: int = TOP

    @classmethod
    def of(cls, ranked: dict[str, list[int]], top: int = TOP) -> Profiles:
        names = sorted(ranked)
        codes = np.unique(np.array([c for n in names for c in ranked[n]], np.uint64))
        ranks = np.full((len(names), len(codes)), -1, np.int64)
        for i, n in enumerate(names):
            ranks[i, np.searchsorted(codes, np.array(ranked[n], np.uint64))] = np.arange(len(ranked[n]))
        return cls(names, codes, ranks, top)

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language and one minus its distance over the largest possible."""
        codes = ngrams(text) if text and self.languages else None
        if codes is None:
            return "und", 0.0
        mine = top_codes(codes, self.top)
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        theirs = np.where(self.codes[at] == mine, self.ranks[:, at], -1)
        apart = np.where(theirs < 0, self.top, np.minimum(np.abs(theirs - np.arange(len(mine))), self.top)).sum(1)
        best = int(np.argmin(apart))
        return self.languages[best], float(1 - apart[best] / (self.top * len(mine)))


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 4000, top: int = TOP) -> Profiles:
    """Profiles of each language of `labelled`.

    per_language bounds the sample: rows are taken by a hash of their id, about so many of each language at most.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = rows.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return Profiles.of({}, top)
    part = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    sample = rows.where((F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)) < part[F.col("lang")])

    def make():
        def each(batch):
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (codes := ngrams(text) if text else None) is not None:
                    by.setdefault(lang, []).append(np.stack(np.unique(codes, return_counts=True)))
            langs, codes, ns = [], [], []
            for lang, parts in by.items():
                both = np.concatenate(parts, 1)
                values, inverse = np.unique(both[0], return_inverse=True)
                langs += [lang] * len(values)
                codes.append(values.astype(np.int64))
                ns.append(np.bincount(inverse, both[1].astype(float)).astype(np.int64))
            if langs:
                return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(np.concatenate(codes)), pa.array(np.concatenate(ns))], ["lang", "code", "n"])
            return None

        return each

    totals = map_batches(sample.select("text", "lang"), make, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ranked: dict[str, list[int]] = {}
    for r in totals.withColumn("k", order).where(F.col("k") <= top).orderBy("lang", "k").collect():  # `top` rows per language
        ranked.setdefault(r["lang"], []).append(r["code"])
    return Profiles.of(ranked, top)


def predict(df: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """All columns of df and lang_pred, lang_score, which replace columns of these names."""
    model = df.sparkSession.sparkContext.broadcast(profiles)
    df = df.select(*without(df, "lang_pred", "lang_score"))
    columns, kinds = df.columns, dict(df.dtypes)

    def make():
        p = model.value

        def each(batch):
            found = [p.predict(t.as_py() or "") for t in batch.column(columns.index(text_col))]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*columns, "lang_pred", "lang_score"])

        return each

    return map_batches(df, make, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", lang_pred string, lang_score double")
