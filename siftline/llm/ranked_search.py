"""Ranked lexical search, score at a time over impact-ordered postings.

Terms are runs of ASCII letters and digits and of everything above U+007F, A-Z in lower case. A posting's impact is the
whole number (10**9 * tf) div (1000 * tf + 8 * m), where m weighs a document's length; a term's weight multiplies it, so
a query's score is a sum of integers and ranks are the same on every run.

Documents are read once: a written table has each document's length and its occurrences of the terms asked for. Counts
of all documents give the weights. Tasks then read that table by blocks of documents. In a block, the postings of a term
lie by falling impact, equal impacts together. A query adds the groups of all its terms, the largest contributions
first, to its documents' scores. The next group of each term bounds what it can still add; once no documents but FEW * k
at most can reach the k-th best score (of this block so far, or of the task's earlier blocks), the query stops, and the
scores of those documents are completed from the documents' own rows. Each task hands on k rows a query at most.

Queries are taken from their table in blocks of ITEMS rows and TERMS terms, each counted once a query (a longer query is a
block of its own); each block of queries meets all documents. So what executors are told has a bound, whatever the tables hold.

Defined results: null and empty texts, and texts without terms, count nowhere and match nothing; a query without terms,
or whose terms no document has, gives no row; repeated rows are documents, or queries, of their own; rows with a null
doc_id are ranked behind equal scores with one; empty tables give an empty result; texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import discard, map_batches, materialize

#: Queries, and their different terms in all, that meet the documents together.
ITEMS, TERMS = 4096, 1 << 17
#: Documents, and postings, of a block.
BLOCK, POSTINGS = 1 << 14, 1 << 22
#: A query stops when so many times k documents are left that bounds do not rule out.
FEW = 16
_PLAIN = bytes(c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of UTF-8 text; all bytes of letters beyond ASCII are above 127."""
    return text.translate(_PLAIN).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, length: int) -> int:
    return 25 + 75 * n * n_docs // length


@dataclass
class Queries:
    """A block of queries: their rows' numbers and how often each has which term, by the term's number."""

    terms: dict[bytes, int]
    counts: list[dict[int, int]]


def query_blocks(rows: Iterator, items: int = ITEMS, most: int = TERMS) -> Iterator[tuple[list, Queries]]:
    """Ids and queries of (id, text) rows, block by block."""
    ids, block, room = [], Queries({}, []), most
    for item, text in rows:
        found = Counter(terms_of((text or "").encode("utf-8", "surrogatepass")))
        if ids and (len(ids) >= items or len(found) > room):
            yield ids, block
            ids, block, room = [], Queries({}, []), most
        ids.append(item)
        room -= len(found)
        block.counts.append({block.terms.setdefault(t, len(block.terms)): n for t, n in found.items()})
    if ids:
        yield ids, block


class Block:
    """Postings of some documents: by document, and by term and falling impact."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.starts, self.terms, self.impacts = starts, terms, impacts  # a document's own row, starts[d] to starts[d + 1]
        self.size = len(starts) - 1
        doc = np.repeat(np.arange(self.size), np.diff(starts))
        order = np.lexsort((-impacts, terms))
        self.doc, self.falling = doc[order], -impacts[order]  # ascending, so that it can be bisected
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def completed(self, docs: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Whole scores; gains: what a term's impacts are multiplied by, 0 for terms not asked for."""
        n = self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(self.starts[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        sums = np.concatenate(([0], np.cumsum(gains[self.terms[at]] * self.impacts[at])))
        ends = np.cumsum(n)
        return sums[ends] - sums[ends - n]

    def best(self, gains: dict[int, int], k: int, floor: int, few: int = FEW) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that can be among the best k and reach `floor`, their scores, and the postings left unread.

        gains: term -> count in the query times weight. The best k are among them, with whole scores."""
        asked = [(g, self.first[t], self.first[t + 1]) for t, g in gains.items() if g > 0 and self.first[t] < self.first[t + 1]]
        if not asked:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        at = [a for _, a, _ in asked]
        score = np.zeros(self.size, np.int64)
        while True:
            left = [g * int(-self.falling[p]) if p < end else 0 for (g, _, end), p in zip(asked, at, strict=True)]
            rest = sum(left)
            least = floor
            if k < self.size:
                least = max(least, int(np.partition(score, self.size - k)[self.size - k]))
            reach = np.flatnonzero(score + rest >= max(least, 1))
            if rest == 0 or len(reach) <= few * k:
                break
            level = max(left) // 2 + 1  # groups from the largest contribution down to half of it
            for i, (g, _, end) in enumerate(asked):
                if left[i] >= level:
                    to = at[i] + int(np.searchsorted(self.falling[at[i] : end], -(-(-level // g)), "right"))
                    score[self.doc[at[i] : to]] -= g * self.falling[at[i] : to]  # a term has a document once
                    at[i] = to
        unread = sum(end - p for (_, _, end), p in zip(asked, at, strict=True))
        if unread:
            whole = np.zeros(len(self.first) - 1, np.int64)
            whole[list(gains)] = list(gains.values())
            return reach, self.completed(reach, whole), unread
        return reach, score[reach], 0


def _occurrences(docs: DataFrame, terms: dict[bytes, int], kind: str) -> DataFrame:
    """doc_id, n (all terms of the document), terms and counts (of those asked for, 32 bits each)."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)  # TERMS terms, or one query's

    def make():
        wanted = sent.value

        def each(b):
            n, which, often = [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                found = terms_of(text or b"")
                counts = Counter(found)
                mine = sorted((wanted[t], c) for t, c in counts.items() if t in wanted)
                n.append(len(found))
                which.append(np.array([t for t, _ in mine], np.int32).tobytes())
                often.append(np.array([c for _, c in mine], np.int32).tobytes())
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(which, pa.binary()), pa.array(often, pa.binary())], ["doc_id", "n", "terms", "counts"])

        return each

    return map_batches(docs, make, f"doc_id {kind}, n long, terms binary, counts binary")


def _frequencies(rows: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term is."""

    def count(batches):
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=n_terms)
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(df[has])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in rows.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term asked for
        out[r["term"]] = r["df"]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], n_docs: int, length: int, n_terms: int) -> Iterator[tuple[list, Block]]:
    """Ids and blocks of documents in the order of the batches."""

    def built(ids, which, often, n):
        sizes = np.array([len(w) // 4 for w in which], np.int64)
        tf = np.frombuffer(b"".join(often), np.int32).astype(np.int64)
        m = np.repeat(np.array([length_part(x, n_docs, length) for x in n], np.int64), sizes)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
        return ids, Block(np.concatenate(([0], np.cumsum(sizes))), np.frombuffer(b"".join(which), np.int32).astype(np.int64), impact, n_terms)

    held: tuple[list, list, list, list] = ([], [], [], [])
    postings = 0
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 1)), strict=True):
            if not row[1]:
                continue
            for column, value in zip(held, row, strict=True):
                column.append(value)
            postings += len(row[1]) // 4
            if len(held[0]) >= BLOCK or postings >= POSTINGS:
                yield built(*held)
                held, postings = ([], [], [], []), 0
    if held[0]:
        yield built(*held)


def _search(rows: DataFrame, queries: Queries, k: int, n_docs: int, length: int, kind: str) -> DataFrame:
    """item (number in the block), doc_id, score: at most k rows of a query from each task."""
    df = _frequencies(rows, len(queries.terms))
    weights = [weight(n_docs, int(d)) for d in df]
    gains = [{t: n * weights[t] for t, n in q.items()} for q in queries.counts]
    sent = rows.sparkSession.sparkContext.broadcast(gains)
    n_terms = len(queries.terms)

    def run(batches):
        top: list[list] = [[] for _ in sent.value]
        for ids, block in _blocks(batches, n_docs, length, n_terms):
            for item, gain in enumerate(sent.value):
                mine = top[item]
                docs, scores, _ = block.best(gain, k, mine[-1][0] if len(mine) == k else 1)
                if len(docs):
                    mine += [(s, ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True) if s > 0]
                    mine.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    del mine[k:]
        found = [(item, doc, s) for item, mine in enumerate(top) for s, doc in mine]
        for at in range(0, len(found), 1 << 14):
            part = found[at : at + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], id_kind), pa.array([x[2] for x in part], pa.int64())], ["item", "doc_id", "score"])

    id_kind = pa.string() if kind == "string" else pa.int64()
    return rows.mapInArrow(run, f"item int, doc_id {kind}, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", query: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query, all that score above 0 if fewer. Ids are texts or
    whole numbers."""
    spark = docs.sparkSession
    kinds = [k if k == "string" else "bigint" for k in (dict(docs.dtypes)[doc_id], dict(queries.dtypes)[item_id])]
    given = docs.select(docs[doc_id].cast(kinds[0]).alias("doc_id"), docs[text].alias("text"))
    asked = queries.select(queries[item_id].cast(kinds[1]), queries[query])
    out = spark.createDataFrame([], f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long")
    for ids, block in query_blocks(map(tuple, asked.toLocalIterator())):
        rows = materialize(_occurrences(given, block.terms, kinds[0]), "occurrences")
        sums = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
        if not sums["docs"] or not block.terms:
            discard(rows)
            continue
        found = materialize(_search(rows, block, k, sums["docs"], sums["length"], kinds[0]), "found")
        discard(rows)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        best = found.withColumn("rank", place).where(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kinds[1]}"))  # ITEMS rows at most
        out = out.unionByName(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
