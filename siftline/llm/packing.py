"""Best-fit-decreasing packing of token sequences, exact at any size.

A segment tree over remaining capacities holds the open bins: leaf r counts the bins with r tokens free, and a descent
finds the tightest bin that still takes a piece. Bins with the same room are alike, so pieces of one length are placed
in runs: the tree works on a histogram of lengths (at most `capacity` entries), and its plan names ranges of pieces by
(length, rank among pieces of that length). The plan's size depends on the capacity, not on the corpus. Pieces get
their rank by a distributed count and look their place up in the plan.

Ids are those of the library's plain call: the string of a special token in a text becomes that token.

Defined results: a null text is an empty one, a single end token; repeated rows are packed each; null ids stay null;
an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.byte_bpe import byte_letters
from siftline.llm.common import map_batches, materialize, own_memory

#: Entries of a worker's memo of encoded words (some 100 MB); a full one stays as the older of two. Results do not depend on it.
MEMO = 500_000
_tokenizers: dict = {}


class _Memo(dict):
    """A dict that computes what it lacks."""

    def __init__(self, compute):
        self.compute = compute

    def __missing__(self, key):
        self[key] = value = self.compute(key)
        return value


#: How a definition must normalise and cut for texts to be encoded by chunks. Fixed values.
BY_CHUNKS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def by_chunks(definition: str) -> bool:
    """Does this tokenizer cut at white space, lower-case, and have no special token that a plain word could hold?"""
    known = json.loads(definition)
    odd = [t for t in known["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not re.search(r"[<>{}\[\]#@_~^]", t["content"]) or re.search(r"\s", t["content"])]
    return not odd and not known["truncation"] and known["post_processor"] is None and all(known[k] == v for k, v in BY_CHUNKS.items())


class WordCodec:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A tokenizer that `by_chunks` drops white space and never joins across it, so texts are cut there and each distinct
    chunk is encoded once. A chunk of Latin-1 letters with at most one mark behind it is two pre-tokens in lower case,
    which go straight to the tokenizer's merges; other chunks go through the whole tokenizer. Texts for any other
    tokenizer go through it whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_chunks = by_chunks(definition)
        self.plain = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([,.;:!?|]?)").fullmatch
        self.merge, self.letters = self.tokenizer.model.tokenize, dict(enumerate(byte_letters()))
        self.chunks, self.older = _Memo(self.encode_chunk), {}
        self.words = _Memo(self.encode_word)

    def encode_word(self, word: str) -> bytes:
        """One pre-token that normalisation leaves as it is."""
        return np.array([t.id for t in self.merge(word.encode().decode("latin-1").translate(self.letters))], "<u4").tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        if (old := self.older.get(chunk)) is not None:
            return old
        if m := self.plain(chunk):
            return self.words[m[1].lower()] + (self.words[m[2]] if m[2] else b"")
        return self.encode_whole(chunk)

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_chunks:
            return self.encode_whole(text)
        if len(self.chunks) > MEMO:
            self.older, self.chunks = dict(self.chunks), _Memo(self.encode_chunk)
        if len(self.words) > MEMO:
            self.words.clear()
        # str.split() also cuts at four separators that are no white space to the tokenizer
        odd = "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
        return b"".join(map(self.chunks.__getitem__, text.split(" ") if odd else text.split()))


def word_codec(definition: str) -> WordCodec:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = zlib.crc32(definition.encode())
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = WordCodec(definition)
        own_memory(__name__, _tokenizers.clear)
    return _tokenizers[key]


class CapacityTree:
    """Counts of open bins by remaining room, with intervals of bin numbers at each leaf."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, room: int, first: int, n: int) -> None:
        self.bins[room].append((first, n))
        self._bump(room, n)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to `most` bins of the last interval at this room: first number, how many."""
        first, n = self.bins[room].pop()
        if n > most:
            self.bins[room].append((first + most, n - most))
            n = most
        self._bump(room, -n)
        return first, n

    def tightest(self, length: int) -> int | None:
        """The smallest room of an open bin that is at least `length`, by one climb and one descent."""
        i = length + self.size
        while not self.count[i]:
            while i & 1:  # a right child, or the root: go up
                i >>= 1
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size

    def _bump(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1


def best_fit_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first_rank, n, first_bin, per_bin, offset): pieces of a length in rank order go per_bin to a bin,
    from first_bin on, the first of each bin at `offset`. Lengths go from long to short, each piece to the tightest bin."""
    tree, bins, plan = CapacityTree(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                per = capacity // length
                full, rest = divmod(left, per)
                for n_bins, k in ((full, per), (1 if rest else 0, rest)):
                    if n_bins:
                        plan.append((length, rank, n_bins * k, bins, k, 0))
                        if capacity - k * length:
                            tree.add(capacity - k * length, bins, n_bins)
                        bins, rank = bins + n_bins, rank + n_bins * k
                left = 0
            else:
                per = room // length  # once in a bin, the same bin is the tightest for the next equal piece
                first, n = tree.take(room, max(1, left // per))
                per = min(per, left)
                plan.append((length, rank, n * per, first, per, capacity - room))
                if room - per * length:
                    tree.add(room - per * length, first, n)
                rank, left = rank + n * per, left - n * per
    return np.array(plan, np.int64).reshape(-1, 6)


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Documents longer than the capacity are cut into full ones."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = df.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def make():
        codec = word_codec(definition.value)

        def each(batch):
            texts = batch.column(1)
            doc, piece, start, length, crc = [], [], [], [], []
            for at in range(0, len(texts), 256):
                rows = batch.column(0).slice(at, 256).to_pylist()
                for d, text in zip(rows, texts.slice(at, 256).to_pylist(), strict=True):
                    ids = codec.encode(text or "") + end
                    for k, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[begin : begin + 4 * capacity]
                        doc.append(d), piece.append(k), start.append(begin // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

        return each

    rows = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    return map_batches(rows, make, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to rows that have doc_id, piece and length (1..capacity).

    Ranks within a length come from row numbers in small hash-dealt groups plus the groups' running totals, so pieces
    that all have one length are still spread out.
    """
    spark = parts.sparkSession
    dealt = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    parts = materialize(parts.withColumn("_deal", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(dealt)).cast("int")), "pieces")
    counts = materialize(parts.groupBy("length", "_deal").agg(F.count("*").alias("_n")), "lengths")
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("length", "_deal", F.coalesce(before, F.lit(0)).alias("_base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # capacity rows at most
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("a piece is empty or longer than the capacity")
    plan = spark.sparkContext.broadcast(best_fit_plan(histogram, capacity))
    within = Window.partitionBy("length", "_deal").orderBy("doc_id", "piece", "start", "ids_crc32")
    # merged, as both sides are dealt by these columns; the totals grow with the number of deals and are not broadcast
    ranked = parts.withColumn("_row", F.row_number().over(within) - 1).join(base.hint("merge"), ["length", "_deal"])
    ranked = ranked.withColumn("_rank", F.col("_row") + F.col("_base")).drop("_row", "_base", "_deal")
    columns = [c for c in ranked.columns if c != "_rank"]
    kinds = dict(ranked.dtypes)

    def make():
        p = plan.value
        order = np.lexsort((p[:, 1], p[:, 0])) if len(p) else np.zeros(0, int)
        p = p[order]
        key = p[:, 0] * (1 << 45) + p[:, 1]

        def each(batch):
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            row = p[np.searchsorted(key, length.astype(np.int64) * (1 << 45) + rank, "right") - 1]
            nth = rank - row[:, 1]
            out = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            return pa.RecordBatch.from_arrays([*out, pa.array(row[:, 3] + nth // row[:, 4]), pa.array(row[:, 5] + nth % row[:, 4] * length)], [*columns, "sequence_id", "offset"])

        return each

    return map_batches(ranked, make, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", sequence_id long, offset long")
