"""Removal of long byte strings that occur more than once, by a hash-compared suffix sort.

Every window of `length` bytes belongs to one anchor: the smallest hashed `GRAM`-byte string in it. Equal windows have
equal anchors at equal offsets, so only windows of one anchor string need comparing, and an anchor string that occurs
once rules out all of its windows. Windows next to each other with the same anchor are one segment. Segments that are
equal as a whole are found by digest; different segments of one anchor string are compared by sorting their suffixes:
a merge sort whose comparisons find the common extension of two suffixes by bisection over prefix polynomial hashes.
Windows that the sort puts together are verified byte by byte; whole segments are one if 160 bits of a cryptographic
digest agree, so that their bytes need not travel.

An anchor string that lies in very many different surroundings would put them all into one group. A group of more than
`GROUP` segments is divided: windows whose offsets from the anchor lie in one block of offsets have bytes in common,
and only those with the same ones need comparing. Pieces that are equal as a whole become one, what is left is sorted,
and groups that are still too large are divided by finer blocks; at one offset a group is one string. Keys that many
rows share are told to every task instead of being shuffled.

keep="none" removes every occurrence; keep="first" leaves the earliest one, by id and place.

Defined results: a null text is an empty one; a text shorter than `length` keeps all its bytes; copies and repeated rows
repeat each other; null ids come first in order; only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import discard, join_skewed, map_batches, materialize, without

GRAM = 48
#: Segments that are sorted together, at most, and the blocks of offsets by which larger groups are divided.
GROUP = 4096
BLOCKS = (64, 8, 1)
BASE = 0x9E3779B97F4A7C15 | 1
BUFFER = 1 << 19
WINDOWS = 1 << 19
PLACE = np.uint64((1 << 21) - 1)


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Prefix polynomial hashes of a buffer: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(19, int(len(data) + 1).bit_length())
        up, self.down = powers(size)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.prefix[1:])

    def of(self, start, length):
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]


def scatter(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values, by block-wise running minima from both sides."""
    n = len(a) - width + 1
    blocks = np.full(-(-len(a) // width) * width, np.iinfo(a.dtype).max, a.dtype)
    blocks[: len(a)] = a
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int):
    """For windows of the texts: arrays text number, start, n (windows), anchor (offset from start), key; and contents."""
    at, group, size = 0, [], 0
    pieces = [(i, s, t[s : s + BUFFER]) for i, t in enumerate(texts) for s in range(0, max(len(t) - length + 1, 0), BUFFER - length + 1)]
    while at < len(pieces):
        group, size = [], 0
        while at < len(pieces) and (not group or size + len(pieces[at][2]) <= BUFFER):
            group.append(pieces[at])
            size += len(pieces[at][2])
            at += 1
        yield from _segments_of(group, length)


def _segments_of(group: list[tuple[int, int, bytes]], length: int):
    joined = b"".join(p[2] for p in group)
    if len(joined) < length:
        return
    gram = min(GRAM, length)
    data = np.frombuffer(joined, np.uint8)
    starts = np.arange(len(data) - gram + 1)
    keys = scatter(Hashes(data).of(starts, gram))
    owner = (sliding_least((keys & ~PLACE) | starts.astype(np.uint64), length - gram + 1) & PLACE).astype(np.int64)
    lengths = np.array([len(p[2]) for p in group])
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    fine = lengths >= length
    # window starts of each piece, without those that reach into the next one
    ok = np.zeros(len(owner) + 1, np.int8)
    np.add.at(ok, firsts[fine], 1)
    np.add.at(ok, np.minimum(firsts[fine] + lengths[fine] - length + 1, len(owner)), -1)
    inside = np.cumsum(ok[:-1]) > 0
    change = np.ones(len(owner), bool)
    change[1:] = (owner[1:] != owner[:-1]) | ~inside[:-1]
    piece_starts = firsts[fine]
    change[piece_starts] = True
    begin = np.flatnonzero(change & inside)
    stop = np.flatnonzero(inside & np.append((change | ~inside)[1:], True)) + 1
    piece = np.searchsorted(firsts, begin, "right") - 1
    for b, e, p in zip(begin.tolist(), stop.tolist(), piece.tolist(), strict=True):
        number, offset, _ = group[p]
        o = int(owner[b])
        yield number, b - int(firsts[p]) + offset, e - b, o - b, int(keys[o]), joined[b : e + length - 1]


def digest(content: bytes, anchor: int) -> bytes:
    return hashlib.blake2b(content, digest_size=20, salt=anchor.to_bytes(8, "little", signed=True)).digest()


def _pass_segments(docs: DataFrame, length: int) -> DataFrame:
    """A row per segment: key, seg, doc_id, rid, start, n, anchor."""

    def make():
        def each(b):
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            for at in range(0, b.num_rows, 128):
                ids, rids = (b.column(c).slice(at, 128).to_pylist() for c in (0, 1))
                out: tuple[list, ...] = ([], [], [], [], [], [], [])
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(2).slice(at, 128).to_pylist()]
                for number, start, n, anchor, key, content in segments(texts, length):
                    for column, value in zip(out, (key - (1 << 63), digest(content, anchor), ids[number], rids[number], start, n, anchor), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "seg", "doc_id", "rid", "start", "n", "anchor"])

        return each

    return map_batches(docs.select("doc_id", "rid", "text"), make, "key long, seg binary, doc_id long, rid long, start int, n int, anchor int")


class SuffixSort:
    """Suffixes (window starts in one buffer), ordered within groups by their first `length` bytes."""

    def __init__(self, data: bytes, length: int):
        self.raw, self.length = data, length
        self.bytes = np.frombuffer(data, np.uint8)
        self.hashes = Hashes(self.bytes)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, up to `length`, by bisection over hashes."""
        low = np.zeros(len(x), np.int64)
        h = self.hashes
        whole = h.of(x, self.length) == h.of(y, self.length)
        low[whole] = self.length
        at = np.flatnonzero(~whole)
        x, y = x[at], y[at]
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.length, np.int64)  # equal up to lo, not up to hi
        for _ in range(self.length.bit_length()):
            mid = (lo + hi) >> 1
            same = h.of(x, mid) == h.of(y, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid)
            hi = np.maximum(hi, lo + 1)
        low[at] = lo
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: bool) -> np.ndarray:
        n = self.common(x, y)
        tied = n >= self.length
        end = np.minimum(n, self.length - 1)
        return np.where(tied, or_equal, self.bytes[x + end] < self.bytes[y + end])

    def sort(self, suffixes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bottom-up merge sort of consecutive groups of these sizes, all groups at a level together: each element's
        place among the other run is bisected. Returns the order."""
        order = np.arange(len(suffixes))
        if not len(sizes):
            return order
        start = np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        total = np.repeat(sizes, sizes)
        within = np.arange(len(suffixes)) - start
        width, most = 1, int(sizes.max(initial=0))
        while width < most:
            live = np.flatnonzero(total > width)
            pair = within[live] // (2 * width) * (2 * width)  # where the two runs begin, in the group
            mine_right = within[live] - pair >= width
            other = np.where(mine_right, pair, pair + width)
            n_other = np.clip(total[live] - other, 0, width)
            value = suffixes[order[live]]
            lo, hi = np.zeros(len(live), np.int64), n_other.astype(np.int64)
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                theirs = suffixes[order[start[live[open_]] + other[open_] + mid]]
                right = mine_right[open_]
                before = np.empty(len(open_), bool)  # does their element come before mine? the left run wins ties
                before[right] = self.less(theirs[right], value[open_[right]], True)
                before[~right] = self.less(theirs[~right], value[open_[~right]], False)
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            own = within[live] - pair - np.where(mine_right, width, 0)
            new = order.copy()
            new[start[live] + pair + own + lo] = order[live]
            order, width = new, 2 * width
        return order


def equal_windows(contents: list[bytes], n: np.ndarray, anchor: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that another segment of their group repeats: arrays segment, window, first (no earlier segment has it).

    Segments are in their order of precedence. Only windows at the same offset from the anchor are compared.
    """
    n_segments = len(contents)
    base = np.concatenate(([0], np.cumsum([len(c) for c in contents])[:-1])).astype(np.int64)
    sort = SuffixSort(b"".join(contents), length)
    segment = np.repeat(np.arange(n_segments), n)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    offset = anchor[segment] - window
    order = np.lexsort((segment, offset, group[segment]))
    segment, window, offset = segment[order], window[order], offset[order]
    new = np.ones(len(segment), bool)
    new[1:] = (group[segment[1:]] != group[segment[:-1]]) | (offset[1:] != offset[:-1])
    sizes = np.diff(np.append(np.flatnonzero(new), len(new)))
    many = np.repeat(sizes > 1, sizes)
    segment, window, sizes = segment[many], window[many], sizes[sizes > 1]
    at = base[segment] + window
    order = sort.sort(at, sizes)
    segment, window, at = segment[order], window[order], at[order]
    first = np.zeros(len(at), bool)
    first[np.cumsum(sizes) - sizes] = True
    same = np.zeros(len(at), bool)  # equal to the one before it
    inner = np.flatnonzero(~first)
    same[inner] = sort.hashes.of(at[inner], length) == sort.hashes.of(at[inner - 1], length)
    _verify(sort, segment, window, at, same, length)
    run = np.cumsum(~same) - 1
    counts = np.bincount(run, minlength=int(run[-1]) + 1 if len(run) else 0)
    least = np.full(len(counts), n_segments)
    np.minimum.at(least, run, segment)
    hit = counts[run] > 1
    return segment[hit], window[hit], (segment == least[run])[hit]


def _verify(sort: SuffixSort, segment, window, at, same, length) -> None:
    """Compare the bytes of windows that hashes call equal, stretches of windows at once; a collision is an error that a
    second base would mend, and has a chance below 1e-9 for each corpus of a petabyte."""
    j = np.flatnonzero(same)
    if not len(j):
        return
    order = np.lexsort((window[j], segment[j - 1], segment[j]))
    j = j[order]
    a, b, s, p = at[j], at[j - 1], segment[j], segment[j - 1]
    new = np.ones(len(j), bool)
    new[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1]) | (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(j))
    raw = sort.raw
    for x, y, k, m in zip(a[begin].tolist(), b[begin].tolist(), (end - begin).tolist(), begin.tolist(), strict=True):
        if raw[x : x + k + length - 1] != raw[y : y + k + length - 1]:
            for i in range(m, m + k):  # some window of the stretch differs after all
                if raw[a[i] : a[i] + length] != raw[b[i] : b[i] + length]:
                    same[j[i]] = False


def spans_of(windows: np.ndarray) -> list[int]:
    """Sorted window numbers as flat [first, past the last, ...]."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > 1)
    first = windows[np.concatenate(([0], cut + 1))]
    last = windows[np.concatenate((cut, [len(windows) - 1]))] + 1
    return np.stack((first, last), 1).ravel().tolist()


def _sorted_flags(contents: DataFrame, length: int) -> DataFrame:
    """For segments with content: repeated windows (spans) and those with an earlier equal (later), by suffix sort."""

    def run(batches):
        held: list[tuple] = []

        def flush(rows: list[tuple]):
            rows.sort(key=lambda r: (r[0], r[6], r[7], r[8]))
            group = np.unique([r[0] for r in rows], return_inverse=True)[1]
            s, w, is_first = equal_windows([r[2] for r in rows], np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), group, length)
            order = np.lexsort((w, s))
            s, w, is_first = s[order], w[order], is_first[order]
            cut = np.searchsorted(s, np.arange(len(rows) + 1))
            out = []
            for i in np.unique(s).tolist():
                part = slice(cut[i], cut[i + 1])
                out.append((rows[i][0], rows[i][1], spans_of(w[part]), spans_of(w[part][~is_first[part]])))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["key", "seg", "spans", "later"])

        windows = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in range(9)), strict=True):
                if held and windows >= WINDOWS and row[0] != held[-1][0]:
                    yield from flush(held)
                    held, windows = [], 0
                held.append(row)
                windows += row[3]
        if held:
            yield from flush(held)

    # null ids first: their order column is false
    rows = contents.select("key", "seg", "content", "n", "anchor", "segs", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "rid", "start")
    parts = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "key long, seg binary, spans array<int>, later array<int>")


def _cut(rows: DataFrame, length: int, block: int) -> DataFrame:
    """The segments' windows in pieces: those of one block of offsets. A piece's key hashes the bytes that all of the
    block's windows have, so equal windows have equal keys. key0, seg0, at: the segment it is from, and which window."""
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    names = ["key0", "seg0", "at", "key", "seg", "content", "n", "anchor", "doc_id", "rid", "start"]

    def make():
        def each(b):
            for i in range(b.num_rows):
                out: tuple[list, ...] = tuple([] for _ in names)
                key0, seg0, at, key, content, n, anchor, doc, rid, start = (b.column(c)[i].as_py() for c in range(10))
                for k in range((anchor - n + 1) // block, anchor // block + 1):
                    last = anchor - k * block  # window numbers that the whole block would have: up to last
                    first = last - block + 1
                    w, end = max(0, first), min(n - 1, last)
                    group = xxhash.xxh3_64_intdigest(content[last : first + length], seed=(key + k * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
                    piece = content[w : end + length]
                    row = (key0, seg0, at + w, group - (1 << 63), digest(piece, anchor - w), piece, end - w + 1, anchor - w, doc, rid, start + w)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

        return each

    wanted = rows.select("key0", "seg0", "at", "key", "content", "n", "anchor", "doc_id", "rid", "start")
    return map_batches(wanted, make, "key0 long, seg0 binary, at int, key long, seg binary, content binary, n int, anchor int, doc_id long, rid long, start int")


def _divided_flags(contents: DataFrame, length: int) -> DataFrame:
    """The same for groups of very many segments, divided by blocks of offsets until none is too large."""
    place = F.struct("doc_id", "rid", "start")
    rows = contents.select(F.col("key").alias("key0"), F.col("seg").alias("seg0"), F.lit(0).alias("at"), "key", "content", "n", "anchor", "doc_id", "rid", "start")
    found = []
    for block in BLOCKS:
        pieces = materialize(_cut(rows, length, min(block, length)), "pieces")
        alike = materialize(pieces.groupBy("key", "seg").agg(F.count("*").alias("copies"), F.min(place).alias("first")), "alike")
        per_key = materialize(alike.groupBy("key").agg(F.count("*").alias("segs"), F.sum("copies").alias("rows")), "pieces-per-key")
        crowded = per_key.where(F.col("segs") > GROUP) if block > 1 else per_key.limit(0)
        few = per_key if block == 1 else per_key.where(F.col("segs") <= GROUP)
        known = materialize(join_skewed(alike, few.select("key", "segs", F.col("segs").alias("weight")), ["key"], "weight"), "pieces-known")
        mine = join_skewed(pieces, known.withColumn("weight", F.col("copies")), ["key", "seg"], "weight").withColumn("is_first", place.eqNullSafe(F.col("first")))
        mine = materialize(mine, "pieces-placed")
        flags = materialize(_sorted_flags(mine.where("is_first and segs > 1"), length), "piece-flags")
        flagged = mine.drop("content").join(flags.hint("merge"), ["key", "seg"], "left").where("copies > 1 or spans is not null")
        whole = F.array(F.lit(0), F.col("n"))
        spans = F.when(F.col("copies") > 1, whole).otherwise(F.col("spans"))
        later = F.when(~F.col("is_first"), whole).otherwise(F.coalesce("later", F.array().cast("array<int>")))
        moved = lambda a: F.transform(a, lambda x: x + F.col("at"))
        found.append(materialize(flagged.select("key0", "seg0", moved(spans).alias("spans"), moved(later).alias("later")), "pieces-flagged"))
        for t in (alike, known, mine, flags):
            discard(t)
        if crowded.isEmpty():
            break
        rows = materialize(join_skewed(pieces.drop("seg"), crowded.select("key", "rows"), ["key"], "rows"), "crowded")
        discard(pieces)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    lists = every.groupBy(F.col("key0").alias("key"), F.col("seg0").alias("seg")).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("later")).alias("later"))

    def make():
        def each(b):
            arrays = [pa.array([joined(x) for x in b.column(c).to_pylist()], pa.list_(pa.int32())) for c in (2, 3)]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], ["key", "seg", "spans", "later"])

        return each

    return map_batches(lists, make, "key long, seg binary, spans array<int>, later array<int>")


def joined(flat: list[int]) -> list[int]:
    """Flat [first, past the last, ...] of ranges in any order, as the fewest ranges."""
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def repeated_spans(docs: DataFrame, length: int, keep: str) -> DataFrame:
    """doc_id, rid, found: byte ranges to remove (first, past the last), a row per document that has any."""
    everything = materialize(_pass_segments(docs, length), "segments")
    often = materialize(everything.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "repeated-keys")
    occurrences = materialize(join_skewed(everything, often, ["key"], "c"), "occurrences")
    discard(everything)
    discard(often)
    first = F.min(F.struct("doc_id", "rid", "start", "n", "anchor")).alias("first")
    distinct = occurrences.groupBy("key", "seg").agg(F.count("*").alias("copies"), first)
    distinct = materialize(distinct.select("key", "seg", "copies", "first.*"), "distinct-segments")
    per_key = materialize(distinct.groupBy("key").agg(F.count("*").alias("segs")).where("segs > 1"), "segments-per-key")
    wanted = join_skewed(distinct.drop("copies"), per_key.withColumn("weight", F.col("segs")), ["key"], "weight")
    contents = materialize(_contents(wanted, docs, length), "contents")
    flags = _sorted_flags(contents.where(F.col("segs") <= GROUP), length)
    crowded = contents.where(F.col("segs") > GROUP)
    if not crowded.isEmpty():
        flags = flags.unionByName(_divided_flags(crowded, length))
    flags = materialize(flags, "flags")
    for t in (contents, per_key):
        discard(t)
    info = distinct.select("key", "seg", "copies", F.struct("doc_id", "rid", "start").alias("first"), F.col("copies").alias("weight")).join(flags.hint("merge"), ["key", "seg"], "left")
    info = materialize(info.where("copies > 1 or spans is not null"), "segment-info")
    discard(flags)
    discard(distinct)
    placed = join_skewed(occurrences.select("key", "seg", "doc_id", "rid", "start", "n"), info, ["key", "seg"], "weight")
    whole = F.array(F.lit(0), F.col("n"))
    if keep == "none":
        ranges = F.when(F.col("copies") > 1, whole).otherwise(F.col("spans"))
    else:
        is_first = F.struct("doc_id", "rid", "start").eqNullSafe(F.col("first"))
        ranges = F.when(~is_first, whole).otherwise(F.coalesce("later", F.array().cast("array<int>")))
    placed = placed.select("doc_id", "rid", "start", ranges.alias("ranges")).where(F.size("ranges") > 0)
    out = materialize(placed.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "ranges")).alias("found")), "found")
    for t in (occurrences, info):
        discard(t)
    return out


def _contents(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted segments, cut from their documents."""
    lists = wanted.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("key", "seg", "start", "n", "anchor", "segs")).alias("w"))
    lists = lists.toDF("_id", "_rid", "w").hint("merge")
    both = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("rid") == F.col("_rid"))).select("rid", "text", "w", "doc_id")

    def make():
        def each(b):
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            for i in range(b.num_rows):
                out: tuple[list, ...] = tuple([] for _ in range(9))
                rid, text, w, doc = (b.column(c)[i].as_py() for c in range(4))
                data = (text or "").encode("utf-8", "surrogatepass")
                for s in w:
                    content = data[s["start"] : s["start"] + s["n"] + length - 1]
                    for column, value in zip(out, (s["key"], s["seg"], content, s["n"], s["anchor"], s["segs"], doc, rid, s["start"]), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "seg", "content", "n", "anchor", "segs", "doc_id", "rid", "start"])

        return each

    return map_batches(both, make, "key long, seg binary, content binary, n int, anchor int, segs long, doc_id long, rid long, start int").dropDuplicates(["key", "seg"])


def merged(found: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the flagged windows, maximal and in order."""
    ranges = sorted((f["start"] + f["ranges"][i], f["start"] + f["ranges"][i + 1] - 1 + length) for f in found for i in range(0, len(f["ranges"]), 2))
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(df: DataFrame, length: int = 400, keep: str = "none", id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """All columns of df with the text replaced by what remains, and n_bytes, n_removed, spans (array of first, past the
    last byte), which replace columns of these names. With digests only doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of
    the remaining bytes) and text.

    Where bytes are removed from within a character, its remaining bytes leave the replaced text too."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    rid = F.xxhash64(F.coalesce(df[text_col], F.lit("")))
    docs = df.select(df[id_col].cast("long").alias("doc_id"), rid.alias("rid"), df[text_col].alias("text"))
    found = repeated_spans(docs, length, keep).toDF("_siftline_id", "_siftline_rid", "_siftline_found")
    columns = [id_col] if digests else without(df, "n_bytes", "n_removed", "spans")
    rows = df.select(*[df[c] for c in columns], df[text_col].alias("_siftline_text"), df[id_col].cast("long").alias("_siftline_doc"), rid.alias("_siftline_own"))
    same = F.col("_siftline_doc").eqNullSafe(F.col("_siftline_id")) & (F.col("_siftline_own") == F.col("_siftline_rid"))
    rows = rows.join(found.hint("merge"), same, "left").select(*columns, "_siftline_text", "_siftline_found")
    kinds = dict(df.dtypes)

    def make():
        at = len(columns)

        def each(b):
            n, removed, spans, kept, shas = [], [], [], [], []
            for text, f in zip(b.column(at).to_pylist(), b.column(at + 1).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                gone = merged(f, length) if f else []
                n.append(len(data)), removed.append(sum(y - x for x, y in gone)), spans.append([v for r in gone for v in r])
                if gone:
                    edges = [0, *spans[-1], len(data)]
                    data = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                kept.append(data.decode("utf-8", "ignore") if gone else text)
                if digests:
                    shas.append(hashlib.sha256(data).hexdigest())
            counts = [pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
            if digests:
                return pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array(shas), pa.array([t or "" for t in kept])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])
            own = [pa.array(kept, pa.string()) if c == text_col else b.column(i) for i, c in enumerate(columns)]
            return pa.RecordBatch.from_arrays([*own, *counts, pa.array(spans, pa.list_(pa.int64()))], [*columns, "n_bytes", "n_removed", "spans"])

        return each

    if digests:
        return map_batches(rows, make, f"doc_id {kinds[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")
    return map_batches(rows, make, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", n_bytes long, n_removed long, spans array<long>")
