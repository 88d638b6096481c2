"""Quality rules: repetition and length, then perplexity under a modified Kneser-Ney model of each language.

The model spells words: strings of ORDER code points, each behind ORDER - 1 marks at a word's start and with a mark at
its end, under the document's language. Spark counts them over all words of all documents. Counts of shorter strings are
continuation counts (how many different code points stand before them; occurrences at a word's start, which has nothing
before it). Each length has three discounts, for counts of one, two and more, from the counts of counts. Probabilities
are interpolated down to a uniform one over the code points of a language and one unseen.

A score is a sum, so the model is stored as what each string adds to a log probability: a context (the empty one too) its
backoff weight, a string its own value less what its shorter form and its context would give. A string is seen only if
its suffix and its context are, so adding what is found gives the model's value. The table of 64-bit hashes and addends
is cut by the first bits of the hash to shards of HELD entries at most on average, which tasks hold one at a time as
sorted arrays and look up by the step of their range; documents are read once for each shard, and the parts add up. No count is capped or dropped.

A document has two perplexities: by letter (code points and word ends) and by word. In each language, both have a lower
and an upper band: Tukey's fences, FENCE interquartile ranges beyond the quartiles, once of the log perplexities and
once of their distance from the median times the square root of the words, since a few words vary more. A document that is
outside both fences of either perplexity is rejected: too unlike its language, or too predictable. Quartiles come from
counts of all documents that pass the base rules in steps of 1 / STEPS; a language with fewer than LEAST of them rejects
none. Different languages are the different values of the language column; null is one more.

Defined results: null and empty texts have no words and fail the base rules; repeated rows count and are judged each; null
ids are like others; without a language column all is one language; an empty table gives an empty result; texts are read
whole; other columns are not read; code points 0, 2 and 3 count as U+FFFD in the model.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import discard, join_skewed, map_batches, materialize

ORDER = 5
BEGIN, END = "\x02", "\x03"
#: Addends that a task holds: a shard of the model.
HELD = 1 << 22
#: Words that a task remembers, or counts before it hands them on.
REMEMBERED = 1 << 19
#: Letters that are looked at together.
SLICE = 1 << 19
FENCE = 3.0
STEPS = 4096
LEAST = 100
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_CONTINUES = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(ORDER)], np.uint64)
_MARKS = ("\0", BEGIN, END)


def n_repeated(words: list[bytes], width: int = 5) -> int:
    """Words that lie in runs of `width` found twice or more."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(ids) == len(words) or len(words) <= width:
        return 0
    word = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    run, span = word, len(ids)  # numbers of runs, below span
    for k in range(1, width):
        if span * len(ids) >= 1 << 62:
            run = np.unique(run, return_inverse=True)[1]
            span = int(run.max()) + 1
        run, span = run[:-1] * len(ids) + word[k:], span * len(ids)
    ordered = np.sort(run)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    again = np.flatnonzero(np.isin(run, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    edges[again] += 1
    edges[again + width] -= 1
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 text and its words."""
    chars = len(text.translate(None, _SPACE + _CONTINUES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), n_repeated(words)


def seed_of(lang: str) -> int:
    """64 bits of a language, which begin the hash of each of its strings."""
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def hashed(letters: np.ndarray, at: np.ndarray, width: int, seed: int | np.ndarray, kind: int = 0) -> np.ndarray:
    """64-bit hashes of the strings of `width` letters that begin there; kind 1 marks them as contexts."""
    h = np.full(len(at), 2 * width + kind, np.uint64) + np.asarray(seed, np.uint64)
    for k in range(width):
        h += letters[at + k].astype(np.uint64) * _FACTORS[k]
        h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def plain(words: list[bytes]) -> list[str]:
    text = b" ".join(words).decode("utf-8", "replace")  # a space ends a broken code point as the end of a word does
    for mark in _MARKS:
        text = text.replace(mark, "\ufffd")
    return text.split(" ") if words else []


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words with their marks, where the string that ends with each letter begins, and letters a word."""
    letters = np.frombuffer("".join([f"{BEGIN * (ORDER - 1)}{w}{END}" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    return letters, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def slices(words: list[bytes]) -> Iterator[slice]:
    """Parts of the list of about SLICE bytes."""
    begin, room = 0, SLICE
    for i, w in enumerate(words):
        room -= len(w) + ORDER
        if room <= 0:
            yield slice(begin, i + 1)
            begin, room = i + 1, SLICE
    if begin < len(words):
        yield slice(begin, len(words))


def count(df: DataFrame) -> DataFrame:
    """lang, gram (ORDER code points), k: how often words of the language have it. df: text, lang."""

    def run(batches):
        held: dict[str, Counter] = defaultdict(Counter)
        size = 0

        def hand_on():
            for lang, counts in held.items():
                words, often = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                for part in slices(words):
                    letters, at, n = spelled(plain(words[part]))
                    _, some, inverse = np.unique(hashed(letters, at, ORDER, 0), return_index=True, return_inverse=True)
                    k = np.bincount(inverse, np.repeat(often[part], n)).astype(np.int64)
                    grams = np.ascontiguousarray(letters[at[some, None] + np.arange(ORDER)]).view(f"<U{ORDER}").ravel().tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(k)], ["lang", "gram", "k"])
            held.clear()

        for b in batches:
            for text, lang in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                mine = held[lang]
                size -= len(mine)
                mine.update((text or b"").split())
                size += len(mine)
                if size > REMEMBERED:
                    yield from hand_on()
                    size = 0
        yield from hand_on()

    parts = df.select("text", "lang").mapInArrow(run, "lang string, gram string, k long")
    return parts.groupBy("lang", "gram").agg(F.sum("k").alias("k"))


def discounts(c: dict[int, int]) -> tuple[float, float, float]:
    """What counts of one, two and more give up, from the number of strings with counts of 1 to 4. Never nothing, and never
    all of it; half of it where a number is missing."""
    y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.0
    found = [j - (j + 1) * y * c[j + 1] / c[j] if y and c[j] else j / 2 for j in (1, 2, 3)]
    return tuple(min(max(d, 0.05), j - 0.05) for j, d in enumerate(found, start=1))


def levels(counts: DataFrame) -> list[DataFrame]:
    """lang, gram, k for each length from 1 to ORDER, k: occurrences of the longest, else what can stand before them."""
    found = [counts]
    for width in range(ORDER - 1, 0, -1):
        longer = found[0].select("lang", F.substring("gram", 2, width).alias("gram"), "k")
        both = longer.groupBy("lang", "gram").agg(F.sum("k").alias("all"), F.count("*").alias("kinds"))
        k = F.when(F.substring("gram", 1, 1) == BEGIN, F.col("all")).otherwise(F.col("kinds"))  # before a mark are only marks
        found.insert(0, materialize(both.select("lang", "gram", k.alias("k")), f"level-{width}"))
    return found


def addends(counts: DataFrame) -> tuple[DataFrame, int]:
    """lang, gram, context (whether it is one), add, as a written table; and the number of different code points."""
    by_length = levels(counts)
    kinds = by_length[0].select("gram").distinct().count()
    written, out, lower = by_length[:-1], None, None
    for width, level in enumerate(by_length, start=1):
        several = level.groupBy(F.least("k", F.lit(5)).cast("int").alias("k")).count().collect()  # five rows
        d = discounts(defaultdict(int, {r["k"]: r["count"] for r in several}))
        off = F.when(F.col("k") == 1, d[0]).when(F.col("k") == 2, d[1]).otherwise(d[2])
        context = Window.partitionBy("lang", "before")  # as many rows as there are code points, at most
        own = level.select("lang", "gram", "k", F.substring("gram", 1, width - 1).alias("before"), off.alias("off"))
        total = F.sum("k").over(context)
        own = own.select("lang", "gram", "before", ((F.col("k") - F.col("off")) / total).alias("own"), (F.sum("off").over(context) / total).alias("rest"))
        if width == 1:
            own = own.withColumn("low", F.lit(1.0 / (kinds + 1)))
        else:
            shorter = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("low"))
            own = own.withColumn("suffix", F.substring("gram", 2, width - 1)).join(shorter, ["lang", "suffix"])
        lower = materialize(own.select("lang", "gram", "before", "rest", "low", (F.col("own") + F.col("rest") * F.col("low")).alias("p")), f"spelled-{width}")
        written.append(lower)
        grams = lower.select("lang", "gram", F.lit(False).alias("context"), F.log(F.col("p") / (F.col("rest") * F.col("low"))).alias("add"))
        contexts = lower.groupBy("lang", "before").agg(F.max("rest").alias("rest")).select("lang", F.col("before").alias("gram"), F.lit(True).alias("context"), F.log("rest").alias("add"))
        both = grams.unionByName(contexts)
        out = both if out is None else out.unionByName(both)
    stored = materialize(store(out), "addends")
    for table in written:
        discard(table)
    return stored, kinds


def store(table: DataFrame) -> DataFrame:
    """hash, add: the addends under the hashes of their strings."""

    def make():
        seeds: dict = {}

        def each(b):
            langs, grams, kinds = b.column(0).to_pylist(), b.column(1).to_pylist(), np.array(b.column(2).to_pylist(), np.uint64)
            seed = np.array([seeds[x] if x in seeds else seeds.setdefault(x, seed_of(x)) for x in langs], np.uint64)
            n = np.fromiter(map(len, grams), np.int64, len(grams))
            letters = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
            at, out = np.cumsum(n) - n, np.zeros(len(n), np.uint64)
            for width in np.unique(n).tolist():
                w = n == width
                out[w] = hashed(letters, at[w], width, seed[w] + kinds[w])
            return pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), b.column(3).cast(pa.float32())], ["hash", "add"])

        return each

    return map_batches(table, make, "hash long, add float")


def shards(stored: DataFrame, held: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted hashes and addends, by the first bits of the hash: `held` entries each, about."""
    bits = max(0, math.ceil(math.log2(max(stored.count(), 1) / held)))
    first = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0)
    for i in range(1 << bits):
        part = stored.where(first == i).toArrow()
        h = part["hash"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        yield h[order], part["add"].to_numpy()[order]


class Reader:
    """Sums of a shard's addends over a word, remembered by language."""

    def __init__(self, hashes: np.ndarray, adds: np.ndarray):
        self.hashes, self.adds = hashes, adds
        if len(hashes):  # hashes are even, so about one of them lies in a step of their range
            self.shift = np.uint64(max(0, int(hashes[-1] - hashes[0]).bit_length() - len(hashes).bit_length()))
            steps = ((hashes - hashes[0]) >> self.shift).astype(np.int64)
            self.begin = np.concatenate(([0], np.cumsum(np.bincount(steps)))).astype(np.int32)
        self.totals: dict[str, dict[bytes, float]] = defaultdict(dict)
        self.size = 0

    def add(self, wanted: np.ndarray) -> np.ndarray:
        out = np.zeros(len(wanted))
        if not len(self.hashes):
            return out
        left = np.flatnonzero((wanted >= self.hashes[0]) & (wanted <= self.hashes[-1]))
        step = ((wanted[left] - self.hashes[0]) >> self.shift).astype(np.int64)
        at, end = self.begin[step], self.begin[step + 1]
        while len(left):
            some = at < end
            left, at, end = left[some], at[some], end[some]
            same = self.hashes[at] == wanted[left]
            out[left[same]] = self.adds[at[same]]
            left, at, end = left[~same], at[~same] + 1, end[~same]
        return out

    def learn(self, lang: str, words: list[bytes]) -> None:
        seed = seed_of(lang)
        for part in slices(words):
            letters, at, n = spelled(plain(words[part]))
            _, some, inverse = np.unique(hashed(letters, at, ORDER, 0), return_index=True, return_inverse=True)
            total = np.zeros(len(some))
            for width in range(1, ORDER + 1):
                begin = at[some] + ORDER - width
                total += self.add(hashed(letters, begin, width, seed)) + self.add(hashed(letters, begin, width - 1, seed, 1))
            self.totals[lang].update(zip(words[part], np.add.reduceat(total[inverse], np.cumsum(n) - n).tolist(), strict=True))

    def read(self, langs: list[str], lists: list[list[bytes]]) -> list[float]:
        if self.size > REMEMBERED:
            self.totals.clear()
            self.size = 0
        new: dict[str, set[bytes]] = defaultdict(set)
        for lang, words in zip(langs, lists, strict=True):
            new[lang].update(words)
        for lang, words in new.items():
            unknown = list(words.difference(self.totals[lang]))  # this looks each word up; difference_update walks all that is known
            self.learn(lang, unknown)
            self.size += len(unknown)
        return [math.fsum(map(self.totals[lang].__getitem__, words)) for lang, words in zip(langs, lists, strict=True)]


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scores(df: DataFrame, shard: tuple[np.ndarray, np.ndarray], with_base: bool) -> DataFrame:
    """doc_id, lang, k1, k2 (128 bits of both), the base counts (with_base) and the sum of a shard's addends."""
    sent = df.sparkSession.sparkContext.broadcast(shard)  # HELD entries, about
    base = BASE if with_base else []

    def make():
        reader = Reader(*sent.value)

        def each(b):
            texts, langs = [t or b"" for t in b.column(4).cast(pa.binary()).to_pylist()], b.column(1).to_pylist()
            counts, total = [], []
            for at in range(0, len(texts), 256):
                lists = [t.split() for t in texts[at : at + 256]]
                total += reader.read(langs[at : at + 256], lists)
                if with_base:
                    counts += [base_counts(t, words) for t, words in zip(texts[at : at + 256], lists, strict=True)]
            columns = [pa.array([x[i] for x in counts], pa.int64()) for i in range(len(base))]
            return pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), *columns, pa.array(total, pa.float64())], ["doc_id", "lang", "k1", "k2", *base, "total"])

        return each

    keys = [F.xxhash64("lang", "text").alias("k1"), F.xxhash64("lang", "text", F.lit(1)).alias("k2")]
    kinds = f"doc_id {dict(df.dtypes)['doc_id']}, lang string, k1 long, k2 long, {''.join(f'{c} long, ' for c in base)}total double"
    return map_batches(df.select("doc_id", "lang", *keys, "text"), make, kinds)


def scored(df: DataFrame, held: int = HELD) -> DataFrame:
    """doc_id, lang, the base counts and log_p, the log probability of the whole text. df: doc_id, lang, text."""
    counts = materialize(count(df), "counts")
    stored, kinds = addends(counts)
    discard(counts)
    parts = [materialize(_scores(df, shard, i == 0), "scores") for i, shard in enumerate(shards(stored, held))]
    discard(stored)
    rows = parts[0]
    if len(parts) > 1:
        more = None
        for i, part in enumerate(parts[1:]):  # rows of equal texts have equal sums
            part = part.groupBy("k1", "k2").agg(F.max("total").alias("more")).withColumn("shard", F.lit(i))
            more = part if more is None else more.unionByName(part)
        more = more.groupBy("k1", "k2").agg(F.sum("more").alias("more")).join(rows.groupBy("k1", "k2").agg(F.count("*").alias("rows")), ["k1", "k2"])
        rows = join_skewed(rows, materialize(more, "sums"), ["k1", "k2"], "rows").withColumn("total", F.col("total") + F.col("more"))
    log_p = F.col("total") - (F.col("word_chars") + F.col("n_words")) * math.log(kinds + 1)
    return rows.select("doc_id", "lang", *BASE, log_p.alias("log_p"))


def quartiles(df: DataFrame, **values: Column) -> DataFrame:
    """lang, docs, and of each value the quartiles {name}_1, _2 and _3, in steps of 1 / STEPS."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.floor(v * STEPS).alias("step")) for n, v in values.items()]))
    steps = df.select("lang", named.alias("s")).groupBy("lang", "s.name", "s.step").agg(F.count("*").alias("n"))
    mine = Window.partitionBy("lang", "name")  # the steps of a language
    ranked = steps.select("lang", "name", "step", F.sum("n").over(mine.orderBy("step")).alias("upto"), F.sum("n").over(mine).alias("docs"))
    reached = lambda n, q: (F.col("name") == n) & (F.col("upto") * 4 >= F.col("docs") * q)
    at = [F.min(F.when(reached(n, q), (F.col("step") + 0.5) / STEPS)).alias(f"{n}_{q}") for n in values for q in (1, 2, 3)]
    return ranked.groupBy("lang").agg(F.max("docs").alias("docs"), *at)


def judge(df: DataFrame, text: str = "text", lang: str | None = "lang", doc_id: str = "doc_id", fence: float = FENCE, least: int = LEAST, held: int = HELD) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lang, letter_perplexity,
    word_perplexity (null without words)."""
    language = F.coalesce(F.concat(F.lit("+"), df[lang].cast("string")), F.lit("-")) if lang else F.lit("-")
    rows = materialize(scored(df.select(df[doc_id].alias("doc_id"), language.alias("lang"), df[text].alias("text")), held), "judged")
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.select("*", failed.alias("base_failed"), (-F.col("log_p") / (F.col("word_chars") + words)).alias("by_letter"), (-F.col("log_p") / words).alias("by_word"))
    fine, col, root = rows.where(~failed), F.col, F.sqrt("n_words")
    middle = materialize(quartiles(fine, letter=col("by_letter"), word=col("by_word")), "quartiles")
    apart = {"letter_z": (col("by_letter") - col("letter_2")) * root, "word_z": (col("by_word") - col("word_2")) * root}
    met = join_skewed(fine, middle, ["lang"], "docs").select("*", *[v.alias(n) for n, v in apart.items()])
    spread = quartiles(met, letter_z=col("letter_z"), word_z=col("word_z"))
    bands = materialize(middle.join(spread.drop("docs"), "lang").withColumn("few", col("docs") < least), "bands")
    judged = join_skewed(fine, bands, ["lang"], "docs").select("*", *[v.alias(n) for n, v in apart.items()])

    def beyond(value: str, name: str) -> Column:
        low, high = col(f"{name}_1"), col(f"{name}_3")
        return (col(value) < low - fence * (high - low)) | (col(value) > high + fence * (high - low))

    outside = (beyond("by_letter", "letter") & beyond("letter_z", "letter_z")) | (beyond("by_word", "word") & beyond("word_z", "word_z"))
    shown = [F.when(col("lang") != "-", F.substring(col("lang"), F.lit(2), F.length("lang"))).alias("lang"), F.exp("by_letter").alias("letter_perplexity"), F.exp("by_word").alias("word_perplexity")]
    passed = judged.select("doc_id", *BASE, "base_failed", (col("few") | ~outside).alias("kept"), *shown)
    return passed.unionByName(rows.where(failed).select("doc_id", *BASE, "base_failed", F.lit(False).alias("kept"), *shown))
