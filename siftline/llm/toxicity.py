"""Toxicity from class-conditional Kneser-Ney models of words and of their spelling.

A text is its different words: runs of letters, digits and underscores in lower case, of LONGEST letters at most (a longer
run is several words). Counts are documents that hold a word. Each class has
p(w) = (max(n - D, 0) + D * kinds * shared(w)) / total, where shared(w) is the word's part of the counts of both classes:
what a class has not seen, it owes to both. A word is also spelled behind ORDER - 1 marks and with one mark at its end,
so that forms which share a stem share what is known of it: each class has
p(c|context) = (max(n - D, 0) + D * followers(context) * shared(c|shorter context)) / n(context) over contexts of
ORDER - 1 letters. The shorter contexts are shared by both classes and hold continuation counts: how many different
letters stand before a string, in either class.

A log ratio of the classes counts as far as it exceeds SURE standard errors of the two counts, or of what a class that
lacks the word should have had. So rare expressions say little by themselves, many words of no meaning do not add up to
noise, and a single insult shows in a long text. Strings that no labelled row has say nothing.

The two log-likelihoods of a whole text, by words and by spelling, are compared over the root of its number of different
words, which is how their chance differences grow. A logistic curve turns both into a probability. It is fitted on a
sample of labelled rows that the counts leave out; then these rows are counted too, so that the counts cover every
labelled row and word. A word counts once in a document, when it is counted and when it is scored. No count is capped,
cut off or dropped.

If more than SENT log ratios are not zero, the most frequent are sent to executors and all others are a table in the
shared folder, as long as the labelled rows make it; a text's words and strings that were not sent are joined to it.

Defined results: null and empty texts and texts without words get the base rate; without labelled rows of both classes
(an empty table is one case) every score is the base rate (0 without any); null ids and labels other than 0 and 1 are
not learned from; repeated rows are counted and scored each; texts are read whole; a column toxic_score is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import discard, map_batches, materialize, without

LONGEST = 256
WORDS = re.compile(r"\w{1,%d}" % LONGEST)
ORDER = 5
D = 0.75
BEGIN, END, WORD = "\x02", "\x03", "\x04"
#: Standard errors that a log ratio must exceed; what exceeds them counts.
SURE = 2.5
#: Log ratios that executors hold, the most frequent; all others are joined.
SENT = 1 << 20
#: Words that a task remembers when it scores, and those it counts before it hands on what it has.
REMEMBERED = 1 << 16
COUNTED = 1 << 18
#: Letters that are looked at together, and texts.
SLICE = 1 << 19
TEXTS = 64
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(LONGEST + 1)], np.uint64)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words with their marks, where each string of ORDER of them begins, and how many a word has."""
    letters = np.frombuffer("".join([f"{BEGIN * (ORDER - 1)}{w}{END}" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    return letters, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def codes(letters: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the strings of `width` letters that begin there."""
    h = np.full(len(at), width, np.uint64)
    for k in range(width):
        h += letters[at + k].astype(np.uint64) * _FACTORS[k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def codes_of(strings: list[str]) -> np.ndarray:
    """The same of strings of any lengths up to LONGEST + 1."""
    n = np.fromiter(map(len, strings), np.int64, len(strings))
    letters = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    at, out = np.cumsum(n) - n, np.zeros(len(n), np.uint64)
    for width in np.unique(n).tolist():
        out[n == width] = codes(letters, at[n == width], width)
    return out


def strings_at(letters: np.ndarray, at: np.ndarray, width: int) -> list[str]:
    return np.ascontiguousarray(letters[at[:, None] + np.arange(width)]).view(f"<U{width}").ravel().tolist() if len(at) else []


def slices(words: list[str], size: int):
    """The words in parts of about `size` letters."""
    begin, room = 0, size
    for i, w in enumerate(words):
        room -= len(w) + 1
        if room <= 0:
            yield words[begin : i + 1]
            begin, room = i + 1, size
    if begin < len(words):
        yield words[begin:]


@dataclass
class Ratios:
    """Sorted codes with a log ratio each."""

    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    @classmethod
    def of(cls, found: np.ndarray, ratio: np.ndarray) -> Ratios:
        order = np.argsort(found)
        return cls(found[order], np.asarray(ratio, np.float32)[order])

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Log ratios; nan for what is not there."""
        if not len(self.codes):
            return np.full(len(wanted), np.nan)
        k = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[k] == wanted, self.ratio[k].astype(float), np.nan)


@dataclass
class Model:
    sent: Ratios = field(default_factory=Ratios)
    joined: DataFrame | None = None  # code, ratio of all others
    base: float = 0.0
    slopes: tuple[float, float] = (0.0, 0.0)  # of words and of spelling
    shift: float = 0.0
    fitted: bool = False


class Reader:
    """Log ratios of words and of their spelling, remembered, and the codes that the sent table may lack."""

    def __init__(self, known: Ratios, all_sent: bool):
        self.known, self.all_sent = known, all_sent
        self.total: dict[str, tuple[float, float]] = {}
        self.open: dict[str, list[tuple[int, bool]]] = {}  # code, whether it is the word's own

    def learn(self, words: set[str]) -> None:
        for part in slices(list(words), SLICE >> 2):
            letters, at, n = spelled(part)
            named, strings = codes_of([WORD + w for w in part]), codes(letters, at, ORDER)
            own, x = self.known.find(named), self.known.find(strings)
            if not self.all_sent:
                for i in np.flatnonzero(np.isnan(own)).tolist():
                    self.open.setdefault(part[i], []).append((int(named[i].view(np.int64)), True))
                where = np.flatnonzero(np.isnan(x))
                for i, code in zip(np.repeat(np.arange(len(part)), n)[where].tolist(), strings[where].view(np.int64).tolist(), strict=True):
                    self.open.setdefault(part[i], []).append((code, False))
            by_letters = np.add.reduceat(np.nan_to_num(x), np.cumsum(n) - n)
            self.total.update(zip(part, zip(np.nan_to_num(own).tolist(), by_letters.tolist(), strict=True), strict=True))

    def read(self, texts: list[str]) -> list[list[str]]:
        """Different words of the texts in a fixed order, all remembered."""
        if len(self.total) > REMEMBERED:
            self.total.clear(), self.open.clear()
        lists = [sorted(set(words_of(t))) for t in texts]
        if new := set().union(*lists).difference(self.total):
            self.learn(new)
        return lists

    def sums(self, words: list[str]) -> tuple[float, float]:
        found = [self.total[w] for w in words]
        return sum(own for own, _ in found), sum(x for _, x in found)


def _count(rows: DataFrame) -> DataFrame:
    """code (of a word, or of a string of ORDER letters, which is the column gram; null for words), and the documents by
    class that hold the word, or whose words have the string, as often as they do: n0, n1; of them in the sample h0, h1."""
    names = ["code", "gram", "n0", "n1", "h0", "h1"]

    def run(batches):
        held: list[Counter] = [Counter() for _ in range(4)]

        def batch(code, gram, by):
            counts = by[0] + by[2], by[1] + by[3], by[2], by[3]
            return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(gram, pa.string()), *map(pa.array, counts)], names)

        def hand_on():
            for part in slices(list(set().union(*held)), SLICE):
                times = [np.array([h[w] for w in part], np.int64) for h in held]
                yield batch(codes_of([WORD + w for w in part]), [None] * len(part), times)
                letters, at, n = spelled(part)
                found, first, inverse = np.unique(codes(letters, at, ORDER), return_index=True, return_inverse=True)
                yield batch(found, strings_at(letters, at[first], ORDER), [np.bincount(inverse, np.repeat(t, n), len(found)).astype(np.int64) for t in times])
            for h in held:
                h.clear()

        for b in batches:
            for text, toxic, sample in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held[toxic + 2 * sample].update(set(words_of(text)))
                if sum(map(len, held)) > COUNTED:
                    yield from hand_on()
        yield from hand_on()

    parts = rows.select("text", "toxic", "held").mapInArrow(run, "code long, gram string, n0 long, n1 long, h0 long, h1 long")
    return parts.groupBy("code", "gram").agg(*[F.sum(c).alias(c) for c in names[2:]])


def _shared(seen: DataFrame) -> DataFrame:
    """gram (ORDER - 1 letters), p: probability of the last letter after the others, from continuation counts."""
    levels = [seen]
    for width in range(ORDER - 1, 0, -1):
        levels.append(levels[-1].groupBy(F.substring("gram", 2, width).alias("gram")).agg(F.count("*").alias("k")))
    every = levels[-1].agg(F.sum("k").alias("k"), F.count("*").alias("kinds")).first()
    at_least = F.greatest(F.col("k") - D, F.lit(0.0))
    p = levels[-1].select("gram", ((at_least + D * every["kinds"] / (every["kinds"] + 1)) / (every["k"] or 1)).alias("p"))
    for width in range(2, ORDER):
        context = Window.partitionBy(F.substring("gram", 1, width - 1))  # as many rows as there are letters, at most
        level = levels[ORDER - width].select("gram", "k", F.sum("k").over(context).alias("t"), F.count("*").over(context).alias("kinds"))
        shorter = p.select(F.col("gram").alias("end"), F.col("p").alias("low"))
        joined = level.withColumn("end", F.substring("gram", 2, width - 1)).join(shorter, "end")
        p = joined.select("gram", ((at_least + D * F.col("kinds") * F.col("low")) / F.col("t")).alias("p"))
    return p


def _sure(ratio: Column, low: Column, t0: Column, t1: Column) -> Column:
    """What of a log ratio exceeds SURE standard errors; of `t0` and `t1` counts, the part `low` is to be expected."""
    errors = [1 / F.greatest(F.col(f"n{c}"), t * low) for c, t in enumerate((t0, t1))]
    beyond = F.greatest(F.abs(ratio) - SURE * F.sqrt(errors[0] + errors[1]), F.lit(0.0))
    return F.when((t0 > 0) & (t1 > 0), F.signum(ratio) * beyond).otherwise(0.0).cast("float").alias("ratio")


def _ratios(counts: DataFrame, n0: Column, n1: Column) -> DataFrame | None:
    """code, n, ratio for such counts, with the strings' part written; None if a class has no word."""
    col, n = F.col, (F.col("n0") + F.col("n1")).alias("n")
    seen = counts.select("code", "gram", n0.alias("n0"), n1.alias("n1")).where("n0 + n1 > 0")
    words = seen.where("gram is null")
    sums = words.agg(*[f.alias(name) for c in "01" for f, name in ((F.sum(f"n{c}"), f"s{c}"), (F.count_if(col(f"n{c}") > 0), f"kinds{c}"))]).first()
    if not sums["s0"] or not sums["s1"]:
        return None
    part = n / (sums["s0"] + sums["s1"])
    mine = [(F.greatest(col(f"n{c}") - D, F.lit(0.0)) + D * sums[f"kinds{c}"] * part) / sums[f"s{c}"] for c in "01"]
    words = words.select("code", n, _sure(F.log(mine[1] / mine[0]), part, F.lit(sums["s0"]), F.lit(sums["s1"])))

    p = _shared(seen.where("gram is not null"))
    context = Window.partitionBy(F.substring("gram", 1, ORDER - 1))  # as many rows as there are letters, at most
    own = seen.where("gram is not null").withColumn("end", F.substring("gram", 2, ORDER - 1))
    for c in "01":
        own = own.withColumn(f"t{c}", F.sum(f"n{c}").over(context)).withColumn(f"kinds{c}", F.count_if(col(f"n{c}") > 0).over(context))
    rest = lambda c: F.when(col(f"t{c}") > 0, D * col(f"kinds{c}") / col(f"t{c}")).otherwise(1.0)  # noqa: E731  what the shared level has
    had = lambda c: F.when(col(f"t{c}") > 0, F.greatest(col(f"n{c}") - D, F.lit(0.0)) / col(f"t{c}")).otherwise(0.0) + rest(c) * col("low")
    grams = own.join(p.select(col("gram").alias("end"), col("p").alias("low")), "end")
    grams = materialize(grams.select("code", n, _sure(F.log(had(1) / had(0)), n / (col("t0") + col("t1")), col("t0"), col("t1"))), "ratios")
    both = grams.unionByName(words)
    both._siftline_path = grams._siftline_path
    return both


def _split(model: Model, ratios: DataFrame) -> Model:
    """The model with SENT log ratios at most at hand: all, or all that are not zero, or the most frequent with those of
    the others that are not zero as a table."""
    step, tells = F.floor(F.log2("n") * 4), F.col("ratio") != 0
    steps = sorted((tuple(r) for r in ratios.groupBy(step.alias("step")).agg(F.count("*"), F.count_if(tells)).collect()), reverse=True)  # some 200 rows at most
    if sum(n for _, n, _ in steps) <= SENT:
        top, joined = ratios, None
    elif sum(n for _, _, n in steps) <= SENT:
        top, joined = ratios.where(tells), None
    else:
        least, room = float("inf"), SENT
        for at, n, _ in steps:
            room -= n
            if room < 0:
                break
            least = at
        rare = F.lit(True) if least == float("inf") else step < least
        top, joined = ratios.where(~rare), ratios.where(rare & tells).select("code", "ratio")
    held = top.select("code", "ratio").toArrow()  # SENT rows at most
    return replace(model, sent=Ratios.of(held["code"].to_numpy().view(np.uint64), held["ratio"].to_numpy()), joined=joined)


def learn(labelled: DataFrame, calibration: int = 20_000) -> Model:
    """Model from rows with id, text, toxic (0 or 1). A sample by a hash of id, a fifth of the rows and about `calibration`
    at most, fits the curve before it is counted with the others. `labelled` is read three times: for its labels, all of
    it, and the sample."""
    rows = labelled.where("id is not null and text is not null and toxic in (0, 1)").select("id", "text", F.col("toxic").cast("int").alias("toxic"))
    model, by = Model(), {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    total = sum(by.values())
    model.base = by.get(1, 0) / total if total else 0.0
    if len(by) < 2:
        return model
    part = int(min(0.2, calibration / total) * (1 << 20))
    held = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < part
    counts = materialize(_count(rows.withColumn("held", held.cast("int"))), "counts")
    others = _ratios(counts, F.col("n0") - F.col("h0"), F.col("n1") - F.col("h1"))
    if others is not None:
        sample = _evidence(rows.where(held).select("text", "toxic"), _split(model, others), "text", ["toxic"])
        got = np.array([tuple(r) for r in sample.select("_siftline_w", "_siftline_x", "toxic").where("_siftline_x is not null").collect()], float).reshape(-1, 3)  # `calibration` rows
        discard(others)
        if len(set(got[:, 2])) == 2:
            model.slopes, model.shift = fit_logistic(got[:, :2], got[:, 2], logit(model.base))
            ratios = _ratios(counts, F.col("n0"), F.col("n1"))
            model = replace(_split(model, ratios), fitted=True)
            if model.joined is not None:
                return model  # it reads both tables
            discard(ratios)
    discard(counts)
    return model


def logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def fit_logistic(x: np.ndarray, y: np.ndarray, base: float) -> tuple[tuple[float, ...], float]:
    """Slopes of the columns of x (never negative: a column that would have such a one is left out) and shift, with a weak
    ridge on the slopes. Newton steps are halved until the loss falls: it is convex, so they end at its least value, while
    whole steps may swing past it for ever where the classes are far apart."""
    mean, sd = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    used = list(range(x.shape[1]))
    while True:
        z = np.vstack((((x - mean) / sd).T[used], np.ones(len(x))))
        ridge = np.array([1e-2] * len(used) + [0])
        b = np.array([0.0] * len(used) + [base])
        loss = lambda v: float(np.logaddexp(0, v @ z).sum() - v @ z @ y + (ridge * v * v).sum() / 2)
        now, gain = loss(b), float("inf")
        while gain > 1e-9:
            p = 1 / (1 + np.exp(-np.clip(b @ z, -40, 40)))
            step = np.linalg.solve((z * (p * (1 - p))) @ z.T + np.diag(ridge + 1e-6), z @ (p - y) + ridge * b)
            tried = next((t for t in (b - step / 2.0**k for k in range(40)) if loss(t) < now), b)
            b, gain = tried, now - loss(tried)
            now -= gain
        if (b[:-1] >= 0).all():
            break
        used.pop(int(np.argmin(b[:-1])))
    slopes = np.zeros(x.shape[1])
    slopes[used] = b[:-1] / sd[used]
    return tuple(slopes.tolist()), float(b[-1] - slopes @ mean)


def _missing(df: DataFrame, model: Model, sent, text_col: str, key: list[Column]) -> DataFrame:
    """k1, k2 (128 bits of a text) and the sums of the log ratios that executors do not hold, of its words and strings."""

    def make():
        reader = Reader(sent.value, False)

        def each(batch):
            for at in range(0, batch.num_rows, TEXTS):
                out: tuple[list, ...] = tuple([] for _ in range(5))
                k1, k2, texts = (batch.column(c).slice(at, TEXTS).to_pylist() for c in range(3))
                for a, b, words in zip(k1, k2, reader.read([t or "" for t in texts]), strict=True):
                    for (code, own), n in Counter(item for w in words for item in reader.open.get(w, ())).items():
                        for column, value in zip(out, (a, b, code, own, n), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["k1", "k2", "code", "own", "n"])

        return each

    # copies of a text ask the same, so each asks once
    texts = df.select(key[0].alias("k1"), key[1].alias("k2"), F.col(text_col).alias("text")).groupBy("k1", "k2").agg(F.any_value("text").alias("text"))
    asked = map_batches(texts, make, "k1 long, k2 long, code long, own boolean, n long")
    found = asked.join(model.joined.hint("merge"), "code")
    value = F.col("ratio") * F.col("n")
    return found.groupBy("k1", "k2").agg(F.sum(F.when(F.col("own"), value)).alias("w"), F.sum(F.when(~F.col("own"), value)).alias("x"))


def _evidence(df: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of df, _siftline_w and _siftline_x: evidence of words and of spelling (null without words)."""
    sent = df.sparkSession.sparkContext.broadcast(model.sent)
    kinds, whole = dict(df.dtypes), model.joined is None
    key = [F.xxhash64(df[text_col]), F.xxhash64(df[text_col], F.lit(1))]
    rows = df.select(*[df[c] for c in keep], df[text_col].alias("_siftline_text"), *([] if whole else [k.alias(n) for k, n in zip(key, ("_siftline_k1", "_siftline_k2"), strict=True)]))
    carried = [*keep, *([] if whole else ["_siftline_k1", "_siftline_k2"])]
    at = len(keep)

    def make():
        reader = Reader(sent.value, whole)

        def each(batch):
            found = []
            for begin in range(0, batch.num_rows, TEXTS):
                found += [(*reader.sums(words), len(words)) for words in reader.read([t or "" for t in batch.column(at).slice(begin, TEXTS).to_pylist()])]
            own = [batch.column(i) for i in range(batch.num_columns) if i != at]
            sums = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.float64(), pa.float64(), pa.int64()), strict=True)]
            return pa.RecordBatch.from_arrays([*own, *sums], [*carried, "_siftline_w", "_siftline_x", "_siftline_n"])

        return each

    kinds |= {"_siftline_k1": "bigint", "_siftline_k2": "bigint"}
    out = map_batches(rows, make, ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "_siftline_w double, _siftline_x double, _siftline_n long"]))
    w, x, n = F.col("_siftline_w"), F.col("_siftline_x"), F.col("_siftline_n")
    if not whole:
        more = _missing(df, model, sent, text_col, key).toDF("_siftline_k1", "_siftline_k2", "_siftline_more_w", "_siftline_more_x")
        out = out.join(more.hint("merge"), ["_siftline_k1", "_siftline_k2"], "left")
        w, x = w + F.coalesce("_siftline_more_w", F.lit(0.0)), x + F.coalesce("_siftline_more_x", F.lit(0.0))
    return out.select(*keep, F.when(n > 0, w / F.sqrt(n)).alias("_siftline_w"), F.when(n > 0, x / F.sqrt(n)).alias("_siftline_x"))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of df (all by default) and toxic_score, which replaces a column of this name."""
    keep = [c for c in without(df, "toxic_score") if keep is None or c in keep]
    if not model.fitted:
        return df.select(*keep).withColumn("toxic_score", F.lit(model.base))
    z = model.shift + model.slopes[0] * F.col("_siftline_w") + model.slopes[1] * F.col("_siftline_x")
    z = F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0))
    return _evidence(df, model, text_col, keep).withColumn("toxic_score", F.when(F.col("_siftline_x").isNull(), model.base).otherwise(1 / (1 + F.exp(-z)))).drop("_siftline_w", "_siftline_x")
