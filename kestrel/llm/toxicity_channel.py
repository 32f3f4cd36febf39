"""Toxicity with noisy-channel deobfuscation.

A character trigram model is counted by Spark over all documents (a folded alphabet of 32 symbols,
so it has 32^3 cells whatever the corpus). Strings with a look-alike, a separator or a doubled letter become
a lattice: each character may stand for itself, for the letters it imitates, or for nothing (separators,
repeats), and a separator may also end a word. Viterbi finds the restored words of least channel plus
language-model cost; strings of more than ``WINDOW`` characters are decided window by window, so time and
memory are in proportion to the text. Strings without any disguise are their own only path. Letters
written apart ("b a d") are read as one such string. Features come from the string as written and as restored.

The restored words and their beginnings are the features of a logistic regression. It is fitted on
at most ``SAMPLE`` labelled training rows (those of the smallest id hash); features are the
``FEATURES`` most telling ones by the log-likelihood ratio. Counts for the trigram model cover every
document, scoring every whole text.

Defined results: a null text is the empty text and gets the score of no features; a null ``toxic``
is no label; a document labelled more than once takes the highest label; a null ``doc_id`` counts
as held out; repeated rows get equal scores; without labels every score is 0.25.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table
from kestrel.llm.shingles import text_runs

FOLDS = 5
SAMPLE, FEATURES, MIN_DOCS = 20_000, 2_000, 4
CACHE_WORDS = 200_000
MAX_WORD = 40  # of longer strings only the parts in ASCII are read, and the whole is not kept in memory
WINDOW = 64  # characters that one path is searched over

# What a character may imitate (fixed values).
IMITATES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
            "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "¡": "i", "*": "aeiou", "#": "aeiou"}
SEPARATORS = " .-_*~'`^,:;/\\"
# Channel costs, as negative natural logarithms.
KEEP, IMITATE, SKIP_SEPARATOR, BREAK, SKIP_REPEAT, SKIP_OTHER = 0.05, 0.7, 0.3, 0.3, 0.6, 4.0

BITS = 5
_FOLD = np.zeros(256, np.int64)
_FOLD[ord("a"):ord("z") + 1] = np.arange(1, 27)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_FOLD[128:] = 27 + np.arange(128) % 5


def symbol(char: str) -> int:
    return int(_FOLD[char.encode()[-1]])


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of (before last, last, next) symbols over all documents; 0 is any run of non-letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 3 * BITS, np.int64)
        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                s = _FOLD[np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)]
                s = s[(s != 0) | np.concatenate([[True], s[:-1] != 0])]
                if len(s) > 2:
                    total += np.bincount((s[:-2] << 2 * BITS) | (s[1:-1] << BITS) | s[2:], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 3 * BITS, np.int64)
    for r in rows:
        counts[r["gram"]] = r["n"]
    return counts


def costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of the next symbol after two, smoothed with the pair's distribution."""
    n = 1 << BITS
    tri = counts.reshape(n, n, n).astype(float)
    bi = tri.sum(axis=0)
    uni = (bi.sum(axis=0) + 1) / (bi.sum() + n)
    p2 = (bi + 5 * uni) / (bi.sum(axis=1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


def restore(text: str, cost: np.ndarray) -> str:
    """The least costly reading of one disguised string (lower case), words parted by one space. States are
    the last two symbols and the last letter."""
    states: dict[tuple[int, int, str], tuple[float, str]] = {(0, 0, ""): (0.0, "")}
    done = []
    for i, char in enumerate(text):
        if i and i % WINDOW == 0:
            (total, out), way = min((v, k) for k, v in states.items())
            done.append(out)
            states = {way: (total, "")}
        options = [(c, IMITATE) for c in IMITATES.get(char, "")]
        if symbol(char):
            options.append((char, KEEP))
        if char in SEPARATORS:
            options.append(("", SKIP_SEPARATOR))
        elif not symbol(char):
            options.append(("", SKIP_OTHER))
        nxt: dict[tuple[int, int, str], tuple[float, str]] = {}
        for (a, b, last), (total, out) in states.items():
            for letter, price in options + [(" ", BREAK)] if char in SEPARATORS and last not in ("", " ") else options:
                if letter:
                    s = symbol(letter)
                    way, value, word = (b, s, letter), total + price + cost[a, b, s], out + letter
                else:
                    way, value, word = (a, b, last), total + price, out
                if way not in nxt or value < nxt[way][0]:
                    nxt[way] = (value, word)
            if last and (char == last or last in IMITATES.get(char, "")):  # a repeat of the letter before
                value = total + SKIP_REPEAT
                if (a, b, last) not in nxt or value < nxt[a, b, last][0]:
                    nxt[a, b, last] = (value, out)
        states = nxt
    return "".join(done) + min((total + cost[a, b, 0], out) for (a, b, _), (total, out) in states.items())[1]


_EDGE = re.compile(r"^[^\w@$!|+(<€¡]+|(?:[.,;:!?)\]}\"'>]+|([^\w\s])\1{2,})+$")
_REPEAT = re.compile(r"(.)\1")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|])(?:[ ._*-]+(?:[^\W_]|[@$!|])){2,}(?!\S)")
_ASCII = re.compile(r"[!-~€¡]+")
_POINTS = ".,;:!?()[]{}\"'<>"


def disguised(word: str) -> bool:
    """Letters with a look-alike or separator among them, a doubled letter, or look-alikes alone that are no number."""
    if word.isalpha():
        return _REPEAT.search(word) is not None
    if any(map(str.isalpha, word)):
        return any(c in IMITATES or c in SEPARATORS for c in word) or _REPEAT.search(word) is not None
    return len(word) > 2 and all(c in IMITATES for c in word) and not word.lstrip("$+<").isdigit()


@dataclass
class Restorer:
    cost: np.ndarray
    limit: int = CACHE_WORDS
    known: dict[str, frozenset[str]] = field(default_factory=dict)

    def word(self, raw: str) -> str:
        """The restored form of one string between white space, in lower case; a long one as it is."""
        plain = _EDGE.sub("", raw)
        return restore(plain, self.cost) if len(plain) <= MAX_WORD and disguised(plain) else plain

    def readings(self, raw: str) -> frozenset[str]:
        """The words that one string between white space may stand for: as written and as restored."""
        found = self.known.get(raw)
        if found is None:
            plain = _EDGE.sub("", raw)
            words = {plain}
            for piece in [plain] if len(plain) <= MAX_WORD else _ASCII.findall(plain):
                if disguised(piece):
                    words.update(restore(piece, self.cost).split(" "))
            masked = raw.strip(_POINTS)
            if len(plain) < 3 and masked != plain and ("*" in masked or "#" in masked):
                words.add(masked)  # a word of which little is left
            found = frozenset(words - {""})
            if len(self.known) < self.limit and len(raw) <= WINDOW:
                self.known[raw] = found
        return found

    def spelled(self, low: str) -> set[str]:
        """Words whose letters are written apart."""
        return {w for m in _SPELLED.finditer(low) if any(map(str.isalpha, m.group()))
                for w in restore(m.group(), self.cost).split(" ") if w}

    def words(self, text: str) -> set[str]:
        low = text.lower()
        return self.spelled(low).union(*map(self.readings, set(low.split())))


def features(words: set[str]) -> set[str]:
    """Whole words, and their first four and five letters."""
    return {f"w {w}" for w in words} | {f"p {w[:k]}" for w in words for k in (4, 5) if len(w) > k}


def bucket(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


@dataclass
class Model:
    cost: np.ndarray
    names: list[str]
    weight: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: int = FEATURES) -> Model:
    cost = costs(count_trigrams(docs))
    spark = docs.sparkSession
    # At most ``sample`` rows: small by that parameter, so it is broadcast.
    chosen = (labels.where((bucket(F.col("doc_id"), FOLDS) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    picked = docs.select("doc_id", "text").join(F.broadcast(materialize(chosen, "tox-sample")), "doc_id").select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(cost)
        for batch in batches:
            for lo, texts in text_runs(batch.column(1)):
                found = [sorted(features(restorer.words(t.decode()))) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)).cast(pa.int32()),
                                                  pa.array(found, pa.list_(pa.string()))], names=["toxic", "names"])

    rows = materialize(picked.mapInArrow(run, "toxic int, names array<string>"), "tox-features")
    sizes = {bool(r["toxic"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(True, 0), sizes.get(False, 0)
    if not pos or not neg:
        return Model(cost, [], np.zeros(0), float(np.log((pos + 0.5) / (neg + 1.5))))
    by_name = (rows.select((F.col("toxic") > 0).cast("long").alias("y"), F.explode("names").alias("name"))
               .groupBy("name").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS))
    expected = F.col("n") * (pos / (pos + neg))
    term = lambda seen, want: F.when(seen > 0, seen * F.log(seen / want)).otherwise(F.lit(0.0))
    ratio = term(F.col("a"), expected) + term(F.col("n") - F.col("a"), F.col("n") - expected)
    names = [r["name"] for r in by_name.withColumn("g", ratio).orderBy(F.col("g").desc(), "name").limit(limit).collect()]
    index = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "name string, i int")
    cells = (rows.withColumn("row", F.monotonically_increasing_id()).select("row", "toxic", F.explode_outer("names").alias("name"))
             .join(F.broadcast(index), "name", "left").groupBy("row").agg(F.max("toxic").alias("toxic"), F.collect_list("i").alias("i")))
    got = cells.select("toxic", "i").collect()  # at most ``sample`` rows of at most ``limit`` numbers
    y = np.array([r["toxic"] > 0 for r in got], float)
    weight, bias = logistic([np.array(r["i"], np.int64) for r in got], y, len(names))
    return Model(cost, names, weight, bias)


def logistic(rows: list[np.ndarray], y: np.ndarray, width: int, ridge: float = 0.2, rounds: int = 300) -> tuple[np.ndarray, float]:
    """L2 logistic regression on 0/1 features; AdaGrad steps, so rare and frequent features learn alike."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows) if len(at) else np.zeros(0, np.int64)
    w, b = np.zeros(width), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    w2, b2 = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        d = 1 / (1 + np.exp(-(b + np.bincount(at, w[col], len(rows))))) - y
        g = np.bincount(col, d[at], width) + ridge * w
        w2 += g * g
        b2 += d.sum() ** 2
        w -= 0.5 * g / np.sqrt(w2)
        b -= 0.5 * d.sum() / np.sqrt(b2)
    return w, float(b)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of documents(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        restorer, index = Restorer(m.cost, 0), {n: i for i, n in enumerate(m.names)}  # known holds what it finds
        known: dict[str, tuple] = {}

        def telling(raw: str) -> tuple:
            got = known.get(raw)
            if got is None:
                got = tuple(index[f] for f in features(restorer.readings(raw)) if f in index)
                if len(known) < CACHE_WORDS and len(raw) <= WINDOW:
                    known[raw] = got
            return got

        for batch in batches:
            for lo, texts in text_runs(batch.column(1)):
                score = []
                for t in texts:
                    low = t.decode().lower()
                    found = set().union(*map(telling, set(low.split())))
                    found.update(index[f] for f in features(restorer.spelled(low)) if f in index)
                    score.append(m.bias + sum(m.weight[i] for i in sorted(found)))
                p = 1 / (1 + np.exp(-np.clip(np.array(score, float), -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)).cast(pa.int64()), pa.array(p)],
                                                 names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op6_noisy_channel_toxicity": toxicity_query}
ORACLE: dict[str, str] = {}
