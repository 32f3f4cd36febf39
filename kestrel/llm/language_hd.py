"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from its code point. An n-gram is the product of
its letters' vectors, each rotated by its place (bind permuted). A text is the sum of its n-grams'
vectors (bundle); a language prototype is the sum over the training texts of the language. A text gets
the language of greatest cosine; the score is that cosine, not below 0.

Letters are what Unicode calls letters, lower-cased; any run of other characters is one blank, which has
a vector of its own; texts begin and end with a blank; no n-gram has a blank in its middle. Sums are
whole numbers below 2^53, so results do not depend on the order of tasks. Each task sends one partial
prototype a language (a flush after ``HELD`` languages keeps that bounded), which Spark adds up by cell.
N-grams of a run of texts are bundled in blocks, and a long text in pieces, so memory is bounded for any
script. Prototypes travel in blocks of ``BLOCK_LANGS`` languages; further blocks are further passes that
carry the best answer so far; the driver holds DIM numbers a language.

Defined results: a null text or one without letters is ``und`` with score 0 and is never learned from; a
null ``lang`` is no label; a null ``doc_id`` counts as held out; equal cosines go to the least language;
repeated rows get equal answers and each count in training; without any learned language every text is
``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import table
from kestrel.llm.shingles import text_runs

FOLDS = 5
DIM, GRAM = 2048, 3
RUN_DOCS, RUN_CHARS, GRAM_BLOCK = 256, 1 << 20, 4096
HELD = 256
BLOCK_LANGS = 1024
UNKNOWN = "und"
SEED = 11


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


@lru_cache(1)
def letter_table() -> np.ndarray:
    """For each code point: is it a letter."""
    chars = (chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    return np.fromiter(map(str.isalpha, chars), bool, 0x110000)


@lru_cache(20_000)
def letter_vector(code: int) -> np.ndarray:
    """The signs of a code point's vector; 0 is the blank."""
    bits = np.random.Generator(np.random.Philox(key=[SEED, code])).bytes(DIM // 8)
    return (np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.int8) << 1) - 1


def folded(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, 0 for each run of other characters, blanks around."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[0], np.where(letter_table()[codes], codes, 0), [0]]).astype(np.uint32)
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0  # the first blank of a run
    keep[0] = True
    return codes[keep]


def bound(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Vectors of n-grams given as rows of places in ``letters``."""
    vectors = np.stack([letter_vector(int(c)) for c in letters])
    out = np.ones((len(grams), DIM), np.int8)
    for place in range(GRAM):
        out *= np.roll(vectors, GRAM - 1 - place, axis=1)[grams[:, place]]
    return out


def run_grams(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, distinct n-grams as places in them, n-gram of each position, part of each position).

    An n-gram lies in one part and has no blank between its ends.
    """
    codes = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    number = np.zeros(0x110000, np.int64)
    number[codes] = 1
    letters = np.flatnonzero(number)
    number[letters] = np.arange(len(letters))
    place = number[codes]
    base, count = len(letters), max(len(codes) - GRAM + 1, 0)
    inside = owner[:count] == owner[len(owner) - count:]
    for j in range(1, GRAM - 1):
        inside &= codes[j:j + count] > 0
    key = np.zeros(count, np.int64)
    for j in range(GRAM):
        key = key * base + place[j:j + count]
    key, owner = key[inside], owner[:count][inside]
    if base ** GRAM <= 1 << 24:
        seen = np.zeros(base ** GRAM, bool)
        seen[key] = True
        distinct = np.flatnonzero(seen)
        number = np.zeros(base ** GRAM, np.int32)
        number[distinct] = np.arange(len(distinct), dtype=np.int32)
        at = number[key].astype(np.int64)
    else:
        distinct, at = np.unique(key, return_inverse=True)
    grams = np.stack([distinct // base ** (GRAM - 1 - j) % base for j in range(GRAM)], axis=1)
    return letters, grams, at, owner


def bundled(parts: list[np.ndarray], groups: np.ndarray, n: int) -> np.ndarray:
    """The sums of the n-grams' vectors of each group of parts, in whole numbers."""
    letters, grams, at, owner = run_grams(parts)
    out = np.zeros((n, DIM))
    pair = at * n + groups[owner]
    if len(grams) > GRAM_BLOCK:
        pair.sort()
    for lo in range(0, len(grams), GRAM_BLOCK):
        hi = min(lo + GRAM_BLOCK, len(grams))
        mine = pair if len(grams) <= GRAM_BLOCK else pair[np.searchsorted(pair, lo * n):np.searchsorted(pair, hi * n)]
        counts = np.bincount(mine - lo * n, minlength=(hi - lo) * n).reshape(hi - lo, n)
        # Single precision is exact up to 2^24; a run has fewer n-grams.
        out += counts.T.astype(np.float32) @ bound(grams[lo:hi], letters).astype(np.float32)
    return out


def bundles(texts: list[str], groups: np.ndarray | None = None, n: int = 0) -> np.ndarray:
    """One vector a text, or a group of texts. A long text is taken in pieces that share no n-gram."""
    groups, n = (np.arange(len(texts)), len(texts)) if groups is None else (groups, n)
    codes = [folded(t) for t in texts]
    if sum(map(len, codes)) <= 2 * RUN_CHARS:
        return bundled(codes, groups, n)
    out = np.zeros((n, DIM))
    for g, c in zip(groups, codes):
        for lo in range(0, len(c), RUN_CHARS):
            out[g] += bundled([c[lo:lo + RUN_CHARS + GRAM - 1]], np.zeros(1, int), 1)[0]
    return out


def text_groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in runs of bounded bytes and rows; null is the empty text."""
    for lo, run in text_runs(texts, RUN_CHARS):
        for at in range(0, len(run), RUN_DOCS):
            yield lo + at, [t.decode("utf-8", "replace") for t in run[at:at + RUN_DOCS]]


def learn(docs: DataFrame) -> DataFrame:
    """(lang, cell, total): the prototypes of training documents(text, lang), one row a cell.

    The texts' vectors are added up by language as whole numbers before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, texts in text_groups(batch.column(0)):
                names = sorted(set(langs[lo:lo + len(texts)]))
                number = {name: i for i, name in enumerate(names)}
                group = np.array([number[x] for x in langs[lo:lo + len(texts)]])
                sums = bundles(texts, group, len(names))
                for name, total in zip(names, sums):
                    held[name] = held[name] + total if name in held else total
                if len(held) > HELD:
                    yield partial(held)
                    held = {}
        yield partial(held)

    def partial(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        names = [name for name, total in held.items() if total.any()]
        sums = [held[name].astype(np.int64) for name in names]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.list_(pa.int64()))], names=["lang", "sums"])

    parts = docs.select("text", "lang").where("text is not null and lang is not null").mapInArrow(run, "lang string, sums array<long>")
    return (parts.select("lang", F.posexplode("sums").alias("cell", "value"))
            .groupBy("lang", "cell").agg(F.sum("value").alias("total")))


def prototypes(learned: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in ascending order and their unit vectors (DIM numbers a language)."""
    rows = learned.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("cell", "total"))).alias("v")).select("lang", "v.total")
    found = sorted((r["lang"], np.array(r["total"], np.float64)) for r in rows.toLocalIterator())
    if not found:
        return [], np.zeros((0, DIM), np.float32)
    unit = np.stack([v / np.linalg.norm(v) for _, v in found])
    return [name for name, _ in found], unit.astype(np.float32)


def compared(docs: DataFrame, names: list[str], unit: np.ndarray) -> DataFrame:
    """Adds lang_pred and score of one block of languages to docs(doc_id, text, held_out, lang_pred, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, top = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for lo, texts in text_groups(batch.column(1)):
                vectors = bundles(texts)
                norm = np.linalg.norm(vectors, axis=1)
                cos = (vectors @ unit.T.astype(np.float64)) / np.where(norm > 0, norm, 1)[:, None]
                best = cos.argmax(axis=1)  # the first, so the least language
                pred, score = before[lo:lo + len(texts)], top[lo:lo + len(texts)]
                for i, text in enumerate(texts):
                    c = min(1.0, max(0.0, float(cos[i, best[i]])))
                    if has_letter(text) and (pred[i] == UNKNOWN and score[i] == 0 or c > score[i]):
                        pred[i], score[i] = names[best[i]], c
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, len(texts)) for k in range(3)] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def identify(docs: DataFrame, training: Column, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of documents(doc_id, text, lang); learns where ``training`` holds."""
    names, unit = prototypes(learn(docs.where(training)))
    out = docs.select("doc_id", "text", held_out.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    for lo in range(0, len(names), BLOCK_LANGS):
        out = compared(out, names[lo:lo + BLOCK_LANGS], unit[lo:lo + BLOCK_LANGS])
    return out.drop("text")


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = fold(F.col("doc_id")) == 0
    return identify(table(spark, sf_dir, "documents"), ~test, test)


QUERIES = {"op11_language_hd": language_query}
ORACLE: dict[str, str] = {}
