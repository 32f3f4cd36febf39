"""Ranked lexical search over bags of words, each distinct bag scored once.

Documents are cut down to the items' vocabulary: a bag is the sorted term numbers and their counts. With
the length part ``m`` of the score it is all that a score depends on, so documents of equal (m, bag) form
a class. Bags are hashed, and their bytes are compared: the aggregate groups on the bytes themselves. A
class is scored once against all items, in blocks of classes and items. Per item the 20 best classes by
(score, least doc_id) hold the 20 best documents: each better class holds at least one better document.
Only those classes are expanded, to their 20 least doc_ids.

Vocabulary and items travel with the tasks in blocks of at most ``ITEM_BYTES`` of item text; a larger
benchmark takes several passes over the documents. What travels does not grow with the documents.

Scores are whole numbers: w = floor(1000 ln((2N+2) / (2df+1))), and the sum over the item's terms (with
repeats) of w * ((10^9 tf) div (1000 tf + 12 m)), m = 75 + (25 n N) div L.

Defined results: a null or empty text has no terms and is not counted in N; an item without terms, or
whose terms no document has, gives no rows; each row of ``benchmark`` is ranked for itself, also
where ids are null or repeated; repeated document rows each take a rank; a null ``doc_id`` comes last
among equal scores; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import ASCII_LOWER, ASCII_UPPER, materialize, table
from kestrel.llm.shingles import text_runs

TOP = 20
ITEM_BYTES = 8 << 20
BROADCAST_BYTES = 32 << 20
BLOCK_PAIRS, BLOCK_ENTRIES = 1 << 20, 1 << 20
LAST = (1 << 63) - 1  # the place of a null doc_id

# ASCII upper case becomes lower case, every ASCII character but letters and digits a space.
_FOLD = bytes(b if b >= 128 or chr(b) in "0123456789" + ASCII_LOWER else ASCII_LOWER.encode()[b - 65] if chr(b) in ASCII_UPPER else 32
              for b in range(256))


def terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts one after the other, place of each text's first term and the end)."""
    data = b"".join(texts).translate(_FOLD)
    ends = np.cumsum([0] + [len(t) for t in texts]).astype(np.int32)
    whole = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    split = pc.ascii_split_whitespace(whole)
    flat, first = split.flatten(), np.asarray(split.offsets)
    word = np.asarray(pc.binary_length(flat)) > 0  # blanks around a text leave empty strings
    before = np.concatenate([[0], np.cumsum(word)])
    return flat.filter(pa.array(word)), before[first - first[0]]


@dataclass
class Items:
    """A block of items: their vocabulary, and for each term the items that hold it and how often."""

    ids: list
    vocabulary: pa.Array
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        counts = [Counter(terms([(text or "").encode()])[0].to_pylist()) for _, text in rows]
        words = sorted(set().union(*counts)) if counts else []
        number = {w: i for i, w in enumerate(words)}
        entries = sorted((number[w], i, k) for i, c in enumerate(counts) for w, k in c.items())
        term, item, times = (np.array(x, np.int64) for x in (zip(*entries) if entries else ((), (), ())))
        return Items([r[0] for r in rows], pa.array(words, pa.string()), np.searchsorted(term, np.arange(len(words) + 1)), item, times)


def item_blocks(benchmark: DataFrame, limit: int = ITEM_BYTES) -> Iterator[Items]:
    """The items in blocks of bounded text; the driver holds one block."""
    rows, size = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id", "text").toLocalIterator():
        more = len(r["text"] or "") + 100
        if rows and size + more > limit:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += more
    if rows:
        yield Items.of(rows)


def packed(number: np.ndarray, tf: np.ndarray) -> bytes:
    return number.astype("<i4").tobytes() + tf.astype("<i4").tobytes()


def unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(bag, "<i4").astype(np.int64)
    return both[:len(both) // 2], both[len(both) // 2:]


def bag_hash(bag: bytes) -> bytes:
    return xxhash.xxh3_128_digest(bag)


def bags(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(doc_id, n, hash, bag) of documents with at least one term; bag and hash are null where no item has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(vocabulary), 1)
        for batch in batches:
            for lo, texts in text_runs(batch.column(1)):
                words, first = terms(texts)
                n = np.diff(first)
                at = pc.index_in(words, value_set=vocabulary)
                known = np.asarray(at.is_valid())
                owner = np.repeat(np.arange(len(texts)), n)[known]
                pair, tf = np.unique(owner * size + np.asarray(at.drop_null(), np.int64), return_counts=True)
                cut = np.searchsorted(pair, np.arange(len(texts) + 1) * size)
                bag = [packed(pair[a:b] % size, tf[a:b]) if b > a else None for a, b in zip(cut, cut[1:])]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array(n, pa.int64()),
                     pa.array([b and bag_hash(b) for b in bag], pa.binary()), pa.array(bag, pa.binary())],
                    names=["doc_id", "n", "hash", "bag"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, hash binary, bag binary")


def classes_of(found: DataFrame) -> DataFrame:
    """(m, hash, bag, members, least): the distinct bags with their length part, how many documents and the least id."""
    return found.where("bag is not null").groupBy("m", "hash", "bag").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.coalesce("doc_id", F.lit(LAST))).alias("least"))


def document_counts(classes: DataFrame, size: int) -> np.ndarray:
    """For each term of the vocabulary, the documents that hold it. Added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for members, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[unpacked(bag)[0]] += members
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in classes.select("members", "bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The ``TOP`` best classes of each item among those seen, by score and least id."""

    def __init__(self, items: int):
        self.item = self.score = self.least = np.zeros(0, np.int64)
        self.held: list = []
        self.floor = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, least: np.ndarray, held: list) -> None:
        item, score, least = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.least, least)))
        held = self.held + held
        order = np.lexsort((least, -score, item))
        first = np.searchsorted(item[order], item[order])
        keep = order[np.arange(len(order)) - first < TOP]
        self.item, self.score, self.least, self.held = item[keep], score[keep], least[keep], [held[i] for i in keep]
        count = np.bincount(self.item, minlength=len(self.floor))
        np.minimum.at(low := np.full(len(self.floor), LAST), self.item, self.score)
        self.floor = np.where(count >= TOP, low, 1)  # equal scores may still win by their id


def scores(bag: list[bytes], m: np.ndarray, items: Items, weight: np.ndarray) -> np.ndarray:
    """Score of each class for each item, in 64-bit integers."""
    out = np.zeros(len(bag) * len(items.ids), np.int64)
    parts = [unpacked(b) for b in bag]
    size = np.array([len(t) for t, _ in parts])
    term, tf = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    row = np.repeat(np.arange(len(bag)), size)
    gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
    uses = np.where(gain > 0, items.first[term + 1] - items.first[term], 0)
    ends = np.cumsum(uses)
    lo = 0
    while lo < len(term):  # each entry meets the items that hold its term, so many at a time
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK_ENTRIES, "right")))
        reps = uses[lo:hi]
        entry = np.repeat(np.arange(lo, hi), reps)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(reps) - reps, reps)
        at = items.first[term[entry]] + nth
        np.add.at(out, row[entry] * len(items.ids) + items.item[at], gain[entry] * items.times[at])
        lo = hi
    return out.reshape(len(bag), len(items.ids))


def best_classes(classes: DataFrame, items: Items, weight: np.ndarray) -> DataFrame:
    """(item, score, least, m, hash, bag): for each item the TOP classes with a score above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.ids))
        step = max(1, BLOCK_PAIRS // len(items.ids))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                m, hashed, bag, least = (batch.column(k).slice(lo, step) for k in range(4))
                raw = bag.to_pylist()
                got = scores(raw, np.asarray(m), items, weight)
                row, item = np.nonzero(got >= best.floor)
                if len(row):
                    key = list(zip(m.to_pylist(), hashed.to_pylist(), raw))
                    best.add(item, got[row, item], np.asarray(least)[row], [key[i] for i in row])
        m, hashed, bag = zip(*best.held) if best.held else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int64()), pa.array(best.score, pa.int64()), pa.array(best.least, pa.int64()),
             pa.array(m, pa.int64()), pa.array(hashed, pa.binary()), pa.array(bag, pa.binary())],
            names=["item", "score", "least", "m", "hash", "bag"])

    each = classes.select("m", "hash", "bag", "least").mapInArrow(run, "item long, score long, least long, m long, hash binary, bag binary")
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "least", "hash", "m"))
    return each.withColumn("nth", nth).where(F.col("nth") <= TOP)


def expanded(found: DataFrame, best: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(item, rank, doc_id, score): the best classes' least ids, in order."""
    # At most TOP classes an item: their number does not grow with the documents.
    named = materialize(best.groupBy("m", "hash", "bag").agg(F.min(F.struct("item", "nth")).alias("class")), "classes-won")
    size = named.agg(F.sum(F.octet_length("bag") + 100).alias("b")).first()["b"] or 0
    side = F.broadcast(named) if size <= broadcast_bytes else named
    place = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last())
    members = (found.select("m", "hash", "bag", "doc_id").join(side, ["m", "hash", "bag"])  # compares the bytes
               .select("class", "doc_id").withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= TOP).drop("nth"))
    scored = best.join(named, ["m", "hash", "bag"]).select("item", "score", "class")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return scored.join(members, "class").withColumn("rank", rank).where(F.col("rank") <= TOP).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the 20 best documents(doc_id, text) of each benchmark(item_id, text)."""
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for items in item_blocks(benchmark, item_bytes):
        if not len(items.vocabulary):
            continue
        found = materialize(bags(docs, items.vocabulary), "bags")
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        found = found.withColumn("m", F.lit(75) + F.expr(f"CAST(25 * CAST(n AS DECIMAL(38, 0)) * {n_docs} AS DECIMAL(38, 0)) div {n_terms}"))
        classes = materialize(classes_of(found), "classes")
        weight = weights(document_counts(classes, len(items.vocabulary)), n_docs)
        best = materialize(best_classes(classes, items, weight), "best")
        names = spark.createDataFrame([(i, name) for i, name in enumerate(items.ids)], f"item long, item_id {kind.simpleString()}")
        out = out.union(expanded(found, best, broadcast_bytes).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
i AS (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT iid, term, count(*) AS times FROM (SELECT iid, unnest(t) AS term FROM i) GROUP BY iid, term),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) SEMI JOIN q USING (term) GROUP BY rid, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
m AS (SELECT rid, doc_id, 75 + (25 * len(t) * n_docs) // n_terms AS m FROM d, total WHERE len(t) > 0),
s AS (
  SELECT iid, rid, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY iid, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM s JOIN m USING (rid) WHERE score > 0) JOIN i USING (iid)
WHERE rank <= 20
"""

QUERIES = {"op13_bag_search": search_query}
ORACLE = {"op13_bag_search": SQL}
