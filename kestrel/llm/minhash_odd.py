"""MinHash near-duplicates with odd sketches.

Every distinct shingle set is one node (equal sets are joined by a 128-bit digest first, so a
group of exact copies of any size is one node). A node's MinHash samples give

* band keys: ``BANDS`` bands of ``ROWS`` samples (a pair at similarity 0.75 shares no band with
  probability 2.4e-6), and
* an odd sketch: the samples folded into a parity bitmap of ``BITS`` bits. The population count
  of the XOR of two bitmaps estimates the similarity; pairs estimated below ``ESTIMATE`` (0.2,
  or more than five standard deviations, under the limit) are not looked at further.

What remains is confirmed on the full sets. No bucket is expanded into all its pairs. Round 1: each
node is paired with the leaders of its buckets, its ``BEST`` pairs by estimate are confirmed, and
their components are formed. Round 2 looks at every pair that shares a bucket but not yet a
component, which loses no link, and emits only those that a second odd sketch lets through: the
whole set folded into ``FINE_BITS`` bits, whose estimate is within 0.01 for sets of up to
``FINE_ITEMS`` shingles (larger sets rely on the first sketch), against a limit of ``FINE_ESTIMATE``.

Defined results: a null or word-less text has an empty set and is a component of its own; a null
``doc_id`` takes part by its text and never names a component; rows that repeat are equal sets.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table
from kestrel.llm.components import components
from kestrel.llm.shingles import mix, shingle_hashes, text_runs

WORDS, LIMIT = 5, 75
BANDS, ROWS = 48, 5
BITS = 512
ESTIMATE = 0.55
FINE_BITS, FINE_ITEMS, FINE_ESTIMATE = 4096, 6000, 0.70
BEST = 3

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_BAND = _rng.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def samples(hashes: np.ndarray) -> np.ndarray:
    """One minimum per hash function over a set of 64-bit shingle hashes."""
    low = None
    for at in range(0, len(hashes), 2048):
        part = (hashes[at:at + 2048, None] * _MUL[None, :] + _ADD[None, :]).min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    mixed = (low.reshape(BANDS, ROWS) * _BAND[None, :]).sum(axis=1, dtype=np.uint64)
    return mix(mixed + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as BITS / 64 long values."""
    cell = mix(low + np.arange(len(low), dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(BITS)
    bits = (np.bincount(cell.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def fine_sketch(unique: np.ndarray) -> np.ndarray | None:
    """Parity bitmap of a whole set of hashes; none for a set that would fill it."""
    if len(unique) > FINE_ITEMS:
        return None
    cell = (mix(unique + np.uint64(0xA24BAED4963EE407)) % np.uint64(FINE_BITS)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=FINE_BITS) & 1).astype(np.uint8)).view(np.int64)


def digest(unique: np.ndarray) -> bytes:
    return hashlib.blake2b(unique.tobytes(), digest_size=16).digest()


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n_shingles, bands, odd) per row; empty sets have null bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in text_runs(batch.column(1)):
                node, size, bands, odd = [], [], [], []
                for h in shingle_hashes(texts, WORDS):
                    u = np.unique(h)
                    low = samples(u) if len(u) else None
                    node.append(digest(u))
                    size.append(len(u))
                    bands.append(None if low is None else band_keys(low))
                    odd.append(None if low is None else odd_sketch(low))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)).cast(pa.int64()), pa.array(node, pa.binary()),
                     pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(odd, pa.list_(pa.int64()))],
                    names=["doc_id", "node", "n_shingles", "bands", "odd"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, node binary, n_shingles long, bands array<long>, odd array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, items, fine): the sorted shingle hashes of each row and their odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                sets = [np.unique(h) for h in shingle_hashes(texts, WORDS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(u) for u in sets], pa.binary()),
                     pa.array([u.view(np.int64) for u in sets], pa.list_(pa.int64())),
                     pa.array([fine_sketch(u) for u in sets], pa.list_(pa.int64()))], names=["node", "items", "fine"])

    return docs.select("text").mapInArrow(run, "node binary, items array<long>, fine array<long>")


def bits_apart(a: Column, b: Column) -> Column:
    """Population count of the XOR of two bitmaps."""
    apart = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def bit_limit(differing: Column, bits: int) -> Column:
    """Bits in which two bitmaps differ on average if the folded collections differ in so many items."""
    return F.lit(bits / 2.0) * (1 - F.exp(differing * F.lit(-2.0 / bits)))


def sample_similar(a: Column, b: Column, similarity: float = ESTIMATE) -> Column:
    """Odd sketches of MinHash samples: the samples differ in 2k (1 - similarity) values."""
    return bits_apart(a, b) <= bit_limit(F.lit(2.0 * BANDS * ROWS * (1 - similarity)), BITS)


def fine_similar(a: Column, b: Column, size_a: Column, size_b: Column, similarity: float = FINE_ESTIMATE) -> Column:
    """Odd sketches of whole sets, which differ in (sizes) (1 - s) / (1 + s) items; true without sketches."""
    differing = (size_a + size_b) * F.lit((1 - similarity) / (1 + similarity))
    return F.coalesce(bits_apart(a, b) <= bit_limit(differing, FINE_BITS), F.lit(True))


def first_shared(a: Column, b: Column) -> Column:
    """The key of the first band that two nodes share."""
    return F.get(F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda k: k.isNotNull()), F.lit(0))


def confirmed(pairs: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * inter >= limit * union."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - F.col("common")
    return both.withColumn("common", common).where(100 * F.col("common") >= limit * union).select("a", "b")


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of documents(doc_id, text)."""
    rows = materialize(features(docs), "features")
    nodes = materialize(rows.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd")), "nodes")

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keyed.join(leaders.select("key", "lead"), "key"), "shared-buckets")

    members = shared.select("node").distinct().join(nodes.select("node", "first_doc"), "node")
    wanted = members.select(F.col("first_doc").alias("doc_id")).distinct()
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = text.join(wanted, text.doc_id.eqNullSafe(wanted.doc_id), "left_semi")
    sets = materialize(full_sets(chosen).dropDuplicates(["node"]), "sets")

    # Round 1: each node against the leaders of its buckets that look most like it.
    odd = nodes.select("node", "odd")
    led = shared.where("lead <> node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    guessed = (led.join(odd.select(F.col("node").alias("a"), F.col("odd").alias("odd_a")), "a")
               .join(odd.select(F.col("node").alias("b"), F.col("odd").alias("odd_b")), "b")
               .where(sample_similar(F.col("odd_a"), F.col("odd_b")))
               .select("a", "b", bits_apart(F.col("odd_a"), F.col("odd_b")).alias("apart")))
    ranked = Window.partitionBy("b").orderBy("apart", "a")  # at most BANDS leaders a node
    first = guessed.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= BEST).select("a", "b")
    links = materialize(confirmed(first, sets, limit), "links")
    labels = components(links)

    # Round 2: pairs of a bucket that are not in one component yet.
    placed = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("comp"))
    open_keys = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where("lo <> hi").select("key"))
    sketches = nodes.select("node", "odd", "bands").join(sets.select("node", "fine", F.size("items").alias("n")), "node")
    unsettled = materialize(placed.join(open_keys, "key").join(sketches, "node"), "unsettled")
    x = unsettled.select("key", *[F.col(c).alias(f"{c}_x") for c in ("node", "comp", "odd", "bands", "fine", "n")])
    y = unsettled.select("key", *[F.col(c).alias(f"{c}_y") for c in ("node", "comp", "odd", "bands", "fine", "n")])
    close = ((x.key == y.key) & (F.col("comp_x") < F.col("comp_y"))
             & (F.least("n_x", "n_y") * 100 >= limit * F.greatest("n_x", "n_y"))
             & sample_similar(F.col("odd_x"), F.col("odd_y"))
             & fine_similar(F.col("fine_x"), F.col("fine_y"), F.col("n_x"), F.col("n_y"))
             & (x.key == first_shared(F.col("bands_x"), F.col("bands_y"))))  # one row a pair, not one a band
    second = x.join(y, close).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))
    more = materialize(confirmed(second, sets, limit), "links")
    labels = components(links.unionByName(more))

    named = (labels.join(nodes.select("node", "first_doc"), "node").groupBy("label")
             .agg(F.min("first_doc").alias("component_id")))
    linked = labels.join(named, "label").select("node", "component_id")
    per_node = (nodes.select("node", "first_doc").join(linked, "node", "left")
                .select("node", F.coalesce("component_id", "first_doc").alias("component_id")))
    out = rows.select("doc_id", "node", "n_shingles").join(per_node, "node", "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The documents with one row of each near-duplicate group left; all columns stay.

    Rows without a ``doc_id`` and without any id in their group all stay.
    """
    verdict = near_duplicates(docs, limit)
    drop = verdict.where("not kept and component_id is not null and doc_id is not null").select("doc_id").distinct()
    left = docs.join(drop, "doc_id", "left_anti")
    named = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(left.where("doc_id is null"))


def dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_minhash_odd_sketch": dedup_query}
ORACLE: dict[str, str] = {}
