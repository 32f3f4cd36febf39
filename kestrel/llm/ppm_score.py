"""Language-model scoring: prediction by partial matching over bytes.

The model is a byte-context trie of depth ``DEPTH``: for every context of up to DEPTH bytes the
counts of the byte (or end of text) that follows, over all training documents. A symbol is coded in
the longest context that exists; a symbol not seen there costs an escape, estimated by method D
(weight 2c - 1 for a symbol of count c, weight 1 for each distinct symbol to the escape), and the
next shorter context is used without the symbols already ruled out (symbol exclusion). In a trained
trie the symbols of a context are a subset of those of its suffix, so what exclusion removes is one
number per context, and the code length depends on the last DEPTH + 1 symbols alone.

Nothing is broadcast but the counts of symbol pairs (at most 257^2). Documents are taken in blocks
of rows. A block asks for each distinct gram and word once; requests are packed by key bucket and
added up there; whole subtries (all contexts with the same last two symbols) are computed together;
answers go back to the block that asked, where the sums per document are made. The numbers of blocks and
buckets grow with the documents, so tasks stay of one size.

Words are compared by a 64-bit hash (ten million words share one with a chance of 3e-6).

Defined results: a null text is the empty text (one end token); a null ``doc_id`` hashes as the
empty string, so it is held out; repeated rows get equal scores and count as often as they occur;
other columns are ignored; an empty table gives no rows; without training rows every symbol has
probability 1 / 257.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table
from kestrel.llm.shingles import mix, text_runs, word_hashes

DEPTH = 5
FOLDS = 10
BLOCK_ROWS = 8192
BUCKET_DOCS = 4000  # documents for one more bucket of keys
BITS, END, SYMBOLS = 9, 256, 257
GRAM, WORD, PAIR = 0, 1, 2
REQUEST = "block string, kind int, bucket int, keys array<long>, counts array<long>"


def mask(symbols: int) -> int:
    return (1 << BITS * symbols) - 1


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram that ends at each symbol, first place of each text and the end); texts in lower case, each with its end."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.full(DEPTH + int((sizes + DEPTH - 1).sum()), END, np.int64)
    place = np.arange(int(starts[-1])) + np.repeat(np.arange(len(texts)) * (DEPTH - 1) + DEPTH, sizes)
    last = starts[1:] - 1
    body = np.delete(place, last)
    data[body] = np.frombuffer(b"".join(texts).lower(), np.uint8)
    g = np.zeros(len(place), np.int64)
    for j in range(DEPTH + 1):
        g |= data[place - j] << (BITS * j)
    return g, starts


def tally(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their weights."""
    codes, seen = pd.factorize(keys)
    return seen, np.bincount(codes, weight, len(seen)).astype(np.int64)


def packed(block: str, kind: int, keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple]:
    """One row per bucket with ascending keys as differences."""
    by = np.lexsort((keys, bucket))
    keys, counts, bucket = keys[by], counts[by], bucket[by]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
    for lo, hi in zip(edges, edges[1:]):
        yield block, kind, int(bucket[lo]), np.diff(keys[lo:hi], prepend=np.int64(0)), counts[lo:hi]


def key_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def requests(docs: DataFrame, buckets: int) -> DataFrame:
    """What each run of rows of a block asks for: grams and words with their counts in training rows.

    Symbol pairs are only reported, as plain keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, {GRAM: [], WORD: []}
        for batch in batches:
            names, train = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for lo, texts in text_runs(batch.column(2)):
                at = 0
                while at < len(texts):
                    name = names[lo + at]
                    end = at
                    while end < len(texts) and names[lo + end] == name:
                        end += 1
                    if name != block:
                        if block is not None:
                            yield from rows(block, parts)
                        block, parts = name, {GRAM: [], WORD: []}
                    some, learn = texts[at:end], train[lo + at:lo + end].astype(np.int64)
                    g, starts = grams(some)
                    parts[GRAM].append(tally(g, np.repeat(learn, np.diff(starts))))
                    h, bounds = word_hashes(some)
                    parts[WORD].append(tally(h.view(np.int64), np.repeat(learn, np.diff(bounds))))
                    at = end
        if block is not None:
            yield from rows(block, parts)

    def rows(block: str, parts: dict) -> Iterator[pa.RecordBatch]:
        out = []
        for kind, found in parts.items():
            keys, n = tally(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
            out += packed(block, kind, keys, n, key_bucket(keys, buckets))
            if kind == GRAM:
                out.append((block, PAIR, 0, *tally(keys & mask(2), n)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())])],
                names=["block", "kind", "bucket", "keys", "counts"])

    return docs.select("block", "train", "text").mapInArrow(run, REQUEST)


def unpack(table_: pa.Table, names: tuple[str, ...]) -> tuple[np.ndarray, ...]:
    """Concatenated lists of a packed table; the first is turned back from differences to keys."""
    lists = [table_.column(n).combine_chunks() for n in names]
    sizes = np.diff(np.asarray(lists[0].offsets)) if len(lists[0]) else np.zeros(0, np.int64)
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
    steps = flat[0].astype(np.int64)
    run = np.cumsum(steps)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    base = np.where(first > 0, run[first - 1], 0) if len(run) else first
    return (run - np.repeat(base, sizes), *flat[1:], sizes)


class Pairs:
    """Orders 0 and 1 of the trie: dense tables of at most 257 x 257 counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.c1 = np.zeros((SYMBOLS, SYMBOLS), np.int64)
        self.c1[keys >> BITS, keys & mask(1)] = counts
        self.c0 = self.c1.sum(axis=0)
        self.weight1, self.q1 = self._sums(self.c1, axis=1)
        self.weight0, self.q0 = self._sums(self.c0, axis=0)
        # What order 0 gives to the symbols that an order-1 context has seen.
        self.excluded1 = np.where(self.c1 > 0, 2 * self.c0[None, :] - 1, 0).sum(axis=1)

    @staticmethod
    def _sums(c: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
        return np.where(c > 0, 2 * c - 1, 0).sum(axis=axis), (c > 0).sum(axis=axis)


def lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in sorted_keys, -1 where absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def code_lengths(wanted: np.ndarray, gram: np.ndarray, count: np.ndarray, pairs: Pairs) -> np.ndarray:
    """log10 probability of the last symbol of each wanted gram.

    gram, count: all grams of the training text that share the last two context symbols with a
    wanted one (whole subtries), each once.
    """
    levels = {}  # context length -> (entry keys, entry counts, contexts, weight, distinct symbols, excluded weight)
    for k in range(2, DEPTH + 1):
        keys, back = np.unique(gram & mask(k + 1), return_inverse=True)
        c = np.bincount(back, count, len(keys)).astype(np.int64)
        ctx, at = np.unique(keys >> BITS, return_inverse=True)
        weight = np.bincount(at, 2 * c - 1, len(ctx)).astype(np.int64)
        distinct = np.bincount(at, minlength=len(ctx))
        if k == 2:
            above = pairs.c1[(keys >> BITS) & mask(1), keys & mask(1)]
        else:
            above = levels[k - 1][1][np.searchsorted(levels[k - 1][0], keys & mask(k))]
        levels[k] = (keys, c, ctx, weight, distinct, np.bincount(at, 2 * above - 1, len(ctx)).astype(np.int64))
    total = np.zeros(len(wanted))
    open_ = np.ones(len(wanted), bool)
    out_weight = np.zeros(len(wanted), np.int64)  # of the symbols ruled out, in the next shorter context
    out_symbols = np.zeros(len(wanted), np.int64)

    def step(exists, c, weight, distinct, excluded):
        nonlocal open_
        weight_left, symbols_left = weight - out_weight, distinct - out_symbols
        whole = weight_left + symbols_left
        found, live = open_ & exists & (c > 0), open_ & exists
        missed = live & ~found & (symbols_left > 0)
        total[found] += np.log10((2 * c[found] - 1) / whole[found])
        total[missed] += np.log10(symbols_left[missed] / whole[missed])
        open_ = open_ & ~found
        out_weight[live] = excluded[live]
        out_symbols[live] = distinct[live]

    for k in range(DEPTH, 1, -1):
        keys, c, ctx, weight, distinct, excluded = levels[k]
        node = lookup(ctx, (wanted >> BITS) & mask(k))
        entry = lookup(keys, wanted & mask(k + 1))
        pick = lambda x, at: np.where(at >= 0, x[at], 0) if len(x) else np.zeros(len(at), np.int64)
        step(node >= 0, pick(c, entry), pick(weight, node), pick(distinct, node), pick(excluded, node))
    before, last = (wanted >> BITS) & mask(1), wanted & mask(1)
    step(pairs.q1[before] > 0, pairs.c1[before, last], pairs.weight1[before], pairs.q1[before], pairs.excluded1[before])
    n = len(wanted)
    step(np.full(n, pairs.q0 > 0), pairs.c0[last], np.full(n, pairs.weight0), np.full(n, pairs.q0), np.zeros(n, np.int64))
    total[open_] -= math.log10(max(1, SYMBOLS - int(pairs.q0)))
    return total


def list_rows(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(types, cols)})


_LONGS, _DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())


def gram_probabilities(asked: DataFrame, pairs: Pairs, buckets: int) -> DataFrame:
    """(bucket, keys, values): log10 probability of every gram asked for, by key bucket."""

    def add(group: pa.Table) -> pa.Table:
        grams_only = group.filter(pc.equal(group.column("kind"), GRAM))
        keys, counts = tally(*unpack(grams_only, ("keys", "counts"))[:2])
        sub = key_bucket((keys >> BITS) & mask(2), buckets)  # subtries: by the last two context symbols
        return list_rows([(b, k, c) for _, _, b, k, c in packed("", GRAM, keys, counts, sub)],
                         [("sub", pa.int32()), ("keys", _LONGS), ("counts", _LONGS)])

    def subtrie(group: pa.Table) -> pa.Table:
        keys, counts, _ = unpack(group, ("keys", "counts"))
        order = np.lexsort((keys, key_bucket(keys, buckets)))
        keys = keys[order]
        counts = counts[order]
        value = code_lengths(keys, keys[counts > 0], counts[counts > 0], pairs) if len(keys) else np.zeros(0)
        bucket = key_bucket(keys, buckets)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
        return list_rows([(int(bucket[lo]), np.diff(keys[lo:hi], prepend=np.int64(0)), value[lo:hi]) for lo, hi in zip(edges, edges[1:])],
                         [("bucket", pa.int32()), ("keys", _LONGS), ("values", _DOUBLES)])

    # The same rows and columns as in answers(), so that one exchange serves both.
    distinct = by_bucket(asked).applyInArrow(add, "sub int, keys array<long>, counts array<long>")
    return distinct.groupBy("sub").applyInArrow(subtrie, "bucket int, keys array<long>, values array<double>")


def by_bucket(asked: DataFrame) -> GroupedData:
    return asked.where(F.col("kind") != PAIR).groupBy("bucket")


def answers(asked: DataFrame, probabilities: DataFrame) -> DataFrame:
    """(block, kind, keys, values, counts, vocabulary) for all keys asked for.

    Grams get log10 probabilities (single precision on the way), words their counts. ``vocabulary``
    is the number of known words of a bucket, on one of its rows.
    """

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        kinds = left.column("kind").to_numpy()
        for kind in (GRAM, WORD):
            part = left.filter(pa.array(kinds == kind))
            if not part.num_rows:
                continue
            keys, counts, sizes = unpack(part, ("keys", "counts"))
            if kind == GRAM:
                known, value, _ = unpack(right, ("keys", "values"))
                by = np.argsort(known)
                reply = value[by][np.searchsorted(known[by], keys)].astype(np.float32)
                vocabulary = 0
            else:
                seen, total = tally(keys, counts)
                by = np.argsort(seen)
                reply = total[by][np.searchsorted(seen[by], keys)]
                vocabulary = int((total > 0).sum())
            ends = np.cumsum(sizes)
            for block, lo, hi in zip(part.column("block").to_pylist(), ends - sizes, ends):
                sent = reply[lo:hi]
                rows.append((block, kind, np.diff(keys[lo:hi], prepend=np.int64(0)), *((sent, None) if kind == GRAM else (None, sent)), vocabulary))
                vocabulary = 0
        return list_rows(rows, [("block", pa.string()), ("kind", pa.int32()), ("keys", _LONGS), ("values", pa.list_(pa.float32())), ("counts", _LONGS), ("vocabulary", pa.int64())])

    return by_bucket(asked).cogroup(probabilities.groupBy("bucket")).applyInArrow(
        answer, "block string, kind int, keys array<long>, values array<float>, counts array<long>, vocabulary long")


def block_scores(docs: DataFrame, replies: DataFrame) -> DataFrame:
    """Sums per document from the answers to its block."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = {}
        kinds = right.column("kind").to_numpy()
        for kind in (GRAM, WORD):
            keys, values, _ = unpack(right.filter(pa.array(kinds == kind)), ("keys", "values" if kind == GRAM else "counts"))
            by = np.argsort(keys, kind="stable")
            sides[kind] = keys[by], values[by].astype(float)
        vocabulary = int(right.column("vocabulary").to_numpy().sum())
        out: dict[str, list] = {n: [] for n in ("score", "words", "known", "log_sum")}
        texts_col = left.column("text").combine_chunks()
        for _, texts in text_runs(texts_col):
            g, starts = grams(texts)
            codes, seen = pd.factorize(g)
            keys, values = sides[GRAM]
            out["score"] += np.add.reduceat(values[np.searchsorted(keys, seen)][codes], starts[:-1]).tolist()
            h, bounds = word_hashes(texts)
            codes, seen = pd.factorize(h.view(np.int64))
            keys, values = sides[WORD]
            c = values[np.searchsorted(keys, seen)][codes] if len(h) else np.zeros(0)
            known = np.concatenate([[0], np.cumsum(c > 0)])
            logs = np.concatenate([[0.0], np.cumsum(np.log10(c + 0.1))])
            out["words"] += np.diff(bounds).tolist()
            out["known"] += (known[bounds[1:]] - known[bounds[:-1]]).tolist()
            out["log_sum"] += (logs[bounds[1:]] - logs[bounds[:-1]]).tolist()
        first = np.zeros(left.num_rows, np.int64)
        if left.num_rows:
            first[0] = vocabulary
        return pa.table({
            "doc_id": left.column("doc_id"), "train": left.column("train"), "n_words": pa.array(out["words"], pa.int64()),
            "known_words": pa.array(out["known"], pa.int64()), "log_sum": pa.array(out["log_sum"], pa.float64()),
            "score": pa.array(out["score"], pa.float64()), "vocabulary": pa.array(first)})

    return (docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score, "doc_id long, train boolean, n_words long, known_words long, log_sum double, score double, vocabulary long"))


def ppm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for documents read from files."""
    buckets = max(16, docs.count() // BUCKET_DOCS)
    block = F.concat_ws(":", F.col("_metadata.file_path"), F.expr(f"_metadata.row_index div {BLOCK_ROWS}"))
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", block.alias("block"),
                         (~held_out(F.col("doc_id"))).alias("train"))
    asked = materialize(requests(blocks, buckets), "ppm-requests")
    counted = (asked.where(F.col("kind") == PAIR).select(F.expr("inline(arrays_zip(keys, counts))"))
               .groupBy(F.col("keys").alias("pair")).agg(F.sum("counts").alias("n")).collect())
    pairs = Pairs(np.array([r["pair"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64))
    replies = answers(asked, gram_probabilities(asked, pairs, buckets))
    rows = materialize(block_scores(blocks, replies), "ppm-scores")
    sums = rows.agg(F.sum(F.when(F.col("train"), F.col("n_words"))).alias("w"), F.sum(F.col("train").cast("long")).alias("d"),
                    F.sum("vocabulary").alias("v")).first()
    ends = sums["d"] or 0
    n, v = (sums["w"] or 0) + ends, (sums["v"] or 0) + (1 if ends else 0)
    per_token = math.log10(n + 0.1 * (v + 1))
    tokens = F.col("n_words") + 1
    return rows.select("doc_id", (~F.col("train")).alias("held_out"), tokens.alias("n_tokens"),
                       (F.col("known_words") + (1 if ends else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("log_sum") + math.log10(ends + 0.1) - tokens * per_token).alias("base_score"), "score")


def score(docs: DataFrame) -> DataFrame:
    """ppm_scores of any DataFrame: it is written to the shared folder first, which gives rows a place."""
    return ppm_scores(materialize(docs.select("doc_id", "text"), "ppm-docs"))


def ppm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op1_ppm_score": ppm_query}
ORACLE: dict[str, str] = {}
