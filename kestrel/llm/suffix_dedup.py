"""Suffix-array dedup: removes every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Only suffixes that can repeat are sorted. Every string of LENGTH bytes holds a *seed*: the string of
``SEED`` bytes of least hash in it. Equal strings have equal seeds at equal places, so the windows of
a document fall into *stretches*, runs of windows with one seed, and a window can repeat only if its
seed occurs again. Steps:

1. Each block of rows asks, packed by key bucket, which seeds occur again and which whole texts are
   copies (one block owns the text; the others send nothing more, as all their bytes go).
2. A block cuts the stretches with repeating seeds, groups them by the bin of the seed, sorts each
   bin's distinct stretches by seed and bytes as a run, and sends the run front-coded: the length
   shared with the string before, and the rest. A block that cuts more than HELD bytes sends
   several runs a bin.
3. A bin merges its runs with a loser tree. Every player carries the length that it shares with the
   last winner, so a match compares only bytes that are not known to be equal. The merged order is
   the suffix order within each seed; equal stretches meet, and a seed, whose stretches come one
   after the other, gives the windows that occur again: wholly for a stretch found twice, else by
   the seed-aligned windows of its seed.
4. The windows go back to the block, which marks the bytes.

Blocks, buckets and bins grow with the input. A block holds the stretches of one run a bin, a bin
those of one seed. Matches never cross documents.

Defined results: a null text is the empty text; texts shorter than LENGTH lose nothing; a null
``doc_id`` is kept; repeated rows are copies of each other; other columns are ignored; an empty
table gives no rows. Seeds are compared by 63-bit hashes (one taken for another only costs work) and
so are whole texts (ten billion different texts hold about five pairs with one hash); stretches and
windows are compared byte by byte, windows of a seed with a stretch over LONG by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table
from kestrel.llm.shingles import mix, text_runs

LENGTH, SEED = 200, 150
LONG = 17 * LENGTH - 1  # bytes of a stretch of 16 * LENGTH windows
BLOCK_ROWS = 4096
BUCKET_DOCS = 4000
HELD = 16 << 20  # bytes of cut stretches that a block holds before it sends them
KEY = 8  # bytes of the seed in front of a sent stretch
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []
_LISTS = pa.list_(pa.int64())


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.full(size, b, np.uint64), dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def seed_hashes(text: bytes) -> np.ndarray:
    """Hash of the SEED bytes at each place."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    up, down = powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up[:len(data)], dtype=np.uint64)])
    n = len(data) - SEED + 1
    return mix((total[SEED:] - total[:-SEED]) * down[:n])


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values: prefix and suffix minima of blocks of that width."""
    n = len(h) - width + 1
    pad = -len(h) % width
    full = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def stretches(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, first window, last window + 1) of each run of windows with one seed; windows are start places."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = sliding_min(seed_hashes(text), LENGTH - SEED + 1)
    edge = np.flatnonzero(low[1:] != low[:-1]) + 1
    first = np.concatenate([[0], edge])
    return low[first].view(np.int64), first, np.concatenate([edge, [len(low)]])


def anchors(text: bytes) -> np.ndarray:
    """The seed at each place that is the least of some window; equal seeds at two places are listed twice."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64)
    h, width = seed_hashes(text), LENGTH - SEED + 1
    low = sliding_min(h, width)
    edge = np.zeros(width - 1, np.uint64)  # the greatest of the minima over a place is its own hash
    high = ~sliding_min(~np.concatenate([edge, low, edge]), width)
    return h[high == h].view(np.int64)


def text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """(block, doc ids, texts) of runs of rows of one block."""
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, texts in text_runs(batch.column(2)):
            at = 0
            while at < len(texts):
                end = at
                while end < len(texts) and names[lo + end] == names[lo + at]:
                    end += 1
                yield names[lo + at], ids[lo + at:lo + end], texts[at:end]
                at = end


def record(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for (_, t), c in zip(types, cols)], names=[n for n, _ in types])


ASK = [("block", pa.string()), ("bucket", pa.int32()), ("keys", _LISTS), ("counts", _LISTS)]


def seed_requests(docs: DataFrame, buckets: int) -> DataFrame:
    """Seeds and whole-text keys of each block with their counts, packed by bucket. Text keys are odd, seeds even."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in by_block(batches):
            keys = [anchors(t) & ~np.int64(1) for t in texts]
            keys.append(np.array([text_key(t) | 1 for t in texts if len(t) >= LENGTH], np.int64))
            seen, n = np.unique(np.concatenate(keys), return_counts=True)
            bucket = buckets_of(seen, buckets)
            by = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[by], prepend=-1, append=-2))
            yield record([(block, int(bucket[by[lo]]), seen[by[lo:hi]], np.minimum(n[by[lo:hi]], 2)) for lo, hi in zip(edges, edges[1:])], ASK)

    return docs.mapInArrow(run, "block string, bucket int, keys array<long>, counts array<long>")


REPLY = [("block", pa.string()), ("kind", pa.int32()), ("keys", _LISTS), ("first", _LISTS), ("last", _LISTS)]
REPLY_DDL = "block string, kind int, keys array<long>, first array<long>, last array<long>"
SEEDS, WINDOWS = 0, 1


def repeated_keys(asked: DataFrame) -> DataFrame:
    """Kind SEEDS: each block's keys that occur twice or more; first is 1 in the one block that owns a key."""

    def answer(group: pa.Table) -> pa.Table:
        names, rank = np.unique(np.array(group.column("block").to_pylist(), dtype=object), return_inverse=True)
        keys = group.column("keys").combine_chunks()
        sizes = np.diff(np.asarray(keys.offsets))
        flat, n = keys.flatten().to_numpy(), group.column("counts").combine_chunks().flatten().to_numpy()
        seen, inverse = np.unique(flat, return_inverse=True)
        total, row = np.bincount(inverse, n), np.repeat(rank, sizes)
        owner = np.full(len(seen), len(names))
        np.minimum.at(owner, inverse, row)
        again, owned = total[inverse] > 1, (owner[inverse] == row).astype(np.int64)
        out, ends = [], np.cumsum(sizes)
        for r, lo, hi in zip(rank.tolist(), ends - sizes, ends):
            pick = np.flatnonzero(again[lo:hi]) + lo
            if len(pick):
                out.append((names[r], SEEDS, flat[pick], owned[pick], owned[pick]))
        return pa.Table.from_batches([record(out, REPLY)])

    return asked.groupBy("bucket").applyInArrow(answer, REPLY_DDL)


def front_code(strings: list[bytes]) -> tuple[list[int], list[int], bytes]:
    """(shared length with the string before, length of the rest) per string of a sorted list, and the rests."""
    shared, rest, out, last = [], [], [], b""
    for s in strings:
        k = common_prefix(last, s, 0)
        shared.append(k)
        rest.append(len(s) - k)
        out.append(s[k:])
        last = s
    return shared, rest, b"".join(out)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to be equal and not looked at."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    lo, hi = known, end  # a[known:lo] equal, difference before hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Run:
    """A front-coded sorted run, read one string at a time."""

    def __init__(self, shared: list[int], rest: list[int], blob: bytes):
        self.shared, self.rest, self.blob = shared, rest, blob
        self.at, self.place, self.now = -1, 0, b""

    def advance(self) -> int:
        """Reads the next string and returns the length that it shares with the one before; -1 at the end."""
        self.at += 1
        if self.at == len(self.shared):
            self.now = None
            return -1
        k, n = self.shared[self.at], self.rest[self.at]
        self.now = self.now[:k] + self.blob[self.place:self.place + n]
        self.place += n
        return k


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int, bytes]]:
    """(run, place in the run, shared length with the string before, string) of all strings in order.

    A loser tree. Players hold the length that they share with the last winner: the one that shares
    more comes first, as it is nearer to the winner; only equal lengths need bytes compared, from there on.
    """
    n = len(runs)
    shared = [run.advance() for run in runs]
    shared = [0 if s >= 0 else -1 for s in shared]
    losers = [-1] * n

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes the one with the winner."""
        if shared[a] < 0 or shared[b] < 0:
            return (b, a) if shared[a] < 0 else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = runs[a].now, runs[b].now
        k = common_prefix(x, y, shared[a])
        if k == len(x) or k < len(y) and x[k] < y[k]:
            shared[b] = k
            return a, b
        shared[a] = k
        return b, a

    def build(node: int) -> int:
        if node >= n:
            return node - n
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if n > 1 else 0
    while shared[top] >= 0:
        yield top, runs[top].at, shared[top], runs[top].now
        shared[top] = runs[top].advance()
        node = (top + n) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


SEND = [("bin", pa.int32()), ("block", pa.string()), ("shared", _LISTS), ("rest", _LISTS), ("blob", pa.binary()), ("counts", _LISTS)]
SEND_DDL = "bin int, block string, shared array<long>, rest array<long>, blob binary, counts array<long>"


class Replies:
    """What a block was told: repeating seeds, copied texts with ownership, and windows of stretches."""

    def __init__(self, right: pa.Table):
        kinds = right.column("kind").to_numpy()
        keys, owned, _ = self._lists(right.filter(pa.array(kinds == SEEDS)))
        text = keys & 1 == 1
        self.seeds = np.unique(keys[~text])
        self.copies = dict(zip(keys[text].tolist(), (owned[text] == 1).tolist()))
        keys, first, last = self._lists(right.filter(pa.array(kinds == WINDOWS)))
        by = np.argsort(keys)
        self.keys, self.first, self.last = keys[by], first[by], last[by]

    @staticmethod
    def _lists(part: pa.Table) -> list[np.ndarray]:
        return [part.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("keys", "first", "last")]

    def repeating(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(seed, first window, end of the bytes) of the stretches whose seed occurs again."""
        seeds, first, end = stretches(text)
        asked = seeds & ~np.int64(1)
        at = np.minimum(np.searchsorted(self.seeds, asked), max(0, len(self.seeds) - 1))
        pick = self.seeds[at] == asked if len(self.seeds) else np.zeros(len(seeds), bool)
        return seeds[pick], first[pick], end[pick] + LENGTH - 1

    def windows(self, stretch_keys: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place in the list, first window, last window + 1) of the told windows of stretches."""
        asked = np.array(stretch_keys, np.int64)
        lo, hi = np.searchsorted(self.keys, asked), np.searchsorted(self.keys, asked, "right")
        for i in np.flatnonzero(hi > lo).tolist():
            for j in range(lo[i], hi[i]):
                yield i, int(self.first[j]), int(self.last[j])


def run_rows(block: str, found: dict[int, dict[bytes, int]]) -> list[tuple]:
    """A row of SEND for each bin of (seed and stretch -> times, at most 2)."""
    rows = []
    for b, strings in found.items():
        order = sorted(strings)
        shared, rest, blob = front_code(order)
        rows.append((b, block, np.array(shared), np.array(rest), zstd.compress(blob), np.array([strings[s] for s in order])))
    return rows


def sorted_runs(docs: DataFrame, replies: DataFrame, bins: int) -> DataFrame:
    """Front-coded sorted runs of the repeating stretches of each block, by bin of the seed."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        told, sent = Replies(right), set()
        found: dict[int, dict[bytes, int]] = defaultdict(dict)
        rows, held, block = [], 0, left.column("block")[0].as_py() if len(left) else ""
        for _, texts in text_runs(left.column("text").combine_chunks()):
            for t in texts:
                weight, k = 1, text_key(t) | 1
                if len(t) >= LENGTH and k in told.copies:
                    if not told.copies[k] or k in sent:
                        continue
                    sent.add(k)
                    weight = 2
                seeds, first, end = told.repeating(t)
                names = seeds.astype(">i8").tobytes()
                bin_of = buckets_of(seeds & ~np.int64(1), bins).tolist()
                for i, (b, f, e) in enumerate(zip(bin_of, first.tolist(), end.tolist())):
                    here, s = found[b], names[KEY * i:KEY * i + KEY] + t[f:e]
                    if s in here:
                        here[s] = 2
                    else:
                        here[s] = weight
                        held += len(s)
                if held > HELD:
                    rows += run_rows(block, found)
                    found.clear()
                    held = 0
        return pa.Table.from_batches([record(rows + run_rows(block, found), SEND)])

    return docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(cut, SEND_DDL)


def merged_stretches(runs: list[Run], counts: list[list[int]]) -> Iterator[list]:
    """[seed and stretch, times, runs that sent it] of the distinct strings of runs, in order."""
    now: list | None = None
    for run, at, shared, s in merge(runs):
        if now and shared == len(s) == len(now[0]):
            now[1] = 2
            now[2].append(run)
        else:
            if now:
                yield now
            now = [s, counts[run][at], [run]]
    if now:
        yield now


def repeated_windows(runs: DataFrame) -> DataFrame:
    """Kind WINDOWS: the windows of sent stretches that occur again, from first to before last, by key of the stretch."""

    def join(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_pylist()
        lists = {c: group.column(c).to_pylist() for c in ("shared", "rest", "counts")}
        readers = [Run(shared, rest, zstd.decompress(blob.as_py()))
                   for shared, rest, blob in zip(lists["shared"], lists["rest"], group.column("blob"))]
        out: dict[str, tuple[array, array, array]] = defaultdict(lambda: (array("q"), array("q"), array("q")))
        for _, same in groupby(merged_stretches(readers, lists["counts"]), lambda x: x[0][:KEY]):
            of_seed = [(s[KEY:], times, members) for s, times, members in same]
            count: dict[bytes, int] = {}
            packed = max(len(s) for s, _, _ in of_seed) > LONG  # one key form for all stretches of a seed
            if any(times == 1 for _, times, _ in of_seed):
                for s, times, _ in of_seed:
                    for w in windows(s, packed):
                        count[w] = count.get(w, 0) + times
            for s, times, members in of_seed:
                spans = [(0, len(s) - LENGTH + 1)] if times > 1 else spans_of([count[w] > 1 for w in windows(s, packed)])
                key = text_key(s)
                for f, e in spans:
                    for run in members:
                        for column, value in zip(out[blocks[run]], (key, f, e)):
                            column.append(value)
        return pa.Table.from_batches([record([(b, WINDOWS, *map(np.array, cols)) for b, cols in out.items()], REPLY)])

    return runs.groupBy("bin").applyInArrow(join, REPLY_DDL)


def windows(stretch: bytes, packed: bool) -> Iterator[bytes]:
    """The windows of a stretch, or (for a seed with long stretches, periodic text) their 128-bit digests, to hold less."""
    n = len(stretch) - LENGTH + 1
    if not packed:
        return (stretch[i:i + LENGTH] for i in range(n))
    return (hashlib.blake2b(stretch[i:i + LENGTH], digest_size=16).digest() for i in range(n))


def spans_of(marks: list[bool]) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.array(marks, np.int8), prepend=0, append=0))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def rest_of(text: bytes, told: Replies) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, bytes that stay)."""
    if len(text) >= LENGTH and text_key(text) | 1 in told.copies:
        return len(text), 1, b""
    step = None
    _, first, end = told.repeating(text)
    for i, f, e in told.windows([text_key(text[a:z]) for a, z in zip(first.tolist(), end.tolist())]):
        if step is None:
            step = np.zeros(len(text) + 1, np.int32)
        step[first[i] + f] += 1
        step[first[i] + e - 1 + LENGTH] -= 1
    if step is None:
        return 0, 0, text
    gone = np.cumsum(step[:-1]) > 0
    return int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), np.frombuffer(text, np.uint8)[~gone].tobytes()


def cleaned(docs: DataFrame, replies: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) per row of docs(block, doc_id, text)."""

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        told, rows = Replies(right), []
        for _, texts in text_runs(left.column("text").combine_chunks()):
            rows += [(len(t), *rest_of(t, told)) for t in texts]
        n, removed, spans, kept = zip(*rows) if rows else ((), (), (), ())
        return pa.table({"doc_id": left.column("doc_id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        rewrite, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of documents read from files."""
    size = max(16, docs.count() // BUCKET_DOCS)
    block = F.concat_ws(":", F.col("_metadata.file_path"), F.expr(f"_metadata.row_index div {BLOCK_ROWS}"))
    blocks = docs.select(block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    seeds = materialize(repeated_keys(seed_requests(blocks, size)), "repeat-seeds")
    hits = materialize(repeated_windows(sorted_runs(blocks, seeds, size)), "repeat-windows")
    return cleaned(blocks, seeds.unionByName(hits))


def deduplicate(docs: DataFrame) -> DataFrame:
    """remove_repeats of any DataFrame: it is written to the shared folder first, which gives rows a place."""
    return remove_repeats(materialize(docs.select("doc_id", "text"), "repeat-docs"))


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op5_suffix_merge_dedup": suffix_query}
ORACLE: dict[str, str] = {}
