"""Word shingles as 64-bit hashes, computed over whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(7)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (all input bits reach all output bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) in runs of about ``limit`` bytes; null is the empty text."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64).tolist()
    raw = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    lo, total = 0, 0
    for i, s in enumerate(size):
        if total and total + s > limit:
            yield lo, [t or b"" for t in raw.slice(lo, i - lo).to_pylist()]
            lo, total = i, 0
        total += s
    if lo < len(size):
        yield lo, [t or b"" for t in raw.slice(lo).to_pylist()]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end): words are runs without ASCII white space."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    text_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    bounds = np.searchsorted(starts, text_at)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    power = np.cumprod(np.full(int(lens.max()), _BASE, np.uint64), dtype=np.uint64)
    small = np.int32 if len(data) < 1 << 31 else np.int64
    place = np.arange(int(lens.sum()), dtype=small)
    place -= np.repeat(first.astype(small), lens)
    terms = power[place]  # in place from here: these arrays are eight times the texts
    del place
    terms *= data[word].astype(np.uint16) + np.uint16(1)
    h = np.add.reduceat(terms, first)
    return mix(h + lens.astype(np.uint64) * _PLACE[63]), bounds


def shingle_hashes(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The hashes of each text's shingles in order. A text of fewer words, but not none, is one shingle."""
    h, bounds = word_hashes(texts)
    count = len(h) - words + 1
    rolled = np.zeros(max(count, 0), np.uint64)
    for j in range(words):
        rolled += h[j:j + len(rolled)] * _PLACE[j]
    rolled = mix(rolled)
    for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
        n = hi - lo
        if n >= words:
            yield rolled[lo:hi - words + 1]
        elif n:
            short = (h[lo:hi] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True)
            yield mix(short + _PLACE[62 - n])
        else:
            yield rolled[:0]
