"""Secret scans by dictionary-primed zstandard novelty.

Fixed patterns give the base spans. The method looks further: a string near a sensitive word is a
candidate, and its marginal compressed size is measured, the bytes that zstandard needs for
context + candidate beyond those for the context alone, with a dictionary of the identifiers that
stand near sensitive words in this corpus. A candidate whose marginal bytes are at least
``NOVELTY`` of its length, or ``RANDOM`` of those of random strings of its alphabet and length (a
random string of a small alphabet costs less than its length), cannot be told from its surroundings or
from known identifiers and is reported as ``novel``. Other copies of the candidate are left out of its
context, so a key written several times is reported each time.

The dictionary holds the ``DICT_WORDS`` most frequent identifiers (ties by name), counted by Spark
over all documents; that number bounds what is sent to the executors.

Defined results: a null text is the empty text; offsets are code points, ends exclusive; repeated
rows give equal answers; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import table
from kestrel.llm.shingles import text_runs

# Base patterns of the contract (fixed values).
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGN, MIN_ACCESS = 8, 16

SENSITIVE = re.compile(r"passw|secret|token|api_?key|credential|private|bearer|auth|access_?key|akia|pwd|signature", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Words, camelCase, snake_case and UPPER_CASE; random strings of mixed case are none of these.
PART = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+)"
IDENTIFIER = re.compile(rf"(?<![A-Za-z0-9_])(?=\w{{3,32}}(?!\w)){PART}(?:_{PART})*(?![A-Za-z0-9_])")
NEAR, CONTEXT = 64, 256
DICT_WORDS = 2000
NOVELTY = 0.8
RANDOM = 0.9  # of what random strings of the candidate's alphabet and length cost in its place
HEXES = (b"0123456789abcdef", b"0123456789ABCDEF")
CLASSES = (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"+", b"/", b"_", b"=", b"-")
LEVEL = 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; matches under their length are dropped."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def windows(text: str) -> list[tuple[int, int]]:
    """Merged stretches of NEAR characters around each sensitive word."""
    out: list[tuple[int, int]] = []
    for m in SENSITIVE.finditer(text):
        lo, hi = max(0, m.start() - NEAR), m.end() + NEAR
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Strings of letters and digits mixed that overlap a window, at their full length."""
    near = windows(text)
    if not near:
        return []
    out, at = [], 0
    for m in CANDIDATE.finditer(text):
        while at < len(near) and near[at][1] <= m.start():
            at += 1
        if at == len(near):
            break
        s = m.group()
        if near[at][0] < m.end() and any(c.isdigit() for c in s) and any(c.isalpha() for c in s):
            out.append(m.span())
    return out


def without(text: str, lo: int, hi: int, own: str) -> str:
    """text[lo:hi] without what belongs to copies of ``own``: a key written twice is as new as written once."""
    kept, at = [], lo
    found = text.find(own, max(0, lo - len(own) + 1), hi + len(own) - 1)
    while found >= 0 and found < hi:
        if found + len(own) > lo:
            kept.append(text[at:max(at, found)])
            at = max(at, min(hi, found + len(own)))
        found = text.find(own, found + len(own), hi + len(own) - 1)
    return "".join(kept) + text[at:hi]


class Novelty:
    def __init__(self, words: list[str]):
        import zstandard

        raw = " ".join(reversed(words)).encode()  # the most frequent last: zstandard finds near matches best
        if len(raw) >= 8:
            primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
            self.z = zstandard.ZstdCompressor(dict_data=primed, write_content_size=False)
        else:
            self.z = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def share(self, text: str, start: int, end: int, own: bytes | None = None) -> float:
        """Marginal compressed bytes of text[start:end], or of ``own`` in its place, per byte, given what stands around it."""
        key, own = text[start:end], own or text[start:end].encode()
        before, after = (without(text, lo, hi, key).encode() for lo, hi in ((max(0, start - CONTEXT), start), (end, end + CONTEXT)))
        return (len(self.z.compress(before + own + after)) - len(self.z.compress(before + after))) / len(own)

    def novel(self, text: str, start: int, end: int, novelty: float) -> bool:
        """The share is at least ``novelty``, or nearly that of random strings of the same alphabet and length."""
        got = self.share(text, start, end)
        return got >= novelty or got >= RANDOM * min(self.share(text, start, end, x) for x in random_like(text[start:end].encode()))


def random_like(own: bytes) -> list[bytes]:
    """Two strings of the length of ``own`` over its alphabet, drawn from hashes of it."""
    seen = set(own)
    small = next((x for x in HEXES if seen <= set(x)), None)
    alphabet = small or b"".join(x if len(x) > 1 else bytes(seen & set(x)) for x in CLASSES if seen & set(x))
    table = bytes(alphabet[i % len(alphabet)] for i in range(256))
    return [hashlib.shake_256(bytes([k]) + own).digest(len(own)).translate(table) for k in range(2)]


def identifiers(docs: DataFrame, limit: int = DICT_WORDS) -> list[str]:
    """The most frequent identifiers near sensitive words, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                for t in texts:
                    text = t.decode()
                    for lo, hi in windows(text):
                        count.update(m.group() for m in IDENTIFIER.finditer(text[max(0, lo - 33):hi + 33])
                                     if lo <= m.start() + max(0, lo - 33) < hi)
                if len(count) > 200_000:
                    yield counted(count)
                    count = Counter()
        yield counted(count)

    def counted(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                          names=["word", "n"])

    total = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in total.orderBy(F.col("n").desc(), "word").limit(limit).collect()]


def scan(docs: DataFrame, words: list[str] | None = None, novelty: float = NOVELTY) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_novel for each row of documents(doc_id, text)."""
    known = identifiers(docs) if words is None else words

    def listed(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(known)
        for batch in batches:
            for lo, texts in text_runs(batch.column(1)):
                rows = []
                for t in texts:
                    text = t.decode()
                    base = base_spans(text)
                    more = [(s, 3, e) for s, e in candidates(text)
                            if not any(s < be and bs < e for bs, _, be in base) and measure.novel(text, s, e, novelty)]
                    n = Counter(k for _, k, _ in base)
                    rows.append((n[0], n[1], n[2], hashlib.sha256(listed(base).encode()).hexdigest(),
                                 listed(sorted(base + more)), len(more)))
                cols = list(zip(*rows))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)).cast(pa.int64()),
                     *[pa.array(list(c), k) for c, k in zip(cols, kinds)]],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op10_zstd_novelty": secrets_query}
ORACLE: dict[str, str] = {}
