"""Token-ID output: Parquet list columns with dictionary or delta encoding.

``write_tokens`` range-partitions documents by id, encodes each partition in order and writes
one file per partition: ``doc_id``, ``ids`` (list of int, closed by the end id), ``n_tokens``,
``part`` (the file's place in the order) and ``local_start`` (ids before the document in its
file). Row-group size, rows per page and encoding are parameters; the writer adds page
indexes, so a filter on ``doc_id`` (ascending within and across files) reads few pages, and
metadata reads never touch the ``ids`` column.

Defined results: a null text is the empty text, a document without ids is the end id alone, a
null ``doc_id`` sorts first, repeated rows are written once each (ties in ``doc_id`` are ordered
by a hash of the text, then the text), an empty table gives no rows. Other columns are ignored.

Special tokens are the library's: a literal ``<|endoftext|>`` in a text becomes its id, as by
``encode(text, add_special_tokens=False)``; ``plain_specials`` encodes it as other text.

Speed: the pre-tokenizer never lets a token cross the place before a single space or newline
that precedes a word, so the text between two such places always encodes alike. Texts are split
there by Arrow, and only the distinct pieces of a run are looked up. Each worker remembers the ids of
pieces (at most ``CACHE_PIECES``) and hands only new ones to the library: words of letters, which its pattern
never cuts, to the tokenizer's model, the others to the tokenizer, joined into one string; their ends are found
again from the byte length of each id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import table
from kestrel.session import shared_folder

END_ID = 0
CACHE_PIECES = 500_000
BATCH_BYTES = 4 << 20
SCHEMA = "doc_id long, ids array<int>, n_tokens long, part int, local_start long"

# Kinds of UTF-8 bytes: white space, first bytes of characters that may be white space, those not sure to be in a letter.
# U+00C0 to U+023F are letters but for two signs that end in 0x97 and 0xB7.
BLANK, UNSURE, OTHER = 1, 2, 4
LETTER_LEAD = 0xC3, 0xC8
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(LETTER_LEAD[0], LETTER_LEAD[1] + 1)]] = 0
KINDS[[0x97, 0xB7]] = OTHER
KINDS[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] |= BLANK
KINDS[[0xC2, 0xE1, 0xE2, 0xE3]] |= UNSURE

_ENCODERS: dict[str, "ChunkEncoder"] = {}


class ChunkEncoder:
    """One tokenizer file with a bounded memory of the ids of pieces.

    A piece is a word after one space, or a newline and the word after it. A text with other
    white space, with two white-space characters side by side or with a special token is encoded whole.
    Ids lie one after the other in ``pool``: ``size[k]`` ids of piece ``k`` from ``begin[k]`` on; piece 0 has none.
    """

    def __init__(self, path: str, cache: int = CACHE_PIECES, plain_specials: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # A space and letters are one match of the pre-tokenizer's pattern: such words go straight to the model,
        # their bytes as the characters that stand for them.
        self.tokenize = self.tok.model.tokenize
        self.shown = np.full(256, ord("|"), "<u4")
        show = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        for c in map(chr, [0x0A, 0x20, *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x240)]):
            self.shown[list(c.encode())] = [ord(x) for x in show(c)[0][0]]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # a byte-level token has one character per byte
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.mark = np.zeros(256, "<i4")
        for m in ".,":
            self.mark[ord(m)] = self._ids(m)[0]  # one byte is one id, the newline before a text too
        self.cache: dict[str, int] = {}
        self.limit = cache
        self.begin, self.size, self.pool = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, "<i4")
        self.pieces, self.used = 1, 0

    @classmethod
    def of(cls, path: str) -> "ChunkEncoder":
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Puts the ids of pieces at the pool's end; the pieces' numbers."""
        pieces, used = self.pieces + len(size), self.used + len(ids)
        if pieces > len(self.size):
            self.begin, self.size = (np.concatenate([x, np.zeros(pieces, np.int64)]) for x in (self.begin, self.size))
        if used >= len(self.pool):  # the place after the last id is there too
            self.pool = np.concatenate([self.pool, np.zeros(used + 1, "<i4")])
        self.begin[self.pieces:pieces] = self.used + np.cumsum(size) - size
        self.size[self.pieces:pieces] = size
        self.pool[self.used:used] = ids
        added = np.arange(self.pieces, pieces)
        self.pieces, self.used = pieces, used
        return added

    def _gather(self, numbers: np.ndarray, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, each with ``more`` places behind; the end of each."""
        n = self.size[numbers] + more
        ends = np.cumsum(n)
        at = np.repeat(self.begin[numbers] - (ends - n), n)
        at += np.arange(len(at))
        return self.pool[at], ends

    def _encode(self, words: pa.Array, lettered: np.ndarray) -> np.ndarray:
        """The numbers of new words: those of letters alone go to the model, the others are encoded in one text."""
        numbers = np.zeros(len(words), np.int64)
        for chosen, sep in ((lettered, "|"), (~lettered, "")):
            if not chosen.any():
                continue
            part = words.filter(pa.array(chosen))
            lined = pc.starts_with(part, "\n")
            spaced = pc.if_else(lined, pc.replace_substring(part, "\n", "\n" + sep), pc.binary_join_element_wise("", part, " "))
            text = sep.join(spaced.to_numpy(zero_copy_only=False).tolist())
            if sep:
                shown = self.shown[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
                ids = np.array([t.id for w in shown.split(sep) for t in self.tokenize(w)], "<i4")
            else:
                ids = self._ids(text)
            bytes_in = np.cumsum(np.asarray(pc.binary_length(part), np.int64) + ~np.asarray(lined))
            ends = np.searchsorted(np.cumsum(self.width[ids]), bytes_in, side="left") + 1
            numbers[chosen] = self._add(ids, np.diff(ends, prepend=0))
        return numbers

    def _learn(self, new: pa.Array, strings: list[str]) -> np.ndarray:
        """The numbers of new distinct pieces, encoded together; 0 for pieces with inner white space."""
        length = np.asarray(pc.binary_length(new), np.int64)
        end = np.cumsum(length)
        # Two bytes before the first piece, so that a piece's last three bytes can always be looked at.
        data = np.frombuffer(b"  " + "".join(strings).encode(), np.uint8)
        kind = KINDS[data]
        of = np.zeros((3, len(new)), np.int64)
        for k, bit in enumerate((BLANK, UNSURE, OTHER)):
            seen = np.cumsum(kind & bit != 0)
            of[k] = seen[end + 1] - seen[end - length + 1]
        blank, unsure, other = of
        lined = (length > 0) & (data[np.minimum(end - length + 2, len(data) - 1)] == 10)
        good = (length > lined) & (blank == lined)
        for i in np.flatnonzero(good & (unsure > 0)).tolist():
            p = strings[i]
            x = p.split()
            good[i] = len(x) == 1 and (x[0] == p or "\n" + x[0] == p)
        # A letter and a full stop or comma are never in one token: only the word before is new.
        last, before, third = data[end + 1], data[end], data[end - 1]
        letter = ((before | 32) >= 97) & ((before | 32) <= 122) | ((LETTER_LEAD[0] <= third) & (third <= LETTER_LEAD[1]) & (KINDS[before] == 0) & (length > 2))
        marked = good & (length > 1 + lined) & ((last == 46) | (last == 44)) & letter
        numbers = np.zeros(len(new), np.int64)
        at = np.flatnonzero(good)
        words = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(new, 0, -1), new).filter(pa.array(good)).dictionary_encode()
        index = np.asarray(words.indices)
        lettered = np.zeros(len(words.dictionary), bool)
        lettered[index] = (other - lined - marked)[at] == 0
        names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        word = np.zeros(len(names), np.int64)
        stems = np.unique(index[marked[at]])  # pieces without a mark are not in the cache
        word[stems] = [self.cache.get(names[i], 0) for i in stems.tolist()]
        unknown = word == 0
        keep = len(self.cache) + int(unknown.sum()) + int(marked.sum()) <= self.limit
        if unknown.any():
            word[unknown] = self._encode(words.dictionary.filter(pa.array(unknown)), lettered[unknown])
        numbers[at] = word[index]
        if marked.any():
            ids, ends = self._gather(numbers[marked], 1)
            ids[ends - 1] = self.mark[last[marked]]
            numbers[marked] = self._add(ids, np.diff(ends, prepend=0))
        if keep:  # once full, new pieces serve their batch only
            self.cache.update((names[i], n) for i, n in zip(np.flatnonzero(unknown).tolist(), word[unknown].tolist()))
            self.cache.update((strings[i], n) for i, n in zip(np.flatnonzero(marked).tolist(), numbers[marked].tolist()))
            self.kept = self.pieces, self.used
        return numbers

    def arrays(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, without an end id; null is the empty text."""
        texts = pc.fill_null(texts, "")
        special = np.zeros(len(texts), bool)
        for token in self.specials:
            special |= np.asarray(pc.match_substring(texts, token))
        cut = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        lists = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(cut, "\n", " \n"), ""), " ")
        first = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        pieces, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
        numbers = np.array(list(map(self.cache.get, pieces, repeat(0))), np.int64)
        missing = numbers == 0
        self.kept = self.pieces, self.used
        if missing.any():
            numbers[missing] = self._learn(coded.dictionary.filter(pa.array(missing)),
                                           [pieces[i] for i in np.flatnonzero(missing).tolist()])
        here = numbers[at]
        flat, ends = self._gather(here)
        self.pieces, self.used = self.kept
        text_at = np.concatenate([[0], ends])[first]
        # A text's ids begin after those of the newline put before it.
        out = [flat[a + 1:b] for a, b in zip(text_at.tolist(), text_at[1:].tolist())]
        whole = special | np.logical_or.reduceat(here == 0, first[:-1]) if len(texts) else special
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._ids(texts[i].as_py())
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian int32 bytes, without an end id; null is the empty text."""
        return [x.tobytes() for x in self.arrays(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))]


def encode_frame(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, n_tokens, part, local_start), one row per input row, in the order of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = ChunkEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<i4")
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in slices(texts, BATCH_BYTES):
                docs_ids = enc.arrays(texts.slice(lo, hi - lo))
                n = np.array([len(x) + 1 for x in docs_ids], np.int64)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.array(np.concatenate([y for x in docs_ids for y in (x, end)])))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo).cast(pa.int64()), lists, pa.array(n),
                     pa.array(np.full(len(n), part, np.int32)), pa.array(start + ends - n)],
                    names=["doc_id", "ids", "n_tokens", "part", "local_start"])
                start += int(ends[-1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes of text (a longer single text is a run of its own)."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    lo, total = 0, 0
    for i, s in enumerate(size.tolist()):
        if total and total + s > limit:
            yield lo, i
            lo, total = i, 0
        total += s
    if lo < len(size):
        yield lo, len(size)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, encoding: str = "dictionary",
                 row_group_bytes: int = 32 << 20, page_rows: int = 2000, order: list | None = None) -> None:
    """Encodes documents and writes them to ``path`` in ascending ``doc_id`` order (or by ``order``)."""
    by = order or [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]  # no texts in the sampled range bounds
    ranged = docs.repartitionByRange(*by).sortWithinPartitions(*by, F.col("text").asc_nulls_first())
    writer = (encode_frame(ranged, tokenizer, end_id).write
              .option("compression", "zstd")
              .option("parquet.block.size", str(row_group_bytes))
              .option("parquet.page.row.count.limit", str(page_rows)))
    if encoding == "dictionary":
        writer = writer.option("parquet.enable.dictionary", "true")
    elif encoding == "delta":
        writer = writer.option("parquet.enable.dictionary", "false").option("parquet.writer.version", "PARQUET_2_0")
    else:
        raise ValueError(f"encoding is dictionary or delta, not {encoding}")
    writer.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens and start (ids of all documents before it) without reading any ids."""
    return with_start(spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens", "part", "local_start"))


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id and ids of the documents with low <= doc_id <= high (pushed down to row groups and pages)."""
    df = spark.read.schema(SCHEMA).parquet(path)
    if low is not None:
        df = df.where(F.col("doc_id") >= low)
    if high is not None:
        df = df.where(F.col("doc_id") <= high)
    return df.select("doc_id", "ids")


def with_start(rows: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """start = ids of all earlier files plus local_start. One total per file goes through the ordered window;
    totals are read from ``metadata`` (part, n_tokens), by default the rows themselves."""
    totals = (rows if metadata is None else metadata).groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = totals.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    return (rows.join(before, "part").withColumn("start", F.col("_before") + F.col("local_start"))
            .drop("_before", "part", "local_start"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 from the written files."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            off = np.asarray(lists.offsets).tolist()
            raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), "<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), b.column(4), pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "part", "local_start", "ids_crc32"])

    written = spark.read.schema(SCHEMA).parquet(path)
    rows = written.mapInArrow(
        crc, "doc_id long, n_tokens long, part int, local_start long, ids_crc32 long")
    return with_start(rows, written.select("part", "n_tokens")).select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_digest(spark, path)


QUERIES = {"op7_token_output": token_query}
ORACLE: dict[str, str] = {}
