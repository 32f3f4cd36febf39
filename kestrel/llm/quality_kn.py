"""Quality rules: n-gram perplexity under a modified Kneser-Ney model, with bands by language.

Spark counts the 4-grams of every distinct text by language. Texts are written in 64 symbols without
loss, a byte as one symbol or two (see ``_code``), and end with a symbol that is counted and predicted
like the others; so every byte is modelled and a language still has at most 64^4 4-grams whatever the
corpus. Texts are told apart by 64-bit hashes, and copies count once, or the model would learn a copied
text by heart. From these counts the
interpolated modified Kneser-Ney probabilities and back-off weights of orders 1 to 4 are
computed and kept in arrays sorted by (language, n-gram) key; a lookup is a binary search. Each
document gets its perplexity per byte, the end being one more; a language's band is the median of the log
perplexity plus and minus a number of robust standard deviations (median absolute deviation)
over the distinct texts of the language that pass the base rules, so copies do not narrow it. A
language with a zero deviation or fewer than MIN_TEXTS texts gets at least the deviation of all
languages' texts from their medians; where that is zero too there is no band. A text shorter than the language's
median has a wider band, by the square root of the ratio of the lengths: its mean log
probability varies that much more.

Defined results: a null text has no words and fails the base rules, a null ``lang`` is a
language of its own, repeated rows get equal verdicts, other columns pass through the filter
form unchanged, an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table
from kestrel.llm.shingles import text_runs

ORDER, SYMBOL_BITS = 4, 6
LOW_DEVIATIONS, HIGH_DEVIATIONS = 5.0, 5.0
MIN_TEXTS = 30
SCORED_BYTES = 1 << 20  # of texts looked at together; a byte takes about 50 bytes of arrays
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
SYMBOLS = "#*$%&|<>"


BOUND = 55  # around every text, never inside one


def _code() -> tuple[np.ndarray, np.ndarray]:
    """Byte -> (symbol, second symbol or -1), so that a text's symbols give back its bytes.

    Letters, space, newline, three marks and the first bytes of the commonest two-byte characters have a
    symbol of their own. A byte that goes on a UTF-8 character is its six bits: the first byte tells how many
    follow. Every other byte is a mark for its range and its six bits. A text never holds the byte 255.
    """
    every = np.arange(256)
    first, second = np.array([56, 57, 0, 58])[every >> 6], every & 63
    one = [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), ord(" "), ord("\n"), 255]
    first[one], second[one] = [*range(1, 53), 53, 54, BOUND], -1
    common = [*b".,-", 0xC3, 0xD0, 0xD1]
    first[common], second[common] = np.array([59, 60, 61, 62, 63, 0]), -1
    follow = slice(128, 192)
    first[follow], second[follow] = every[follow] & 63, -1
    return first.astype(np.int32), second.astype(np.int32)


FIRST, SECOND = _code()


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each symbol and at the end of each text, first place of each text and the end).

    Every byte of a text is one symbol or two; bounds stand before the text, and one more is its end.
    """
    pad = b"\xff" * (order - 1)
    raw = np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)
    size = np.where(SECOND >= 0, 2, 1).astype(np.int8)[raw]
    at = np.cumsum(size, dtype=np.int32 if len(raw) < 1 << 30 else np.int64) - 1  # the last symbol of each byte
    data = np.zeros(int(at[-1]) + 1 if len(at) else 0, np.int32)
    two = size == 2
    data[at] = np.where(two, SECOND[raw], FIRST[raw])
    data[at[two] - 1] = FIRST[raw[two]]
    g = np.zeros(len(data), np.int32 if order * SYMBOL_BITS < 32 else np.int64)
    for j in range(order):
        g[j:] |= data[:len(data) - j].astype(g.dtype) << (SYMBOL_BITS * j)
    ends = at[np.cumsum([len(t) + order - 1 for t in texts], dtype=np.int64)].astype(np.int64) if texts else np.zeros(0, np.int64)
    keep = np.ones(len(g), bool)
    keep[at[raw == 255]] = False
    keep[ends] = True
    return g[keep], np.concatenate([[0], ends + 1 - (order - 1) * (np.arange(len(texts)) + 1) + np.arange(len(texts))])


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One (keys, counts) from several."""
    codes, seen = pd.factorize(np.concatenate([k for k, _ in parts]))
    return seen, np.bincount(codes, np.concatenate([n for _, n in parts]), len(seen)).astype(np.int64)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all documents; each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, texts in text_runs(batch.column(1)):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(langs[lo:lo + len(texts)], texts):
                    by_lang.setdefault(lang, []).append(text)
                for lang, group in by_lang.items():
                    codes, seen = pd.factorize(grams(group)[0])
                    parts = held.setdefault(lang, [])
                    parts.append((seen, np.bincount(codes, minlength=len(seen))))
                    if len(parts) >= 16:
                        held[lang] = [merged(parts)]
        for lang, parts in held.items():
            seen, n = merged(parts)
            for at in range(0, len(seen), 100_000):
                part = seen[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part.astype(np.int32)),
                     pa.array(n[at:at + 100_000].astype(np.int64))], names=["lang", "gram", "n"])

    part = docs.where(F.octet_length("text") > 0).select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text").mapInArrow(
        run, "lang string, gram int, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(counts: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the counts of counts; plain 0.5, 1, 1.5 where these are too few to tell."""
    n = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
    if min(n) == 0:
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]])
    return np.clip(d, [0.05, 0.05, 0.05], [1, 2, 3])


@dataclass
class KneserNey:
    """Sorted key arrays by order: ``prob[k]`` of seen n-grams, ``back[k]`` of seen contexts of length k."""

    langs: list[str]
    keys: list[np.ndarray]
    prob: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]

    @classmethod
    def fit(cls, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> "KneserNey":
        """lang: index into langs; counts of the highest order. Lower orders count distinct left neighbours."""
        key = (lang.astype(np.int64) << (SYMBOL_BITS * ORDER)) | gram
        by = np.argsort(key)
        levels = [(key[by], n[by].astype(np.int64))]
        for k in range(ORDER - 1, 0, -1):
            above = levels[0][0]
            tail = ((above >> (SYMBOL_BITS * (k + 1))) << (SYMBOL_BITS * k)) | (above & ((1 << (SYMBOL_BITS * k)) - 1))
            levels.insert(0, np.unique(tail, return_counts=True))
        keys, prob, contexts, back = [], [], [], []
        for k, (kk, c) in enumerate(levels, 1):
            d = discounts(c)[np.minimum(c, 3) - 1]
            ctx, at = np.unique(kk >> SYMBOL_BITS, return_inverse=True)
            total = np.bincount(at, c)
            weight = np.bincount(at, d) / total
            lower = (np.full(len(kk), 1.0 / (1 << SYMBOL_BITS)) if k == 1 else
                     prob[-1][np.searchsorted(keys[-1], cls._tail(kk, k - 1))])
            keys.append(kk)
            prob.append((c - d) / total[at] + weight[at] * lower)
            contexts.append(ctx)
            back.append(weight)
        return cls(langs, keys, prob, contexts, back)

    @staticmethod
    def _tail(key: np.ndarray, k: int) -> np.ndarray:
        """The last k symbols of (k + 1)-grams, with the language kept."""
        return ((key >> (SYMBOL_BITS * (k + 1))) << (SYMBOL_BITS * k)) | (key & ((1 << (SYMBOL_BITS * k)) - 1))

    @staticmethod
    def _find(sorted_keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, key), max(len(sorted_keys) - 1, 0))
        return at, (sorted_keys[at] == key if len(sorted_keys) else np.zeros(len(key), bool))

    def log_prob(self, lang: int, gram: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each gram of the highest order."""
        key = (np.int64(lang) << (SYMBOL_BITS * ORDER)) | gram
        chain = [key]
        for k in range(ORDER - 1, 0, -1):
            chain.insert(0, self._tail(chain[0], k))
        p = np.full(len(gram), 1.0 / (1 << SYMBOL_BITS))
        for k in range(ORDER):
            at, seen = self._find(self.keys[k], chain[k])
            ctx, known = self._find(self.contexts[k], chain[k] >> SYMBOL_BITS)
            p = np.where(known, self.back[k][ctx] * p, p) if len(self.contexts[k]) else p
            p = np.where(seen, self.prob[k][at], p) if len(self.keys[k]) else p
        return np.log(p)


def fit_model(docs: DataFrame) -> KneserNey:
    """Counts of the distinct texts with Spark; the driver holds one entry per (language, seen 4-gram)."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    texts = docs.select(lang, "text", F.xxhash64("text").alias("digest")).dropDuplicates(["lang", "digest"])
    counts = count_grams(texts).toPandas()
    langs = sorted(counts["lang"].unique())
    index = {x: i for i, x in enumerate(langs)}
    return KneserNey.fit(langs, counts["lang"].map(index).to_numpy(np.int64), counts["gram"].to_numpy(np.int64),
                         counts["n"].to_numpy(np.int64))


METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, log_ppl double")
WHITE = " \t\n\x0b\x0c\r"
_NO_WHITE = str.maketrans("", "", WHITE)


def repeated_words(words: list) -> int:
    """Words inside 5-word windows that occur at least twice in the text."""
    if len(words) < 6:
        return 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    total, covered = 0, 0  # covered: words before this place that are counted or passed
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 5 - max(i, covered)
            covered = i + 5
    return total


def base_metrics(text: str, raw: bytes) -> tuple:
    words = raw.split()
    seen, dup = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(WHITE):
                if line in seen:
                    dup += 1
                seen.add(line)
    n, repeat = len(words), repeated_words(words)
    white = sum(map(text.count, WHITE))
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    return n, len(text) - white, sum(map(text.count, SYMBOLS)), dup, repeat, failed


def scored(docs: DataFrame, model: KneserNey | Broadcast, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row and the METRICS; ``log_ppl`` is null for an empty text.

    A text goes to the workers once, also where it is kept. Give the broadcast of a model that scores twice.
    """
    shared = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(keep))]
    schema = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, names)]).schema
    sent = [c for c in keep if c != "text"]
    place = [1 if c == "text" else 2 + sent.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = shared.value
        index = {x: i for i, x in enumerate(kn.langs)}
        for batch in batches:
            langs = [index.get(x, len(index)) for x in batch.column(0).to_pylist()]
            for lo, texts in text_runs(batch.column(1), SCORED_BYTES):
                ppl = np.full(len(texts), np.nan)
                here = np.array(langs[lo:lo + len(texts)])
                for lang in np.unique(here):
                    rows = np.flatnonzero(here == lang)
                    g, starts = grams([texts[i] for i in rows])
                    codes, seen = pd.factorize(g)
                    sums = np.add.reduceat(kn.log_prob(int(lang), seen)[codes], starts[:-1])
                    size = np.array([len(texts[i]) for i in rows])
                    ppl[rows] = np.where(size, -sums / (size + 1), np.nan)
                base = [base_metrics(t.decode(), t) for t in texts]
                cols = [batch.column(i).slice(lo, len(texts)) for i in place]
                metric = [pa.array(list(x), pa.int64() if i < 5 else pa.bool_()) for i, x in enumerate(zip(*base))]
                yield pa.RecordBatch.from_arrays([*cols, *metric, pa.array(ppl, from_pandas=True)],
                                                 names=[*names, *[m.split()[0] for m in METRICS.split(", ")]])

    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), F.col("text").alias("_text"),
                         *[F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(sent)])
    from pyspark.sql.types import StructType, _parse_datatype_string

    return source.mapInArrow(run, StructType(schema.fields + _parse_datatype_string(METRICS).fields))


def median(name: str) -> Column:
    """Mean of the lower and the upper median, so that two values have their middle."""
    return (F.percentile_approx(name, 0.5, 10000) - F.percentile_approx(-F.col(name), 0.5, 10000)) / 2


def bands(rows: DataFrame, digest: str) -> DataFrame:
    """(band_lang, mid, dev, size): by language the median log perplexity, its robust deviation and the median length.

    From rows with c0 = language and the digest of the text in the column ``digest``; one row per
    language. Every text counts once; ``dev`` is null where no texts differ.
    """
    texts = (rows.where("not base_failed and log_ppl is not null")
             .groupBy(F.coalesce("c0", F.lit("")).alias("band_lang"), digest)
             .agg(F.min("log_ppl").alias("log_ppl"), F.min("word_chars").alias("word_chars")))
    mid = texts.groupBy("band_lang").agg(median("log_ppl").alias("mid"),
                                         F.percentile_approx("word_chars", 0.5, 10000).alias("size"))
    off = texts.join(F.broadcast(mid), "band_lang").withColumn("off", F.abs(F.col("log_ppl") - F.col("mid")))
    deviation = 1.4826 * median("off")
    own = off.groupBy("band_lang", "mid", "size").agg(deviation.alias("own"), F.count("*").alias("texts"))
    dev = F.when((F.col("own") > 0) & (F.col("texts") >= MIN_TEXTS), F.col("own")).otherwise(F.greatest("own", "pooled"))
    return (own.crossJoin(F.broadcast(off.agg(deviation.alias("pooled"))))
            .select("band_lang", "mid", "size", F.nullif(dev, F.lit(0.0)).alias("dev")))


def with_verdict(rows: DataFrame, limits: DataFrame, low: float = LOW_DEVIATIONS,
                 high: float = HIGH_DEVIATIONS) -> DataFrame:
    """Adds kept: not base_failed and the log perplexity inside the language's band."""
    wider = F.sqrt(F.greatest(F.lit(1.0), F.col("size") / F.greatest(F.lit(1), F.col("word_chars"))))
    off = (F.col("log_ppl") - F.col("mid")) / wider
    inside = F.coalesce((off >= -low * F.col("dev")) & (off <= high * F.col("dev")), F.lit(True))
    return (rows.join(F.broadcast(limits), F.coalesce("c0", F.lit("")) == F.col("band_lang"), "left")
            .withColumn("kept", ~F.col("base_failed") & inside))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass the base rules and their language's band, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs))
    texts = docs.select("lang", "text", F.xxhash64("text").alias("digest"))
    measured = materialize(scored(texts, model, ["lang", "digest"]), "quality")
    limits = materialize(bands(measured, "c1"), "bands")
    columns = list(docs.columns)
    full = with_verdict(scored(docs, model, ["lang", *columns]), limits).where("kept")
    return full.select(*[F.col(f"c{i + 1}").alias(c) for i, c in enumerate(columns)])


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("lang", "doc_id", "text", F.xxhash64("text").alias("digest"))
    measured = materialize(scored(texts, fit_model(docs), ["lang", "doc_id", "digest"]), "quality")
    out = with_verdict(measured, materialize(bands(measured, "c2"), "bands"))
    return out.select(F.col("c1").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "log_ppl")


QUERIES = {"op3_ngram_perplexity": quality_query}
ORACLE: dict[str, str] = {}
