"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window). A
document contains a window only if it contains all of the window's words, so one word is prefix
enough: the words of the benchmark are counted over all documents, each window is ordered by
rarity and joined by its rarest word. The word's offset in the window fixes the only place where
the window can start (positional bound); it must lie inside the document (length bound); then the
words of that place are compared one by one. Windows are joined once per distinct text.

The prefix table (one row per distinct window) is broadcast if its measured size is at most
``broadcast_bytes``, and compared inside the scan. Beyond that the join shuffles, and candidates
are joined back to the documents' words.

Defined results: a null text has no words; a null ``item_id`` still marks words but is not
listed; repeated document rows get the same answer each; items of the same text are all listed;
other columns are ignored; without benchmark windows every count is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import ascii_lower, materialize, table

WINDOW = 10
BROADCAST_BYTES = 32 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def size_in_bytes(df: DataFrame, text: str, copies: int = 1) -> int:
    """Rough size of a broadcast: bytes of a text column, held ``copies`` times, and 100 bytes a row."""
    return df.agg(F.sum(copies * F.octet_length(text) + 100).alias("b")).first()["b"] or 0


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, window, words) for every window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = items.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.slice("w", F.col("at"), F.lit(size)).alias("words"))
    return cut.select("item_id", F.array_join("words", " ").alias("window"), "words").distinct()


def rarest_words(windows: DataFrame, doc_words: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(window, words, word, offset): the window's word that documents use least, and its first place.

    The benchmark's words are broadcast within ``broadcast_bytes``; beyond that document words are
    added up before they meet them, so a frequent word is one row.
    """
    distinct = windows.select("window", "words").dropDuplicates(["window"])
    placed = distinct.select("window", "words", F.posexplode("words").alias("offset", "word"))
    wanted = materialize(placed.select("word").distinct(), "benchmark-words")
    spread = doc_words.select(F.explode("w").alias("word"))
    count = F.count(F.lit(1)).alias("uses")
    if size_in_bytes(wanted, "word") <= broadcast_bytes:
        used = spread.join(F.broadcast(wanted), "word", "left_semi").groupBy("word").agg(count)
    else:
        used = spread.groupBy("word").agg(count).join(wanted, "word", "left_semi")
    rank = F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), F.col("word"), F.col("offset"))
    best = (placed.select("window", "word", "offset").join(used, "word", "left")
            .groupBy("window").agg(F.min(rank).alias("best")))
    # Windows whose rarest word no document has cannot occur.
    return (distinct.join(best.where("best.uses > 0"), "window")
            .select("window", "words", F.col("best.word").alias("word"), F.col("best.offset").alias("offset")))


def occurrences(docs: DataFrame, prefixes: DataFrame, in_scan: bool) -> DataFrame:
    """(key, start, size, window) of every window found in docs(key, w); start counts from 0."""
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (start + F.size("words") <= F.col("n"))
    if in_scan:
        spread = docs.select("key", "w", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
        found = spread.join(F.broadcast(prefixes), "word").where(inside)
    else:
        spread = docs.select("key", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
        found = spread.join(prefixes, "word").where(inside).drop("n").join(docs.dropDuplicates(["key"]), "key")
    same = F.slice("w", start + 1, F.size("words")) == F.col("words")
    return found.where(same).select("key", start.alias("start"), F.size("words").alias("size"), "window")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row of documents(doc_id, text)."""
    base = docs.select("doc_id", F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                                                   F.coalesce("text", F.lit("")))).alias("key"), words(F.col("text")).alias("w"))
    windows = materialize(item_windows(benchmark, size), "windows")
    prefixes = materialize(rarest_words(windows, base, broadcast_bytes), "prefixes")
    in_scan = size_in_bytes(prefixes, "window", 3) <= broadcast_bytes
    found = materialize(occurrences(base.select("key", "w"), prefixes, in_scan).distinct(), "hits")

    # Words covered per document: each occurrence adds what lies beyond all earlier ends.
    spans = found.select("key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    listed = (found.select("key", "window").distinct().join(windows.select("window", "item_id"), "window")
              .groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    per_key = hit.join(listed, "key", "left")
    return (base.select("doc_id", "key", F.size("w").cast("long").alias("n_words")).join(per_key, "key", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns; rows without an id stay if clean."""
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    base = docs.select("text", key.alias("key"), words(F.col("text")).alias("w"))
    windows = materialize(item_windows(benchmark, WINDOW), "windows")
    prefixes = materialize(rarest_words(windows, base, BROADCAST_BYTES), "prefixes")
    in_scan = size_in_bytes(prefixes, "window", 3) <= BROADCAST_BYTES
    bad = materialize(occurrences(base.select("key", "w"), prefixes, in_scan).select(F.col("key").alias("_contaminated_key")).distinct(), "hits")
    return docs.join(bad, key == bad["_contaminated_key"], "left_anti")


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT rid, k, s, array_to_string(list_slice(w, s, s + k - 1), ' ') AS t
  FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM d JOIN ks ON len(w) >= k)),
hit AS (SELECT DISTINCT rid, s, dw.k, item_id FROM dw JOIN win ON dw.t = win.t AND dw.k = win.k),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(s, s + k - 1)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

QUERIES = {"op2_prefix_decontamination": decontaminate_query}
ORACLE = {"op2_prefix_decontamination": SQL}
