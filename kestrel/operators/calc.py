"""Projections and filters of the auction queries (q0, q1, q2, q14, q21, q22) and the
simple record jobs (threshold filter, cos/cbrt number crunch). All native expressions:
one scan, one whole-stage-codegen span, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions import scalar as S

BID_COLUMNS = ["auction", "bidder", "price", "channel", "url", "dateTime", "extra"]

# Fixed values of q21: channels with a known id, in the order of their ids 0..3.
KNOWN_CHANNELS = ["apple", "google", "facebook", "baidu"]
CHANNEL_ID_PATTERN = "(&|^)channel_id=([^&]*)"


def passthrough(bid: DataFrame) -> DataFrame:
    """q0: the bid columns unchanged."""
    return bid.select(*BID_COLUMNS)


def currency(bid: DataFrame) -> DataFrame:
    """q1: price converted with ``0.908 * price`` as DECIMAL(23,3)."""
    return bid.select("auction", "bidder", S.dollar_to_euro("price").alias("price"),
                      "channel", "url", "dateTime", "extra")


def mod_filter(bid: DataFrame, modulus: int = 123) -> DataFrame:
    """q2: bids whose auction id is divisible by ``modulus``; price stored as DECIMAL(23,3)."""
    return (bid.where(F.col("auction") % modulus == 0)
            .select("auction", "bidder", F.col("price").cast("decimal(23,3)").alias("price"),
                    "channel", "url", "dateTime", "extra"))


def calc(bid: DataFrame, low: int = 1_000_000, high: int = 50_000_000) -> DataFrame:
    """q14: euro price band filter (both ends open), time-of-day class and count of 'c'."""
    euro = S.dollar_to_euro("price")
    return (bid.withColumn("price", euro)
            .where((F.col("price") > low) & (F.col("price") < high))
            .select("auction", "bidder", "price",
                    S.bid_time_type("dateTime").alias("bidTimeType"),
                    "dateTime", "extra", S.count_char("extra", "c").alias("c_counts")))


def channel_id(bid: DataFrame) -> DataFrame:
    """q21: id of the four known channels, else the ``channel_id`` URL parameter.

    The whole regex match (group 0) is computed once per row in its own projection: it
    is non-empty exactly when the pattern matches (it always contains ``channel_id=``),
    and the value (group 2) is what follows the first ``channel_id=`` in it, so a matched
    empty value stays ''. The filter is a plain OR, not a test on the CASE result, which
    the optimizer would expand into nested branches that each re-run the regex.
    """
    x = (bid.select("auction", "bidder", "price", "channel", F.lower("channel").alias("_lc"),
                    F.regexp_extract("url", CHANNEL_ID_PATTERN, 0).alias("_m"))
         .where(F.col("_lc").isin(*KNOWN_CHANNELS) | (F.col("_m") != "")))
    m = F.col("_m")
    from_url = m.substr(F.instr(m, "channel_id=") + len("channel_id="), F.length(m))
    cid = F.when(F.col("_lc") == KNOWN_CHANNELS[0], "0")
    for i, name in enumerate(KNOWN_CHANNELS[1:], start=1):
        cid = cid.when(F.col("_lc") == name, str(i))
    return x.select("auction", "bidder", "price", "channel", cid.otherwise(from_url).alias("channel_id"))


def url_dirs(bid: DataFrame) -> DataFrame:
    """q22: URL path fields 3, 4, 5 (0-based split on '/'), NULL when absent."""
    return bid.select("auction", "bidder", "price", "channel",
                      *[S.split_index("url", "/", i).alias(f"dir{i - 2}") for i in (3, 4, 5)])


def threshold_filter(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Keep rows with ``col > threshold`` (strict)."""
    return df.where(F.col(col) > threshold)


def number_crunch(df: DataFrame, col: str) -> DataFrame:
    """``cos(cbrt(v))`` per value."""
    return df.select(S.cos_cbrt(F.col(col).cast("double")).alias("value"))


def split_words(df: DataFrame, text: str, out: str = "word", keep: list[str] | None = None) -> DataFrame:
    """One row per word of ``text`` split on single spaces, like Java's ``split(" ")``:
    empty words between spaces are kept, trailing empty words are dropped (so a line of
    spaces has no words) and an empty line is one empty word."""
    t = F.col(text)
    words = (F.when(t == "", F.array(F.lit("")))
             .when(F.rtrim(t) == "", F.array().cast("array<string>"))
             .otherwise(F.split(F.rtrim(t), " ", -1)))
    return df.select(*(keep or []), F.explode(words).alias(out))
