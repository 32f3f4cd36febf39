"""Aggregations: daily price bands with filtered distinct counts (q15, q16), per-auction
daily statistics (q17) and keyed running sums.

Filtered ``count(DISTINCT ...)`` over two columns makes Spark expand every row once per
distinct column (``Expand``) and join or re-aggregate per band. Here one scan tags each bid
with its bidder and its auction, ``group by (keys, tag, value)`` keeps counts and one flag
per band (partial aggregation collapses duplicates map-side), and a second aggregate per
key counts values and sums flags. No join, so NULL groups stay; NULL values are not
counted as distinct values; a band without a bid is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import scalar as S
from kestrel.operators import prefix as P

# Price bands of the daily statistics (rank1 < 10,000 <= rank2 < 1,000,000 <= rank3).
BAND_LIMITS = (10_000, 1_000_000)


def bands(price: str = "price") -> list[Column]:
    lo, hi = BAND_LIMITS
    return [S.in_band(price, None, lo), S.in_band(price, lo, hi), S.in_band(price, hi, None)]


TAGS = ("bidder", "auction")


def band_partials(bid: DataFrame, keys: list[str], latest: dict[str, Column] | None = None) -> DataFrame:
    """One row per (keys, tag, value): rows and rows per band, band flags, maxima of ``latest``."""
    tagged = F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).cast("long").alias("value")) for t in TAGS])
    more = {name: c for name, c in (latest or {}).items()}
    x = bid.select(*keys, "price", *[c.alias(n) for n, c in more.items()], F.explode(tagged).alias("_t"))
    r = bands()
    return x.groupBy(*keys, F.col("_t.tag").alias("tag"), F.col("_t.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(r, 1)],
        *[F.max(n).alias(n) for n in more])


def merged_partials(partials: DataFrame, keys: list[str], latest: list[str] | None = None) -> DataFrame:
    """Partials of several batches as one."""
    return partials.groupBy(*keys, "tag", "value").agg(
        *[F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3")], *[F.max(c).alias(c) for c in latest or []])


def band_totals(partials: DataFrame, keys: list[str], latest: list[str] | None = None) -> DataFrame:
    def total(tag, cond, what=F.lit(1)):
        return F.coalesce(F.sum(F.when((F.col("tag") == tag) & cond, what)), F.lit(0)).cast("long")

    every, known = F.lit(True), F.col("value").isNotNull()
    bids = [total("bidder", every, F.col("n")).alias("total_bids")]
    bids += [total("bidder", every, F.col(f"n{i}")).alias(f"rank{i}_bids") for i in (1, 2, 3)]
    distinct = []
    for tag in TAGS:
        distinct.append(total(tag, known).alias(f"total_{tag}s"))
        distinct += [total(tag, known & (F.col(f"n{i}") > 0)).alias(f"rank{i}_{tag}s") for i in (1, 2, 3)]
    return partials.groupBy(*keys).agg(*[F.max(c).alias(c) for c in latest or []], *bids, *distinct)


def band_stats(bid: DataFrame, keys: list[str], latest: dict[str, Column] | None = None) -> DataFrame:
    names = list(latest or {})
    return band_totals(band_partials(bid, keys, latest), keys, names)


def _with_date(bid: DataFrame) -> DataFrame:
    """Group on the calendar date (a fixed-width key); the ``yyyy-MM-dd`` string is
    formatted after aggregation, on one row per group instead of one per bid."""
    return bid.withColumn("_date", F.to_date("dateTime"))


def _day_first(df: DataFrame, keys_before: list[str]) -> DataFrame:
    cols = [c for c in df.columns if c not in (*keys_before, "_date")]
    return df.select(*keys_before, F.date_format("_date", "yyyy-MM-dd").alias("day"), *cols)


def clock(minute: Column) -> Column:
    """A minute of the day as ``HH:mm``, NULL for none."""
    return F.when(minute.isNotNull(), F.format_string("%02d:%02d", F.floor(minute / 60).cast("int"), (minute % 60).cast("int")))


def daily_bands(bid: DataFrame) -> DataFrame:
    """q15: per day, bids / distinct bidders / distinct auctions, overall and per band."""
    return _day_first(band_stats(_with_date(bid), ["_date"]), [])


def channel_daily(bid: DataFrame) -> DataFrame:
    """q16: q15 per (channel, day), plus the latest HH:mm of the day (``max`` of the
    minute of day, formatted after aggregation: same order as the ``HH:mm`` strings)."""
    minute_of_day = F.hour("dateTime") * 60 + F.minute("dateTime")
    out = band_stats(_with_date(bid), ["channel", "_date"], {"_mod": minute_of_day})
    return _day_first(out.withColumn("minute", clock(F.col("_mod"))).drop("_mod"), ["channel"]).select(
        "channel", "day", "minute", *[c for c in out.columns if c not in ("channel", "_date", "_mod")])


def auction_daily(bid: DataFrame) -> DataFrame:
    """q17: per (auction, day) counts, bands, min / max / truncated avg / sum of price."""
    r1, r2, r3 = bands()
    out = (_with_date(bid)
           .groupBy("auction", "_date")
           .agg(F.count(F.lit(1)).alias("total_bids"),
                F.count_if(r1).alias("rank1_bids"),
                F.count_if(r2).alias("rank2_bids"),
                F.count_if(r3).alias("rank3_bids"),
                F.min("price").alias("min_price"),
                F.max("price").alias("max_price"),
                S.int_avg("price").alias("avg_price"),
                F.sum("price").alias("sum_price")))
    return _day_first(out, ["auction"])


def running_sum(df: DataFrame, key: str, order: list[str], value: str, keep: list[str],
                scale: int = 2, buckets: int | None = None) -> DataFrame:
    """Keyed running sum, one output row per input row.

    As the reference's keyed ``sum``: the summed field is the running total, the other
    fields (``keep``) are those of the key's *first* row. The sum runs in DECIMAL(38,
    ``scale``) so that it does not depend on the order of partial additions.
    """
    total = F.col(value).cast(f"decimal(38,{scale})")
    outs = {"_run": (total, "sum"), "_first": (F.struct(*[F.col(c) for c in keep]), "first")}
    run = P.scan(df, [key], order, outs, True, buckets)
    return run.select(*[F.col("_first")[c].alias(c) for c in keep], key,
                      F.col("_run").cast("double").alias(value), *[F.col(c).alias(f"row_{c}") for c in order])


def running_sum_values(df: DataFrame, value: str, order: list[str], buckets: int | None = None) -> DataFrame:
    """Keyed running count and sum where the key is the value itself: one row per input row."""
    d = df.withColumn("_one", F.lit(1).cast("long"))
    run = P.prefix(d, [value], order, F.col("_one"), "sum", "_n", True, buckets)
    return run.select(F.col(value), F.col("_n").alias("occurrence"))
