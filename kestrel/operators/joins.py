"""Joins of the auction queries and the record jobs. All inner, as in the reference.

Every join has an equality key, so Spark plans a hash or sort-merge join on it (AQE
turns it into a broadcast join only when the runtime size of a side is small). A hot key's
partition is split by AQE; where an aggregate reuses the join's partitioning (q4, q9) that
needs ``spark.sql.adaptive.forceOptimizeSkewedJoin``, which ``session.configure`` sets. Range conditions ride along as residuals.
Filters are written before the join so they reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import scalar as S
from kestrel.operators import prefix as P

AUCTION_COLUMNS = ["id", "itemName", "description", "initialBid", "reserve", "dateTime", "expires",
                   "seller", "category", "extra"]


def _near(one: str, other: str, within: str | None) -> Column:
    """Times at most ``within`` (an interval) apart; without it no condition."""
    if within is None:
        return F.lit(True)
    span = F.expr(f"INTERVAL {within}")
    return F.col(one).between(F.col(other) - span, F.col(other) + span)


def join_equi(auction: DataFrame, person: DataFrame, category: int = 10,
              states=("OR", "ID", "CA"), within: str | None = None) -> DataFrame:
    """q3: sellers of one category living in some states. With ``within`` only rows at most so far apart
    in ``dateTime`` meet, which lets a stream join with watermarks drop old rows."""
    times = [] if within is None else ["dateTime"]
    a = auction.where(F.col("category") == category).select("id", "seller", *[F.col(c).alias("a_time") for c in times])
    p = (person.where(F.col("state").isin(*states))
         .select(F.col("id").alias("p_id"), "name", "city", "state", *[F.col(c).alias("p_time") for c in times]))
    return a.join(p, (a.seller == p.p_id) & _near("a_time", "p_time", within)).select("name", "city", "state", "id")


def join_expand(bid: DataFrame, auction: DataFrame, category: int = 10, within: str | None = None) -> DataFrame:
    """q20: every bid with its auction's columns, for auctions of one category. ``within`` as in ``join_equi``."""
    a = auction.where(F.col("category") == category).select(
        "id", "itemName", "description", "initialBid", "reserve",
        F.col("dateTime").alias("auction_dateTime"), "expires", "seller", "category",
        F.col("extra").alias("auction_extra"))
    b = bid.select("auction", "bidder", "price", "channel", "url",
                   F.col("dateTime").alias("bid_dateTime"), F.col("extra").alias("bid_extra"))
    return b.join(a, (b.auction == a.id) & _near("bid_dateTime", "auction_dateTime", within)).select(
        "auction", "bidder", "price", "channel", "url", "bid_dateTime", "bid_extra", "itemName",
        "description", "initialBid", "reserve", "auction_dateTime", "expires", "seller", "category",
        "auction_extra")


def interval_join(auction: DataFrame, bid: DataFrame) -> DataFrame:
    """Bids placed while their auction is open: ``a.id = b.auction`` and
    ``b.dateTime BETWEEN a.dateTime AND a.expires`` (both ends inclusive).

    Auction columns keep their names; bid columns are ``auction, bidder, price,
    bid_dateTime, bid_extra`` plus channel and url.
    """
    b = bid.select("auction", "bidder", "price", "channel", "url",
                   F.col("dateTime").alias("bid_dateTime"), F.col("extra").alias("bid_extra"))
    return auction.join(
        b, (auction.id == b.auction) & b.bid_dateTime.between(auction.dateTime, auction.expires))


def avg_of_max(auction: DataFrame, bid: DataFrame) -> DataFrame:
    """q4: average winning price per category; BIGINT average truncates (``sum div count``).

    Both levels aggregate partially before their shuffle; the first groups by auction id,
    which is also the join key, so the join's partitioning is reused.
    """
    a = auction.select("id", "category", "dateTime", "expires")
    b = bid.select("auction", "price", F.col("dateTime").alias("bid_dateTime"))
    j = a.join(b, (a.id == b.auction) & b.bid_dateTime.between(a.dateTime, a.expires))
    q = j.groupBy("id", "category").agg(F.max("price").alias("final"))
    return (q.groupBy("category")
            .agg(S.int_avg("final").alias("final"))
            .select(F.col("category").alias("id"), "final"))


def window_join(orders: DataFrame, goods: DataFrame, size: str, order_time: str = "ts",
                goods_time: str = "ts") -> DataFrame:
    """Tumbling-window inner join on goodsId: every (order, goods) pair of the same window.

    Output (goodsId, goodsName, count, totalMoney = goodsPrice * count), decimal kept.
    """
    o = orders.select("goodsId", "count", F.window(order_time, size).start.alias("wstart"))
    g = goods.select(F.col("goodsId").alias("g_id"), "goodsName", "goodsPrice",
                     F.window(goods_time, size).start.alias("g_wstart"))
    j = o.join(g, (o.goodsId == g.g_id) & (o.wstart == g.g_wstart))
    return j.select("goodsId", "goodsName", "count",
                    (F.col("goodsPrice") * F.col("count")).alias("totalMoney"))


def dim_changes(dim: DataFrame, dim_key: str, valid_from: str = "valid_from") -> DataFrame:
    """Whole snapshots → changes of single keys: (key, at, alive, row).

    A snapshot replaces the one before, so a key that the next snapshot lacks gets a tombstone at that
    snapshot's time. Several rows of a key in one snapshot count as the greatest one, as in a map
    by key. Rows without key or time never apply.
    """
    rest = [c for c in dim.columns if c != dim_key]
    one = (dim.where(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull())
           .groupBy(F.col(dim_key).alias("key"), F.col(valid_from).alias("at"))
           .agg(F.max(F.struct(*[F.col(c) for c in rest])).alias("row")))
    # One row a snapshot: its successor.
    times = dim.where(F.col(valid_from).isNotNull()).select(F.col(valid_from).alias("at")).distinct()
    times = times.select("at", F.lead("at").over(Window.orderBy("at")).alias("next"))
    own = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    versions = one.join(times, "at").withColumn("own", own)
    gone = versions.where(F.col("next").isNotNull() & ~F.col("own").eqNullSafe(F.col("next")))
    return (versions.select("key", "at", F.lit(True).alias("alive"), "row")
            .unionByName(gone.select("key", F.col("next").alias("at"), F.lit(False).alias("alive"), "row")))


def as_of_enrich(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_time: str,
                 how: str = "inner", buckets: int | None = None) -> DataFrame:
    """Each fact row with its key's row in the snapshot valid at its time. Facts before the first
    snapshot, or of keys that the snapshot lacks, are dropped (``how="left"`` keeps them with NULLs).

    Facts and changes of a key are merged in one order of time and the last change is carried to
    the facts behind it (``prefix.scan``): a fact never meets the other versions of its key, and a hot
    key is scanned in ranges of time. The columns are those of ``facts`` and of ``dim``.
    """
    changes = dim_changes(dim, dim_key)
    fact, change = F.struct(*[F.col(c) for c in facts.columns]), F.struct("alive", "row", "key")
    nothing = lambda df, c: F.lit(None).cast(df.select(c.alias("s")).schema["s"].dataType)
    merged = (changes.select("key", "at", F.lit(0).alias("kind"), change.alias("change"), nothing(facts, fact).alias("fact"))
              .union(facts.select(F.col(fact_key), F.col(fact_time), F.lit(1), nothing(changes, change), fact)))
    seen = P.scan(merged, ["key"], ["at", "kind"], {"now": (F.col("change"), "last")}, True, buckets).where("kind = 1")
    known = F.coalesce(F.col("now.alive"), F.lit(False))
    if how == "inner":
        seen = seen.where(known)
    elif how != "left":
        raise ValueError(f"how must be inner or left, not {how}")
    found = [F.when(known, F.col("now.key") if c == dim_key else F.col("now.row")[c]).alias(c) for c in dim.columns]
    return seen.select("fact.*", *found)
