"""Top-k per group (q9, q18, q19).

Two plans, both cut a hot group down before the shuffle:

* ``row_number() <= k``: Spark plans a ``WindowGroupLimit`` that also runs per map
  task, so a group sends at most k rows per task. Best when groups are small (q18:
  groups are nearly unique; 4.4 s against 5.3 s on sf0.1).
* top-1 as ``min_by(record, ordering key)``: a partial aggregate. Best when groups are
  large (q9: several bids per auction; 3.4 s against 6.1 s on sf0.1).

Orderings end in a unique tiebreak, so the winners are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import joins as J

WINNER_COLUMNS = J.AUCTION_COLUMNS + ["auction", "bidder", "price", "bid_dateTime", "bid_extra"]
BID_COLUMNS = ["auction", "bidder", "price", "channel", "url", "dateTime", "extra"]


def top1(df: DataFrame, keys: list[str], order, cols: list[str], plan: str = "window") -> DataFrame:
    """The row of each group that sorts first by ``order`` (a list of Columns, ascending).
    ``plan`` is ``"window"`` (row_number with a group limit) or ``"aggregate"`` (min_by)."""
    if plan == "aggregate":
        rec = F.struct(*[F.col(c) for c in cols])
        best = df.groupBy(*keys).agg(F.min_by(rec, F.struct(*order)).alias("_best"))
        return best.select(*[F.col("_best")[c].alias(c) for c in cols])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1).select(*cols)


def winning_bids(auction: DataFrame, bid: DataFrame) -> DataFrame:
    """q9: per auction, the highest bid placed while it was open; earliest on a price tie
    (then lowest bidder, so the answer does not depend on arrival)."""
    j = J.interval_join(auction, bid)
    return top1(j, ["id"], winning_order(), WINNER_COLUMNS, "aggregate")


def winning_order() -> list:
    """A bid without a price never beats one with a price."""
    return [F.col("price").isNull(), -F.col("price"), F.col("bid_dateTime"), F.col("bidder")]


def last_bid(bid: DataFrame) -> DataFrame:
    """q18: keep the latest bid of each (bidder, auction); ties on time are broken by the
    remaining columns, ascending."""
    newest_first = F.lit(0) - F.unix_micros(F.col("dateTime").cast("timestamp"))
    return top1(bid, ["bidder", "auction"],
                [newest_first, F.col("price"), F.col("channel"), F.col("url"), F.col("extra")], BID_COLUMNS)


def top_bids(bid: DataFrame, k: int = 10) -> DataFrame:
    """q19: the ``k`` highest bids per auction with their rank (BIGINT, 1 = highest).
    Ties on price are ordered by the remaining columns, ascending."""
    w = Window.partitionBy("auction").orderBy(
        F.col("price").desc(), "bidder", "dateTime", "channel", "url", "extra")
    return (bid.withColumn("rank_number", F.row_number().over(w).cast("long"))
            .where(F.col("rank_number") <= k))
