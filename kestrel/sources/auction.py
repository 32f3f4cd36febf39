"""Views over the nested event table: tag filter + struct flatten.

``dateTime`` is computed from the tag (person / auction / bid time). The tag filter is
pushed into each branch of the union below it, so a bid view scans only bids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERSON, AUCTION, BID = 0, 1, 2


def event_time() -> Column:
    t = F.col("event_type")
    return (F.when(t == PERSON, F.col("person.dateTime"))
            .when(t == AUCTION, F.col("auction.dateTime"))
            .when(t == BID, F.col("bid.dateTime")))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("dateTime", event_time())


def bid_view(events: DataFrame) -> DataFrame:
    return with_event_time(events).where(F.col("event_type") == BID).select(
        "bid.auction", "bid.bidder", "bid.price", "bid.channel", "bid.url", "dateTime", "bid.extra")


def auction_view(events: DataFrame) -> DataFrame:
    return with_event_time(events).where(F.col("event_type") == AUCTION).select(
        "auction.id", "auction.itemName", "auction.description", "auction.initialBid", "auction.reserve",
        "dateTime", "auction.expires", "auction.seller", "auction.category", "auction.extra")


def person_view(events: DataFrame) -> DataFrame:
    return with_event_time(events).where(F.col("event_type") == PERSON).select(
        "person.id", "person.name", "person.emailAddress", "person.creditCard", "person.city",
        "person.state", "dateTime", "person.extra")
