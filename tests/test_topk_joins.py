"""Top-k and joins on hand-made auctions and bids: ties, inclusive interval ends."""

import datetime as dt

from kestrel import schemas
from kestrel.operators import joins, topk
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def t(s):
    return T0 + dt.timedelta(seconds=s)


def auctions(spark, data):
    return spark.createDataFrame(
        [(i, "item", "d", 1, 2, t(a), t(b), seller, cat, "") for i, a, b, seller, cat in data], schemas.AUCTION)


def bids(spark, data):
    return spark.createDataFrame([(a, b, p, "c", "u", t(s), "") for a, b, p, s in data], schemas.BID)


def test_winning_bid_ties_and_interval_ends(spark):
    a = auctions(spark, [(1, 10, 20, 7, 10), (2, 10, 20, 7, 10)])
    b = bids(spark, [(1, 5, 100, 15), (1, 6, 100, 12), (1, 4, 90, 11),   # tie on price: earliest (12 s) wins
                     (2, 1, 500, 9), (2, 2, 50, 20), (2, 3, 40, 10)])     # 9 s is before the auction opens
    got = {r.id: (r.bidder, r.price) for r in topk.winning_bids(a, b).collect()}
    assert got == {1: (6, 100), 2: (2, 50)}
    # q4 on the same data: max per auction 100 and 50, category average (100 + 50) div 2
    assert rows(joins.avg_of_max(a, b)) == [(10, 75)]


def test_top_bids_rank_and_ties(spark):
    b = bids(spark, [(1, 3, 100, 1), (1, 1, 100, 2), (1, 2, 50, 3), (2, 9, 10, 4)])
    got = rows(topk.top_bids(b, 2).select("auction", "bidder", "rank_number"))
    assert got == [(1, 1, 1), (1, 3, 2), (2, 9, 1)]
    assert topk.top_bids(b, 2).schema["rank_number"].dataType.simpleString() == "bigint"
    last = rows(topk.last_bid(bids(spark, [(1, 1, 5, 1), (1, 1, 7, 3), (1, 1, 6, 2)])).select("price"))
    assert last == [(7,)]


def test_equi_join_filters(spark):
    a = auctions(spark, [(1, 0, 1, 7, 10), (2, 0, 1, 8, 10), (3, 0, 1, 7, 11)])
    p = spark.createDataFrame([(7, "ann", "e", "c", "city", "OR", t(0), ""), (8, "bob", "e", "c", "city", "WA", t(0), "")],
                              schemas.PERSON)
    assert rows(joins.join_equi(a, p)) == [("ann", "city", "OR", 1)]
