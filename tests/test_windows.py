"""Time windows with the reference's literal intervals (seconds), including boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import windows
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(s, ms=0):
    return T0 + dt.timedelta(seconds=s, milliseconds=ms)


def events(spark, data, schema="k long, ts timestamp_ntz, price long"):
    return spark.createDataFrame(data, schema)


def test_hop_puts_each_row_in_five_windows(spark):
    df = events(spark, [(1, at(5), 1)])
    out = windows.window_sum(df, "k", "ts", "10 seconds", "2 seconds")
    assert sorted(r.starttime for r in out.collect()) == [at(s) for s in (-4, -2, 0, 2, 4)]


def test_hot_items_keeps_ties(spark):
    df = events(spark, [(1, at(1), 1), (1, at(2), 1), (2, at(3), 1), (2, at(4), 1), (3, at(5), 1)])
    out = windows.hot_items(df, "k", "ts", "10 seconds", "10 seconds")
    assert rows(out) == [(1, 2), (2, 2)]


def test_max_per_window_boundaries(spark):
    # Window [10 s, 20 s), rowtime 19.999 s: a bid 1 ms before the window with the max
    # price matches, as does one exactly at rowtime; 20.000 s belongs to the next window.
    data = [(1, at(9, 999), 50), (2, at(12), 50), (3, at(19, 999), 50), (4, at(15), 10),
            (5, at(9, 998), 50), (6, at(20), 7)]
    out = windows.max_per_window(events(spark, data), "ts", "price", "10 seconds", 10)
    got = sorted(r.k for r in out.collect())
    # window [0,10): max 50 (ids 1, 5) -> ids 1 and 5 match it, id 1 also matches [10,20)
    assert got == [1, 1, 2, 3, 5, 6]


def test_session_gap_is_inclusive(spark):
    data = [(1, at(0), 0), (1, at(10), 0), (1, at(20, 1), 0), (2, at(0), 0)]
    out = windows.session_count(events(spark, data), "k", "ts", "10 seconds")
    assert rows(out) == [(1, 1, at(20, 1), at(30, 1)), (1, 2, at(0), at(20)), (2, 1, at(0), at(10))]


def test_tumble_count_and_new_users(spark):
    data = [(1, at(0), 0), (1, at(9, 999), 0), (1, at(10), 0)]
    out = windows.tumble_count(events(spark, data), "k", "ts", "10 seconds")
    assert rows(out) == [(1, 1, at(10), at(20)), (1, 2, at(0), at(10))]
    person = spark.createDataFrame([(7, "ann", at(3)), (8, "bob", at(3))], "id long, name string, dateTime timestamp_ntz")
    auction = spark.createDataFrame([(7, at(9)), (8, at(11))], "seller long, dateTime timestamp_ntz")
    assert rows(windows.new_users(person, auction, "10 seconds")) == [(7, "ann", at(0))]


def test_argmin_earliest_on_tie(spark):
    df = spark.createDataFrame([(1, "s", 3, 20.0, at(1)), (2, "s", 4, 15.0, at(2)), (3, "s", 5, 15.0, at(3)),
                                (4, "s", 6, 1.0, at(11))],
                               "seq long, id string, val1 long, temperature double, ts timestamp_ntz")
    out = windows.window_argmin(df, "id", "ts", "10 seconds", "temperature", "seq",
                                ["seq", "id", "val1", "temperature", "ts"])
    assert sorted(r.seq for r in out.collect()) == [2, 4]
    counts = windows.window_count(df, "id", "ts", "10 seconds")
    assert sorted(r.cnt for r in counts.collect()) == [1, 3]


def test_two_level_sessions_equal_single_level(spark):
    import random
    rnd = random.Random(5)
    data = [(rnd.randrange(3), at(rnd.randrange(2000)), 0) for _ in range(400)]
    data += [(0, at(500), 0), (0, at(510), 0), (0, at(520), 0)]  # exact-gap chain across buckets
    df = events(spark, data)
    for gap in ("10 seconds", "3 seconds", "1 minute"):
        one = (df.groupBy(F.col("k").alias("bidder"), F.session_window("ts", gap))
               .agg(F.count(F.lit(1)).alias("bid_count"))
               .select("bidder", "bid_count", "session_window.start", "session_window.end"))
        two = windows.session_count(df, "k", "ts", gap)
        assert rows(two) == rows(one), gap
