"""Rule jobs (as-of semantics) and count windows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import counts, prefix
from kestrel.operators import rules as R
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def t(h):
    return T0 + dt.timedelta(hours=h)


def keywords(spark, data):
    return spark.createDataFrame(data, "ts timestamp_ntz, keyword string")


def test_latest_rule(spark):
    msgs = spark.createDataFrame([(1, "learn java", t(1)), (2, "learn scala", t(2)), (3, "java again", t(3)),
                                  (4, "scala at switch", t(2))], "seq long, message string, ts timestamp_ntz")
    kw = keywords(spark, [(None, "java"), (t(2), "scala")])
    out = R.latest_rule_filter(msgs, kw)
    assert sorted((r.seq, r.keyword) for r in out.collect()) == [(1, "java"), (2, "scala"), (4, "scala")]
    assert out.where("seq = 1").first().alert == "拦截消息:learn java, 是因为匹配到规则:java"


def test_accumulated_rules_text(spark):
    txn = spark.createDataFrame([(i, i % 5 + 1, t(h)) for i, h in enumerate([0, 1, 2, 3, 4])],
                                "id long, account_id long, ts timestamp_ntz")
    kw = keywords(spark, [(t(1), "rule1"), (t(3), "rule2"), (t(3.5), "rule1")])
    out = {r.id: r.rules for r in R.rules_for_each(txn, kw).collect()}
    assert out == {0: "", 1: "rule1:rule1;", 2: "rule1:rule1;", 3: "rule1:rule1;rule2:rule2;",
                   4: "rule1:rule1;rule2:rule2;"}


def test_snapshot_enrich(spark):
    ev = spark.createDataFrame([(1, 10, "view", t(0)), (2, 10, "buy", t(5)), (3, 11, "view", t(5)),
                                (4, 12, "view", t(5))],
                               "event_id long, user_id long, event_type string, ts timestamp_ntz")
    users = spark.createDataFrame([(10, "a", 20, t(1)), (11, "b", 30, t(1)), (10, "a2", 21, t(4))],
                                  "userId long, userName string, userAge int, valid_from timestamp_ntz")
    out = rows(R.snapshot_enrich(ev, users).select("productId", "userName", "userAge"))
    assert out == [(2, "a2", 21)]  # the snapshot at 4 replaces the whole map: user 11 is gone
    early = ev.where("event_id = 3").withColumn("ts", F.lit(t(3)).cast("timestamp_ntz"))
    assert rows(R.snapshot_enrich(early, users).select("productId", "userName")) == [(3, "b")]


def test_rules_at_one_time_are_ordered_by_arrival(spark):
    msgs = spark.createDataFrame([(1, "aa bb", t(2))], "seq long, message string, ts timestamp_ntz")
    for order, last in (((1, 2), "bb"), ((2, 1), "aa")):
        kw = spark.createDataFrame([(t(1), "aa", order[0]), (t(1), "bb", order[1])], "ts timestamp_ntz, keyword string, arrival int")
        assert [r.keyword for r in R.latest_rule_filter(msgs, kw).collect()] == [last]


def test_rules_are_not_joined_to_rows(spark):
    msgs = spark.range(200).select(F.col("id").alias("seq"), F.lit("k7 k9").alias("message"),
                                   F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("ts"))
    kw = spark.range(0, 200, 3).select(F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("ts"),
                                       F.concat(F.lit("k"), (F.col("id") % 10).cast("string")).alias("keyword"))
    txn = msgs.select(F.col("seq").alias("id"), F.col("seq").alias("account_id"), "ts")
    for df in (R.latest_rule_filter(msgs, kw), R.rules_for_each(txn, kw)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r.seq: r.keyword for r in R.latest_rule_filter(msgs, kw).collect()}
    assert got == {i: f"k{i // 3 * 3 % 10}" for i in range(200) if i // 3 * 3 % 10 in (7, 9)}


def cars(spark, data):
    return spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(data)], "seq long, sensorId string, count int")


def test_count_windows(spark):
    data = [("a", 1)] * 7 + [("b", 2)] * 5 + [("a", 10)] * 3
    df = cars(spark, data)
    # a: 1,1,1,1,1,1,1,10,10,10 (10 rows) -> windows of 5: 5, 32 ; b: 5 rows -> 10
    assert rows(counts.count_tumble(df, "sensorId", "seq", "count", 5, buckets=4).select("sensorId", "count")) == \
        [("a", 5), ("a", 32), ("b", 10)]
    # sliding 5 every 3: a ends at rows 3, 6, 9 -> 3, 5, 1+1+1+10+10 = 23 ; b: row 3 -> 6
    assert rows(counts.count_slide(df, "sensorId", "seq", "count", 5, 3, buckets=4).select("sensorId", "count")) == \
        [("a", 3), ("a", 5), ("a", 23), ("b", 6)]
    # global: 15 rows in seq order -> 3 windows, key of each window's first row
    assert rows(counts.count_global(df, "sensorId", "seq", "count", 5, buckets=4)) == \
        [("a", 5, 1), ("a", 8, 2), ("b", 34, 3)]


def test_rank_and_prefix_max_match_plain_windows(spark):
    rnd = random.Random(11)
    data = [(rnd.randrange(4), i, rnd.randrange(1000)) for i in range(400)]
    df = spark.createDataFrame(data, "k long, seq long, v long")
    got = prefix.rank(df, ["k"], ["seq"], "rn", buckets=9)
    got = prefix.prefix(got, [], ["seq"], F.col("v"), "max", "mx", False, buckets=5)
    w = Window.partitionBy("k").orderBy("seq")
    g = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("rn", F.row_number().over(w).cast("long")).withColumn("mx", F.max("v").over(g))
    assert rows(got.select("k", "seq", "v", "rn", "mx")) == rows(want.select("k", "seq", "v", "rn", "mx"))


def test_null_keys_and_values_stay(spark):
    from kestrel.operators import aggs, topk
    from kestrel.operators import joins as J

    df = cars(spark, [(None, 1), (None, 2), ("a", 3), (None, 4)])
    assert rows(counts.count_slide(df, "sensorId", "seq", "count", 2, 2).select("sensorId", "count").fillna("-")) == [("-", 3)]
    run = aggs.running_sum(df.withColumnRenamed("seq", "id"), "sensorId", ["id"], "count", ["id"])
    assert sorted((r["sensorId"] or "-", r["count"], r["id"], r["row_id"]) for r in run.collect()) == [
        ("-", 1.0, 0, 0), ("-", 3.0, 0, 1), ("-", 7.0, 0, 3), ("a", 3.0, 2, 2)]
    bids = spark.createDataFrame([(None, 1, 7, 50, t(1)), (None, None, 7, None, t(1)), ("c", 2, None, None, None)],
                                 "channel string, bidder long, auction long, price long, dateTime timestamp_ntz")
    out = {r.channel: r for r in aggs.channel_daily(bids).collect()}
    assert (out[None].total_bids, out[None].total_bidders, out[None].total_auctions, out[None].rank1_bids) == (2, 1, 1, 1)
    assert (out["c"].total_bidders, out["c"].total_auctions, out["c"].rank1_bidders, out["c"].day) == (1, 0, 0, None)
    auction = spark.createDataFrame([(7, t(0), t(9))], "id long, dateTime timestamp_ntz, expires timestamp_ntz")
    for c in J.AUCTION_COLUMNS:
        if c not in auction.columns:
            auction = auction.withColumn(c, F.lit(0))
    full = bids.withColumns({"url": F.lit("u"), "extra": F.lit("x")})
    assert [r.price for r in topk.winning_bids(auction, full).collect()] == [50]


def test_count_ranges_are_even_on_clustered_orders(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 100 == 0, F.col("id") * 10**9).otherwise(F.col("id")).alias("seq"))
    for source in (df, spark.range(100_000).withColumnRenamed("id", "seq")):
        sizes = [r["count"] for r in prefix.with_bucket(source, "seq", 500).groupBy(prefix.BKT).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) <= 3 * 200
