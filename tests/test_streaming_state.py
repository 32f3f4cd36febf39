"""Stateful and foreachBatch streaming forms equal their batch forms."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from kestrel.operators import joins, rules, state, topk
from kestrel.sources import fixtures as X
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import split_files

SF = "/root/testdata/sf0.001"
BID_STATE = "auction long, bidder long, price long, channel string, url string, dateTime timestamp, extra string"


def collect_batches(spark, path):
    """foreachBatch sink that appends each batch with its id."""
    def sink(df, batch_id):
        df.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(path)
    return sink


def latest_lists(spark, path, keys):
    """Update-mode output: per key, the rows of its latest emission."""
    df = spark.read.parquet(path)
    w = Window.partitionBy(*keys)
    return df.withColumn("_last", F.max("_batch").over(w)).where("_batch = _last").drop("_batch", "_last")


def test_top_k_stream_equals_batch(spark, scratch):
    bids = X.bids(spark, SF)
    src = f"{scratch}/bids"
    split_files(bids, src, 3, "dateTime")
    stream = readers.stream_parquet(spark, src, bids.schema, ("dateTime",), 1)
    order = ["price", "bidder", "dateTime", "channel", "url", "extra"]
    q = jobs.top_k(stream, ["auction"], 10, order, [False, True, True, True, True, True], BID_STATE)
    jobs.run_batches(q, f"{scratch}/ck", collect_batches(spark, f"{scratch}/out"))
    got = latest_lists(spark, f"{scratch}/out", ["auction"]).withColumn("dateTime", F.col("dateTime").cast("timestamp_ntz"))
    want = topk.top_bids(bids, 10)
    assert rows(got.select(*want.columns)) == rows(want)


def test_keep_last_stream_equals_batch(spark, scratch):
    bids = X.bids(spark, SF)
    src = f"{scratch}/bids"
    split_files(bids, src, 3, "dateTime")
    stream = readers.stream_parquet(spark, src, bids.schema, ("dateTime",), 1)
    q = jobs.top_k(stream, ["bidder", "auction"], 1, ["dateTime", "price", "channel", "url", "extra"],
                   [False, True, True, True, True], BID_STATE, rank_col=None)
    jobs.run_batches(q, f"{scratch}/ck", collect_batches(spark, f"{scratch}/out"))
    got = latest_lists(spark, f"{scratch}/out", ["bidder", "auction"])
    got = got.withColumn("dateTime", F.col("dateTime").cast("timestamp_ntz"))
    want = topk.last_bid(bids)
    assert rows(got.select(*want.columns)) == rows(want)


def test_pattern_stream_equals_batch(spark, scratch):
    ev = X.events(spark, SF)
    src = f"{scratch}/ev"
    split_files(ev, src, 4, "event_id")
    stream = readers.stream_parquet(spark, src, ev.schema, ("ts",), 1)
    rule_list = [("view", "purchase"), ("click", "click")]
    q = jobs.two_step_pattern(stream, rule_list, "user_id", "event_id", "event_type")
    jobs.run_available(q, f"{scratch}/ck", f"{scratch}/out")
    got = rows(spark.read.parquet(f"{scratch}/out"))
    want = rows(state.two_step_pattern(ev, rules.pattern_rules(spark, rule_list), "user_id", "event_id", "event_type"))
    assert got == want and len(want) > 0


def test_punctuated_stream_equals_batch(spark, scratch):
    jit = X.jitter(spark, SF)
    src = f"{scratch}/jit"
    split_files(jit, src, 3, "seq")
    stream = readers.stream_parquet(spark, src, jit.schema, ("ts",), 1)
    run = jobs.punctuated_late_batches(f"{scratch}/wm", "seq", "ts", "id", 1, 60, collect_batches(spark, f"{scratch}/out"))
    jobs.run_batches(stream, f"{scratch}/ck", run)
    got = rows(spark.read.parquet(f"{scratch}/out").select("seq"))
    want = rows(state.punctuated_late(jit, "seq", "ts", "id", 1, 60).select("seq"))
    assert got == want and len(want) > 0


def test_avg_of_max_batches_equals_batch(spark, scratch):
    bids, auctions = X.bids(spark, SF), X.auctions(spark, SF)
    src = f"{scratch}/bids"
    split_files(bids, src, 3, "dateTime")
    stream = readers.stream_parquet(spark, src, bids.schema, (), 1)
    run = jobs.avg_of_max_batches(lambda: X.auctions(spark, SF), f"{scratch}/store",
                                  collect_batches(spark, f"{scratch}/out"))
    jobs.run_batches(stream, f"{scratch}/ck", run)
    got = latest_lists(spark, f"{scratch}/out", []).drop("_batch")
    assert rows(got) == rows(joins.avg_of_max(auctions, bids))


def test_auction_daily_update_stream_equals_batch(spark, scratch):
    from kestrel.operators import aggs
    bids = X.bids(spark, SF)
    src = f"{scratch}/bids"
    split_files(bids, src, 3, "auction")  # the same (auction, day) spans batches
    stream = readers.stream_parquet(spark, src, bids.schema, (), 1)
    q = jobs.auction_daily(stream)
    (q.writeStream.outputMode("update").foreachBatch(collect_batches(spark, f"{scratch}/out"))
     .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start().awaitTermination())
    got = latest_lists(spark, f"{scratch}/out", ["auction", "day"])
    want = aggs.auction_daily(bids)
    assert rows(got.select(*want.columns)) == rows(want)


def test_snapshot_enrich_and_keyed_upsert_batches(spark, scratch):
    ev = X.events(spark, SF)
    src = f"{scratch}/ev"
    split_files(ev, src, 3, "ts")
    stream = readers.stream_parquet(spark, src, ev.schema, (), 1)
    run = jobs.snapshot_enrich_batches(lambda: X.user_info(spark, SF), collect_batches(spark, f"{scratch}/out"))
    jobs.run_batches(stream, f"{scratch}/ck", run)
    got = rows(spark.read.parquet(f"{scratch}/out").drop("_batch"))
    assert got == rows(rules.snapshot_enrich(ev, X.user_info(spark, SF)))

    keyed = stream.select(F.col("user_id").cast("string").alias("rowkey"), F.col("event_id").alias("id"),
                          F.col("event_type").alias("name"), F.col("event_id").alias("seq"))
    q = jobs.run_batches(keyed, f"{scratch}/ck2", jobs.keyed_upsert_batches(f"{scratch}/kv", "rowkey", "seq", ["id", "name"]))
    last = max(int(p.split("=")[1]) for p in __import__("os").listdir(f"{scratch}/kv") if p.startswith("v="))
    snap = spark.read.parquet(f"{scratch}/kv/v={last}").select("rowkey", "id", "name")
    from kestrel.sources import sinks
    want = sinks.latest_per_key(ev.select(F.col("user_id").cast("string").alias("rowkey"), F.col("event_id").alias("id"),
                                          F.col("event_type").alias("name"), F.col("event_id").alias("seq")),
                                "rowkey", "seq", ["id", "name"])
    assert rows(snap) == rows(want)


def test_band_stats_batches_equal_batch(spark, scratch):
    from kestrel.operators import aggs
    bids = X.bids(spark, SF)
    src = f"{scratch}/bids"
    split_files(bids, src, 3, "auction")  # every day spans several batches
    stream = readers.stream_parquet(spark, src, bids.schema, (), 1)
    for keys, minute, batch_form in (([], False, aggs.daily_bands), (["channel"], True, aggs.channel_daily)):
        tag = "_".join(keys) or "day"
        run = jobs.band_stats_batches(f"{scratch}/store_{tag}", keys, collect_batches(spark, f"{scratch}/out_{tag}"), minute)
        jobs.run_batches(stream, f"{scratch}/ck_{tag}", run)
        got = latest_lists(spark, f"{scratch}/out_{tag}", [*keys, "day"])
        want = batch_form(bids)
        assert rows(got.select(*want.columns)) == rows(want), tag


def test_rule_batches_equal_batch(spark, scratch):
    msgs, txn = X.messages(spark, SF), X.transactions(spark, SF)
    for name, df, fn in (("latest", msgs, rules.latest_rule_filter), ("accumulate", txn, rules.rules_for_each)):
        src = f"{scratch}/{name}"
        split_files(df, src, 3, "ts")
        stream = readers.stream_parquet(spark, src, df.schema, (), 1)
        run = jobs.rule_batches(fn, lambda: X.keywords(spark), collect_batches(spark, f"{scratch}/out_{name}"))
        jobs.run_batches(stream, f"{scratch}/ck_{name}", run)
        got = rows(spark.read.parquet(f"{scratch}/out_{name}").drop("_batch"))
        assert got == rows(fn(df, X.keywords(spark))) and len(got) > 0, name


def test_running_sum_and_sliding_count_streams_equal_batch(spark, scratch):
    from kestrel.operators import aggs, counts
    scores = (X.events(spark, SF).select(F.col("event_id").alias("id"), F.col("event_type").alias("name"),
                                         F.col("value").alias("score")).where("score > 101"))
    split_files(scores, f"{scratch}/s", 3, "id")
    st = readers.stream_parquet(spark, f"{scratch}/s", scores.schema, (), 1)
    jobs.run_available(jobs.running_sum(st, "name", "id", "score", ["id"]), f"{scratch}/ck1", f"{scratch}/o1")
    got = rows(spark.read.parquet(f"{scratch}/o1").select("id", "name", "score", "row_id"))
    want = rows(aggs.running_sum(scores, "name", ["id"], "score", ["id"]).select("id", "name", "score", "row_id"))
    assert got == want and len(want) > 0

    cars = X.cars(spark, SF)
    split_files(cars, f"{scratch}/c", 3, "seq")
    cs = readers.stream_parquet(spark, f"{scratch}/c", cars.schema, ("ts",), 1)
    jobs.run_available(jobs.count_slide(cs, "sensorId", "seq", "count", 5, 3), f"{scratch}/ck2", f"{scratch}/o2")
    got = rows(spark.read.parquet(f"{scratch}/o2").select("sensorId", "count", "end_position"))
    want = rows(counts.count_slide(cars, "sensorId", "seq", "count", 5, 3))
    assert got == want and len(want) > 0


def test_winning_bids_batches_equal_batch(spark, scratch):
    bids, auctions = X.bids(spark, SF), X.auctions(spark, SF)
    split_files(bids, f"{scratch}/bids", 3, "dateTime")
    stream = readers.stream_parquet(spark, f"{scratch}/bids", bids.schema, (), 1)
    run = jobs.winning_bids_batches(lambda: X.auctions(spark, SF), f"{scratch}/store",
                                    collect_batches(spark, f"{scratch}/out"))
    jobs.run_batches(stream, f"{scratch}/ck", run)
    got = latest_lists(spark, f"{scratch}/out", ["id"])
    want = topk.winning_bids(auctions, bids)
    assert rows(got.select(*want.columns)) == rows(want) and want.count() > 0


def test_bids_that_come_before_their_auction_wait_for_it(spark, scratch):
    import datetime as dt

    from kestrel.operators import joins as J
    from kestrel.operators import topk

    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    auction = spark.createDataFrame([(1, 10, at(0), at(60)), (2, 10, at(0), at(60)), (3, 11, at(0), at(30))],
                                    "id long, category long, dateTime timestamp_ntz, expires timestamp_ntz")
    for c in J.AUCTION_COLUMNS:
        if c not in auction.columns:
            auction = auction.withColumn(c, F.lit(None).cast("string"))
    bids = spark.createDataFrame(
        [(1, 100 + b, p, at(m), n) for n, b, p, m in ((0, 1, 900, 5), (0, 2, 100, 6), (1, 3, 400, 7), (2, 4, 50, 8), (2, 5, 999, 70))]
        + [(2, 7, 10, at(9), 0), (3, 8, 70, at(20), 1), (3, 9, None, at(21), 2), (9, 9, 5, at(1), 0)],
        "auction long, bidder long, price long, dateTime timestamp_ntz, batch int").withColumns(
        {c: F.lit("x") for c in ("channel", "url", "extra")})
    seen = {0: [], 1: [2], 2: [1, 2, 3]}  # the auctions known when each batch comes
    known = []
    best, avg = {}, {}
    q9 = jobs.winning_bids_batches(lambda: auction.where(F.col("id").isin(known)), f"{scratch}/q9",
                                   lambda df, _: best.update({r["id"]: (r["bidder"], r["price"]) for r in df.collect()}))
    q4 = jobs.avg_of_max_batches(lambda: auction.where(F.col("id").isin(known)), f"{scratch}/q4",
                                 lambda df, _: avg.update({r["id"]: r["final"] for r in df.collect()}))
    for n in range(3):
        known[:] = seen[n]
        for _ in range(2):  # a retried batch changes nothing
            q9(bids.where(F.col("batch") == n), n)
            q4(bids.where(F.col("batch") == n), n)
    assert best == {r["id"]: (r["bidder"], r["price"]) for r in topk.winning_bids(auction, bids).collect()}
    assert avg == {r["id"]: r["final"] for r in J.avg_of_max(auction, bids).collect()} and best[1] == (101, 900)
    left = spark.read.parquet(f"{scratch}/q9/pending/batch=2")
    assert [r["auction"] for r in left.collect()] == [9]
