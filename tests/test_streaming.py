"""Streaming forms equal their batch forms: the input is split into files by time, read
as a stream one file per micro-batch, and the sink read back at the end."""

import datetime as dt
import os

from pyspark.sql import functions as F

from kestrel.operators import counts, state, windows
from kestrel.sources import fixtures as X
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
FAR = dt.datetime(2030, 1, 1)


def split_files(df, path, parts, order):
    """Write ``df`` as ``parts`` files with consecutive ranges of ``order`` (file i < i+1)."""
    df.repartitionByRange(parts, order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)
    _stamp(path)


def _stamp(path):
    """The file source reads files in modification-time order: make it the name order."""
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    base = 1_700_000_000
    for i, f in enumerate(files):
        os.utime(f"{path}/{f}", (base + i, base + i))


def add_file(spark, path, data, schema, name):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}_{name}")
    src = [f for f in os.listdir(f"{path}_{name}") if f.endswith(".parquet")][0]
    os.replace(f"{path}_{name}/{src}", f"{path}/part-99999-{name}.parquet")
    _stamp(path)


def test_window_sum_stream_equals_batch(spark, scratch):
    words = X.words(spark, SF)
    src = f"{scratch}/words"
    split_files(words, src, 3, "ts")
    schema = "word string, ts timestamp_ntz"
    add_file(spark, src, [("~sentinel", FAR)], schema, "s1")
    add_file(spark, src, [("~sentinel", FAR + dt.timedelta(days=1))], schema, "s2")
    stream = readers.stream_parquet(spark, src, words.schema, ("ts",), max_files_per_trigger=1)
    out = jobs.window_sum(stream, "word", "ts", "5 minutes", delay="0 seconds")
    jobs.run_available(out, f"{scratch}/ckpt", f"{scratch}/out")
    got = spark.read.parquet(f"{scratch}/out").where("word <> '~sentinel'")
    want = windows.window_sum(words, "word", "ts", "5 minutes")
    norm = [F.col("word"), F.col("starttime").cast("string"), F.col("cnt")]
    assert rows(got.select(*norm)) == rows(want.select(*norm))


def test_restart_from_checkpoint_and_late_rows(spark, scratch):
    schema = "k long, ts timestamp_ntz"
    t0 = dt.datetime(2024, 1, 1)
    src, ckpt, out = f"{scratch}/in", f"{scratch}/ckpt", f"{scratch}/out"
    os.makedirs(src)
    add_file(spark, src, [(1, t0 + dt.timedelta(seconds=s)) for s in (100, 101, 105)], schema, "a")
    stream = readers.stream_parquet(spark, src, spark.createDataFrame([], schema).schema, ("ts",), 1)
    q = jobs.tumble_count(stream, "k", "ts", "10 seconds", delay="4 seconds")
    jobs.run_available(q, ckpt, out)  # first run: window [100, 110) still open
    # Second run, restarted from the checkpoint. Spark filters late rows with the
    # watermark of the previous batch (eviction uses the current one), so the late row
    # comes two batches after the one that moves the watermark past 110 s.
    add_file(spark, src, [(1, t0 + dt.timedelta(seconds=200))], schema, "b")
    add_file(spark, src, [(1, t0 + dt.timedelta(seconds=250))], schema, "b2")
    add_file(spark, src, [(1, t0 + dt.timedelta(seconds=106)), (1, t0 + dt.timedelta(seconds=300))], schema, "c")
    jobs.run_available(q, ckpt, out)
    got = rows(spark.read.parquet(out).select(F.col("starttime").cast("string"), "bid_count"))
    closed = [r for r in got if r[0] < "2024-01-01 00:04:00"]
    assert closed == [("2024-01-01 00:01:40", 3), ("2024-01-01 00:03:20", 1)]


def test_fraud_processor_equals_batch(spark, scratch):
    txn = X.transactions(spark, SF)
    src = f"{scratch}/txn"
    split_files(txn, src, 4, "ts")
    stream = readers.stream_parquet(spark, src, txn.schema, ("ts",), max_files_per_trigger=1)
    for timeout in (None, 3600):
        out = jobs.fraud_alerts(stream, 5.0, 50.0, timeout)
        jobs.run_available(out, f"{scratch}/ckpt{timeout}", f"{scratch}/out{timeout}")
        got = rows(spark.read.parquet(f"{scratch}/out{timeout}").select("id", "txn_id"))
        want = rows(state.flag_alerts(txn, 5.0, 50.0, timeout).select("id", "txn_id"))
        assert got == want and len(want) > 0


def test_count_window_processor_equals_batch(spark, scratch):
    cars = X.cars(spark, SF)
    src = f"{scratch}/cars"
    split_files(cars, src, 3, "seq")
    stream = readers.stream_parquet(spark, src, cars.schema, ("ts",), max_files_per_trigger=1)
    jobs.run_available(jobs.count_tumble(stream, "sensorId", 5), f"{scratch}/ckpt", f"{scratch}/out")
    got = rows(spark.read.parquet(f"{scratch}/out"))
    want = rows(counts.count_tumble(cars, "sensorId", "seq", "count", 5))
    assert got == want and len(want) > 0


def test_hot_items_stream_equals_batch(spark, scratch):
    ev = X.events(spark, SF)
    src = f"{scratch}/ev"
    split_files(ev, src, 3, "ts")
    schema = ev.schema
    for i in range(2):
        add_file(spark, src, [(10**9 + i, FAR + dt.timedelta(days=5 * i), 999, "x", 0.0, "{}")], schema, f"s{i}")
    stream = readers.stream_parquet(spark, src, schema, ("ts",), max_files_per_trigger=1)
    counts = jobs.hot_item_counts(stream, "user_id", "ts", "1 day", "6 hours", delay="0 seconds")

    def sink(df, batch_id):
        df.write.mode("append").parquet(f"{scratch}/out")
    jobs.run_batches(counts, f"{scratch}/ckpt", jobs.hot_items_batches(sink))
    got = rows(spark.read.parquet(f"{scratch}/out").where("auction <> 999"))
    want = rows(windows.hot_items(ev, "user_id", "ts", "1 day", "6 hours"))
    assert got == want and len(want) > 0


def test_session_and_window_join_streams_equal_batch(spark, scratch):
    from kestrel.operators import joins
    ev = X.events(spark, SF)
    src = f"{scratch}/ev"
    split_files(ev, src, 3, "ts")
    for i in range(2):
        add_file(spark, src, [(10**9 + i, FAR + dt.timedelta(days=5 * i), 999, "x", 0.0, "{}")], ev.schema, f"s{i}")
    stream = readers.stream_parquet(spark, src, ev.schema, ("ts",), 1)
    jobs.run_available(jobs.session_count(stream, "user_id", "ts", "6 hours", delay="0 seconds"),
                       f"{scratch}/ck1", f"{scratch}/out1")
    got = rows(spark.read.parquet(f"{scratch}/out1").where("bidder <> 999")
               .select("bidder", "bid_count", F.col("starttime").cast("string")))
    want = rows(windows.session_count(ev, "user_id", "ts", "6 hours").select(
        "bidder", "bid_count", F.col("starttime").cast("string")))
    assert got == want and len(want) > 0

    orders, goods = X.order_items(spark, SF), X.goods(spark, SF)
    split_files(orders, f"{scratch}/o", 3, "ts")
    split_files(goods, f"{scratch}/g", 3, "ts")
    os_ = readers.stream_parquet(spark, f"{scratch}/o", orders.schema, ("ts",), 1)
    gs = readers.stream_parquet(spark, f"{scratch}/g", goods.schema, ("ts",), 1)
    jobs.run_available(jobs.window_join(os_, gs, "30 days", delay="0 seconds"), f"{scratch}/ck2", f"{scratch}/out2")
    got = rows(spark.read.parquet(f"{scratch}/out2"))
    want = rows(joins.window_join(orders, goods, "30 days"))
    assert got == want and len(want) > 0


def test_equi_join_stream_equals_batch(spark, scratch):
    from kestrel.operators import joins
    auctions, persons = X.auctions(spark, SF), X.persons(spark, SF)
    split_files(auctions, f"{scratch}/a", 3, "dateTime")
    split_files(persons, f"{scratch}/p", 2, "dateTime")
    a = readers.stream_parquet(spark, f"{scratch}/a", auctions.schema, ("dateTime", "expires"), 1)
    p = readers.stream_parquet(spark, f"{scratch}/p", persons.schema, ("dateTime",), 1)
    jobs.run_available(joins.join_equi(a, p), f"{scratch}/ck", f"{scratch}/out")
    got = rows(spark.read.parquet(f"{scratch}/out"))
    assert got == rows(joins.join_equi(auctions, persons)) and len(got) > 0


def test_max_per_window_stream_equals_batch(spark, scratch):
    ev = X.events(spark, SF)
    src = f"{scratch}/ev"
    split_files(ev, src, 3, "ts")
    for i in range(3):
        add_file(spark, src, [(10**9 + i, FAR + dt.timedelta(days=5 * i), 999, "x", -1.0, "{}")], ev.schema, f"s{i}")
    stream = readers.stream_parquet(spark, src, ev.schema, ("ts",), 1)
    out = jobs.max_per_window(stream, "ts", "value", "1 day", 86400, delay="0 seconds")
    jobs.run_available(out, f"{scratch}/ckpt", f"{scratch}/out")
    got = rows(spark.read.parquet(f"{scratch}/out").where("user_id <> 999").select("event_id"))
    want = rows(windows.max_per_window(ev, "ts", "value", "1 day", 86400).select("event_id"))
    assert got == want and len(want) > 0


def test_new_users_stream_equals_batch(spark, scratch):
    persons, auctions = X.persons(spark, SF), X.auctions(spark, SF)
    for name, df in (("p", persons), ("a", auctions)):
        split_files(df, f"{scratch}/{name}", 3, "dateTime")
    far_p = [(10**9 + i, "zz", "e", "c", "x", "OR", FAR + dt.timedelta(days=90 * i), "") for i in range(3)]
    far_a = [(10**9 + i, "i", "d", 1, 1, FAR + dt.timedelta(days=90 * i), FAR, 10**9, 10, "") for i in range(3)]
    for i in range(3):
        add_file(spark, f"{scratch}/p", [far_p[i]], persons.schema, f"s{i}")
        add_file(spark, f"{scratch}/a", [far_a[i]], auctions.schema, f"s{i}")
    p = readers.stream_parquet(spark, f"{scratch}/p", persons.schema, ("dateTime",), 1)
    a = readers.stream_parquet(spark, f"{scratch}/a", auctions.schema, ("dateTime", "expires"), 1)
    jobs.run_available(jobs.new_users(p, a, "30 days", delay="0 seconds"), f"{scratch}/ck", f"{scratch}/out")
    got = rows(spark.read.parquet(f"{scratch}/out").where("id < 1000000000").select("id", "name", F.col("stime").cast("string")))
    want = rows(windows.new_users(persons, auctions, "30 days").select("id", "name", F.col("stime").cast("string")))
    assert got == want and len(want) > 0


def test_processing_time_tumble_counts_every_row(spark, scratch):
    bids = X.bids(spark, SF)
    split_files(bids, f"{scratch}/b", 2, "dateTime")
    stream = readers.stream_parquet(spark, f"{scratch}/b", bids.schema, ("dateTime",), 1)
    timed = jobs.with_ingest_time(stream)
    q = windows.tumble_count(timed, "bidder", "p_time", "10 seconds")

    def sink(df, batch_id):
        df.write.mode("append").parquet(f"{scratch}/out")
    (q.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", f"{scratch}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(f"{scratch}/out")
    last = out.groupBy("bidder", "starttime").agg(F.max("bid_count").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == bids.count()
