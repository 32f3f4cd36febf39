"""NULL keys and text ids in the stateful processors, and state that is forgotten."""

import datetime as dt
import time

from pyspark.sql import functions as F

from kestrel.operators import counts, state
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.test_streaming import split_files

T0 = dt.datetime(2024, 1, 1)
key = lambda r: tuple(map(str, r))


def txns(spark, kind):
    """Accounts 0..4 and NULL; text or number."""
    account = F.when(F.col("id") % 7 != 5, (F.col("id") * 7 % 5).cast(kind))
    return spark.range(240).select(account.alias("account_id"), F.col("id"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
                                   F.when(F.col("id") % 3 == 0, 1.0).otherwise(100.0).alias("amount"))


def test_fraud_alerts_of_null_and_text_accounts(spark, scratch):
    for kind in ("string", "long"):
        t = txns(spark, kind)
        split_files(t, f"{scratch}/{kind}", 3, "ts")
        stream = readers.stream_parquet(spark, f"{scratch}/{kind}", t.schema, ("ts",), 1)
        jobs.run_available(jobs.fraud_alerts(stream, 5.0, 50.0), f"{scratch}/ck{kind}", f"{scratch}/out{kind}")
        got = spark.read.parquet(f"{scratch}/out{kind}").select("id", "txn_id")
        want = state.flag_alerts(t, 5.0, 50.0).select("id", "txn_id")
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
        assert want.where("id is null").count() > 0 and got.schema["id"].dataType == t.schema["account_id"].dataType


def test_count_windows_of_null_sensors(spark, scratch):
    cars = spark.range(200).select(F.when(F.col("id") % 4 != 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("sensorId"), F.col("id").alias("seq"),
                                   (F.col("id") % 9).cast("int").alias("count"))
    split_files(cars, f"{scratch}/in", 3, "seq")
    stream = readers.stream_parquet(spark, f"{scratch}/in", cars.schema, (), 1)
    for name, q, want in (("t", jobs.count_tumble(stream, "sensorId", 5), counts.count_tumble(cars, "sensorId", "seq", "count", 5)),
                          ("s", jobs.count_slide(stream, "sensorId", "seq", "count", 5, 3), counts.count_slide(cars, "sensorId", "seq", "count", 5, 3))):
        jobs.run_available(q, f"{scratch}/ck{name}", f"{scratch}/out{name}")
        got = spark.read.parquet(f"{scratch}/out{name}")
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
        assert want.where("sensorId is null").count() > 0


def test_forgotten_state_stays_flat(spark, scratch):
    """Ten keys a batch, never the same: with a lifetime the state holds the last ones only, else all."""
    rows = spark.range(50).select((F.col("id") % 50).alias("auction"), F.col("id").alias("price"))
    split_files(rows, f"{scratch}/in", 5, "price")
    sizes = {}
    for ttl in (None, 1500):
        stream = readers.stream_parquet(spark, f"{scratch}/in", rows.schema, (), 1)
        q = jobs.top_k(stream, ["auction"], 2, ["price"], [False], "auction long, price long", ttl_ms=ttl)
        seen = []

        def sink(df, batch_id):
            seen.extend(map(tuple, df.collect()))
            time.sleep(2)  # longer than the lifetime

        # With a lifetime Spark always plans a further batch, so the query is stopped here.
        run = (q.writeStream.foreachBatch(sink).outputMode("update").option("checkpointLocation", f"{scratch}/ck{ttl}")
               .trigger(processingTime="0 seconds").start())
        until = time.time() + 120
        while len(seen) < 50 and run.isActive and time.time() < until:
            time.sleep(0.5)
        time.sleep(3)
        run.stop()
        sizes[ttl] = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in run.recentProgress if p["numInputRows"] > 0]
        assert sorted(seen) == [(i, i, 1) for i in range(50)]  # the answers are the same
    assert sizes[None] == sorted(sizes[None]) and sizes[None][-1] >= 4 * sizes[None][0]
    assert sizes[1500][-1] <= sizes[None][-1] // 2
