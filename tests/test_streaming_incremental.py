"""Chained stateful aggregates equal their batch forms for any batch cuts, with NULLs, after a killed batch."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import aggs, joins
from kestrel.sources import fixtures as X
from kestrel.sources import readers
from kestrel.streaming import incremental
from tests.conftest import rows
from tests.test_streaming import split_files

SF = "/root/testdata/sf0.001"


def some_bids(spark):
    """A few days of bids, with NULL channels, bidders, prices and times among them."""
    b = X.bids(spark, SF)
    b = b.where(F.col("dateTime") < F.lit(b.agg(F.min("dateTime")).first()[0]) + F.expr("INTERVAL 90 DAYS"))
    n = F.xxhash64("auction", "bidder", "dateTime")
    gap = lambda c, k: F.when(F.pmod(n, F.lit(k)) == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
    return b.select(gap("auction", 17), gap("bidder", 13), gap("price", 11), gap("channel", 7), "url", gap("dateTime", 19), "extra",
                    n.alias("cut"))


class Killed(Exception):
    pass


def run_stream(spark, stream, scratch, kill_at=None):
    """All micro-batches into files by batch id; ``kill_at`` fails that batch once, after it was computed."""
    out = f"{scratch}/out"

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id == kill_at:
            raise Killed

    def start(fn):
        q = (stream.writeStream.foreachBatch(fn).outputMode("append").option("checkpointLocation", f"{scratch}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    if kill_at is not None:
        with pytest.raises(Exception):
            start(sink)
        kill_at = None
    start(sink)
    return spark.read.parquet(out)


def latest(df, keys):
    """The last emitted row of each group."""
    w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "batch")


@pytest.mark.parametrize("keys, kill_at", [([], 1), (["channel"], None)])
def test_band_stats_equal_batch(spark, scratch, keys, kill_at):
    bids = some_bids(spark)
    split_files(bids, f"{scratch}/in", 3, "cut")  # groups and values span the batches
    stream = readers.stream_parquet(spark, f"{scratch}/in", bids.schema, (), 1).drop("cut")
    got = latest(run_stream(spark, incremental.band_stats(stream, keys, bool(keys), slots=3), scratch, kill_at), [*keys, "day"])
    want = (aggs.channel_daily if keys else aggs.daily_bands)(bids.drop("cut"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert want.where("day is null").count() > 0


def test_avg_of_max_equals_batch(spark, scratch):
    bids, auctions = X.bids(spark, SF), X.auctions(spark, SF)
    j = (auctions.select("id", F.when(F.col("id") % 5 != 0, F.col("category")).alias("category"), "dateTime", "expires")
         .join(bids.select("auction", "price", F.col("dateTime").alias("t")), (F.col("id") == F.col("auction")) & F.col("t").between(F.col("dateTime"), F.col("expires")))
         .select("id", "category", "price", F.xxhash64("id", "price", "t").alias("cut")))
    split_files(j, f"{scratch}/in", 4, "cut")  # bids of an auction in any order, over all batches
    stream = readers.stream_parquet(spark, f"{scratch}/in", j.schema, (), 1)
    emitted = run_stream(spark, incremental.avg_of_max(stream), scratch, 2)
    best = j.groupBy("id", "category").agg(F.max("price").alias("final"))
    want = best.groupBy("category").agg((F.sum("final").cast("long")).alias("s"), F.count("final").alias("n")).selectExpr("category id", "s div n final")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, latest(emitted, ["id"]).select("id", "final").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
