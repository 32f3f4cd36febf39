"""q3 and q20 on streams with a bound in event time: the batch rows, and state that does not grow."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import joins
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import split_files

START = dt.datetime(2024, 1, 1)
PARTS, EACH = 8, 50


def at(seconds):
    return F.timestamp_add("SECOND", seconds, F.lit(START)).cast("timestamp_ntz")


def people(spark):
    """One person a minute; NULL ids and times as well."""
    n = spark.range(PARTS * EACH)
    return n.select(F.when(n.id % 17 > 0, n.id).alias("id"), F.concat(F.lit("p"), n.id).alias("name"), F.lit("Bend").alias("city"),
                    F.when(n.id % 3 > 0, "OR").otherwise("TX").alias("state"), at(n.id * 60).alias("dateTime"))


def sales(spark):
    """Two auctions a person: within the bound, exactly at it or just beyond it."""
    n = spark.range(PARTS * EACH)
    late = F.element_at(F.array(*map(F.lit, (0, 600, 601))), (n.id % 3 + 1).cast("int"))
    one = n.select((n.id * 2).alias("id"), F.when(n.id % 17 > 0, n.id).alias("seller"), at(n.id * 60 + late).alias("dateTime"))
    two = n.select((n.id * 2 + 1).alias("id"), n.id.alias("seller"), at(n.id * 60 - late).alias("dateTime"))
    return one.unionByName(two).select("id", "seller", "dateTime", F.lit("item").alias("itemName"), F.lit("d").alias("description"),
                                       F.lit(1).alias("initialBid"), F.lit(2).alias("reserve"), F.col("dateTime").alias("expires"),
                                       F.when(F.col("id") % 5 > 0, 10).otherwise(11).alias("category"), F.lit("e").alias("extra"))


def offers(spark):
    n = spark.range(PARTS * EACH * 2)
    return n.select(n.id.alias("auction"), (n.id % 7).alias("bidder"), n.id.alias("price"), F.lit("c").alias("channel"),
                    F.lit("u").alias("url"), at(n.id * 30 + 100 * (n.id % 9)).alias("dateTime"), F.lit("x").alias("extra"))


def streamed(spark, scratch, df, name, times=("dateTime",)):
    split_files(df, f"{scratch}/{name}", PARTS, "dateTime")
    return readers.stream_parquet(spark, f"{scratch}/{name}", df.schema, times, 1)


def run(df, scratch):
    """Runs to the end of the input; the state rows after each batch."""
    q = (df.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]


def test_sellers_within_equals_batch_and_forgets(spark, scratch):
    a, p = sales(spark), people(spark)
    out = jobs.sellers_within(streamed(spark, scratch, a, "a", ("dateTime", "expires")), streamed(spark, scratch, p, "p"), "10 minutes", "20 minutes")
    state = run(out, scratch)
    want = joins.join_equi(a, p, within="10 minutes")
    got = rows(spark.read.parquet(f"{scratch}/out"))
    assert got == rows(want) and 0 < len(got) < joins.join_equi(a, p).count()
    assert max(state) < 0.4 * (a.where("category = 10").count() + p.where("state = 'OR'").count())


def test_expanded_within_equals_batch_and_forgets(spark, scratch):
    b, a = offers(spark), sales(spark)
    out = jobs.expanded_within(streamed(spark, scratch, b, "b"), streamed(spark, scratch, a, "a", ("dateTime", "expires")), "10 minutes", "20 minutes")
    state = run(out, scratch)
    got = rows(spark.read.schema(out.schema).parquet(f"{scratch}/out").select("auction", "price", "itemName", "category"))
    want = joins.join_expand(b, a, within="10 minutes").select("auction", "price", "itemName", "category")
    assert got == rows(want) and 0 < len(got) < joins.join_expand(b, a).count()
    assert max(state) < 0.4 * (b.count() + a.where("category = 10").count())
