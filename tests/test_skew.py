"""One key holding a third of all rows: the ordered scans split it over many buckets
(so over many tasks) and still give the exact answers of a single window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import counts, prefix
from tests.conftest import rows


def skewed(spark, n=3000):
    # key 0 holds a third of the rows; keys 1..200 share the rest
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).cast("long").alias("k"),
        F.col("id").alias("seq"), ((F.col("id") * 7919) % 1000).cast("long").alias("v"))


def test_hot_key_is_split_over_buckets(spark):
    df = skewed(spark)
    b = prefix.with_bucket(df, "seq", 32)
    per = b.where("k = 0").groupBy(prefix.BKT).count().collect()
    assert len(per) == 32 and max(r["count"] for r in per) <= 1000 // 32 + 2


def test_hot_key_scans_are_exact(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("seq")
    want = (df.withColumn("rn", F.row_number().over(w).cast("long"))
            .withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("prev_v", F.lag("v").over(w)))
    got = prefix.rank(df, ["k"], ["seq"], "rn", buckets=16)
    got = prefix.prefix(got, ["k"], ["seq"], F.col("v"), "sum", "run", True, buckets=16)
    got = prefix.previous(got, ["k"], ["seq"], ["v"], "prev_", buckets=16)
    cols = ["k", "seq", "v", "rn", "run", "prev_v"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_hot_key_count_windows_and_lag_alerts(spark):
    df = skewed(spark).select(F.col("k").cast("string").alias("sensorId"), "seq", F.col("v").cast("int").alias("count"))
    got = counts.count_tumble(df, "sensorId", "seq", "count", 5, buckets=16)
    w = Window.partitionBy("sensorId").orderBy("seq")
    r = df.withColumn("rn", F.row_number().over(w))
    want = (r.groupBy("sensorId", F.floor((F.col("rn") - 1) / 5).alias("g"))
            .agg(F.sum("count").cast("long").alias("count"), F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq"))
            .where("n = 5").drop("g", "n"))
    assert rows(got) == rows(want.select("sensorId", "count", "last_seq"))


def test_only_hot_keys_are_bucketed_and_null_keys_kept(spark):
    df = skewed(spark).union(spark.createDataFrame([(None, 3000 + i, 1) for i in range(5)], "k long, seq long, v long"))
    b = prefix.with_bucket(df, "seq", 16, ["k"])
    per_key = {r["k"]: r["n"] for r in b.groupBy("k").agg(F.countDistinct(prefix.BKT).alias("n")).collect()}
    assert per_key[0] > 1 and all(n == 1 for k, n in per_key.items() if k != 0)
    got = prefix.rank(df, ["k"], ["seq"], "rn", buckets=16)
    w = Window.partitionBy("k").orderBy("seq")
    want = df.withColumn("rn", F.row_number().over(w).cast("long"))
    assert rows(got.select("k", "seq", "rn").fillna(-1, ["k"])) == rows(want.select("k", "seq", "rn").fillna(-1, ["k"]))


def test_outliers_do_not_collapse_buckets(spark):
    df = skewed(spark).union(spark.createDataFrame([(7, 10**9, 1), (7, 10**9 + 1, 1)], "k long, seq long, v long"))
    b = prefix.with_bucket(df, "seq", 16, ["k"])
    assert b.where("k = 0").select(prefix.BKT).distinct().count() > 8
    got = prefix.rank(df, ["k"], ["seq"], "rn", buckets=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")).cast("long"))
    assert rows(got.select("k", "seq", "rn")) == rows(want.select("k", "seq", "rn"))
