"""Sinks: each writes, then the data is read back."""

import datetime as dt
import os


from kestrel.sources import readers, sinks
from tests.conftest import rows

# The reference's closed fixture for the partitioned table: 3 people in dt=2022-01-01.
PEOPLE = [("Alice", 25), ("Bob", 30), ("Charlie", 35)]


def test_partitioned_table(spark, scratch):
    df = spark.createDataFrame(PEOPLE, "name string, age int")
    sinks.partitioned_table(spark, df, "people_test", "dt", "2022-01-01", location=f"{scratch}/people")
    back = spark.sql("SELECT name, age, dt FROM people_test WHERE dt = '2022-01-01'")
    assert rows(back) == [(n, a, "2022-01-01") for n, a in PEOPLE]
    assert os.path.isdir(f"{scratch}/people/dt=2022-01-01")
    spark.sql("DROP TABLE people_test")


def test_json_nested_and_text_append(spark, scratch):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 5)), (2, "b", dt.datetime(2024, 1, 2, 5))],
                               "id int, name string, ts timestamp_ntz")
    sinks.json_nested(df, f"{scratch}/json", "id", ["id", "name"])
    back = spark.read.schema("rowkey string, info struct<id:int,name:string>").json(f"{scratch}/json")
    assert rows(back.select("rowkey", "info.id", "info.name")) == [("1", 1, "a"), ("2", 2, "b")]
    sinks.text_append(df, f"{scratch}/text", "name", "ts")
    sinks.text_append(df, f"{scratch}/text", "name", "ts")
    assert {"dt=2024-01-01", "dt=2024-01-02"} <= set(os.listdir(f"{scratch}/text"))
    assert spark.read.text(f"{scratch}/text").count() == 4


def test_keyed_upsert_versions(spark, scratch):
    path = f"{scratch}/kv"
    v0 = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 2), ("k1", "c", 3)], "rowkey string, name string, seq long")
    sinks.upsert_snapshot(spark, v0, path, "rowkey", "seq", ["name"], 0)
    v1 = spark.createDataFrame([("k2", "d", 4), ("k3", "e", 5)], "rowkey string, name string, seq long")
    snap = sinks.upsert_snapshot(spark, v1, path, "rowkey", "seq", ["name"], 1)
    assert rows(snap.select("rowkey", "name")) == [("k1", "c"), ("k2", "d"), ("k3", "e")]


def test_discard_and_csv_lines(spark):
    lines = spark.createDataFrame([("s1,3",), ("s2,4,extra",)], "value string")
    df = readers.parse_csv_lines(lines)
    assert rows(df) == [("s1", 3), ("s2", 4)]
    sinks.discard(df)
    assert readers.number_range(spark, 1, 10).count() == 10


def test_jdbc_append_embedded_derby(spark, scratch):
    url = f"jdbc:derby:{scratch}/derby;create=true"
    df = spark.createDataFrame([(1, "a_1", 150.5)], "id int, name string, score double")
    try:
        sinks.jdbc_append(df, url, "scores", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    except Exception as e:  # the embedded driver is not on every classpath
        import pytest
        pytest.skip(f"embedded Derby not available: {str(e)[:100]}")
    sinks.jdbc_append(df, url, "scores", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = spark.read.jdbc(url, "scores", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert back.count() == 2


def test_streaming_jdbc_and_text_sinks(spark, scratch):
    from pyspark.sql import functions as F

    from kestrel.operators import aggs
    from kestrel.sources import fixtures as X
    from kestrel.streaming import jobs
    from tests.test_streaming import split_files

    sf = "/root/testdata/sf0.001"
    scores = (X.events(spark, sf).select(F.col("event_id").alias("id"), F.col("event_type").alias("name"),
                                         F.col("value").alias("score"), "ts").where("score > 101"))
    split_files(scores, f"{scratch}/s", 2, "id")
    stream = readers.stream_parquet(spark, f"{scratch}/s", scores.schema, ("ts",), 1)
    url = f"jdbc:derby:{scratch}/derby;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    def run(df, batch_id):
        sinks.jdbc_append(df, url, "scores", props)
    jobs.run_batches(jobs.running_sum(stream.drop("ts"), "name", "id", "score", ["id"]), f"{scratch}/ck1", run)
    back = spark.read.jdbc(url, "scores", properties=props)
    want = aggs.running_sum(scores.drop("ts"), "name", ["id"], "score", ["id"])
    assert rows(back.select("id", "name", "score", "row_id")) == rows(want.select("id", "name", "score", "row_id"))

    q = (sinks.text_stream(stream, "name", "ts").option("path", f"{scratch}/text")
         .option("checkpointLocation", f"{scratch}/ck2").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.text(f"{scratch}/text").count() == scores.count()


def test_print_rows(spark, capsys):
    sinks.print_rows(spark.createDataFrame([(1, "alert")], "id int, msg string"))
    assert "alert" in capsys.readouterr().out


def test_continuous_start_and_stop(spark, scratch):
    from kestrel.streaming import jobs
    src = f"{scratch}/in"
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(src)
    stream = spark.readStream.schema("id long, v string").parquet(src)
    q = jobs.start(stream, f"{scratch}/ck", f"{scratch}/out", interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{scratch}/out").count() == 1


def test_upsert_never_forgets_a_missing_version(spark, scratch):
    import pytest
    up = lambda data: spark.createDataFrame(data, "k string, seq long, v string")
    sinks.upsert_snapshot(spark, up([("a", 1, "x"), ("b", 1, "y"), (None, 1, "n")]), scratch, "k", "seq", ["v"], 0)
    with pytest.raises(Exception):
        sinks.upsert_snapshot(spark, up([("c", 2, "z")]), scratch, "k", "seq", ["v"], 2)
    out = sinks.upsert_snapshot(spark, up([("b", 2, "w"), (None, 2, "m")]), scratch, "k", "seq", ["v"], 1)
    assert sorted((r.k or "-", r.v) for r in out.collect()) == [("-", "m"), ("a", "x"), ("b", "w")]
    with pytest.raises(ValueError):
        sinks.upsert_snapshot(spark, up([("c", 2, "z")]), scratch, "k", "seq", ["v"], 3, first_version=4)
