"""Exactly-once JDBC append into an embedded store of this process."""

import pytest
from pyspark.sql import functions as F

from kestrel.sources import jdbc_once as J
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import split_files

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture()
def url(scratch):
    return f"jdbc:derby:{scratch}/derby;create=true"


def scores(spark, lo, hi):
    return (spark.range(lo, hi, numPartitions=3).select(F.col("id").alias("n"), F.concat(F.lit("x"), F.col("id")).alias("name"),
                                                        F.when(F.col("id") % 5 > 0, F.col("id") / 2).alias("score")))


def stored(spark, url, table="scores"):
    return spark.read.jdbc(url, table, properties=PROPS)


def test_a_batch_run_twice_leaves_one_copy(spark, url):
    ledger = J.Ledger(spark, url, "scores", "nightly", PROPS)
    assert ledger.append(scores(spark, 0, 50), 0) and ledger.append(scores(spark, 50, 80), 1)
    assert not ledger.append(scores(spark, 0, 50), 0)
    assert J.Ledger(spark, url, "scores", "other", PROPS).append(scores(spark, 80, 90), 0)  # a job has its own ids
    assert rows(stored(spark, url)) == rows(scores(spark, 0, 90))
    assert rows(stored(spark, url, "scores_ledger")) == [("nightly", 0, 50), ("nightly", 1, 30), ("other", 0, 10)]


def test_crash_before_and_after_the_transaction(spark, url, monkeypatch):
    ledger = J.Ledger(spark, url, "scores", "j", PROPS)
    ledger.append(scores(spark, 0, 10), 0)
    run = ledger._run

    def fails(connection, sql, *values):
        if sql.startswith("UPDATE"):
            raise RuntimeError("lost")
        return run(connection, sql, *values)

    monkeypatch.setattr(ledger, "_run", fails)
    with pytest.raises(RuntimeError):
        ledger.append(scores(spark, 10, 30), 1)
    assert stored(spark, url).count() == 10 and not ledger.published(1)  # rows and entry were rolled back
    monkeypatch.undo()
    assert ledger.append(scores(spark, 10, 30), 1)
    assert rows(stored(spark, url)) == rows(scores(spark, 0, 30))
    with pytest.raises(Exception):  # a second publisher of the same batch
        ledger.publish(["n", "name", "score"], 1)
    assert rows(stored(spark, url)) == rows(scores(spark, 0, 30))


def test_a_task_that_wrote_twice_counts_once(spark, url):
    ledger = J.Ledger(spark, url, "scores", "j", PROPS)
    ledger.append(scores(spark, 0, 0), 0)
    ledger.write_stage(scores(spark, 0, 60))
    staged = stored(spark, url, "scores_j_stage")
    assert staged.select(J.PART).distinct().count() == 3
    again = spark.createDataFrame(staged.where(F.col(J.PART) == 1).withColumn(J.ATTEMPT, F.col(J.ATTEMPT) + 1000).collect(), staged.schema)
    again.write.jdbc(url, "scores_j_stage", mode="append", properties=PROPS)
    assert stored(spark, url, "scores_j_stage").count() == 80
    assert ledger.publish(["n", "name", "score"], 1) == 60
    assert rows(stored(spark, url)) == rows(scores(spark, 0, 60))


def test_stream_killed_between_sink_and_commit(spark, url, scratch):
    split_files(scores(spark, 0, 90), f"{scratch}/s", 3, "n")
    schema = scores(spark, 0, 1).schema
    append = J.append_batches(url, "scores", "s", PROPS)

    def killed(batch, batch_id):
        append(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("killed")

    def run(sink):
        stream = readers.stream_parquet(spark, f"{scratch}/s", schema, (), 1)
        jobs.run_batches(stream, f"{scratch}/ck", sink)

    with pytest.raises(Exception, match="killed"):
        run(killed)
    assert stored(spark, url).count() == 60
    run(append)
    assert rows(stored(spark, url)) == rows(scores(spark, 0, 90))
    assert rows(stored(spark, url, "scores_ledger")) == [("s", i, 30) for i in range(3)]


def test_bad_names_are_refused(spark, url):
    with pytest.raises(ValueError):
        J.Ledger(spark, url, "scores", "a b", PROPS)
    with pytest.raises(ValueError):
        J.Ledger(spark, url, "scores", "j", {})
