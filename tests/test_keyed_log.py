"""The keyed log: equal to whole snapshots, batches write their own rows, crashes lose nothing, readers are pinned."""

import os
import random

import pytest
from pyspark.sql import functions as F

from kestrel.sources import keyed_log, sinks
from kestrel.sources.keyed_log import KeyedLog
from kestrel.streaming import jobs
from tests.conftest import rows

SCHEMA = "k string, seq long, name string"


def batches(n, seed=1):
    """Batches of updates; a later batch wins even with lower sequence numbers."""
    rng = random.Random(seed)
    return [[(rng.choice([None, *"abcdefghij"]), rng.randint(0, 50), f"b{b}r{i}") for i in range(rng.randint(1, 8))] for b in range(n)]


def model(data):
    state = {}
    for batch in data:
        best = {}
        for k, seq, name in batch:
            if k not in best or (seq, name) > best[k]:
                best[k] = (seq, name)
        state.update(best)
    return state


def table(df):
    return {r["k"]: (r["seq"], r["name"]) for r in df.collect()}


def test_equals_a_map_at_every_version(spark, scratch):
    data, log = batches(11), KeyedLog(spark, f"{scratch}/log", "k", "seq", ["name"], fanout=2)
    for v, batch in enumerate(data):
        log.write(spark.createDataFrame(batch, SCHEMA), v)
    for v in (0, 1, 4, 7, 10):  # readers pinned to versions, after all merges
        assert table(log.read(v)) == model(data[:v + 1])
    assert table(log.read()) == model(data) and log.versions() == list(range(11))
    levels = [r["level"] for r in log.runs(10)]
    assert levels == sorted(levels) and all(levels.count(x) < 2 for x in levels)
    wanted = spark.createDataFrame([("a",), ("zz",), (None,)], "x string")
    assert table(log.lookup(wanted)) == {k: v for k, v in model(data).items() if k in ("a", None)}


def written(path):
    return {f: os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_batch_writes_its_own_rows(spark, scratch):
    log = KeyedLog(spark, f"{scratch}/log", "k", "seq", ["name"], fanout=4)
    big = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("seq"), F.lit("x").alias("name"))
    log.write(big, 0)
    before = written(f"{scratch}/log/runs")
    log.write(spark.createDataFrame([("5", 1, "new")], SCHEMA), 1)
    fresh = {f: s for f, s in written(f"{scratch}/log/runs").items() if f not in before}
    assert sum(fresh.values()) < sum(before.values()) / 20
    assert log.read().count() == 20_000 and table(log.lookup(spark.createDataFrame([("5",)], "x string"))) == {"5": (1, "new")}


def test_a_crash_before_the_manifest_loses_nothing(spark, scratch, monkeypatch):
    data, log = batches(6, 3), KeyedLog(spark, f"{scratch}/log", "k", "seq", ["name"], fanout=2)
    frames = [spark.createDataFrame(b, SCHEMA) for b in data]
    for v in range(3):
        log.write(frames[v], v)

    def crash(*_):
        raise RuntimeError("killed between runs and manifest")

    for v in range(3, 6):
        with monkeypatch.context() as m:
            m.setattr(KeyedLog, "_commit", crash)
            with pytest.raises(RuntimeError):
                log.write(frames[v], v)
        assert not log.has(v) and table(log.read()) == model(data[:v])
        log.write(frames[v], v)  # the retried batch
        log.write(spark.createDataFrame([("a", 99, "twice")], SCHEMA), v)  # a committed version stays
        assert table(log.read()) == model(data[:v + 1])
    gone = log.vacuum(keep=1)
    assert gone and table(log.read()) == model(data) and log.versions() == [5]
    listed = {r["path"].rsplit("/", 1)[1] for r in log.runs(5)}
    assert set(os.listdir(f"{scratch}/log/runs")) == listed


def test_missing_version_and_bad_fanout(spark, scratch):
    log = KeyedLog(spark, f"{scratch}/log", "k", "seq", ["name"])
    with pytest.raises(ValueError):
        log.read()
    with pytest.raises(ValueError):
        log.write(spark.createDataFrame([("a", 1, "x")], SCHEMA), 3)  # version 2 is not there
    with pytest.raises(ValueError):
        KeyedLog(spark, scratch, "k", "seq", ["name"], fanout=1)
    log.write(spark.createDataFrame([], SCHEMA), 0)
    assert log.read().collect() == []


def test_stream_equals_whole_snapshots(spark, scratch):
    from kestrel.sources import readers
    from tests.test_streaming import split_files
    rowsdf = spark.range(400).select((F.col("id") % 37).cast("string").alias("k"), F.col("id").alias("seq"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    split_files(rowsdf, f"{scratch}/in", 5, "seq")
    stream = readers.stream_parquet(spark, f"{scratch}/in", rowsdf.schema, (), 1)
    jobs.run_batches(stream, f"{scratch}/ck", jobs.keyed_log_batches(f"{scratch}/log", "k", "seq", ["name"], fanout=2))
    log = KeyedLog(spark, f"{scratch}/log", "k", "seq", ["name"])
    assert rows(log.read()) == rows(sinks.latest_per_key(rowsdf, "k", "seq", ["seq", "name"])) and len(log.versions()) == 5
    assert keyed_log.FANOUT >= 2
