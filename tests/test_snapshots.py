"""The polled snapshot source: whole snapshots, versions as offsets, each read once, restart behind the last one."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kestrel.operators import joins
from kestrel.sources import snapshots as S
from kestrel.streaming import jobs
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def put(folder, version, data, groups=2):
    """A snapshot appears by rename, whole."""
    os.makedirs(folder, exist_ok=True)
    table = pa.table({"id": pa.array([r[0] for r in data], pa.int64()), "name": pa.array([r[1] for r in data], pa.string())})
    pq.write_table(table, f"{folder}/{version}.tmp", row_group_size=groups)
    os.rename(f"{folder}/{version}.tmp", f"{folder}/{version}.parquet")


def poll(spark, folder, checkpoint, seen, fail=False):
    def sink(df, batch_id):
        seen.setdefault(batch_id, []).append(sorted(map(tuple, df.collect()), key=str))
        if fail:
            raise RuntimeError("killed")

    q = (S.stream_snapshots(spark, folder, "id long, name string").writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_versions_are_read_once_and_whole(spark, scratch):
    folder, seen = f"{scratch}/in", {}
    put(folder, 3, [(1, "a"), (2, "b"), (3, None), (4, "d"), (5, "e")])
    open(f"{folder}/notes.txt", "w").close()  # not a snapshot
    poll(spark, folder, f"{scratch}/ck", seen)
    put(folder, 7, [(1, "a2")])
    put(folder, 9, [])
    put(folder, 10, [(9, "z")])
    with pytest.raises(Exception):
        poll(spark, folder, f"{scratch}/ck", seen, fail=True)  # killed inside the batch
    poll(spark, folder, f"{scratch}/ck", seen)
    poll(spark, folder, f"{scratch}/ck", seen)  # nothing new
    assert seen[0] == [[(1, "a", 3), (2, "b", 3), (3, None, 3), (4, "d", 3), (5, "e", 3)]]
    assert seen[1] == [[(1, "a2", 7), (9, "z", 10)]] * 2 and set(seen) == {0, 1}  # the killed batch again, with the same versions


def test_empty_folder_and_schema(spark, scratch):
    os.makedirs(f"{scratch}/in")
    seen = {}
    poll(spark, f"{scratch}/in", f"{scratch}/ck", seen)
    assert all(b == [[]] for b in seen.values()) and S.snapshot_versions(f"{scratch}/none") == {}
    with pytest.raises(ValueError):
        S.SnapshotSource({"path": scratch}).streamReader(spark.createDataFrame([], "id long").schema)


def test_enrichment_uses_the_snapshot_of_its_event_time(spark, scratch):
    """Snapshot versions are seconds; events come in other batches than the snapshots of their time."""
    folder, store = f"{scratch}/in", f"{scratch}/dim"
    snaps = {0: [(1, "a"), (2, "b")], 60: [(1, "a2")], 120: [(1, "a3"), (2, "b3")]}
    for v, data in snaps.items():
        put(folder, v, data)
        q = (S.stream_snapshots(spark, folder, "id long, name string").writeStream.foreachBatch(jobs.snapshot_store_batches(store))
             .option("checkpointLocation", f"{scratch}/ck").start())
        q.processAllAvailable()
        q.stop()
    dim = jobs.stored_snapshots(spark, store, "id long, name string")
    assert dim.count() == 5  # every snapshot once
    events = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s)) for k in (1, 2, 3) for s in (0, 59, 60, 119, 120, 500)], "k long, t timestamp_ntz")
    when = dim.selectExpr("id", "name", f"timestamp_ntz'{T0}' + make_dt_interval(0, 0, 0, version) AS valid_from")
    got = joins.as_of_enrich(events, when, "k", "id", "t")
    want = []
    for k in (1, 2, 3):
        for s in (0, 59, 60, 119, 120, 500):
            name = dict(snaps[max(v for v in snaps if v <= s)]).get(k)
            want += [(k, T0 + dt.timedelta(seconds=s), name)] if name else []
    assert rows(got.select("k", "t", "name")) == sorted(want)
