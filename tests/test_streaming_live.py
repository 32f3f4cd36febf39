"""Global count windows and pattern rules that change on a stream equal their batch forms for any batch cuts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import counts, rules, state
from kestrel.sources import readers
from kestrel.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import FAR, add_file, split_files

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


# -- count_global -----------------------------------------------------------------------------

@pytest.mark.parametrize("n, cuts, size", [(103, 4, 5), (12, 5, 7), (60, 3, 5)])
def test_count_global_equals_batch(spark, scratch, n, cuts, size):
    cars = spark.range(n).select(F.when(F.col("id") % 9 != 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("sensorId"),
                                 (F.col("id") * 3).alias("seq"), F.when(F.col("id") % 11 != 0, F.col("id") % 10).alias("count"))
    split_files(cars, f"{scratch}/in", cuts, "seq")
    stream = readers.stream_parquet(spark, f"{scratch}/in", cars.schema, (), 1)
    killed = []

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{scratch}/out/b={batch_id}")
        if batch_id == 1 and not killed:
            killed.append(batch_id)
            raise RuntimeError("killed after the batch's output, before its carry")

    run = jobs.count_global_batches(f"{scratch}/open", "sensorId", "seq", "count", size, sink)
    with pytest.raises(Exception):
        jobs.run_batches(stream, f"{scratch}/ck", run)
    jobs.run_batches(stream, f"{scratch}/ck", run)  # the killed batch runs again from the same open window
    got = spark.read.parquet(f"{scratch}/out").drop("b")
    want = counts.count_global(cars, "sensorId", "seq", "count", size)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


# -- rules that change ------------------------------------------------------------------------

def simulate(items, changes):
    """One row after the other in event time, rules before items of the same time."""
    table, pending, out = {}, {}, []
    greatest = {}
    for rule, a, b, t in changes:
        k = (rule, t)
        greatest[k] = max(greatest.get(k, ("", "")), (a or "", b or ""))
    stream = [(t, 0, 0, rule, a, b) for (rule, t), (a, b) in greatest.items()] + [(t, 1, seq, k, shape, None) for k, seq, shape, t in items]
    for t, is_item, seq, x, y, z in sorted(stream, key=lambda r: (r[0], r[1], r[2], str(r[3]))):
        if not is_item:
            table[x] = (y, z)
            pending = {p: v for p, v in pending.items() if p[1] != x}
            continue
        for rule, (a, b) in table.items():
            if not a:
                continue
            if y == b:
                out += [(rule, x, first, seq) for first in pending.pop((x, rule), [])]
            if y == a:
                pending.setdefault((x, rule), []).append(seq)
    return sorted(out)


def case(seed, n=160):
    rng = random.Random(seed)
    items = [(rng.randint(1, 5) + (1 << 60), i, rng.choice("RTC"), at(rng.randint(0, 300))) for i in range(n)]
    changes = []
    for _ in range(14):
        gone = rng.random() < 0.25
        changes.append((f"Rule_{rng.randint(0, 2)}", None if gone else rng.choice("RTC"), None if gone else rng.choice("RTC"), at(rng.randint(0, 280))))
    return items, changes


ITEMS, CHANGES = "k long, seq long, shape string, ts timestamp_ntz", "rule string, first string, second string, ts timestamp_ntz"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pattern_as_of_equals_simulation(spark, seed):
    items, changes = case(seed)
    got = state.pattern_as_of(spark.createDataFrame(items, ITEMS), spark.createDataFrame(changes, CHANGES), "k", "seq", "shape", buckets=8)
    assert rows(got) == simulate(items, changes) and got.count() > 0


def test_fixed_rules_as_of_equal_two_step(spark):
    items, _ = case(4)
    items = [(k, i, s, at(i)) for k, i, s, _ in items]  # seq in the order of time
    df = spark.createDataFrame(items, ITEMS)
    fixed = rules.pattern_rules(spark, [("R", "T"), ("C", "C")])
    start = fixed.withColumn("ts", F.lit(T0 - dt.timedelta(days=1)).cast("timestamp_ntz"))
    assert rows(state.pattern_as_of(df, start, "k", "seq", "shape")) == rows(state.two_step_pattern(df, fixed, "k", "seq", "shape"))


@pytest.mark.parametrize("seed, item_cuts, rule_cuts", [(1, 3, 2), (2, 1, 4)])
def test_live_rules_equal_batch_for_any_cuts(spark, scratch, seed, item_cuts, rule_cuts):
    items, changes = case(seed)
    i, c = spark.createDataFrame(items, ITEMS), spark.createDataFrame(changes, CHANGES)
    for df, name, cuts, end in ((i, "items", item_cuts, (0, 10**6, "~")), (c, "rules", rule_cuts, ("~", None, None))):
        split_files(df, f"{scratch}/{name}", cuts, "ts")
        for n in range(2):  # rows far ahead close the watermark
            add_file(spark, f"{scratch}/{name}", [(*end, FAR + dt.timedelta(days=n))], ITEMS if name == "items" else CHANGES, f"s{n}")
    read = lambda name, df: readers.stream_parquet(spark, f"{scratch}/{name}", df.schema, ("ts",), 1)
    q = jobs.live_pattern(read("items", i), read("rules", c), "k", "seq", "shape", delay="600 seconds", slots=4)
    jobs.run_available(q, f"{scratch}/ck", f"{scratch}/out")
    got = spark.read.parquet(f"{scratch}/out").where("rule <> '~'")
    assert rows(got) == simulate(items, changes)
