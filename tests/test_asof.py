"""As-of enrichment: one merged order of facts and versions, against the join with validity intervals."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import joins
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
FACTS = "k long, t timestamp_ntz, n long, row string"
DIM = "id long, valid_from timestamp_ntz, name string, age int"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def interval_join(facts, dim, how):
    """The same by key equality and ``valid_from <= t < valid_to``: every version of a key meets its facts."""
    times = dim.select(F.col("valid_from").alias("_at")).distinct()
    until = times.select("_at", F.lead("_at").over(Window.orderBy("_at")).alias("_to"))
    d = dim.join(until, dim.valid_from == until["_at"]).drop("_at")
    cond = (facts.k == d.id) & (facts.t >= d.valid_from) & (d["_to"].isNull() | (facts.t < d["_to"]))
    return facts.join(d, cond, how).drop("_to")


def random_case(spark, seed, hot=False):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(0, 1000), 12))
    dim = [(k, at(s), f"u{k}v{s}" if rng.random() < 0.9 else None, rng.randint(1, 90))
           for s in times for k in range(8) if rng.random() < 0.6]  # a key comes, goes and comes again
    facts = [(0 if hot and i % 3 else rng.randint(0, 9), at(rng.choice([*times, rng.randint(-50, 1100)])), i, "r") for i in range(900)]
    facts += [(None, at(500), 9000, "r"), (1, None, 9001, None)]
    return spark.createDataFrame(facts, FACTS), spark.createDataFrame(dim, DIM)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [False, True])
def test_equals_interval_join_with_removals(spark, how, hot):
    for seed in range(2):
        facts, dim = random_case(spark, seed, hot)
        got = joins.as_of_enrich(facts, dim, "k", "id", "t", how, buckets=16)
        want = interval_join(facts, dim, how)
        assert sorted(map(str, rows_any(got))) == sorted(map(str, rows_any(want.select(*got.columns))))


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_facts_never_meet_all_versions(spark):
    """1,000 snapshots of one user with 3,000 facts: the plan joins facts with nothing but range carries."""
    dim = spark.range(1000).select(F.lit(7).cast("long").alias("id"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("valid_from"),
                                   F.concat(F.lit("v"), F.col("id")).alias("name"), F.lit(1).alias("age"))
    facts = spark.range(3000).select(F.lit(7).cast("long").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 1000)).cast("timestamp_ntz").alias("t"),
                                     F.col("id").alias("n"), F.lit("r").alias("row"))
    got = joins.as_of_enrich(facts, dim, "k", "id", "t", buckets=16)
    assert got.count() == 3000
    assert got.where("name <> concat('v', cast(unix_seconds(cast(t as timestamp)) - unix_seconds(cast('2024-01-01' as timestamp)) as string))").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_bkt" in line or "at#" in line for line in plan.splitlines() if "Join" in line)


def test_boundaries_removal_and_repeats(spark):
    dim = spark.createDataFrame([(1, at(10), "a", 1), (2, at(10), "b", 1), (2, at(20), "b2", 1), (2, at(20), "b1", 9), (1, at(30), "a2", 1)], DIM)
    facts = spark.createDataFrame([(1, at(9), 1, ""), (1, at(10), 2, ""), (1, at(20), 3, ""), (1, at(30), 4, ""), (2, at(19), 5, ""),
                                   (2, at(20), 6, ""), (2, at(30), 7, "")], FACTS)
    got = joins.as_of_enrich(facts, dim, "k", "id", "t")
    assert rows(got.select("n", "name")) == [(2, "a"), (4, "a2"), (5, "b"), (6, "b2")]
    assert joins.as_of_enrich(facts, dim.where("false"), "k", "id", "t").collect() == []
    assert joins.as_of_enrich(facts.where("false"), dim, "k", "id", "t", "left").collect() == []


def test_unknown_how(spark):
    facts, dim = random_case(spark, 5)
    with pytest.raises(ValueError):
        joins.as_of_enrich(facts, dim, "k", "id", "t", "outer")
