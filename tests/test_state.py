"""Keyed state jobs in batch form, checked against sequential simulations."""

import datetime as dt
import random

from kestrel.operators import rules as R
from kestrel.operators import state
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)

# The reference's closed fixture: 9 (shape, color) items and the rule (RECTANGLE, TRIANGLE).
ITEMS = [("RECTANGLE", "GREEN"), ("TRIANGLE", "BLUE"), ("TRIANGLE", "RED"), ("CIRCLE", "BLUE"),
         ("CIRCLE", "GREEN"), ("TRIANGLE", "BLUE"), ("RECTANGLE", "GREEN"), ("CIRCLE", "GREEN"),
         ("TRIANGLE", "GREEN")]


def test_pattern_reference_fixture(spark):
    items = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(ITEMS, start=1)],
                                  "seq long, shape string, color string")
    out = state.two_step_pattern(items, R.pattern_rules(spark, [("RECTANGLE", "TRIANGLE")]), "color", "seq", "shape")
    assert rows(out) == [("Rule_0", "GREEN", 1, 9), ("Rule_0", "GREEN", 7, 9)]


def simulate_pattern(items, rule_list):
    """Sequential form of the reference's keyed broadcast process function."""
    pending, out = {}, []
    for seq, shape, key in items:
        for i, (first, second) in enumerate(rule_list):
            lst = pending.setdefault((f"Rule_{i}", key), [])
            if shape == second and lst:
                out += [(f"Rule_{i}", key, a, seq) for a in lst]
                lst.clear()
            if shape == first:
                lst.append(seq)
    return sorted(out)


def test_pattern_equals_simulation(spark):
    rnd = random.Random(7)
    rule_list = [("a", "b"), ("b", "b"), ("c", "a")]
    for trial in range(3):
        items = [(i, rnd.choice("abc"), rnd.randrange(3)) for i in range(200)]
        df = spark.createDataFrame(items, "seq long, shape string, key long")
        got = rows(state.two_step_pattern(df, R.pattern_rules(spark, rule_list), "key", "seq", "shape", buckets=7))
        assert got == simulate_pattern(items, rule_list), trial


def txns(spark, data):
    return spark.createDataFrame([(i, a, amt, T0 + dt.timedelta(seconds=s)) for i, (a, amt, s) in enumerate(data)],
                                 "id long, account_id long, amount double, ts timestamp_ntz")


def test_fraud_flag_and_timer(spark):
    data = [(1, 0.5, 0), (1, 600.0, 60),     # small then large within 60 s: alert (v2 and v3)
            (2, 0.5, 0), (2, 600.0, 61),     # 61 s later: v2 only
            (3, 0.5, 0), (3, 10.0, 1), (3, 600.0, 2),  # flag cleared by the middle one
            (4, 1.0, 0), (4, 600.0, 1),      # 1 is not < 1
            (5, 0.1, 0), (5, 500.0, 1)]      # 500 is not > 500
    v2 = rows(state.flag_alerts(txns(spark, data), 1, 500).select("id"))
    v3 = rows(state.flag_alerts(txns(spark, data), 1, 500, 60).select("id"))
    assert v2 == [(1,), (2,)] and v3 == [(1,)]
    assert state.alert_all(txns(spark, data)).count() == len(data)


def test_previous_row_across_buckets_equals_lag(spark):
    rnd = random.Random(3)
    data = [(rnd.randrange(3), float(rnd.randrange(10)), rnd.randrange(10_000)) for _ in range(500)]
    df = txns(spark, data)
    got = rows(state.flag_alerts(df, 3, 6, buckets=13).select("txn_id"))
    by_acct = {}
    for i, (a, amt, s) in sorted(enumerate(data), key=lambda x: (x[1][2], x[0])):
        by_acct.setdefault(a, []).append((i, amt))
    want = sorted((i,) for lst in by_acct.values() for (_, p), (i, amt) in zip(lst, lst[1:]) if p < 3 and amt > 6)
    assert got == want


def test_punctuated_late_rows(spark):
    data = [(1, 5, 100), (2, 1, 200),   # marker at 200 s: watermark 140 s
            (3, 5, 140),                # at the watermark: late
            (4, 5, 141),                # after it: on time
            (5, 1, 150),                # marker behind: watermark stays 140 s
            (6, 5, 139)]                # late
    df = spark.createDataFrame([(s, i, T0 + dt.timedelta(seconds=t)) for s, i, t in data],
                               "seq long, id long, ts timestamp_ntz")
    out = state.punctuated_late(df, "seq", "ts", "id", 1, 60, buckets=3)
    assert sorted(r.seq for r in out.collect()) == [3, 6]
