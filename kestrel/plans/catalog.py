"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the
inventory, each on whole tables (or entities Spark derives from them).

Interval sizes suit the test data (events are minutes apart, bids spread over years);
the reference's literal seconds-scale intervals are exercised by the unit tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import session
from kestrel.functions import scalar as S
from kestrel.operators import accumulate, aggs, calc, counts, joins, rules, state, topk, windows
from kestrel.sources import auction as V
from kestrel.sources import fixtures as X
from kestrel.sources import readers, sinks
from kestrel.sources.keyed_log import KeyedLog

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries on the test data (FIXTURES.md part C).
FRAUD_SMALL, FRAUD_LARGE, FRAUD_TIMEOUT_S = 5.0, 50.0, 3600
SCORE_THRESHOLD = 101
PATTERN_RULES = [("view", "purchase"), ("click", "click")]
LATE_MARKER, LATE_DELAY_S = 1, 60


# The auction queries read the flat entity projections: equal to the tag-filtered views
# of the nested event table (tested), but Catalyst prunes unused derived columns, which
# it does not do through the struct built for the nested form.
def _bid(spark, d):
    return X.bids(spark, d)


def _auction(spark, d):
    return X.auctions(spark, d)


def _person(spark, d):
    return X.persons(spark, d)


def _event_counts(spark, d):
    """The nested event table through its three views: rows and latest time per tag."""
    ev = X.events_table(spark, d)
    views = [(0, V.person_view(ev)), (1, V.auction_view(ev)), (2, V.bid_view(ev))]
    parts = [v.agg(F.lit(tag).alias("event_type"), F.count(F.lit(1)).alias("events"),
                   F.max("dateTime").alias("last_time")) for tag, v in views]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Sinks are written over whole tables and read back, in a new folder under spark.checkpoint.dir.
def _text_by_date(spark, d):
    path = session.shared_folder(spark, "text")
    sinks.text_append(X.events(spark, d), path, "props", "ts")
    return spark.read.schema("value string, dt string").text(path)


def _text_lines(spark, d):
    path = session.shared_folder(spark, "lines")
    X.cars(spark, d).select(F.concat_ws(",", "sensorId", "count").alias("value")).write.text(path)
    return readers.parse_csv_lines(readers.text_lines(spark, path))


def _json_rows(spark, d):
    path = session.shared_folder(spark, "json")
    sinks.json_nested(_keyed_rows(spark, d), path, "rowkey", ["id", "name"])
    back = spark.read.schema("rowkey string, info struct<id: bigint, name: string>").json(path)
    return back.select("rowkey", "info.id", "info.name")


def _partitioned(spark, d):
    path, table = session.shared_folder(spark, "table"), f"kestrel_{uuid.uuid4().hex}"
    for name in ("view", "click"):  # two static partitions
        sinks.partitioned_table(spark, _scores(spark, d).where(F.col("name") == name).select("id", "score"), table, "kind", name, path)
    return spark.read.schema("id bigint, score double, kind string").parquet(path)


def _upsert_versions(spark, d):
    """Two versions: rows of even sequence numbers, then the others merged into them. An update always wins."""
    path, k = session.shared_folder(spark, "upsert"), _keyed_rows(spark, d)
    half = F.col("seq") % 2 == 0
    sinks.upsert_snapshot(spark, k.where(half), path, "rowkey", "seq", ["id", "name"], 0)
    return sinks.upsert_snapshot(spark, k.where(~half), path, "rowkey", "seq", ["id", "name"], 1).select("rowkey", "id", "name")


def _moments(spark, d):
    """A user's accumulator per sensor and day: count, sum, sum of squares, least and greatest ``val1``."""
    rows = X.sensors(spark, d).select("id", F.window("ts", "1 day").start.alias("starttime"), "val1")
    return accumulate.accumulate(rows, ["id", "starttime"], ["val1"], accumulate.Moments("val1"),
                                 "n long, total long, squares long, least long, most long")


def _log_versions(spark, d):
    """Seven versions by sequence number (newest last) as runs, merged by twos, read at the last version."""
    log, k = KeyedLog(spark, session.shared_folder(spark, "log"), "rowkey", "seq", ["id", "name"], fanout=2), _keyed_rows(spark, d)
    for v in range(7):
        log.write(k.where(F.col("seq") % 7 == v), v)
    return log.read().select("rowkey", "id", "name")


def _scores(spark, d):
    return X.events(spark, d).select(F.col("event_id").alias("id"), F.col("event_type").alias("name"),
                                     F.col("value").alias("score"))


def _keyed_rows(spark, d):
    return X.events(spark, d).select(F.col("user_id").cast("string").alias("rowkey"),
                                     F.col("event_id").alias("id"), F.col("event_type").alias("name"),
                                     F.col("event_id").alias("seq"))


QUERIES: dict[str, Query] = {
    # projections and filters
    "q0": lambda s, d: calc.passthrough(_bid(s, d)),
    "q1": lambda s, d: calc.currency(_bid(s, d)),
    "q2": lambda s, d: calc.mod_filter(_bid(s, d), 123),
    "q14": lambda s, d: calc.calc(_bid(s, d)),
    "q21": lambda s, d: calc.channel_id(_bid(s, d)),
    "q22": lambda s, d: calc.url_dirs(_bid(s, d)),
    # joins
    "q3": lambda s, d: joins.join_equi(_auction(s, d), _person(s, d)),
    "q4": lambda s, d: joins.avg_of_max(_auction(s, d), _bid(s, d)),
    "q9": lambda s, d: topk.winning_bids(_auction(s, d), _bid(s, d)),
    "q20": lambda s, d: joins.join_expand(_bid(s, d), _auction(s, d)),
    "win_join_orders_goods": lambda s, d: joins.window_join(X.order_items(s, d), X.goods(s, d), "30 days"),
    # aggregates
    "q15": lambda s, d: aggs.daily_bands(_bid(s, d)),
    "q16": lambda s, d: aggs.channel_daily(_bid(s, d)),
    "q17": lambda s, d: aggs.auction_daily(_bid(s, d)),
    "running_sum": lambda s, d: aggs.running_sum(
        calc.threshold_filter(_scores(s, d), "score", SCORE_THRESHOLD), "name", ["id"], "score", ["id"]),
    # top-k
    "q18": lambda s, d: topk.last_bid(_bid(s, d)),
    "q19": lambda s, d: topk.top_bids(_bid(s, d), 10),
    # time windows
    "q5": lambda s, d: windows.hot_items(X.events(s, d), "user_id", "ts", "1 day", "6 hours"),
    "q7": lambda s, d: windows.max_per_window(X.events(s, d), "ts", "value", "1 day", 86400),
    "q8": lambda s, d: windows.new_users(_person(s, d), _auction(s, d), "30 days"),
    "q11": lambda s, d: windows.session_count(X.events(s, d), "user_id", "ts", "6 hours"),
    "q12": lambda s, d: windows.tumble_count(X.events(s, d), "user_id", "ts", "1 day"),
    "win_sum_tumble": lambda s, d: windows.window_sum(X.words(s, d), "word", "ts", "5 minutes"),
    "win_sum_slide": lambda s, d: windows.window_sum(X.words(s, d), "word", "ts", "10 minutes", "5 minutes"),
    "win_reduce_argmin": lambda s, d: windows.window_argmin(
        X.sensors(s, d), "id", "ts", "1 day", "temperature", "seq", ["seq", "id", "val1", "temperature", "ts"]),
    "win_agg_count": lambda s, d: windows.window_count(X.sensors(s, d), "id", "ts", "1 day"),
    "win_agg_moments": _moments,
    # count windows
    "count_tumble": lambda s, d: counts.count_tumble(X.cars(s, d), "sensorId", "seq", "count", 5),
    "count_slide": lambda s, d: counts.count_slide(X.cars(s, d), "sensorId", "seq", "count", 5, 3),
    "count_global": lambda s, d: counts.count_global(X.cars(s, d), "sensorId", "seq", "count", 5),
    "win_process_total": lambda s, d: counts.window_total(X.cars(s, d), "sensorId", "seq", "count", 5),
    # keyed state, batch form
    "state_alert_all": lambda s, d: state.alert_all(X.transactions(s, d)),
    "state_prev_flag": lambda s, d: state.flag_alerts(X.transactions(s, d), FRAUD_SMALL, FRAUD_LARGE),
    "state_flag_timer": lambda s, d: state.flag_alerts(
        X.transactions(s, d), FRAUD_SMALL, FRAUD_LARGE, FRAUD_TIMEOUT_S),
    "state_two_step_pattern": lambda s, d: state.two_step_pattern(
        X.events(s, d), rules.pattern_rules(s, PATTERN_RULES[:1]), "user_id", "event_id", "event_type"),
    "wm_punctuated": lambda s, d: state.punctuated_late(X.jitter(s, d), "seq", "ts", "id", LATE_MARKER,
                                                        LATE_DELAY_S),
    # rules
    "rules_latest": lambda s, d: rules.latest_rule_filter(X.messages(s, d), X.keywords(s)),
    "rules_accumulate": lambda s, d: rules.rules_for_each(X.transactions(s, d), X.keywords(s)),
    "rules_snapshot": lambda s, d: rules.snapshot_enrich(X.events(s, d), X.user_info(s, d)),
    "rules_pattern": lambda s, d: state.two_step_pattern(
        X.events(s, d), rules.pattern_rules(s, PATTERN_RULES), "user_id", "event_id", "event_type"),
    # scalar jobs, sources, sinks
    "src_events": _event_counts,
    "view_bid": lambda s, d: V.bid_view(X.events_table(s, d)),
    "view_auction": lambda s, d: V.auction_view(X.events_table(s, d)),
    "view_person": lambda s, d: V.person_view(X.events_table(s, d)),
    "src_text_lines": _text_lines,
    "sink_text_append": _text_by_date,
    "sink_json_nested": _json_rows,
    "sink_partitioned_table": _partitioned,
    "sink_upsert_merge": _upsert_versions,
    "sink_upsert_log": _log_versions,
    "running_sum_values": lambda s, d: aggs.running_sum_values(
        X.table(s, d, "lineitem").select(S.cos_cbrt("l_orderkey").alias("value"), "l_linenumber"), "value", ["l_linenumber"]),
    "map_tostring": lambda s, d: joins.window_join(X.order_items(s, d), X.goods(s, d), "30 days").select(
        S.record_text("OrderDetails", ["goodsId", "goodsName", "count", "totalMoney"]).alias("text")),
    "map_cos_cbrt": lambda s, d: calc.number_crunch(X.table(s, d, "lineitem"), "l_orderkey"),
    "src_text_csv": lambda s, d: readers.parse_csv_lines(
        X.cars(s, d).select(F.concat_ws(",", "sensorId", "count").alias("value"))),
    "sink_keyed_upsert": lambda s, d: sinks.latest_per_key(_keyed_rows(s, d), "rowkey", "seq", ["id", "name"]),
}
