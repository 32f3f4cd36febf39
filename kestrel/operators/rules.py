"""Rule-driven (broadcast-state) jobs, pinned to event-time as-of semantics: a rule or a
dimension snapshot applies to rows at or after its own timestamp.

Rules and rows are put in one order of time and each row takes the last rule at or before
it, with the ordered scan of ``prefix`` (the last rule carried). There is no
join of rows with rules, no broadcast and no limit on the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import joins as J
from kestrel.operators import prefix as P

# Alert text of the keyword filter job ("message intercepted: <msg>,
# because it matched rule: <keyword>").
ALERT_PREFIX = "拦截消息:"
ALERT_MIDDLE = ", 是因为匹配到规则:"

START = "0001-01-01 00:00:00"  # a rule without a time is there from the start


def last_rule(rows: DataFrame, rules: DataFrame, value: str, time: str = "ts", arrival: str = "arrival",
              out: str = "rule") -> DataFrame:
    """Rows with the ``value`` of the last rule at or before their time (NULL before the first).

    Rules at one time are ordered by their ``arrival`` number, where they have one, then by value.
    """
    when = F.coalesce(F.col(time), F.lit(START).cast("timestamp_ntz"))
    came = F.col(arrival).cast("long") if arrival in rules.columns else F.lit(0).cast("long")
    row = F.struct(*[F.col(c) for c in rows.columns])
    r = rules.select(when.alias("_time"), F.lit(0).alias("_is_row"), came.alias("_came"), F.col(value).alias("_value"),
                     F.lit(None).cast(rows.select(row).schema[0].dataType).alias("_row"))
    x = rows.select(F.col(time).alias("_time"), F.lit(1).alias("_is_row"), F.lit(0).cast("long").alias("_came"),
                    F.lit(None).cast(r.schema["_value"].dataType).alias("_value"), row.alias("_row"))
    order = ["_time", "_is_row", "_came", "_value"]
    seen = P.prefix(r.unionByName(x), [], order, F.when(F.col("_is_row") == 0, F.struct("_value")), "last", "_last")
    return seen.where("_is_row = 1").select("_row.*", F.col("_last._value").alias(out))


def latest_rule_filter(messages: DataFrame, keywords: DataFrame, text: str = "message",
                       time: str = "ts") -> DataFrame:
    """Each message checked against the keyword current at its time; matches become alerts."""
    j = last_rule(messages, keywords, "keyword", time, out="keyword")
    return (j.where(F.col(text).contains(F.col("keyword")))
            .select("seq", text, "keyword",
                    F.concat(F.lit(ALERT_PREFIX), F.col(text), F.lit(ALERT_MIDDLE), F.col("keyword"))
                    .alias("alert")))


def accumulated_rules(rules: DataFrame, rule: str = "keyword", time: str = "ts") -> DataFrame:
    """Growing rule set: after each arrival, the sorted set of all rules so far as text
    ``r:r;r:r;`` (a rule seen twice is one entry). One row per time at which the set grew;
    its texts are the job's answer, so they grow with the set by definition."""
    first = rules.where(F.col(time).isNotNull()).groupBy(rule).agg(F.min(time).alias(time))
    w = Window.orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    sets = (first.groupBy(time).agg(F.collect_set(rule).alias("_new"))
            .withColumn("_all", F.array_sort(F.array_distinct(F.flatten(F.collect_list("_new").over(w))))))
    text: Column = F.array_join(F.transform("_all", lambda r: F.concat(r, F.lit(":"), r, F.lit(";"))), "")
    return sets.select(time, text.alias("rules"))


def rules_for_each(txn: DataFrame, rules: DataFrame, time: str = "ts") -> DataFrame:
    """Every transaction with the text of all rules known at its time (a transaction
    before any rule gets the empty list)."""
    j = last_rule(txn, accumulated_rules(rules, time=time), "rules", time, out="rules")
    return j.select("id", "account_id", F.coalesce("rules", F.lit("")).alias("rules"))


def snapshot_enrich(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events enriched with the user snapshot valid at event time: (userId, eventTime,
    eventType, productId, userName, userAge). Events of unknown users, or before the
    first snapshot, are dropped."""
    e = events.select(F.col("user_id"), F.col("ts").alias("eventTime"),
                      F.col("event_type").alias("eventType"), F.col("event_id").alias("productId"))
    j = J.as_of_enrich(e, users, "user_id", "userId", "eventTime")
    return j.select("userId", "eventTime", "eventType", "productId", "userName", "userAge")


def pattern_rules(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules ``(first, second)`` named ``Rule_0``, ``Rule_1``... in arrival order."""
    return spark.createDataFrame([(f"Rule_{i}", a, b) for i, (a, b) in enumerate(rules)],
                                 "rule string, first string, second string")
