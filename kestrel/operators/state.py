"""Batch forms of the keyed state jobs: card-fraud rules, the two-step shape pattern and
punctuated-watermark lateness. The streaming forms (``kestrel.streaming.stateful``)
carry the same state across micro-batches; these are the answers they converge to.

"Previous row of the key" and "running max over all earlier rows" use
``prefix.previous`` / ``prefix.prefix``, which split hot keys into range buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import prefix as P


def alert_all(txn: DataFrame) -> DataFrame:
    """Fraud detector v1: one alert (the account id) for every transaction."""
    return txn.select(F.col("account_id").alias("id"), F.col("id").alias("txn_id"))


def flag_alerts(txn: DataFrame, small: float, large: float, timeout_seconds: int | None = None,
                buckets: int | None = None) -> DataFrame:
    """Fraud v2 / v3: alert when a transaction above ``large`` directly follows (same
    account) one below ``small``; with ``timeout_seconds`` the small one must be at most
    that old (the flag's timer is reset by every small transaction, so the previous row
    alone decides). Order within an account: (ts, id)."""
    t = P.previous(txn, ["account_id"], ["ts", "id"], ["amount", "ts"], "prev_", buckets)
    cond = (F.col("prev_amount") < small) & (F.col("amount") > large)
    if timeout_seconds is not None:
        cond = cond & (F.col("ts") <= F.timestamp_add("SECOND", F.lit(timeout_seconds), F.col("prev_ts")))
    return t.where(cond).select(F.col("account_id").alias("id"), F.col("id").alias("txn_id"), "ts", "amount")


def two_step_pattern(items: DataFrame, rules: DataFrame, key: str, seq: str, shape: str,
                     buckets: int | None = None) -> DataFrame:
    """Per key and rule ``(first, second)``: every item of shape ``second`` matches each
    pending ``first`` item of the key, then the pending list is cleared. When first =
    second, an item matches before it is added.

    Equivalently, each first item matches the next second item strictly after it (it
    stays pending exactly until then). That is a suffix minimum of the seconds' ``seq``:
    an exclusive running max of ``-seq`` in descending ``seq`` order, computed with the
    bucketed ordered scan (no self-join, hot keys split into range buckets).
    """
    # One row per (rule, shape, role); an equality join, which Spark broadcasts if its size allows.
    roles = (rules.select("rule", F.col("first").alias("shape"), F.lit(True).alias("is_first"),
                          (F.col("first") == F.col("second")).alias("is_second"))
             .unionByName(rules.where(F.col("first") != F.col("second"))
                          .select("rule", F.col("second").alias("shape"), F.lit(False).alias("is_first"),
                                  F.lit(True).alias("is_second"))))
    x = (items.join(roles, items[shape] == roles.shape)
         .select("rule", key, seq, "is_first", "is_second", (-F.col(seq)).alias("_desc")))
    later_second = F.when(F.col("is_second"), -F.col(seq))
    x = P.prefix(x, ["rule", key], ["_desc"], later_second, "max", "_next", False, buckets)
    return (x.where(F.col("is_first") & F.col("_next").isNotNull())
            .select("rule", key, F.col(seq).alias("first_seq"), (-F.col("_next")).alias("second_seq")))


def rule_versions(changes: DataFrame) -> DataFrame:
    """Rule changes (rule, first, second, ts) → versions (rule, first, second, valid_from, valid_to): a change
    replaces the rule of its name from its time on, a NULL ``first`` removes it. Of several changes of a
    rule at one time the greatest (first, second) counts, a removal only where it is alone."""
    one = changes.groupBy("rule", "ts").agg(F.max(F.struct("first", "second")).alias("c"))
    until = F.lead("ts").over(Window.partitionBy("rule").orderBy("ts"))
    return (one.select("rule", "c.first", "c.second", F.col("ts").alias("valid_from"), until.alias("valid_to"))
            .where(F.col("first").isNotNull()))


def pattern_as_of(items: DataFrame, changes: DataFrame, key: str, seq: str, shape: str, time: str = "ts",
                  buckets: int | None = None) -> DataFrame:
    """``two_step_pattern`` under rules that change over event time: a rule version sees the items from its
    time up to its successor's, and what it has pending goes with it. Items are in the order (time, seq)."""
    v = rule_versions(changes)
    both = F.col("first") == F.col("second")
    roles = (v.select("rule", "valid_from", "valid_to", F.col("first").alias("_shape"), F.lit(True).alias("is_first"), both.alias("is_second"))
             .unionByName(v.where(~both).select("rule", "valid_from", "valid_to", F.col("second").alias("_shape"),
                                                F.lit(False).alias("is_first"), F.lit(True).alias("is_second"))))
    at = F.col(time)
    x = (items.join(roles, (items[shape] == F.col("_shape")) & (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
         .select("rule", "valid_from", key, seq, "is_first", "is_second", (-F.unix_micros(at.cast("timestamp"))).alias("_desc"), (-F.col(seq)).alias("_desc_seq")))
    later = F.when(F.col("is_second"), F.col(seq))
    x = P.prefix(x, ["rule", "valid_from", key], ["_desc", "_desc_seq"], later, "last", "_next", False, buckets)
    return x.where(F.col("is_first") & F.col("_next").isNotNull()).select("rule", key, F.col(seq).alias("first_seq"), F.col("_next").alias("second_seq"))


def punctuated_late(df: DataFrame, seq: str, time: str, id_col: str, marker, delay_seconds: int,
                    buckets: int | None = None) -> DataFrame:
    """Rows behind a punctuated watermark: only rows with ``id_col == marker`` advance it,
    to their time - ``delay``; a row is late when its time is at or before the watermark
    set by strictly earlier arrivals (order ``seq``). Global order, computed in buckets."""
    mark = F.when(F.col(id_col) == marker, F.timestamp_add("SECOND", F.lit(-delay_seconds), F.col(time)))
    x = P.prefix(df, [], [seq], mark, "max", "watermark", False, buckets)
    return x.where(F.col(time) <= F.col("watermark"))
