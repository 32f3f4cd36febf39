"""Time-window queries: hop (q5), tumble (q7, q8, q12, word counts, sensor reduce /
aggregate) and session (q11). Sizes and the time column are parameters: the reference
uses seconds and processing time in places; tests pass its literal intervals.

Windows are epoch-aligned (``F.window`` with no offset), bounds come out as
``starttime`` / ``endtime``. All aggregates here aggregate partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import scalar as S


def _bounds(w: str = "window"):
    return [F.col(f"{w}.start").alias("starttime"), F.col(f"{w}.end").alias("endtime")]


def hot_items(df: DataFrame, key: str, time: str, size: str, slide: str, out_key: str = "auction") -> DataFrame:
    """q5: per hop window, the keys with the most rows (all ties kept) and their count.

    The per-window maximum is a partial aggregate (one row per window), joined back to
    the counts on the window; AQE broadcasts it when its runtime size allows and splits a
    skewed window otherwise. A window function ``max() over (partition by window)`` would
    put every key of a window into one task.
    """
    counts = (df.groupBy(F.col(key).alias(out_key), F.window(time, size, slide))
              .agg(F.count(F.lit(1)).alias("num")))
    return top_per_window(counts, out_key)


def top_per_window(counts: DataFrame, out_key: str) -> DataFrame:
    """Rows of ``(out_key, window, num)`` whose ``num`` is the maximum of their window."""
    maxes = counts.groupBy(F.col("window").alias("m_window")).agg(F.max("num").alias("maxn"))
    j = counts.join(maxes, (counts.window == maxes.m_window) & (counts.num >= maxes.maxn))
    return j.select(out_key, "num")


def _seconds(interval: str) -> float:
    n, unit = interval.split()
    mult = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return float(n) * mult[unit.lower().rstrip("s")]


def max_per_window(df: DataFrame, time: str, price: str, size: str, size_seconds: int) -> DataFrame:
    """q7: rows whose ``price`` equals the maximum of a tumbling window and whose time lies
    in ``[rowtime - size, rowtime]``, rowtime = window end - 1 ms (both ends inclusive).

    A row can match its own window, or, in the last millisecond before it, the next one. Own
    window: ``rank() = 1`` by price, which Spark limits per map task before the shuffle, so
    only rows that may win are moved. Next window: the few rows of those last milliseconds,
    joined to the windows' maxima.
    """
    cols = df.columns
    one_ms = F.expr("INTERVAL 1 MILLISECOND")
    own = df.where(F.col(price).isNotNull()).withColumn("_w", F.window(time, size))
    best = Window.partitionBy("_w").orderBy(F.col(price).desc())
    won = (own.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= 1)
           .where(F.col(time) <= S.rowtime("_w.end")).select(*cols))
    maxes = (df.groupBy(F.window(time, size)).agg(F.max(price).alias("_max"))
             .select(F.col("window.start").alias("_start"), "_max"))
    last_ms = own.where(F.col(time) >= S.rowtime("_w.end"))
    lower = F.timestamp_add("SECOND", F.lit(-size_seconds), F.col("_start") + F.expr(f"INTERVAL {size_seconds} SECONDS") - one_ms)
    early = (last_ms.join(maxes, (F.col("_w.end") == maxes["_start"]) & (F.col(price) == maxes["_max"]))
             .where(F.col(time) >= lower).select(*cols))
    return won.unionByName(early)


def new_users(person: DataFrame, auction: DataFrame, size: str) -> DataFrame:
    """q8: persons who opened an auction in the same tumbling window as they registered."""
    p = (person.select("id", "name", F.window("dateTime", size).alias("window")).distinct()
         .select("id", "name", *_bounds()))
    a = (auction.select("seller", F.window("dateTime", size).alias("window")).distinct()
         .select("seller", F.col("window.start").alias("a_start"), F.col("window.end").alias("a_end")))
    j = p.join(a, (p.id == a.seller) & (p.starttime == a.a_start) & (p.endtime == a.a_end))
    return j.select("id", "name", F.col("starttime").alias("stime"))


def session_count(df: DataFrame, key: str, time: str, gap: str, out_key: str = "bidder") -> DataFrame:
    """q11: rows per (key, session); a session ends after ``gap`` with no row of the key.
    A row exactly one gap after the previous one joins the session; end = last + gap.

    Two levels. Rows of one slot ``floor(time / gap)`` are never more than a gap apart, so a
    slot is always part of one session: a plain partial aggregate per (key, slot) folds a hot
    key's rows before the shuffle and leaves at most one row per slot of the time range. Those
    are merged as rows with the dynamic gap ``(last - first) + gap``, i.e. the window
    ``[first, last + gap)``, which meets the next one exactly when their rows would have.
    """
    gap_us = int(_seconds(gap) * 1_000_000)
    us = F.unix_micros(F.col(time).cast("timestamp"))
    part = (df.groupBy(F.col(key).alias(out_key), F.floor(us / F.lit(gap_us)).alias("_slot"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_lo"), F.max(time).alias("_hi")))
    span_us = F.unix_micros(F.col("_hi").cast("timestamp")) - F.unix_micros(F.col("_lo").cast("timestamp"))
    dyn_gap = F.concat((span_us + F.lit(gap_us)).cast("string"), F.lit(" microseconds"))
    return (part.groupBy(out_key, F.session_window("_lo", dyn_gap))
            .agg(F.sum("_n").alias("bid_count"))
            .select(out_key, "bid_count", F.col("session_window.start").alias("starttime"),
                    F.col("session_window.end").alias("endtime")))


def session_count_single(df: DataFrame, key: str, time: str, gap: str, out_key: str = "bidder") -> DataFrame:
    """q11 in one level (Spark's session window): the streaming form, whose state store
    already works per key incrementally and is bounded by the watermark."""
    return (df.groupBy(F.col(key).alias(out_key), F.session_window(time, gap))
            .agg(F.count(F.lit(1)).alias("bid_count"))
            .select(out_key, "bid_count", F.col("session_window.start").alias("starttime"),
                    F.col("session_window.end").alias("endtime")))


def tumble_count(df: DataFrame, key: str, time: str, size: str, out_key: str = "bidder") -> DataFrame:
    """q12: rows per (key, tumbling window). For processing time pass an ingest-time column."""
    return (df.groupBy(F.col(key).alias(out_key), F.window(time, size))
            .agg(F.count(F.lit(1)).alias("bid_count"))
            .select(out_key, "bid_count", *_bounds()))


def window_sum(df: DataFrame, key: str, time: str, size: str, slide: str | None = None,
               value: str | None = None, out: str = "cnt") -> DataFrame:
    """Per-key windowed sum (``value`` None: count of rows, i.e. the sum of 1s)."""
    win = F.window(time, size, slide) if slide else F.window(time, size)
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(key, win).agg(agg.alias(out)).select(key, *_bounds(), out)


def window_argmin(df: DataFrame, key: str, time: str, size: str, value: str, seq: str,
                  cols: list[str]) -> DataFrame:
    """Per (key, window) the record with the lowest ``value``; the earlier one on a tie."""
    rec = F.struct(*[F.col(c) for c in cols])
    best = (df.groupBy(key, F.window(time, size))
            .agg(F.min_by(rec, F.struct(F.col(value), F.col(seq))).alias("_best")))
    return best.select(*[F.col("_best")[c].alias(c) for c in cols])


def window_count(df: DataFrame, key: str, time: str, size: str) -> DataFrame:
    """Accumulator count per (key, window): partial counts merge, like the reference's
    create / add / merge / getResult accumulator."""
    return window_sum(df, key, time, size, out="cnt")
