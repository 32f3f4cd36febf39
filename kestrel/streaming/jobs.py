"""Streaming forms of the jobs (Structured Streaming).

Contract: run to the end of the input, a streaming job emits the same rows as its
batch form, for windows the watermark has closed (append mode emits a window once,
when ``watermark > window end``). Event time must be TIMESTAMP here (readers cast it).

What Spark runs natively is used as is: windowed and session aggregates with a
watermark, stream-stream joins bounded by a window key. What it refuses (row_number,
aggregate of an aggregate, exact distinct counts) uses ``foreachBatch`` or the
stateful processors in ``kestrel.streaming.stateful``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel.operators import windows
from kestrel.streaming import stateful
from kestrel.streaming.keys import KEY, process, with_key

# The reference's bounded out-of-orderness for every auction job.
DEFAULT_DELAY = "4 seconds"


def watermarked(df: DataFrame, time: str, delay: str = DEFAULT_DELAY) -> DataFrame:
    return df.withWatermark(time, delay)


def tumble_count(stream: DataFrame, key: str, time: str, size: str, delay: str = DEFAULT_DELAY,
                 out_key: str = "bidder") -> DataFrame:
    return windows.tumble_count(watermarked(stream, time, delay), key, time, size, out_key)


def window_sum(stream: DataFrame, key: str, time: str, size: str, slide: str | None = None,
               delay: str = DEFAULT_DELAY) -> DataFrame:
    return windows.window_sum(watermarked(stream, time, delay), key, time, size, slide)


def session_count(stream: DataFrame, key: str, time: str, gap: str, delay: str = DEFAULT_DELAY,
                  out_key: str = "bidder") -> DataFrame:
    """Session windows in append mode (update mode is refused for sessions)."""
    return windows.session_count_single(watermarked(stream, time, delay), key, time, gap, out_key)


def window_join(orders: DataFrame, goods: DataFrame, size: str, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Stream-stream inner join on (goodsId, window): both sides watermarked, so the state
    of a window is dropped once the watermark passes it."""
    from kestrel.operators import joins

    return joins.window_join(watermarked(orders, "ts", delay), watermarked(goods, "ts", delay), size)


def sellers_within(auctions: DataFrame, persons: DataFrame, within: str, delay: str = DEFAULT_DELAY, **options) -> DataFrame:
    """q3 on two streams with bounded state: a row is kept until the watermark is ``within`` past it. The
    same rows as ``joins.join_equi(..., within=within)``; without the bound both inputs are kept for good."""
    from kestrel.operators import joins

    return joins.join_equi(watermarked(auctions, "dateTime", delay), watermarked(persons, "dateTime", delay),
                           within=within, **options)


def expanded_within(bids: DataFrame, auctions: DataFrame, within: str, delay: str = DEFAULT_DELAY, **options) -> DataFrame:
    """q20 on two streams with bounded state, as ``sellers_within``."""
    from kestrel.operators import joins

    return joins.join_expand(watermarked(bids, "dateTime", delay), watermarked(auctions, "dateTime", delay),
                             within=within, **options)


def max_per_window(stream: DataFrame, time: str, price: str, size: str, size_seconds: int,
                   delay: str = DEFAULT_DELAY) -> DataFrame:
    """q7 on a stream: rows joined to the maximum of a tumbling window of the same stream
    (append mode: the maximum is emitted when the window closes; the range condition on
    the row time bounds the join state)."""
    from kestrel.functions import scalar as S

    w = watermarked(stream, time, delay)
    maxes = (w.groupBy(F.window(time, size)).agg(F.max(price).alias("maxprice"))
             .select(F.col("window.start").alias("m_start"), "maxprice", S.rowtime("window.end").alias("rowtime")))
    lower = F.timestamp_add("SECOND", F.lit(-size_seconds), F.col("rowtime"))
    j = w.join(maxes, (w[price] == maxes.maxprice) & F.col(time).between(lower, F.col("rowtime")))
    return j.drop("m_start", "maxprice", "rowtime")


def new_users(persons: DataFrame, auctions: DataFrame, size: str, delay: str = DEFAULT_DELAY) -> DataFrame:
    """q8 on two streams: per tumbling window, the distinct persons and distinct sellers
    (windowed aggregates, emitted when the window closes), joined on id and window."""
    p = (watermarked(persons, "dateTime", delay).groupBy("id", "name", F.window("dateTime", size))
         .agg(F.count(F.lit(1)).alias("_n")))
    a = (watermarked(auctions, "dateTime", delay).groupBy("seller", F.window("dateTime", size).alias("a_window"))
         .agg(F.count(F.lit(1)).alias("_m")))
    j = p.join(a, (p.id == a.seller) & (p.window == a.a_window))
    return j.select("id", "name", F.col("window.start").alias("stime"))


def hot_item_counts(stream: DataFrame, key: str, time: str, size: str, slide: str,
                    delay: str = DEFAULT_DELAY, out_key: str = "auction") -> DataFrame:
    """q5, first half: windowed counts in append mode. A window is emitted once the
    watermark passes its end, and all keys of a window share that end, so every count
    of a window arrives in the same micro-batch."""
    return (watermarked(stream, time, delay).groupBy(F.col(key).alias(out_key), F.window(time, size, slide))
            .agg(F.count(F.lit(1)).alias("num")))


def hot_items_batches(sink, out_key: str = "auction"):
    """q5, second half, per micro-batch of closed-window counts: keep the window maxima.
    (A stream self-join of the two aggregates is accepted by Spark but needs the
    watermark to travel through three stateful operators; this needs none.)"""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(windows.top_per_window(batch, out_key), batch_id)
    return run


def auction_daily(bids: DataFrame) -> DataFrame:
    """q17 on a stream, output mode Update: the latest row of each (auction, day) is its
    answer (an unwindowed aggregate emits a change stream, as in the reference)."""
    from kestrel.operators import aggs

    return aggs.auction_daily(bids)


def band_stats_batches(store: str, keys: list[str], sink, with_minute: bool = False):
    """q15 (``keys=[]``) / q16 (``keys=["channel"]``) on a stream via ``foreachBatch``;
    exact distinct counts are refused by streaming aggregation.

    Log-structured and idempotent: batch ``id`` writes its partials (one row per keys, day,
    bidder or auction) under ``store/batch=<id>/_month=...``; a retried batch rewrites the
    same folder. Then only the days the batch touched are recomputed from all batches'
    partials (month folders prune the reads), and their rows are emitted: the latest row of a
    (keys, day) is its answer. NULL keys, days and values count as in the batch form.
    """
    from kestrel.operators import aggs

    group = [*keys, "_date"]
    latest = {"_mod": F.hour("dateTime") * 60 + F.minute("dateTime")} if with_minute else {}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = aggs._with_date(batch).withColumn("_month", F.coalesce(F.date_format("_date", "yyyy-MM"), F.lit("none")))
        own = f"{store}/batch={batch_id}"
        aggs.band_partials(b, ["_month", *group], latest).write.mode("overwrite").partitionBy("_month").parquet(own)
        days = spark.read.parquet(own).select(F.col("_month").alias("_m"), F.col("_date").alias("_d")).distinct()
        past = spark.read.parquet(store)
        hist = past.join(days, (past["_month"] == days["_m"]) & past["_date"].eqNullSafe(days["_d"]), "left_semi")
        res = aggs.band_totals(aggs.merged_partials(hist, group, list(latest)), group, list(latest))
        if with_minute:
            res = res.withColumn("minute", aggs.clock(F.col("_mod"))).drop("_mod")
        sink(aggs._day_first(res, keys), batch_id)
    return run


def fraud_alerts(txn: DataFrame, small: float, large: float, timeout_seconds: int | None = None,
                 delay: str = "0 seconds") -> DataFrame:
    """Fraud v2 / v3 as a keyed stateful processor (previous row per account, cleared by an
    event-time timer once it can no longer raise an alert)."""
    proc = stateful.FlagProcessor(small, large, timeout_seconds)
    return process(watermarked(txn, "ts", delay), ["account_id"], proc, stateful.FLAG_OUTPUT, "Append",
                   "EventTime" if timeout_seconds else "None").withColumnRenamed("account_id", "id")


def count_tumble(cars: DataFrame, key: str, size: int, ttl_ms: int | None = None) -> DataFrame:
    """Count window per key as a stateful processor: emits every ``size``-th row's sum. With ``ttl_ms`` an
    open window without a new row for so long (processing time) is forgotten."""
    proc = stateful.CountWindowProcessor(size, ttl_ms)
    return process(cars, [key], proc, stateful.COUNT_OUTPUT, "Append", "ProcessingTime" if ttl_ms else "None")


def running_sum(scores: DataFrame, key: str, seq: str, value: str, keep: list[str], scale: int = 2) -> DataFrame:
    """Keyed running sum as a stateful processor (Append: one row per input row)."""
    out = T.StructType([*[T.StructField(c, T.LongType()) for c in keep], T.StructField(value, T.DoubleType()),
                        T.StructField(f"row_{seq}", T.LongType())])
    found = process(scores, [key], stateful.RunningSumProcessor(seq, value, keep, scale), out)
    return found.select(*keep, key, value, f"row_{seq}")


def count_slide(cars: DataFrame, key: str, seq: str, value: str, size: int, slide: int) -> DataFrame:
    """Sliding count window per key as a stateful processor."""
    out = T.StructType([T.StructField(value, T.LongType()), T.StructField("end_position", T.LongType())])
    return process(cars, [key], stateful.SlidingCountProcessor(size, slide, seq, value), out)


def with_ingest_time(df: DataFrame, col: str = "p_time") -> DataFrame:
    """Processing time as a column (``PROCTIME()``): constant within a micro-batch."""
    return df.withColumn(col, F.current_timestamp())


def per_event_watermark(df: DataFrame, col: str = "p_time") -> DataFrame:
    """Watermark that follows the wall clock per batch (ingest time, no delay)."""
    return with_ingest_time(df, col).withWatermark(col, "0 seconds")


def top_k(bids: DataFrame, keys: list[str], k: int, order: list[str], ascending: list[bool],
          state_schema: str, rank_col: str | None = "rank_number", ttl_ms: int | None = None) -> DataFrame:
    """Stateful top-k per key (row_number is refused on streams). Output mode Update. With ``ttl_ms`` a list
    that did not change for so long (processing time) is forgotten, which bounds the state by the keys
    active in that time; a later row of the key starts a new list."""
    cols = [f.name for f in bids.schema.fields]
    out = T.StructType(bids.schema.fields + ([T.StructField(rank_col, T.LongType())] if rank_col else []))
    proc = stateful.TopKProcessor(k, cols, order, ascending, state_schema, rank_col, ttl_ms)
    return with_key(bids, keys).groupBy(KEY).transformWithStateInPandas(proc, out, "Update", "ProcessingTime" if ttl_ms else "None")


def two_step_pattern(items: DataFrame, rules: list[tuple[str, str]], key: str, seq: str, shape: str) -> DataFrame:
    """Stateful pattern matcher for a fixed rule list (named ``Rule_0``...)."""
    named = [(f"Rule_{i}", a, b) for i, (a, b) in enumerate(rules)]
    out = T.StructType([T.StructField("rule", T.StringType()), T.StructField("first_seq", T.LongType()),
                        T.StructField("second_seq", T.LongType())])
    found = process(items.select(key, seq, shape), [key], stateful.PatternProcessor(named, shape, seq), out)
    return found.select("rule", key, "first_seq", "second_seq")


def live_pattern(items: DataFrame, rules: DataFrame, key: str, seq: str, shape: str, time: str = "ts",
                 delay: str = DEFAULT_DELAY, slots: int = 64) -> DataFrame:
    """Two-step pattern under rules that change while the job runs (``state.pattern_as_of`` on streams).

    ``rules`` is a stream (rule, first, second, ts): a row replaces the rule of that name from its time
    on, and a NULL ``first`` removes it. Items and rules are one tagged input, cut into ``slots`` by the
    items' key; each slot gets every rule. Rows wait in state until the watermark has passed them, so
    they are handled in event time whatever the batch cuts, and rules may come late by ``delay``.
    """
    text = lambda c: F.col(c).cast("string")  # noqa: E731  exact in pandas next to the rules' NULLs
    x = watermarked(items.where(F.col(time).isNotNull() & F.col(seq).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot"), F.col(time).alias("ts"), text(key).alias("key"),
        text(seq).alias("seq"), F.col(shape).alias("shape"), *[F.lit(None).cast("string").alias(c) for c in ("rule", "first", "second")]),
        "ts", delay)
    r = watermarked(rules.where(F.col("ts").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.col("ts"),
        *[F.lit(None).cast("string").alias(c) for c in ("key", "seq", "shape")], "rule", "first", "second"), "ts", delay)
    out = T.StructType([T.StructField("rule", T.StringType()), T.StructField("key", T.StringType()),
                        T.StructField("first_seq", T.LongType()), T.StructField("second_seq", T.LongType())])
    found = x.unionByName(r).groupBy("slot").transformWithStateInPandas(stateful.LivePatternProcessor(out.names), out, "Append", "EventTime")
    return found.select("rule", F.col("key").cast(items.schema[key].dataType).alias(key), "first_seq", "second_seq")


def punctuated_late_batches(store: str, seq: str, time: str, id_col: str, marker, delay_seconds: int, sink):
    """``foreachBatch`` form of the punctuated watermark: late rows of each batch, with
    the watermark carried between batches in a one-row table under ``store`` (written
    per batch id, so a retried batch reads the same starting value)."""
    from kestrel.operators import prefix as P

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = None
        if batch_id > 0:
            start = spark.read.parquet(f"{store}/b={batch_id - 1}").first()["watermark"]
        mark = F.when(F.col(id_col) == marker, F.timestamp_add("SECOND", F.lit(-delay_seconds), F.col(time)))
        x = P.prefix(batch, [], [seq], mark, "max", "watermark", False)
        if start is not None:
            x = x.withColumn("watermark", F.greatest(F.col("watermark"), F.lit(start)))
        late = x.where(F.col(time) <= F.col("watermark"))
        sink(late, batch_id)
        end = batch.agg(F.max(mark).alias("m")).first()["m"]
        wm = max([v for v in (start, end) if v is not None], default=None)
        spark.createDataFrame([(wm,)], f"watermark {batch.schema[time].dataType.simpleString()}") \
            .coalesce(1).write.mode("overwrite").parquet(f"{store}/b={batch_id}")
    return run


OPEN_WINDOW = "rows long, total long, windows long"


def count_global_batches(store: str, key: str, seq: str, value: str, size: int, sink):
    """``foreachBatch`` form of ``counts.count_global``: every ``size`` rows over all keys.

    What a micro-batch leaves open (rows, sum, key of the first row, windows closed so far) is carried
    as one row under ``store/b=<id>``; the next batch numbers its rows on from there with the range-cut
    scan, so no task holds the whole order. A retried batch starts from the same row and rewrites its
    own. ``seq`` orders rows within and across batches.
    """
    from kestrel.operators import prefix as P

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, kind = batch.sparkSession, batch.schema[key].dataType.simpleString()
        schema = f"{OPEN_WINDOW}, first {kind}"
        old = (0, 0, 0, None) if batch_id == 0 else tuple(spark.read.schema(schema).parquet(f"{store}/b={batch_id - 1}").first())
        rows, total, windows_so_far, first = old
        r = P.rank(batch.select(key, seq, value), [], [seq], "rn")
        g = r.withColumn("_grp", F.floor((F.col("rn") - 1 + rows) / size))
        sums = g.groupBy("_grp").agg(F.min_by(key, seq).alias(key), F.sum(value).cast("long").alias(value), F.count(F.lit(1)).alias("_n"))
        carried = F.col("_grp") == 0  # the window left open by the batch before
        sums = sums.select(
            "_grp", F.when(carried & F.lit(rows > 0), F.lit(first).cast(kind)).otherwise(F.col(key)).alias(key),
            (F.coalesce(value, F.lit(0)) + F.when(carried, F.lit(total)).otherwise(F.lit(0))).alias(value),
            (F.col("_n") + F.when(carried, F.lit(rows)).otherwise(F.lit(0))).alias("_n")).persist()
        sink(sums.where(F.col("_n") == size).select(key, value, (F.col("_grp") + 1 + windows_so_far).alias("window_no")), batch_id)
        done = sums.where(F.col("_n") == size).count()
        rest = sums.where(F.col("_n") < size).select("_n", value, key).first()  # at most one window is open
        if rest is not None:
            left = (rest["_n"], rest[value], windows_so_far + done, rest[key])
        else:
            left = (0, 0, windows_so_far + done, None) if done else old
        sums.unpersist()
        spark.createDataFrame([left], schema).coalesce(1).write.mode("overwrite").parquet(f"{store}/b={batch_id}")
    return run


def _pending(spark, batch: DataFrame, store: str, batch_id: int, cols: list[str]) -> DataFrame:
    """The batch's bids and those of earlier batches that still wait for their auction.

    The waiting bids of batch n are the table ``store/pending/batch=<n>``; each batch reads
    exactly the one before it, so a retried batch starts from the same rows.
    """
    new = batch.select(*cols)
    return new if batch_id == 0 else spark.read.parquet(f"{store}/pending/batch={batch_id - 1}").unionByName(new)


def _keep_waiting(bids: DataFrame, auctions: DataFrame, store: str, batch_id: int, wait: str | None) -> None:
    """Bids without an auction so far wait: for good, or up to ``wait`` behind the newest bid time (bounds
    the store; a bid whose auction comes later than that is lost)."""
    newest = bids.agg(F.max("dateTime").alias("t")).first()["t"] if wait else None
    waiting = bids.join(auctions.select(F.col("id").alias("_known")).distinct(), F.col("auction") == F.col("_known"), "left_anti")
    if newest is not None:
        waiting = waiting.where(F.col("dateTime") >= F.lit(newest) - F.expr(f"INTERVAL {wait}"))
    waiting.write.mode("overwrite").parquet(f"{store}/pending/batch={batch_id}")


def avg_of_max_batches(load_auctions, store: str, sink, wait: str | None = None):
    """``foreachBatch`` form of q4 (an aggregate of an aggregate is refused on streams):
    per batch, join the new and the waiting bids to the auctions known by now, write the
    batch's per-auction maxima under ``store/maxima/batch=<id>`` (idempotent on retry), and
    recompute the averages of the categories the batch touched from all partials. A bid may
    come before its auction: it waits, with ``wait`` at most so far behind the newest bid."""
    from kestrel.functions import scalar as S

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, a = batch.sparkSession, load_auctions()
        bids = _pending(spark, batch, store, batch_id, ["auction", "price", "dateTime"]).persist()
        j = a.join(bids.withColumnRenamed("dateTime", "bid_dateTime"),
                   (a.id == F.col("auction")) & F.col("bid_dateTime").between(a.dateTime, a.expires))
        part = j.groupBy("id", "category").agg(F.max("price").alias("final"))
        part.write.mode("overwrite").parquet(f"{store}/maxima/batch={batch_id}")
        _keep_waiting(bids, a, store, batch_id, wait)
        bids.unpersist()
        touched = spark.read.parquet(f"{store}/maxima/batch={batch_id}").select(F.col("category").alias("_c")).distinct()
        past = spark.read.parquet(f"{store}/maxima")
        maxima = (past.join(touched, past["category"].eqNullSafe(touched["_c"]), "left_semi")
                  .groupBy("id", "category").agg(F.max("final").alias("final")))
        sink(maxima.groupBy("category").agg(S.int_avg("final").alias("final"))
             .select(F.col("category").alias("id"), "final"), batch_id)
    return run


def winning_bids_batches(load_auctions, store: str, sink, wait: str | None = None):
    """``foreachBatch`` form of q9 (row_number is refused on streams): the batch's and the
    waiting bids are interval-joined to the auctions known by now, the best bid per auction is
    written under ``store/best/batch=<id>`` (idempotent), and the auctions the batch touched are
    re-decided from all batches' bests (semi-join on their ids). A bid that comes before its
    auction waits, with ``wait`` at most so far behind the newest bid."""
    from kestrel.operators import joins, topk

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, a = batch.sparkSession, load_auctions()
        bids = _pending(spark, batch, store, batch_id, topk.BID_COLUMNS).persist()
        best = topk.top1(joins.interval_join(a, bids), ["id"], topk.winning_order(), topk.WINNER_COLUMNS, "aggregate")
        best.write.mode("overwrite").parquet(f"{store}/best/batch={batch_id}")
        _keep_waiting(bids, a, store, batch_id, wait)
        bids.unpersist()
        touched = spark.read.parquet(f"{store}/best/batch={batch_id}").select("id").distinct()
        hist = spark.read.parquet(f"{store}/best").drop("batch").join(touched, "id", "left_semi")
        sink(topk.top1(hist, ["id"], topk.winning_order(), topk.WINNER_COLUMNS, "aggregate"), batch_id)
    return run


def keyed_upsert_batches(store: str, key: str, seq: str, cols: list[str]):
    """``foreachBatch`` keyed upsert: each batch writes snapshot version ``batch_id``."""
    from kestrel.sources import sinks

    def run(batch: DataFrame, batch_id: int) -> None:
        sinks.upsert_snapshot(batch.sparkSession, batch, store, key, seq, cols, batch_id)
    return run


def keyed_log_batches(store: str, key: str, seq: str, cols: list[str], fanout: int = 4):
    """``foreachBatch`` keyed upsert into a log of runs: a batch writes its own rows and now and then a
    merge, not the whole table (``sources.keyed_log``). Version ``batch_id`` is written once, also on retry."""
    from kestrel.sources.keyed_log import KeyedLog

    def run(batch: DataFrame, batch_id: int) -> None:
        KeyedLog(batch.sparkSession, store, key, seq, cols, fanout).write(batch, batch_id)
    return run


def rule_batches(apply, load_rules, sink):
    """``foreachBatch`` form of the rule jobs (``rules.latest_rule_filter``,
    ``rules.rules_for_each``): the rule history is re-read for every micro-batch (it is
    small and changes over time) and applied as of each row's event time."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(apply(batch, load_rules()), batch_id)
    return run


def snapshot_enrich_batches(load_dim, sink):
    """``foreachBatch`` form of snapshot enrichment: the dimension is re-read for every
    micro-batch (the reference polls its table every 5 s) and joined as of event time."""
    from kestrel.operators import rules

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(rules.snapshot_enrich(batch, load_dim()), batch_id)
    return run


def snapshot_store_batches(store: str):
    """``foreachBatch`` sink of ``sources.snapshots``: keeps each polled snapshot under ``store/version=<v>``.
    A retried batch rewrites the same versions."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(store))
    return run


def stored_snapshots(spark, store: str, schema: str) -> DataFrame:
    """All snapshots kept so far, with their ``version`` (the dimension of ``joins.as_of_enrich``)."""
    return spark.read.schema(f"{schema}, version long").parquet(store)


def run_available(df: DataFrame, checkpoint: str, sink_path: str, mode: str = "append",
                  fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now, with offsets and state in ``checkpoint``, into
    files at ``sink_path`` (exactly-once file sink). Blocks until done."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .option("path", sink_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def start(df: DataFrame, checkpoint: str, sink_path: str, interval: str = "30 seconds",
          mode: str = "append", fmt: str = "parquet") -> StreamingQuery:
    """Run continuously: one micro-batch (and one checkpoint of offsets and state) every
    ``interval`` (the reference checkpoints every 30 s, exactly once). Returns the query."""
    return (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
            .option("path", sink_path).trigger(processingTime=interval).start())


def run_batches(df: DataFrame, checkpoint: str, fn) -> StreamingQuery:
    """Process everything available now through ``foreachBatch(fn)``."""
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
