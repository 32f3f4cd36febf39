"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Every source is cut into blocks of ``block`` documents, in the order of a hash of ``doc_id``. A
source of weight w = q / Q gives its k-th block (from 0) the release time floor(k * Q / q) and the
deadline ceil((k + 1) * Q / q), in slots of one block. In each slot the released block with the
earliest deadline is taken, so after any number of slots a source has had its share of them to
within less than one block.

The weights are whole numbers of slots per period (``resolution`` slots, at least one a source),
so all windows meet at the end of each period and the schedule repeats: one period is scheduled
by earliest deadline first, and the slot of any block follows from its number. Nothing grows with
the documents but the documents. The period has one row per slot and is broadcast; its size is set
by ``resolution`` and the number of sources alone.

Every row is placed once. When a source has no block left, its later slots stay empty and the
others go on in the same proportions. Without given weights a source's weight is its number of
rows to the power ``exponent``, which lifts small sources.

Defined results: a null ``source`` is a source of its own; a null ``doc_id`` is ordered as the
empty string; repeated rows are placed one after the other; sources without a given weight count
as weight one slot; an empty table gives no rows; other columns pass through ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table

BLOCK, RESOLUTION, EXPONENT = 32, 1000, 0.7
HASH_DIGITS = 3  # 16^3 buckets a source: row numbers need no task that holds a whole source


def _name() -> Column:
    return F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))


def slots_per_period(per_source: DataFrame, weights: dict[str | None, float] | None, resolution: int,
                     exponent: float) -> DataFrame:
    """(src, q): whole slots of a period for each source of (src, n)."""
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(exponent))
    else:
        total = float(sum(weights.values()))
        w = F.lit(0.0)
        for source, x in weights.items():
            name = "null" if source is None else f"={source}"
            w = F.when(F.col("src") == name, F.lit(x / total)).otherwise(w)
    share = per_source.select("src", w.alias("w"))
    total = F.sum("w").over(Window.partitionBy())
    return share.select("src", F.greatest(F.lit(1), F.round(resolution * F.col("w") / total)).cast("long").alias("q"))


def period(slots: DataFrame) -> DataFrame:
    """(src, nth, slot, q, period): the slot of each source's nth block of a period, earliest deadline first."""
    one = slots.agg(F.array_sort(F.collect_list(F.struct("src", "q"))).alias("s"), F.sum("q").alias("period"))
    # State: blocks done by source, and the sources picked so far. A block competes once released.
    picked = F.expr("""
      aggregate(
        sequence(0L, period - 1),
        named_struct('done', transform(s, x -> 0L), 'picks', array(named_struct('i', -1, 'k', -1L))),
        (acc, t) -> transform(
          array(array_min(transform(
            filter(sequence(0, size(s) - 1), i -> (acc.done[i] * period) div s[i].q <= t),
            i -> named_struct('due', ((acc.done[i] + 1) * period + s[i].q - 1) div s[i].q, 'i', i)))),
          best -> named_struct(
            'done', transform(acc.done, (v, i) -> if(i = best.i, v + 1L, v)),
            'picks', concat(acc.picks, array(named_struct('i', best.i, 'k', acc.done[best.i])))))[0],
        acc -> slice(acc.picks, 2, size(acc.picks)))""")
    return (one.where("period > 0").select("s", "period", F.posexplode(picked).alias("slot", "p"))
            .select(F.expr("s[p.i].src").alias("src"), F.col("p.k").alias("nth"), F.col("slot").cast("long").alias("slot"),
                    F.expr("s[p.i].q").alias("q"), "period"))


def scheduled(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK,
              resolution: int = RESOLUTION, exponent: float = EXPONENT) -> DataFrame:
    """The rows with _src, _block, _place, _slot, _release and _deadline. _slot and _place give the order."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = docs.withColumns({"_src": _name(), "_hash": digest, "_bucket": F.substring(digest, 1, HASH_DIGITS)})
    counts = materialize(keyed.groupBy("_src", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "mix-counts")
    plan = materialize(period(slots_per_period(
        counts.groupBy(F.col("_src").alias("src")).agg(F.sum("_n").alias("n")), weights, resolution, exponent)), "mix-period")
    earlier = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_src", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ties = [F.col(c) for c in ("doc_id", "text") if c in docs.columns]
    within = Window.partitionBy("_src", "_bucket").orderBy("_hash", *ties)
    numbered = (keyed.withColumn("_rn", F.row_number().over(within)).join(offsets, ["_src", "_bucket"])
                .withColumn("_seq", F.col("_before") + F.col("_rn") - 1))
    quota = plan.groupBy(F.col("src").alias("_quota_src")).agg(F.max("q").alias("_q"), F.max("period").alias("_period"))
    blocks = (numbered.join(F.broadcast(quota), F.col("_src") == F.col("_quota_src")).drop("_quota_src")
              .withColumns({"_block": F.expr(f"_seq div {block}"), "_place": F.expr(f"_seq % {block}")})
              .withColumn("_nth", F.expr("_block % _q")))
    slots = plan.select(F.col("src").alias("_at_src"), F.col("nth").alias("_at_nth"), F.col("slot").alias("_at"))
    return (blocks.join(F.broadcast(slots), (F.col("_src") == F.col("_at_src")) & (F.col("_nth") == F.col("_at_nth")))
            .withColumns({"_slot": F.expr("(_block div _q) * _period + _at"),
                          "_release": F.expr("(_block * _period) div _q"),
                          "_deadline": F.expr("((_block + 1) * _period + _q - 1) div _q")})
            .drop("_hash", "_bucket", "_before", "_rn", "_seq", "_q", "_period", "_nth", "_at_src", "_at_nth", "_at"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The same rows and columns, sorted in mixing order over all partitions."""
    return (scheduled(docs, **options).repartitionByRange("_slot", "_place").sortWithinPartitions("_slot", "_place")
            .select(*docs.columns))


def mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scheduled(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return out.select("doc_id", "source", *[F.col(f"_{c}").alias(c) for c in ("block", "place", "slot", "release", "deadline")])


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS src,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT src, power(CAST(count(*) AS DOUBLE), 0.7) AS w FROM d GROUP BY src),
s AS (SELECT src, CAST(greatest(1, round(1000 * w / sum(w) OVER ())) AS BIGINT) AS q,
             row_number() OVER (ORDER BY src) AS i FROM n),
p AS (SELECT list(q ORDER BY i) AS qs, CAST(sum(q) AS BIGINT) AS period FROM s),
run AS (
  SELECT CAST(-1 AS BIGINT) AS t, CAST(0 AS BIGINT) AS pick, CAST(0 AS BIGINT) AS nth, list_transform(qs, lambda q: CAST(0 AS BIGINT)) AS done, qs, period FROM p
  UNION ALL
  SELECT t + 1, pick2, done[pick2], list_transform(done, lambda v, i: CASE WHEN i = pick2 THEN v + 1 ELSE v END), qs, period
  FROM (SELECT *, list_min(list_transform(
                 list_filter(range(1, len(qs) + 1), lambda i: (done[i] * period) // qs[i] <= t + 1),
                 lambda i: (((done[i] + 1) * period + qs[i] - 1) // qs[i]) * 1000000 + i)) % 1000000 AS pick2
        FROM run WHERE t + 1 < period)),
r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY h, doc_id) - 1 AS seq FROM d),
b AS (SELECT r.*, s.q, s.i, p.period, seq // 32 AS block, seq % 32 AS place FROM r JOIN s USING (src), p)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(place AS BIGINT) AS place,
       CAST((block // q) * b.period + run.t AS BIGINT) AS slot, CAST((block * b.period) // q AS BIGINT) AS release,
       CAST(((block + 1) * b.period + q - 1) // q AS BIGINT) AS deadline
FROM b JOIN run ON run.pick = b.i AND run.nth = block % q AND run.t >= 0
"""

QUERIES = {"op4_pfair_mix": mix_query}
ORACLE = {"op4_pfair_mix": SQL}
