"""Ordered scans (rank, running sum / max, last or first value, previous row) that stay parallel.

A bare ``Window.partitionBy(key).orderBy(seq)`` puts every row of a key in one task; without a
key, every row of the table. The helpers here split such keys by *range of the order column*:

1. one aggregate over the key's hash and the order column gives bounds of equal depth (approximate
   quantiles) and the hot keys (frequent items of a bounded sketch: no count of all keys). It is the one
   job that runs when the DataFrame is built;
2. rows of hot keys (without keys: all rows) get the number of their range, other rows 0;
3. rows are shuffled once, on (key, range), and scanned by an ordinary window. Without a hot key that
   is all;
4. what each range of a hot key holds (total, last row, first row) is aggregated in a second read of
   hot rows only, carried over the key's ranges, and joined to the scanned rows where they already are.

All results of one ``scan`` share these steps. Rows of one key with one and the same value of the first
order column are not split.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BKT = "_bkt"
SKETCH_ITEMS = 8  # tracked keys for each range
_FIRST = -(1 << 63)

# How a scan combines rows within a range, the ranges before it, and both.
HOWS = ("sum", "max", "last", "first", "previous")


def default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(64, 4 * parts)


def order_value(df: DataFrame, col: str) -> Column:
    """A long that orders like ``col`` (timestamps become epoch microseconds); NULL comes first."""
    dtype = df.schema[col].dataType.typeName()
    v = F.unix_micros(F.col(col).cast("timestamp")) if dtype.startswith("timestamp") else F.col(col).cast("long")
    return F.coalesce(v, F.lit(_FIRST))


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return F.xxhash64(*[F.col(k) + 0.0 if kinds[k] in ("double", "float") else F.col(k) for k in keys])  # -0.0 is 0.0 to a window


def _cuts(df: DataFrame, keys: list[str], order_col: str, buckets: int) -> tuple[list[float], list[int]]:
    """The ranges' bounds and the hashes of hot keys, from one aggregate over two columns.

    Hot keys are the frequent items of a bounded sketch, which finds every key above total / buckets rows.
    """
    v = order_value(df, order_col)
    inner = [i / buckets for i in range(1, buckets)]
    quantiles = F.percentile_approx("v", inner or [0.5], max(10_000, 20 * buckets)).alias("q")
    if not keys:
        return sorted({float(x) for x in df.select(v.alias("v")).agg(quantiles).first()["q"] or []}), []
    frequent = F.expr(f"approx_top_k(h, {buckets}, {SKETCH_ITEMS * buckets})").alias("top")
    r = df.select(v.alias("v"), key_hash(df, keys).alias("h")).agg(quantiles, F.count(F.lit(1)).alias("n"), frequent).first()
    # A count is off by n / (0.75 SKETCH_ITEMS buckets) at most.
    hot = [x["item"] for x in r["top"] or [] if x["count"] * buckets > r["n"] * (1 - 2 / SKETCH_ITEMS)]
    return sorted({float(x) for x in r["q"] or []}), hot


def with_ranges(df: DataFrame, keys: list[str], order_cols: list[str], buckets: int | None = None) -> tuple[DataFrame, bool]:
    """Adds ``_bkt``, the number of the row's range, and ``_edge``: its key is in several ranges. And: is any key."""
    bounds, hot = _cuts(df, keys, order_cols[0], buckets or default_buckets(df))
    if not bounds or keys and not hot:
        return df.withColumns({BKT: F.lit(0).cast("long"), "_edge": F.lit(False)}), False
    # A row's range is found by binary search in the JVM; NULL order values come first.
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_order", outputCol="_range")
    ranged = cut.transform(df.withColumn("_order", order_value(df, order_cols[0]).cast("double")))
    edge = key_hash(df, keys).isin(hot) if keys else F.lit(True)
    return ranged.withColumns({BKT: F.when(edge, F.col("_range")).otherwise(0).cast("long"), "_edge": edge}).drop("_order", "_range"), True


def with_bucket(df: DataFrame, order_col: str, buckets: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """Adds ``_bkt``: the range of ``order_col`` for rows of hot keys (of all rows without keys), else 0."""
    return with_ranges(df, keys or [], [order_col], buckets)[0].drop("_edge")


def scan(df: DataFrame, keys: list[str], order_cols: list[str], outs: dict[str, tuple[Column, str]],
         inclusive: bool = True, buckets: int | None = None) -> DataFrame:
    """Adds columns ``outs`` (name: (value, how)) over the rows of each key in ``order_cols`` order.

    ``sum`` and ``max`` run over the rows so far; ``last`` and ``first`` are the last / first value so
    far that is not NULL; ``previous`` is the value of the row before. ``inclusive`` counts the current
    row in (``previous`` never does). Without earlier rows a sum is 0 and the others are NULL.
    ``order_cols`` must give a total order within each key; the first one (a number or a time) cuts
    the ranges. All outs together take one shuffle of the rows.
    """
    order = [F.col(c) for c in order_cols]
    values = {f"_v{i}": value for i, (value, _) in enumerate(outs.values())}
    how = {f"_v{i}": h for i, (_, h) in enumerate(outs.values())}
    b, split = with_ranges(df.withColumns(values), keys, order_cols, buckets)

    w = Window.partitionBy(*keys, BKT).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    inner = {
        "sum": lambda c: F.sum(c).over(so_far), "max": lambda c: F.max(c).over(so_far),
        "last": lambda c: F.last(c, True).over(so_far), "first": lambda c: F.first(c, True).over(so_far),
        "previous": lambda c: F.lag(F.struct(c)).over(w),
    }
    scanned = b.drop("_edge").withColumns({f"{c}i": inner[h](c) for c, h in how.items()})
    rest = [F.col(c) for c in df.columns if c not in outs]
    if not split:
        alone = {"sum": lambda c: F.coalesce(f"{c}i", F.lit(0)), "previous": lambda c: F.col(f"{c}i")[c]}
        return scanned.select(*rest, *[alone.get(h, lambda c: F.col(f"{c}i"))(c).alias(name) for name, (c, h) in zip(outs, how.items())])

    # What each range of a split key holds, then what all its earlier ranges hold.
    seat = F.struct(*order)
    whole = {
        "sum": lambda c: F.sum(c), "max": lambda c: F.max(c),
        "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), seat)),
        "first": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), seat)),
        "previous": lambda c: F.max_by(F.struct(c), seat),
    }
    ranges = b.where("_edge").groupBy(*keys, BKT).agg(*[whole[h](c).alias(c) for c, h in how.items()])
    wr = Window.partitionBy(*keys).orderBy(BKT)
    earlier = wr.rowsBetween(Window.unboundedPreceding, -1)
    before = {
        "sum": lambda c: F.sum(c).over(earlier), "max": lambda c: F.max(c).over(earlier),
        "last": lambda c: F.last(c, True).over(earlier), "first": lambda c: F.first(c, True).over(earlier),
        "previous": lambda c: F.lag(c).over(wr),
    }
    carried = ranges.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(BKT).alias("_kb"),
                            *[before[h](c).alias(f"{c}b") for c, h in how.items()])

    both = {
        "sum": lambda c: F.coalesce(f"{c}b", F.lit(0)) + F.coalesce(f"{c}i", F.lit(0)),
        "max": lambda c: F.greatest(f"{c}b", f"{c}i"),
        "last": lambda c: F.coalesce(f"{c}i", f"{c}b"), "first": lambda c: F.coalesce(f"{c}b", f"{c}i"),
        "previous": lambda c: F.coalesce(f"{c}i", f"{c}b")[c],
    }
    cond = [scanned[k].eqNullSafe(carried[f"_k{i}"]) for i, k in enumerate(keys)] + [scanned[BKT] == carried["_kb"]]
    j = scanned.join(carried, cond, "left")
    return j.select(*rest, *[both[h](c).alias(name) for name, (c, h) in zip(outs, how.items())])


def prefix(df: DataFrame, keys: list[str], order_cols: list[str], value: Column, how: str, out: str,
           inclusive: bool = True, buckets: int | None = None) -> DataFrame:
    """Running ``sum``, ``max``, ``last`` or ``first`` of ``value`` per key in ``order_cols`` order."""
    return scan(df, keys, order_cols, {out: (value, how)}, inclusive, buckets)


def rank(df: DataFrame, keys: list[str], order_cols: list[str], out: str = "rn",
         buckets: int | None = None) -> DataFrame:
    """1-based row number per key (global when ``keys`` is empty), computed in ranges."""
    return prefix(df, keys, order_cols, F.lit(1).cast("long"), "sum", out, True, buckets)


def previous(df: DataFrame, keys: list[str], order_cols: list[str], cols: list[str], prefix_name: str = "prev_",
             buckets: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` in the previous row of the same key (NULL for the first)."""
    return scan(df, keys, order_cols, {prefix_name + c: (F.col(c), "previous") for c in cols}, True, buckets)
