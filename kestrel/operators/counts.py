"""Count windows: every ``size`` rows of a key (tumbling), the last ``size`` rows every
``slide`` rows (sliding), and every ``size`` rows over all keys (global).

Row positions come from ``prefix.rank`` (range buckets, so neither a hot key nor the
keyless global order lands in one task). A window is then just a group of positions:
rows are assigned to the windows that contain them and summed with a partial
aggregate. An incomplete tumbling window never fires, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import prefix as P


def count_tumble(df: DataFrame, key: str, seq: str, value: str, size: int = 5,
                 buckets: int | None = None) -> DataFrame:
    """Sum of ``value`` over each complete group of ``size`` consecutive rows of a key."""
    r = P.rank(df, [key], [seq], "rn", buckets)
    g = r.withColumn("_grp", F.floor((F.col("rn") - 1) / size))
    out = (g.groupBy(key, "_grp")
           .agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("_n"), F.max(seq).alias("last_" + seq))
           .where(F.col("_n") == size))
    return out.select(key, F.col(value).cast("long").alias(value), "last_" + seq)


def count_slide(df: DataFrame, key: str, seq: str, value: str, size: int = 5, slide: int = 3,
                buckets: int | None = None) -> DataFrame:
    """Every ``slide``-th row of a key emits the sum of its last ``size`` rows (fewer at
    the start). Row ``j`` (1-based) belongs to the windows ending at ``e`` in
    ``[j, j + size - 1]`` with ``e % slide == 0`` and ``e`` not past the key's last row."""
    r = P.rank(df, [key], [seq], "rn", buckets)
    ends = F.filter(F.sequence(F.col("rn"), F.col("rn") + size - 1), lambda e: e % slide == 0)
    x = r.select(key, value, "rn", F.explode(ends).alias("_end"))
    sums = x.groupBy(key, "_end").agg(F.sum(value).cast("long").alias(value), F.max(F.col("rn") == F.col("_end")).alias("_ended"))
    return sums.where("_ended").select(key, value, F.col("_end").alias("end_position"))


def count_global(df: DataFrame, key: str, seq: str, value: str, size: int = 5,
                 buckets: int | None = None) -> DataFrame:
    """Every ``size`` rows over all keys: sum of ``value``; the key field is that of the
    group's first row (the reference's ``sum`` keeps the first record's other fields)."""
    r = P.rank(df, [], [seq], "rn", buckets)
    g = r.withColumn("_grp", F.floor((F.col("rn") - 1) / size))
    out = (g.groupBy("_grp")
           .agg(F.min_by(key, seq).alias(key), F.sum(value).alias(value), F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") == size))
    return out.select(key, F.col(value).cast("long").alias(value), (F.col("_grp") + 1).alias("window_no"))


def window_total(df: DataFrame, key: str, seq: str, value: str, size: int = 5) -> DataFrame:
    """Full-window function over count windows: the sum of ``value``, key dropped."""
    return count_tumble(df, key, seq, value, size).select(F.col(value).alias("total"))
