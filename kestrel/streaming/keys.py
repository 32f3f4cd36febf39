"""Grouping keys for ``transformWithStateInPandas`` that may be NULL.

PySpark hands rows of a NULL key to Python as NaN, which is equal to nothing: they come one by one and
end in the state of whatever key was handled before. So processors group by one text that is never
NULL, and the key's columns are restored from it, with their types, behind them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

KEY = "_key"


def with_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_key``: the key columns as JSON, NULLs included. Without keys it is one constant."""
    plain = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k"))
    return df.withColumn(KEY, F.to_json(plain, {"ignoreNullFields": "false"}))


def key_column(key: tuple, n: int) -> pd.Series:
    """``_key`` of ``n`` rows out (plain objects: pandas' own text type ends in chunks that Spark does not take)."""
    return pd.Series([key[0]] * n, dtype=object)


def restored(df: DataFrame, keys: list[T.StructField]) -> DataFrame:
    """The key columns in front, ``_key`` gone."""
    inner = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(keys)])
    rest = [F.col(c) for c in df.columns if c != KEY]
    if not keys:
        return df.select(*rest)
    x = df.withColumn(KEY, F.from_json(KEY, inner))
    return x.select(*[F.col(KEY)[f"k{i}"].alias(f.name) for i, f in enumerate(keys)], *rest)


def process(df: DataFrame, keys: list[str], processor: StatefulProcessor, out: T.StructType,
            mode: str = "Append", time_mode: str = "None", extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """``processor`` over the rows of each key, NULL keys included. It gets the key text (then ``extra_keys``,
    never NULL) and yields ``_key`` and the columns of ``out``; the result has the key columns and those."""
    schema = T.StructType([T.StructField(KEY, T.StringType()), *out.fields])
    x = with_key(df, keys).groupBy(KEY, *extra_keys).transformWithStateInPandas(processor, schema, mode, time_mode)
    return restored(x, [df.schema[k] for k in keys])
