"""Scalar functions of the auction queries, as native Spark expressions (no Python UDFs).

Each returns a Column so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dollar_to_euro(price) -> Column:
    """``0.908 * price`` as DECIMAL(23,3): decimal literal times BIGINT, never a double."""
    return (F.lit(0.908).cast("decimal(4,3)") * _c(price)).cast("decimal(23,3)")


def count_char(s, ch: str) -> Column:
    """Occurrences of one character in a string."""
    s = _c(s)
    return (F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))).cast("int")


def split_index(s, delim: str, index: int) -> Column:
    """0-based ``index``-th field of ``s`` split on the literal ``delim``; NULL when out of range.

    Empty fields are kept (limit -1). ``get`` returns NULL out of range, unlike ``[]``
    under ANSI mode.
    """
    import re

    return F.get(F.split(_c(s), re.escape(delim), -1), index)


def regexp_extract_or_null(s, pattern: str, group: int) -> Column:
    """``REGEXP_EXTRACT`` that is NULL when the pattern does not match.

    Spark returns '' on no match; a matched empty group must stay ''.
    """
    s = _c(s)
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, group))


def bid_time_type(ts) -> Column:
    """dayTime for hours 8..18, nightTime for <= 6 or >= 20, otherTime for 7 and 19."""
    h = F.hour(_c(ts))
    return (F.when((h >= 8) & (h <= 18), "dayTime")
            .when((h <= 6) | (h >= 20), "nightTime")
            .otherwise("otherTime"))


def cos_cbrt(v) -> Column:
    return F.cos(F.cbrt(_c(v)))


def rowtime(window_end) -> Column:
    """Row time of a window: end - 1 ms (``TUMBLE_ROWTIME``); not Spark's end - 1 us."""
    return F.timestamp_add("MILLISECOND", F.lit(-1), _c(window_end))


def day_string(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def minute_string(ts) -> Column:
    return F.date_format(_c(ts), "HH:mm")


def int_avg(col: str) -> Column:
    """Average of an integer column as BIGINT, truncated: ``sum div count`` (an integer
    average that stays integer, unlike Spark's ``avg`` which gives a double)."""
    return F.expr(f"sum(`{col}`) div count(`{col}`)")


def in_band(price, low=None, high=None) -> Column:
    """``low <= price < high`` with open ends when a bound is None."""
    p = _c(price)
    cond = F.lit(True)
    if low is not None:
        cond = cond & (p >= low)
    if high is not None:
        cond = cond & (p < high)
    return cond


def record_text(name: str, cols: list[str]) -> Column:
    """A record as text ``Name(a=1, b=x)`` (the object-to-string map of the join job)."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.lit(("" if i == 0 else ", ") + f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))]
    return F.concat(F.lit(f"{name}("), *parts, F.lit(")"))
