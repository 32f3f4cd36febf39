"""SQL surface: the scalar functions the reference's SQL calls by name, registered as
native SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``). Their bodies are
Catalyst expressions, inlined into the plan like any built-in: no Python runs.

``register_views`` exposes the entity views (``bid``, ``auction``, ``person``) so that
queries written as SQL text run unchanged with ``spark.sql``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    # occurrences of one character in a string
    "count_char": "(s STRING, c STRING) RETURNS INT "
                  "RETURN CAST(length(s) - length(replace(s, c, '')) AS INT)",
    # 0-based field of s split on the literal d; NULL out of range; empty fields kept
    "split_index": "(s STRING, d STRING, i INT) RETURNS STRING "
                   "RETURN get(split(s, concat('\\\\Q', d, '\\\\E'), -1), i)",
    # REGEXP_EXTRACT that is NULL when the pattern does not match ('' stays '')
    "regexp_extract_or_null": "(s STRING, p STRING, g INT) RETURNS STRING "
                              "RETURN CASE WHEN s RLIKE p THEN regexp_extract(s, p, g) END",
}


def register_functions(spark: SparkSession) -> None:
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views ``bid``, ``auction``, ``person`` over the derived entities."""
    from kestrel.sources import fixtures as X

    X.bids(spark, sf_dir).createOrReplaceTempView("bid")
    X.auctions(spark, sf_dir).createOrReplaceTempView("auction")
    X.persons(spark, sf_dir).createOrReplaceTempView("person")
