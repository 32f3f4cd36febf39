"""Readers for the parquet tables the jobs run on.

``table`` returns a lazy scan; Catalyst prunes columns and pushes filters into it, so
callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql`` users."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
