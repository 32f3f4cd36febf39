"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import shared_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` does the same on pure ASCII text and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """A key of a row's content, for joins back to rows whose id may be null or repeated."""
    return F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])))
