"""Sources: text lines, ``id,count`` CSV lines, in-memory rows, number ranges, and the
streaming readers of the same tables.

No socket is opened: text streams are directories of files read with ``readStream``.
Streaming readers cast event time to TIMESTAMP (watermarks refuse TIMESTAMP_NTZ);
the session time zone is UTC, so the instants are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_csv_lines(lines: DataFrame, names=("sensorId", "count"), types=("string", "int"),
                    col: str = "value") -> DataFrame:
    """``a,b`` text lines → typed columns. A bad number fails the job (ANSI cast), like the
    reference's ``parseInt``; fields past the last name are ignored."""
    parts = F.split(F.col(col), ",", -1)
    return lines.select(*[F.get(parts, i).cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Unparsed lines of the text files under ``path`` (column ``value``)."""
    return spark.read.text(path)


def values(spark: SparkSession, rows, schema) -> DataFrame:
    """In-memory rows with an explicit schema (closed fixtures, rule lists)."""
    return spark.createDataFrame(rows, schema)


def number_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Numbers ``first..last`` inclusive (column ``id``), generated in parallel."""
    return spark.range(first, last + 1)


# ---- streaming -------------------------------------------------------------------------

def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, time_cols=("ts",),
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet directory as a stream; ``time_cols`` cast to TIMESTAMP for watermarks."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    for c in time_cols:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def stream_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)


def stream_csv_lines(spark: SparkSession, path: str, names=("sensorId", "count"), types=("string", "int")):
    return parse_csv_lines(stream_text(spark, path), names, types)
