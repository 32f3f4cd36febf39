"""Sinks: discard, print, JDBC append, text append partitioned by date, nested JSON,
keyed upsert snapshots and partitioned catalog tables. Batch writers take a DataFrame, so
they serve as ``foreachBatch`` functions too (exactly-once per batch id where the writer
is idempotent: snapshot versions are named by batch id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discard(df: DataFrame) -> None:
    """Run the plan, write nothing (the reference's blackhole connector)."""
    df.write.format("noop").mode("overwrite").save()


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append rows in batches over JDBC (the reference commits one row at a time)."""
    df.write.jdbc(url, table, mode="append", properties=properties or {})


def text_append(df: DataFrame, path: str, value: str, time: str, fmt: str = "yyyy-MM-dd") -> None:
    """Append ``value`` as text lines into one folder per formatted date of ``time``."""
    (df.select(F.col(value).cast("string").alias("value"), F.date_format(time, fmt).alias("dt"))
     .write.mode("append").partitionBy("dt").text(path))


def json_nested(df: DataFrame, path: str, key: str, fields: list[str]) -> None:
    """(rowkey STRING, info STRUCT<fields>) rows as JSON files."""
    (df.select(F.col(key).cast("string").alias("rowkey"), F.struct(*fields).alias("info"))
     .write.mode("append").json(path))


def latest_per_key(df: DataFrame, key: str, seq: str, cols: list[str]) -> DataFrame:
    """Last write per key wins: the newest row (by ``seq``) of each key. Partial aggregate."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("_v"))
    return best.select(key, *[F.col("_v")[c].alias(c) for c in cols])


def upsert_snapshot(spark: SparkSession, updates: DataFrame, path: str, key: str, seq: str,
                    cols: list[str], version: int, first_version: int = 0) -> DataFrame:
    """Merge ``updates`` into the keyed snapshot at ``path`` and write it as version
    ``version`` (``path/v=<version>``): keys not updated keep their row, updated keys
    take their newest update. Returns the new snapshot. Re-running a version rewrites
    the same files, so a retried micro-batch is harmless.

    Version ``first_version`` starts the snapshot; every later one reads exactly the version
    before it and fails if that cannot be read, so no earlier row is forgotten. A NULL key
    is a key like any other."""
    if version < first_version:
        raise ValueError(f"version {version} is before the first version {first_version}")
    fresh = latest_per_key(updates, key, seq, [*cols, seq])
    if version > first_version:
        old = spark.read.parquet(f"{path}/v={version - 1}")
        updated = fresh.select(F.col(key).alias("_updated"))
        fresh = old.join(updated, old[key].eqNullSafe(F.col("_updated")), "left_anti").unionByName(fresh)
    fresh.write.mode("overwrite").parquet(f"{path}/v={version}")
    return spark.read.parquet(f"{path}/v={version}")


def partitioned_table(spark: SparkSession, df: DataFrame, table: str, partition: str, value: str,
                      location: str | None = None) -> None:
    """Create a parquet table partitioned by ``partition`` (if absent) and insert ``df``
    into the static partition ``partition = value``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, `{partition}` STRING) USING parquet "
              f"PARTITIONED BY (`{partition}`){loc}")
    view = f"_insert_{table.replace('.', '_')}"
    df.createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {table} PARTITION (`{partition}` = '{value}') SELECT * FROM {view}")


def print_rows(df: DataFrame, n: int = 20) -> None:
    """Print rows (the reference's ``print()`` / alert sink) in batch."""
    df.show(n, truncate=False)


def console(stream: DataFrame, mode: str = "append"):
    """Streaming print sink: a ``DataStreamWriter`` on the console format."""
    return stream.writeStream.format("console").outputMode(mode).option("truncate", "false")


def text_stream(stream: DataFrame, value: str, time: str, fmt: str = "yyyy-MM-dd"):
    """Streaming text sink, one folder per formatted date (exactly-once file sink; give
    ``path`` and ``checkpointLocation`` to the returned writer)."""
    return (stream.select(F.col(value).cast("string").alias("value"), F.date_format(time, fmt).alias("dt"))
            .writeStream.format("text").partitionBy("dt").outputMode("append"))
