"""A polled dimension: a streaming source whose micro-batches are whole snapshots.

The reference polls its user table every few seconds and replaces its map with what it read. Here a
snapshot is a file ``<version>.<format>`` (versions are whole numbers, any gaps) that a writer puts into a
folder all executors share. ``readStream.format("kestrel_snapshots")`` has the versions as offsets: a
micro-batch holds the snapshots after the last offset, each whole and read once, with its version.
Offsets are in the query's checkpoint, so a restart goes on behind the last version.

``jobs.snapshot_store_batches`` keeps the snapshots by version; events are then enriched as of event time
(``joins.as_of_enrich``), whichever micro-batch brought a snapshot or an event.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "kestrel_snapshots"
ROWS_PER_PART = 1 << 16


class SnapshotPart(InputPartition):
    """Some row groups of one snapshot."""

    def __init__(self, path: str, version: int, groups: list[int]):
        self.path, self.version, self.groups = path, version, groups


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def snapshot_versions(path: str) -> dict[int, str]:
    """version -> file of the snapshots in a folder; other files are ignored."""
    fs, folder = _open(path)
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    names = {f.base_name: f.path for f in found if f.type == pafs.FileType.File}
    return {int(n[:-8]): p for n, p in names.items() if n.endswith(".parquet") and n[:-8].isdigit()}


class SnapshotStream(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.columns = schema.names

    def initialOffset(self) -> dict:
        return {"version": -1}

    def latestOffset(self) -> dict:
        known = snapshot_versions(self.path)
        return {"version": max(known, default=-1)}

    def partitions(self, start: dict, end: dict) -> list[SnapshotPart]:
        """Row groups of the snapshots with start < version <= end, several small ones in one part."""
        fs, _ = _open(self.path)
        parts = []
        for version, path in sorted(snapshot_versions(self.path).items()):
            if start["version"] < version <= end["version"]:
                meta = pq.read_metadata(path, filesystem=fs)
                groups, rows = [], 0
                for g in range(meta.num_row_groups):
                    groups.append(g)
                    rows += meta.row_group(g).num_rows
                    if rows >= ROWS_PER_PART:
                        parts.append(SnapshotPart(path, version, groups))
                        groups, rows = [], 0
                if groups:
                    parts.append(SnapshotPart(path, version, groups))
        return parts

    def read(self, part: SnapshotPart) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        columns = [c for c in self.columns if c != "version"]
        file = pq.ParquetFile(part.path, filesystem=fs)
        for batch in file.iter_batches(row_groups=part.groups, columns=columns):
            batch = batch.select(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part.version] * len(batch), pa.int64())], names=[*columns, "version"])

    def commit(self, end: dict) -> None:
        pass


class SnapshotSource(DataSource):
    """``readStream.format("kestrel_snapshots").schema(<columns>, version long).load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        raise ValueError("give the snapshot's columns and 'version long' as the schema")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if "version" not in schema.names:
            raise ValueError("the schema needs a column 'version long'")
        return SnapshotStream(schema, self.options)


def stream_snapshots(spark: SparkSession, folder: str, schema: str):
    """The snapshots of ``folder`` as a stream; ``schema`` (DDL) without the version, which is added."""
    spark.dataSource.register(SnapshotSource)
    return spark.readStream.format(NAME).schema(f"{schema}, version long").load(folder)
