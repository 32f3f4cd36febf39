"""A keyed table as a log of sorted runs, with levels, a manifest a version and pinned readers.

A micro-batch writes its own rows (the newest of each key, sorted by key) as a run of level 0. When a
level holds ``fanout`` runs, they are merged into one run of the next level, so a row is rewritten once
a level and a batch costs its own rows plus amortised merges, never the whole table.

A version is its manifest: one JSON file that lists the runs it consists of, newest first. Runs are
written before it and never changed, and the file appears by the rename of Spark's commit, so a crash
at any point leaves the version before it whole, and a retried version writes its runs again. A reader
holds the runs of one version; ``vacuum`` removes only runs that no kept version lists.

A later version wins over an earlier one, whatever the sequence numbers; within a version the newest
row by ``seq`` wins. A NULL key is a key like any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, run_no int, level int, path string, age long"
FANOUT = 4


class KeyedLog:
    """The keyed table under ``path``: rows (key, seq, *cols)."""

    def __init__(self, spark: SparkSession, path: str, key: str, seq: str, cols: list[str], fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.path, self.key, self.seq, self.cols, self.fanout = spark, path.rstrip("/"), key, seq, cols, fanout

    # -- versions -----------------------------------------------------------------------------

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _children(self, path: str) -> list[str]:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def has(self, version: int) -> bool:
        """Whether the version is committed: its manifest's success marker is there."""
        return self._exists(f"{self.path}/manifest/v={version}/_SUCCESS")

    def versions(self) -> list[int]:
        found = (int(name[2:]) for name in self._children(f"{self.path}/manifest") if name.startswith("v="))
        return sorted(v for v in found if self.has(v))

    def runs(self, version: int) -> list[dict]:
        """The runs of a version, newest first."""
        if not self.has(version):
            raise ValueError(f"version {version} of {self.path} is not committed")
        rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/v={version}").orderBy("run_no").collect()
        return [{"level": r["level"], "path": r["path"], "age": r["age"]} for r in rows if r["path"]]

    def _commit(self, version: int, runs: list[dict]) -> None:
        # A version without runs still has a manifest: one line without a path.
        rows = [(version, i, r["level"], r["path"], r["age"]) for i, r in enumerate(runs)] or [(version, 0, 0, None, 0)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v={version}")

    # -- rows ---------------------------------------------------------------------------------

    def _newest(self, df: DataFrame, order: list[str]) -> DataFrame:
        value = F.struct(*[F.col(c) for c in [self.seq, *self.cols]])
        best = df.groupBy(self.key).agg(F.max_by(value, F.struct(*order)).alias("_v"))
        return best.select(self.key, *[F.col("_v")[c].alias(c) for c in [self.seq, *self.cols]])

    def _write_run(self, df: DataFrame, name: str) -> str:
        path = f"{self.path}/runs/{name}-{uuid.uuid4().hex}"
        df.repartitionByRange(F.col(self.key).asc_nulls_first()).sortWithinPartitions(F.col(self.key).asc_nulls_first()).write.parquet(path)
        return path

    def _union(self, runs: list[dict]) -> DataFrame:
        """The runs' rows with the age of their run: the version that wrote its newest rows."""
        parts = [self.spark.read.parquet(r["path"]).withColumn("_age", F.lit(r["age"])) for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def write(self, updates: DataFrame, version: int, previous: int | None = None) -> int:
        """Adds ``updates`` as version ``version`` on top of ``previous`` (default: the version before it;
        the first version stands alone). A committed version is left as it is, so a retry changes nothing.
        """
        if self.has(version):
            return version
        if previous is None and version > 0:
            previous = version - 1
        runs = self.runs(previous) if previous is not None else []
        fresh = self._newest(updates.select(self.key, self.seq, *self.cols), [self.seq, *self.cols])
        runs = [{"level": 0, "path": self._write_run(fresh, f"v{version}-l0"), "age": version}, *runs]
        level = 0
        while sum(r["level"] == level for r in runs) >= self.fanout:
            runs = self._merge(runs, level, version)
            level += 1
        self._commit(version, runs)
        return version

    def _merge(self, runs: list[dict], level: int, version: int) -> list[dict]:
        """All runs of a level as one run of the next; it stands where the newest of them stood."""
        old = [r for r in runs if r["level"] == level]
        merged = self._newest(self._union(old), ["_age"])
        one = {"level": level + 1, "path": self._write_run(merged, f"v{version}-l{level + 1}"), "age": max(r["age"] for r in old)}
        return [r for r in runs if r["level"] < level] + [one] + [r for r in runs if r["level"] > level]

    def read(self, version: int | None = None) -> DataFrame:
        """The newest row of each key as of a version (default: the last committed one)."""
        if version is None:
            committed = self.versions()
            if not committed:
                raise ValueError(f"{self.path} has no committed version")
            version = committed[-1]
        runs = self.runs(version)
        rows = self._union(runs)
        if len(runs) == 1:  # a run holds each key once
            return rows.select(self.key, self.seq, *self.cols)
        return self._newest(rows, ["_age"])

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of some keys; sorted runs let the scan skip other key ranges where the plan can tell."""
        k = keys.select(F.col(keys.columns[0]).alias("_wanted")).distinct()
        rows = self.read(version)
        return rows.join(k, rows[self.key].eqNullSafe(k["_wanted"]), "left_semi")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes runs that none of the last ``keep`` versions lists, and older manifests. Returns the runs removed."""
        committed = self.versions()
        kept = committed[-keep:] if keep > 0 else committed
        listed = {r["path"].rsplit("/", 1)[1] for v in kept for r in self.runs(v)}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        gone = [name for name in self._children(f"{self.path}/runs") if name not in listed]
        for name in gone:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs/{name}")
            p.getFileSystem(conf).delete(p, True)
        for v in committed:
            if v not in kept:
                p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/v={v}")
                p.getFileSystem(conf).delete(p, True)
        return gone
