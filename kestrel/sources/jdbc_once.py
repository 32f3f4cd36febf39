"""Exactly-once JDBC append: a batch's rows and its entry in a ledger become visible in one transaction.

Tasks write to a staging table of the job, each under its partition and its attempt. Spark's JDBC writer
commits a task's rows at once, so an attempt that is in the staging table is there whole; a task that was
run twice (an executor lost after its commit) left two, and the smallest attempt of each partition counts.
The driver then publishes the batch by one transaction: the ledger's row, whose primary key refuses a
second time, and ``INSERT ... SELECT`` inside the database. No row passes through the driver.

A batch that ended before the transaction is staged again; one that ended after it is found in the ledger
and skipped. Batch ids are those of the query's checkpoint, so ``job`` names one checkpoint.

The database has to give transactions, and its tables must be reachable from every executor (an embedded
one is not, except in a local session). A NULL anywhere in the rows stays NULL; a batch without rows is
entered in the ledger too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PART, ATTEMPT = "kestrel_part", "kestrel_attempt"


def _attempted(df: DataFrame) -> DataFrame:
    """The rows with the partition and the task attempt that writes them."""
    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.LongType()), T.StructField(ATTEMPT, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for b in batches:
            own = [pa.array([x] * b.num_rows, pa.int64()) for x in (task.partitionId(), task.taskAttemptId())]
            yield pa.RecordBatch.from_arrays([*b.columns, *own], names=[*b.schema.names, PART, ATTEMPT])

    return df.mapInArrow(run, schema)


class Ledger:
    """Appends batches of one job to one table, each once."""

    def __init__(self, spark: SparkSession, url: str, table: str, job: str, properties: dict[str, str]):
        if "driver" not in properties:
            raise ValueError("properties must name the JDBC driver class")
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]{0,63}", job):
            raise ValueError(f"a job is named by letters, digits and underscores: {job!r}")
        self.spark, self.url, self.table, self.job, self.properties = spark, url, table, job, dict(properties)
        self.ledger, self.stage = f"{table}_ledger", f"{table}_{job}_stage"

    @contextmanager
    def transaction(self):
        """A connection of the driver: committed at the end, rolled back by an error."""
        jvm = self.spark._jvm
        given = jvm.java.util.Properties()
        for k, v in self.properties.items():
            given.setProperty(k, v)
        registry = jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
        registry.register(self.properties["driver"])
        connection = registry.get(self.properties["driver"]).connect(self.url, given)
        try:
            connection.setAutoCommit(False)
            yield connection
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _exists(self, connection, table: str) -> bool:
        dialect = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        statement = connection.createStatement()
        try:
            statement.executeQuery(dialect.getSchemaQuery(table)).close()
            return True
        except Exception as e:
            if "java.sql.SQL" not in str(e):
                raise
            return False
        finally:
            statement.close()

    def _run(self, connection, sql: str, *values) -> int:
        statement = connection.prepareStatement(sql)
        try:
            for i, v in enumerate(values, 1):
                (statement.setString if isinstance(v, str) else statement.setLong)(i, v)
            return statement.executeUpdate()
        finally:
            statement.close()

    def prepare(self) -> None:
        with self.transaction() as c:
            there = self._exists(c, self.ledger)
        if not there:
            with self.transaction() as c:
                self._run(c, f"CREATE TABLE {self.ledger} (job VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL, "
                             "n_rows BIGINT NOT NULL, PRIMARY KEY (job, batch_id))")

    def published(self, batch_id: int) -> bool:
        with self.transaction() as c:
            statement = c.prepareStatement(f"SELECT 1 FROM {self.ledger} WHERE job = ? AND batch_id = ?")
            statement.setString(1, self.job)
            statement.setLong(2, batch_id)
            found = statement.executeQuery().next()
            statement.close()
            return found

    def write_stage(self, df: DataFrame) -> None:
        """Writes the batch next to the table; what an earlier run staged goes."""
        _attempted(df).write.jdbc(self.url, self.stage, mode="overwrite", properties=self.properties)

    def publish(self, columns: list[str], batch_id: int) -> int:
        """Moves the staged rows to the table and enters the batch, in one transaction. Returns their number."""
        dialect = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        names = ", ".join(map(dialect.quoteIdentifier, columns))
        part, attempt = dialect.quoteIdentifier(PART), dialect.quoteIdentifier(ATTEMPT)
        with self.transaction() as c:
            # First, so that a second publisher of the batch waits here and then fails on the key.
            self._run(c, f"INSERT INTO {self.ledger} (job, batch_id, n_rows) VALUES (?, ?, 0)", self.job, batch_id)
            n = self._run(c, f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.stage} s WHERE s.{attempt} = "
                             f"(SELECT MIN(t.{attempt}) FROM {self.stage} t WHERE t.{part} = s.{part})")
            self._run(c, f"UPDATE {self.ledger} SET n_rows = ? WHERE job = ? AND batch_id = ?", n, self.job, batch_id)
        return n

    def append(self, df: DataFrame, batch_id: int) -> bool:
        """Appends one batch. False if the ledger already holds it."""
        self.prepare()
        if self.published(batch_id):
            return False
        df.limit(0).write.jdbc(self.url, self.table, mode="append", properties=self.properties)  # creates the table
        self.write_stage(df)
        self.publish(df.columns, batch_id)
        return True


def append_batches(url: str, table: str, job: str, properties: dict[str, str]):
    """The ledger as a ``foreachBatch`` function."""
    def run(batch: DataFrame, batch_id: int) -> None:
        Ledger(batch.sparkSession, url, table, job, properties).append(batch, batch_id)
    return run
