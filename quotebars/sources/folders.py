"""Folders that appear whole or not at all, and at most once.

A job writes into a hidden folder and makes it visible by one rename. The name says what was
written (an append, a publish, a micro-batch of a checkpoint), so whoever repeats the same work
after a crash finds it done. It needs a file system that renames a folder in one step, as
Spark's own file sinks do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STAGED = "_staged"      # Spark doesn't list names that begin with an underscore


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder, _ = file_system(spark, path)
    return fs.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """The visible entries of a folder, in the order of their names; none if it isn't there."""
    fs, folder, _ = file_system(spark, path)
    if not fs.exists(folder):
        return []
    found = (st.getPath().getName() for st in fs.listStatus(folder))
    return sorted(n for n in found if not n.startswith(("_", ".")))


def put_once(spark: SparkSession, path: str, name: str, write: Callable[[str], None]) -> bool:
    """Let ``write`` fill a hidden folder and show it as ``path``/``name``. False, without a call of
    ``write``, if it is there already. What an earlier, broken attempt left is overwritten."""
    path = path.rstrip("/")
    fs, final, jvm = file_system(spark, f"{path}/{name}")
    if fs.exists(final):
        return False
    hidden = f"{path}/{STAGED}/{name}"
    write(hidden)
    fs.mkdirs(final.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(hidden), final):
        raise OSError(f"{hidden} could not be renamed to {final}")
    return True


def batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


class BatchState:
    """A small table that a stream replaces in every micro-batch: the state after batch n is in a folder of
    its own, so batch n always starts from the state before it, however often it is repeated."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _read(self, found: list[str], session: SparkSession) -> DataFrame:
        if not found:
            return session.createDataFrame([], self.schema)
        return session.read.schema(self.schema).parquet(f"{self.path}/{found[-1]}")

    def before(self, batch_id: int, session: SparkSession | None = None) -> DataFrame:
        return self._read([n for n in names(self.spark, self.path) if n < batch_name(batch_id)], session or self.spark)

    def put(self, table: DataFrame, batch_id: int) -> None:
        """The state after ``batch_id``; only the one before it is kept besides. The table of a repeated batch
        is evaluated but not written, as a stateful stream commits its state only so."""
        if not put_once(self.spark, self.path, batch_name(batch_id), lambda folder: table.write.mode("overwrite").parquet(folder)):
            table.write.format("noop").mode("overwrite").save()
        for old in [n for n in names(self.spark, self.path) if n < batch_name(batch_id)][:-1]:
            fs, folder, _ = file_system(self.spark, f"{self.path}/{old}")
            fs.delete(folder, True)

    def read(self) -> DataFrame:
        return self._read(names(self.spark, self.path), self.spark)


def put_batch(rows: DataFrame, path: str, batch_id: int) -> bool:
    """Append a micro-batch in a folder of its own. A batch that is there already is evaluated all the
    same, as a stateful stream commits its state only so."""
    if put_once(rows.sparkSession, path, batch_name(batch_id), lambda folder: rows.write.mode("overwrite").parquet(folder)):
        return True
    rows.write.format("noop").mode("overwrite").save()
    return False


def read_batches(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """All batches that ``put_batch`` has shown."""
    if not names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
