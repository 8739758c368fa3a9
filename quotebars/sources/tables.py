"""Tables: DDL, raw append (batch and streaming) and the idempotent bar upsert.

Raw quotes are append-only: a catalog table, or a folder in which every stream checkpoint
(``stream/<writer>``) and the batch appends (``batch``) have sub-folders of their own, so that
neither hides the other's rows. ``read_raw`` reads them as one table.

Bars need MERGE semantics on ``(symbol, window_start)``. With a row-level-ops catalog
configured, ``BarStore(table=...)`` issues ``MERGE INTO``. Without one, a small offline
stand-in keeps a merge-on-read version log:

* each attempt of an upsert writes ``data/seq=<n>/attempt=<id>/symbol=../bar_day=..``, a folder
  of its own, and then commits by creating ``_commits/log/seq=<n>`` that names the attempt. If
  another writer has taken ``n``, the attempt moves on to the next free number; data that no
  commit names is invisible, and nothing is ever overwritten;
* a batch whose ``(writer, batch_id)`` is already committed is evaluated but not written again,
  so that a stateful stream can commit its state; the writer id of a stream is kept in its
  checkpoint, so a new checkpoint is a new writer;
* ``read()`` keeps, per key, the row of the highest committed ``seq`` (with the trade-count
  guard: of the highest trade count, then ``seq``).
"""

from __future__ import annotations

import functools
import json
import uuid
from contextlib import contextmanager
from datetime import date as _date
from datetime import timedelta as _timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.schemas import BAR, QUOTE
from quotebars.sources.folders import put_once


def ddl_namespace(spark: SparkSession, namespace: str, catalog: str | None = None) -> None:
    name = f"{catalog}.{namespace}" if catalog else namespace
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def _columns(schema: T.StructType, *more: str) -> str:
    return ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + list(more))


def ddl_tables(spark: SparkSession, quotes_table: str | None = None, bars_table: str | None = None, using: str = "parquet",
               location_root: str | None = None) -> None:
    """Create the tables that are named, if absent, from the row contracts, partitioned by symbol and day:
    ``using='iceberg'`` by hidden ``days()``, parquet by a column of its own (``quote_day``, ``bar_day``)."""
    for table, schema, time, day, folder in ((quotes_table, QUOTE, "quote_time", "quote_day", "quotes_raw"),
                                             (bars_table, BAR, "window_start", "bar_day", "ohlcv")):
        if table:
            hidden = using == "iceberg"
            parts = f"symbol, days({time})" if hidden else f"symbol, {day}"
            columns = _columns(schema) if hidden else _columns(schema, f"{day} date")
            place = f" LOCATION '{location_root}/{folder}'" if location_root else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {using} PARTITIONED BY ({parts}){place}")


def with_quote_day(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("quote_day", F.to_date("quote_time"))


def _for_table(quotes: DataFrame, table: str) -> DataFrame:
    """``quotes`` with the day column if the table has one."""
    return with_quote_day(quotes) if "quote_day" in quotes.sparkSession.table(table).columns else quotes


def sink_batch_append(quotes: DataFrame, path: str | None = None, table: str | None = None, append_id: str | None = None) -> bool:
    """Batch append into the raw table: a catalog table, or the folder's batch part. An append is known by
    its ``append_id`` (the run of a job, say), so one that is retried after a crash leaves one copy, and
    returns False; equal rows under another id, or without one, are appended like any others.

    In a folder the rows of an append appear whole or not at all. A catalog table notes the id in its
    properties after the rows, so a crash between the two is the one case that appends twice there.
    Rows are ranged by (symbol, time) first, so a task writes few of the (symbol, day)
    folders and a hot symbol is spread over several tasks."""
    spark = quotes.sparkSession
    if table:
        note = f"quotebars.append.{append_id}"
        if append_id is not None and note in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}:
            return False
        view = f"_quotes_{uuid.uuid4().hex[:8]}"
        _for_table(quotes, table).createOrReplaceTempView(view)
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")     # any catalog's table, columns by name
        spark.catalog.dropTempView(view)
        if append_id is not None:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{note}' = 'done')")
        return True
    ranged = with_quote_day(quotes).repartitionByRange("symbol", "quote_time")
    return put_once(spark, f"{path.rstrip('/')}/batch", f"append={append_id or uuid.uuid4().hex[:12]}",
                    lambda folder: ranged.write.mode("overwrite").partitionBy("symbol", "quote_day").parquet(folder))


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The random identity of a checkpoint, made at its first use and kept in it."""
    fs, path, jvm = _file_system(spark, f"{checkpoint.rstrip('/')}/writer_id")
    if not fs.exists(path):
        try:
            out = fs.create(path, False)
        except Exception:  # another starter was first: its identity holds
            pass
        else:
            try:
                out.write(bytearray(uuid.uuid4().hex[:12].encode()))
            finally:
                out.close()
    stream = fs.open(path)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def sink_raw_append(quotes: DataFrame, path: str | None, checkpoint: str, query_name: str = "quotes_raw",
                    trigger: dict | None = None, table: str | None = None):
    """Streaming append of every decoded quote, to a catalog table or to the checkpoint's own
    part of the raw folder. The sink's log plus the source offsets in the checkpoint make it
    exactly-once; a new checkpoint starts a part of its own and hides nobody's rows."""
    writer = (_for_table(quotes, table) if table else with_quote_day(quotes)).writeStream.queryName(query_name).outputMode("append") \
        .option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if table:
        return writer.toTable(table)
    part = f"{path.rstrip('/')}/stream/{writer_id(quotes.sparkSession, checkpoint)}"
    return writer.format("parquet").partitionBy("symbol", "quote_day").option("path", part).start()


RAW_STORED = T.StructType(list(QUOTE.fields) + [T.StructField("quote_day", T.DateType())])


def read_raw(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """The raw table with typed partition columns (symbol stays a string): the parts of all
    stream checkpoints and of the batch appends together."""
    columns = [f.name for f in RAW_STORED.fields]
    if table:
        rows = spark.table(table)
        return (rows if "quote_day" in rows.columns else with_quote_day(rows)).select(*columns)
    fs, root, jvm = _file_system(spark, path.rstrip("/"))
    streams = jvm.org.apache.hadoop.fs.Path(root, "stream")
    # one folder per checkpoint: a handful, whatever the number of rows
    parts = [st.getPath().toString() for st in fs.listStatus(streams)] if fs.exists(streams) else []
    batch = jvm.org.apache.hadoop.fs.Path(root, "batch")
    if fs.exists(batch):
        parts.append(batch.toString())
    found = [spark.read.schema(RAW_STORED).parquet(p).select(*columns) for p in sorted(parts)]
    if not found:
        return spark.createDataFrame([], RAW_STORED)
    return functools.reduce(DataFrame.unionByName, found)


def day_range_filter(df: DataFrame, ts_col: str, day_col: str, lo=None, hi=None) -> DataFrame:
    """Time-range filter that also prunes the explicit day partitions."""
    if lo is not None:
        df = df.where((F.col(day_col) >= F.to_date(F.lit(lo))) & (F.col(ts_col) >= F.lit(lo).cast("timestamp")))
    if hi is not None:
        df = df.where((F.col(day_col) <= F.to_date(F.lit(hi))) & (F.col(ts_col) < F.lit(hi).cast("timestamp")))
    return df


LISTING = "spark.sql.sources.parallelPartitionDiscovery.threshold"


@contextmanager
def one_listing(spark: SparkSession):
    """List a table's folders in one job, a task for each entry of the first level that has several. By
    default every folder of more than 32 entries is a job of its own, one after the other: one for each
    symbol of each version of a store that spans months."""
    old = spark.conf.get(LISTING)
    spark.conf.set(LISTING, "1")
    try:
        yield
    finally:
        spark.conf.set(LISTING, old)


class BarStore:
    """Idempotent upsert target for bars keyed by ``(symbol, window_start)``."""

    def __init__(self, spark: SparkSession, path: str | None = None, table: str | None = None,
                 writer: str | None = None, guard_trade_count: bool = False):
        if not path and not table:
            raise ValueError("BarStore needs a log path or a catalog table")
        self.spark = spark
        self.path = path.rstrip("/") if path else None
        self.table = table
        self.named = writer is not None
        self.writer = writer or uuid.uuid4().hex[:12]
        self.guard = guard_trade_count
        self._last: int | None = None

    # ---------------------------------------------------------------- commits
    # _commits/log/seq=<n>       one JSON entry per committed version (create-if-absent)
    # _commits/_batches/<w>/<b>  marker: batch b of writer w is committed (replay check)
    # _commits/_base/seq=<n>     marker: version n is a compacted base
    def _fs(self):
        fs, _, jvm = _file_system(self.spark, self.path)
        return fs, jvm

    def _path(self, rel: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rel}")

    def _seqs(self, rel: str = "_commits/log") -> list[int]:
        fs, _ = self._fs()
        d = self._path(rel)
        if not fs.exists(d):
            return []
        return sorted(int(st.getPath().getName()[4:]) for st in fs.listStatus(d)
                      if st.getPath().getName().startswith("seq="))

    def _day_bases(self) -> dict:
        """{bar_day: newest base seq} from day-scoped compactions."""
        fs, _ = self._fs()
        d = self._path("_commits/_base_day")
        if not fs.exists(d):
            return {}
        out = {}
        for st in fs.listStatus(d):
            day = st.getPath().getName()
            seqs = self._seqs(f"_commits/_base_day/{day}")
            if seqs:
                out[day] = seqs[-1]
        return out

    def last_seq(self) -> int:
        """The newest committed version. The log is listed once; from then on this store only
        looks whether the next numbers are taken."""
        if self._last is None:
            self._last = (self._seqs() or [0])[-1]
        fs, _ = self._fs()
        while fs.exists(self._path(f"_commits/log/seq={self._last + 1:012d}")):
            self._last += 1
        return self._last

    def _marker(self, batch_id) -> str:
        return f"_commits/_batches/{self.writer}/{batch_id}"

    def is_committed(self, batch_id) -> bool:
        fs, _ = self._fs()
        return batch_id is not None and fs.exists(self._path(self._marker(batch_id)))

    def _create(self, rel: str, text: str = "") -> None:
        fs, _ = self._fs()
        out = fs.create(self._path(rel), False)     # create-if-absent: a racing committer fails here
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def _commit(self, entry: dict) -> None:
        """Commit under the entry's number, or, if another writer was first, under the next free
        one; the attempt's folder moves along."""
        fs, _ = self._fs()
        while True:
            seq = entry["seq"]
            try:
                self._create(f"_commits/log/seq={seq:012d}", json.dumps(entry))
                break
            except Exception:
                if not fs.exists(self._path(f"_commits/log/seq={seq:012d}")):
                    raise
            entry["seq"] = self.last_seq() + 1
            fs.mkdirs(self._path(f"data/seq={entry['seq']:012d}"))
            fs.rename(self._path(f"data/seq={seq:012d}/attempt={entry['attempt']}"),
                      self._path(f"data/seq={entry['seq']:012d}/attempt={entry['attempt']}"))
        if entry.get("base"):
            self._create(f"_commits/_base/seq={entry['seq']:012d}")
        for day in entry.get("base_days") or ():
            self._create(f"_commits/_base_day/{day}/seq={entry['seq']:012d}")
        if entry.get("batch_id") is not None:
            self._create(self._marker(entry["batch_id"]))

    def _commits(self) -> list[dict]:
        """Every commit entry, oldest first (reads each entry: audits and tests only)."""
        fs, jvm = self._fs()
        entries = []
        for seq in self._seqs():
            stream = fs.open(self._path(f"_commits/log/seq={seq:012d}"))
            try:
                reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
                entries.append(json.loads(reader.readLine()))
            finally:
                stream.close()
        return entries

    def _has_data(self, rel: str) -> bool:
        fs, _ = self._fs()
        it = fs.listFiles(self._path(rel), True)
        while it.hasNext():
            name = it.next().getPath().getName()
            if not name.startswith(("_", ".")):
                return True
        return False

    # ---------------------------------------------------------------- writes
    def upsert(self, bars: DataFrame, batch_id: int | None = None, base: bool = False,
               base_days=()) -> bool:
        """Upsert one batch. Returns False when the batch was already committed; it is then
        evaluated all the same, as a stateful stream commits its state only so.

        The batch is computed once (one write); an empty batch writes no data file and
        is not committed."""
        if self.table:
            self._merge(bars)
            return True
        if self.is_committed(batch_id):
            bars.write.format("noop").mode("overwrite").save()
            return False
        seq, attempt = self.last_seq() + 1, uuid.uuid4().hex[:12]
        rel = f"data/seq={seq:012d}/attempt={attempt}"
        cols = [c for c in bars.columns if c not in ("bar_day", "seq", "attempt")]
        # one file per (symbol, day) partition: bars per symbol-day are bounded by the
        # number of windows in a day, so clustering on them cannot build a hot task
        (bars.select(*cols, F.to_date("window_start").alias("bar_day"))
             .repartition("symbol", "bar_day")
             .write.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy("symbol", "bar_day")
             .parquet(f"{self.path}/{rel}"))
        if not self._has_data(rel):
            return True
        self._commit({"seq": seq, "attempt": attempt, "writer": self.writer, "batch_id": batch_id, "base": base,
                      "base_days": list(base_days)})
        return True

    def for_checkpoint(self, checkpoint: str) -> "BarStore":
        """This store, with the checkpoint's identity as its writer unless one was given: batch
        numbers start anew with a checkpoint, so they identify a batch only together with it."""
        if not self.named and not self.table:
            self.writer = writer_id(self.spark, checkpoint)
        return self

    def foreach_batch(self):
        """``foreachBatch`` callback; uses the batch's own session and its batch id."""
        def write(batch_df: DataFrame, batch_id: int) -> None:
            self.upsert(batch_df, batch_id)
        return write

    def _merge(self, bars: DataFrame) -> None:
        session = bars.sparkSession
        view = f"_bar_updates_{uuid.uuid4().hex[:8]}"
        bars.createOrReplaceTempView(view)
        guard = " AND s.trade_count >= t.trade_count" if self.guard else ""
        session.sql(f"""MERGE INTO {self.table} t USING {view} s
            ON t.symbol = s.symbol AND t.window_start = s.window_start
            WHEN MATCHED{guard} THEN UPDATE SET *
            WHEN NOT MATCHED THEN INSERT *""")

    # ---------------------------------------------------------------- reads
    def read(self, symbol: str | None = None, day_lo=None, day_hi=None) -> DataFrame:
        """Latest committed version of every bar (optionally one symbol / day range)."""
        if self.table:
            df = self.spark.table(self.table)
            df = df if "bar_day" in df.columns else df.withColumn("bar_day", F.to_date("window_start"))
            return self._filtered(df, symbol, day_lo, day_hi).select(*[f.name for f in BAR.fields])
        last = self.last_seq()
        if not last:
            return self.spark.createDataFrame([], self._empty_schema())
        first = max(self._seqs("_commits/_base") or [1])
        # which attempt of each version counts: one small row per committed batch
        commits = (self.spark.read.schema("seq int, attempt string").json(f"{self.path}/_commits/log")
                   .where((F.col("seq") >= first) & (F.col("seq") <= last)))
        with one_listing(self.spark):
            stored = self.spark.read.schema(self.stored_schema()).parquet(f"{self.path}/data")
        df = (stored.where((F.col("seq") >= first) & (F.col("seq") <= last))
              .join(commits, ["seq", "attempt"], "left_semi"))
        day_bases = {d: q for d, q in self._day_bases().items() if q > first}
        if day_bases:
            # one entry per compacted day: a small literal map, evaluated on partition values
            bases = F.create_map(*[x for d, q in sorted(day_bases.items())
                                   for x in (F.lit(d).cast("date"), F.lit(q))])
            df = df.where(F.col("seq") >= F.coalesce(F.element_at(bases, F.col("bar_day")), F.lit(first)))
        df = self._filtered(df, symbol, day_lo, day_hi)
        # bar_day is a function of window_start: ranking within (symbol, bar_day, window_start)
        # keeps partition filters on symbol/bar_day pushable below the window.
        newest = [F.col("seq").desc()]
        if self.guard:  # as a guarded MERGE leaves it: a smaller count never replaces a larger one
            newest.insert(0, F.col("trade_count").desc())
        w = Window.partitionBy("symbol", "bar_day", "window_start").orderBy(*newest)
        latest = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
        # contract column order (partition columns come back last from the reader)
        return latest.select(*[f.name for f in BAR.fields])

    @staticmethod
    def _filtered(df: DataFrame, symbol=None, day_lo=None, day_hi=None) -> DataFrame:
        if symbol is not None:
            df = df.where(F.col("symbol") == F.lit(symbol))
        if day_lo is not None:
            df = df.where(F.col("bar_day") >= F.to_date(F.lit(day_lo)))
        if day_hi is not None:
            df = df.where(F.col("bar_day") <= F.to_date(F.lit(day_hi)))
        return df

    def _empty_schema(self):
        return BAR

    @staticmethod
    def stored_schema() -> T.StructType:
        """Data columns plus the directory columns, typed explicitly so partition
        values are never re-typed by inference (a numeric-looking symbol stays a string)."""
        return T.StructType(list(BAR.fields) + [T.StructField("seq", T.IntegerType()),
                                                T.StructField("attempt", T.StringType()),
                                                T.StructField("bar_day", T.DateType())])

    def compact(self, day_lo=None, day_hi=None) -> bool:
        """Rewrite the latest rows as one base version (no-op on an empty store).

        Without a range the whole store is rewritten and reads start from the new
        version. With ``day_lo``/``day_hi`` (inclusive) only those days are rewritten,
        e.g. the days the stream has closed; each becomes a day-scoped base, so reads of
        those days skip every older version while other days keep theirs."""
        if self.table:
            return False
        before = self.last_seq()
        if not before:
            return False
        if day_lo is None and day_hi is None:
            self.upsert(self.read(), batch_id=None, base=True)
        else:
            if day_lo is None or day_hi is None:
                raise ValueError("give both day_lo and day_hi for a day-scoped compaction")
            lo, hi = _date.fromisoformat(str(day_lo)), _date.fromisoformat(str(day_hi))
            days = [(lo + _timedelta(days=i)).isoformat() for i in range((hi - lo).days + 1)]
            self.upsert(self.read(day_lo=lo.isoformat(), day_hi=hi.isoformat()), batch_id=None,
                        base_days=days)
        return self.last_seq() > before

    def versions(self) -> DataFrame:
        """Every row version with its seq (for audits and tests)."""
        return self.spark.read.schema(self.stored_schema()).parquet(f"{self.path}/data")
