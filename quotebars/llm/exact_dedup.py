"""Exact deduplication as a stateful stream, in DataFrame functions only.

Each document becomes a narrow key row (digest of the normalised text, length, identifier,
locator). The key rows stream through an aggregation whose state, on disk (RocksDB) and
without expiry, holds for each digest the row that stays and the number of rows seen. On a
hit, that is in a group of several rows, the full bytes are compared with those of the row
that stays, so no document goes on the strength of a digest alone.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.session import scratch_dir
from quotebars.sources.folders import file_system, put_once

#: the characters that normalisation deletes
SPACES = " \t\n\x0b\x0c\r"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: micro-batches that the key rows of a run are cut into, as far as they are in so many files: from the second
#: on, rows meet the state that earlier ones have left
BATCHES = 4
#: state on disk; a store takes the space that it uses, not blocks set aside beforehand, and the stores of
#: an executor share a bounded part of its memory outside the heap
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128"}


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def locators(docs: DataFrame) -> Column:
    """Where a row is stored (file and row number), if it comes straight from files; else null."""
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    try:
        docs.select(place)
    except AnalysisException:
        return F.lit(None).cast("string")
    return place


def key_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), locators(docs).alias("locator"),
                       F.sha2(normalised(text).cast("binary"), 256).alias("digest"),
                       F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("points"))


def stream_groups(keys: DataFrame) -> DataFrame:
    """The stateful stream: for each digest the best row so far and the number of rows.

    The longest original text wins, then the smallest identifier (null last), then the
    smallest locator."""
    order = F.struct((-F.col("points")).alias("longest"), F.col("id").isNull().alias("without_id"),
                     F.col("id").alias("smallest"), F.col("locator").alias("place"))
    best = F.min_by(F.struct("id", "locator"), order)
    return keys.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def run_stream(keys: DataFrame, root: str, run_id: str, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Put the key rows of a run into the folder ``root`` and stream what is new there through ``stream_groups``;
    the last state of each digest comes back, earlier runs included. Batches are bounded in bytes, the state is
    on disk, a restart from the checkpoint repeats a batch into the same folder, and a run that is repeated
    under its ``run_id`` is not counted twice."""
    spark = keys.sparkSession
    put_once(spark, f"{root}/keys", f"run={run_id}", lambda folder: keys.write.mode("overwrite").parquet(folder))
    fs, folder, _ = file_system(spark, f"{root}/keys/run={run_id}")
    bound = max_bytes_per_trigger or max(1, fs.getContentSummary(folder).getLength() // BATCHES)
    source = (spark.readStream.schema(keys.schema).option("maxBytesPerTrigger", bound).option("recursiveFileLookup", "true")
              .parquet(f"{root}/keys"))
    groups = stream_groups(source)

    def keep_batch(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/changed/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        query = (groups.writeStream.outputMode("update").foreachBatch(keep_batch)
                 .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    schema = groups.schema
    changed = spark.read.schema(schema.add("batch", "long")).parquet(f"{root}/changed")
    # a digest's last state is the one that has counted most rows
    return changed.groupBy("digest").agg(F.max_by("best", "group_size").alias("best"),
                                         F.max("group_size").alias("group_size"))


def fetch(wanted: DataFrame, text: str) -> DataFrame:
    """(digest, kept_bytes) of rows of earlier runs, by their locators: only the files that hold them are read."""
    spark = wanted.sparkSession
    # the files of earlier inputs, a path each
    paths = [r["path"] for r in wanted.select(F.substring_index("locator", "#", 1).alias("path")).distinct().collect() if r["path"]]
    if not paths:
        return wanted.select("digest", F.lit(None).cast("string").alias("kept_bytes")).limit(0)
    stored = spark.read.parquet(*sorted(paths))
    return stored.select(locators(stored).alias("locator"), normalised(f"`{text}`").alias("kept_bytes")).join(wanted, "locator").select("digest", "kept_bytes")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
                max_bytes_per_trigger: int | None = None, state: str | None = None, run_id: str | None = None) -> DataFrame:
    """Every row of ``docs`` with ``digest``, ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical without ASCII white space; null counts as empty, and all
    empty texts are one group. Rows that repeat an identifier and a text share one group; of
    them the row with the smallest locator is kept if the rows come straight from files, else
    all that carry the kept identifier are. A null identifier loses every tie. An empty table
    gives no rows. Columns that have the names of the new ones are replaced. Raises if two texts
    of one digest differ in any byte.

    With ``state``, a lasting folder, the keyed state goes on from one run to the next: rows of earlier runs
    count in ``group_size`` and may be the ones that stay (``keep_id``). Their bytes are fetched by their locators,
    so their files must still be there; for one that did not come from files the digest decides. A run that is
    repeated after a crash should come under the same ``run_id``."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("digest", "keep_id", "group_size", "kept")]
    if not docs.take(1):
        return docs.select(*columns, F.lit("").alias("digest"), F.col(key).alias("keep_id"),
                           F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")).limit(0)
    root = state.rstrip("/") if state else scratch_dir(docs.sparkSession, "exact-dedup")
    groups = run_stream(key_rows(docs, key, text), root, run_id or uuid.uuid4().hex[:12], max_bytes_per_trigger)
    # The text goes through this shuffle within its row. Both sides of this join, and of the one below, are tables,
    # and so is its result: Spark splits a hot digest in a join that stands alone.
    tables = scratch_dir(docs.sparkSession, "exact-rows")

    def table(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{tables}/{name}")
        return docs.sparkSession.read.parquet(f"{tables}/{name}")

    packed = docs.select(F.struct(*columns).alias("row"), F.col(key).cast("long").alias("id"), locators(docs).alias("locator"),
                         F.sha2(normalised(text).cast("binary"), 256).alias("digest"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & F.col("locator").eqNullSafe(F.col("best.locator"))
    rows = table(packed.join(table(groups, "groups"), "digest").withColumn("kept", stays), "rows")
    members = rows.where("group_size > 1")
    content = normalised(f"row.`{text}`")
    # the bytes of the row that stays, once for each group of several rows
    kept = table(members.where("kept").groupBy("digest").agg(F.first(content).alias("kept_bytes")), "kept")
    unseen = F.lit(False)
    if state:
        elsewhere = members.select("digest", F.col("best.locator").alias("locator")).distinct().join(kept, "digest", "left_anti")
        kept = table(kept.unionByName(fetch(elsewhere, text)), "kept-of-all-runs")
        unseen = F.col("kept_bytes").isNull() & F.col("best.locator").isNull()
    differ = F.raise_error(F.concat(F.lit("texts of one digest differ: "), F.col("digest")))
    same = F.when(unseen, True).when(F.col("kept_bytes").eqNullSafe(content), True).otherwise(differ.cast("boolean"))
    out = ["row.*", "digest", F.col("best.id").alias("keep_id"), "group_size", "kept"]
    return rows.where("group_size = 1").select(*out).unionByName(members.join(kept, "digest", "left").where(same).select(*out))
