"""Volume increments: batch lag form and the stateful streaming form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quotebars.operators.increments import volume_increments
from quotebars.sources.folders import put_batch, read_batches
from quotebars.sources.topic import write_in_time_order
from quotebars.streaming.increments_state import CARRY, carry_after, increments_after, increments_stateful

T0 = dt.datetime(2026, 6, 20, 12, 0, 0)


def _quotes(spark, cums, sym="A", start=0):
    rows = [(sym, T0 + dt.timedelta(seconds=start + i), c, 1.0) for i, c in enumerate(cums)]
    return spark.createDataFrame(rows, "symbol string, quote_time timestamp, day_volume long, price double") \
        .withColumn("price", F.col("price").cast("decimal(38,8)"))


def test_batch_increments_with_day_reset(spark):
    out = volume_increments(_quotes(spark, [100, 150, 20, 25]))
    assert [r.volume for r in out.orderBy("quote_time").collect()] == [0, 50, 0, 5]


def test_batch_increments_per_symbol(spark):
    df = _quotes(spark, [10, 30], "A").unionByName(_quotes(spark, [5, 6, 4], "B"))
    got = {(r.symbol, r.day_volume): r.volume for r in volume_increments(df).collect()}
    assert got == {("A", 10): 0, ("A", 30): 20, ("B", 5): 0, ("B", 6): 1, ("B", 4): 0}


SCHEMA = "symbol string, quote_time timestamp, day_volume long, price decimal(38,8)"
COUNTED = f"{SCHEMA}, volume long"


def _run(spark, root, **options):
    stream = spark.readStream.schema(SCHEMA).options(**options).parquet(f"{root}/src")
    increments_stateful(stream, f"{root}/ck", lambda rows, n: put_batch(rows, f"{root}/out", n), trigger={"availableNow": True}).awaitTermination()
    return read_batches(spark, f"{root}/out", COUNTED)


def test_stateful_increments_across_batches(spark, scratch):
    root = scratch("inc")
    for i, cums in enumerate([[100, 150], [20, 25]]):
        _quotes(spark, cums, start=10 * i).write.mode("append").parquet(f"{root}/src")
        seen = [r.volume for r in _run(spark, root).orderBy("quote_time").collect()]
    assert seen == [0, 50, 0, 5]


def test_stateful_late_row_keeps_reference(spark, scratch):
    root = scratch("inc-late")
    batches = [_quotes(spark, [100, 150], start=10), _quotes(spark, [90], start=0), _quotes(spark, [170], start=20)]
    for b in batches:
        b.write.mode("append").parquet(f"{root}/src")
        got = {r.day_volume: r.volume for r in _run(spark, root).collect()}
    # 90 is older than the last seen quote: increment 0 and the reference stays 150
    assert got == {100: 0, 150: 50, 90: 0, 170: 20}


def _random_quotes(spark, n=600):
    rng = random.Random(5)
    rows = [("HOT" if rng.random() < 0.4 else rng.choice(["A", "B", None]), T0 + dt.timedelta(minutes=rng.randrange(900)),
             rng.choice([None, *range(0, 5000, 7)]), rng.randrange(9)) for _ in range(n)]
    return spark.createDataFrame(rows, "symbol string, quote_time timestamp, day_volume long, price int") \
        .withColumn("price", F.col("price").cast("decimal(38,8)"))


@pytest.mark.parametrize("files_per_batch", [1, 3, 100])
def test_stream_equals_batch_at_any_file_limit(spark, scratch, files_per_batch):
    root, quotes = scratch("inc-files"), _random_quotes(spark)
    write_in_time_order(quotes, f"{root}/src", 6, ("quote_time",), "quote_time")
    got = _run(spark, root, maxFilesPerTrigger=files_per_batch)
    want = volume_increments(quotes)
    columns = ["symbol", "quote_time", "day_volume", "price", "volume"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))


def test_a_repeated_batch_starts_from_the_same_state(spark, scratch):
    """A crash after the output and the carry of a batch, before its commit: the batch comes again."""
    import glob
    import os
    root = scratch("inc-crash")
    for i, cums in enumerate([[100, 150], [170, 175]]):
        _quotes(spark, cums, start=10 * i).write.mode("append").parquet(f"{root}/src")
        _run(spark, root)
    for f in glob.glob(f"{root}/ck/commits/1") + glob.glob(f"{root}/ck/commits/.1.crc"):
        os.remove(f)
    for _ in range(2):
        assert [r.volume for r in _run(spark, root).orderBy("quote_time").collect()] == [0, 50, 20, 5]
    _quotes(spark, [200], start=30).write.mode("append").parquet(f"{root}/src")
    assert [r.volume for r in _run(spark, root).orderBy("quote_time").collect()] == [0, 50, 20, 5, 25]


def test_rows_of_one_symbol_are_scanned_by_many_tasks(spark):
    quotes = spark.range(4000).select(F.lit("HOT").alias("symbol"), F.expr("timestamp_seconds(id * 60)").alias("quote_time"),
                                      F.col("id").alias("day_volume"), F.lit(1).cast("decimal(38,8)").alias("price"))
    none = spark.createDataFrame([], CARRY)
    rows, carry = increments_after(quotes, none), carry_after(quotes, none)
    plan = rows._jdf.queryExecution().toString()
    assert "hashpartitioning(symbol" in plan and "_block" in plan.split("hashpartitioning(symbol", 1)[1][:40]
    assert carry.collect()[0].day_volume == 3999 and rows.agg(F.sum("volume")).first()[0] == 3999
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = rows.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.sum("volume").alias("v")).where("v > 0").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


def test_null_times_and_empty_batches(spark):
    none = spark.createDataFrame([], CARRY)
    rows = spark.createDataFrame([("A", None, 5, 1), ("A", T0, 9, 1), ("A", T0, 12, 1)], "symbol string, quote_time timestamp, day_volume long, price int")
    out, carry = increments_after(rows, none), carry_after(rows, none)
    assert sorted((r.day_volume, r.volume) for r in out.collect()) == [(5, 0), (9, 0), (12, 3)]
    assert [tuple(r) for r in carry.collect()] == [("A", T0, 12)]
    out, kept = increments_after(rows.limit(0), carry), carry_after(rows.limit(0), carry)
    assert out.collect() == [] and [tuple(r) for r in kept.collect()] == [("A", T0, 12)]


def test_rows_that_do_not_count_are_left_out_after_the_batch_is_evaluated(spark, scratch):
    root, quotes = scratch("inc-only"), _random_quotes(spark)
    write_in_time_order(quotes, f"{root}/src", 6, ("quote_time",), "quote_time")
    only = F.col("price") > 3
    stream = spark.readStream.schema(quotes.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/src").repartition(4, "symbol", "quote_time")
    got, plans = [], []

    def keep(rows, number):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        got.extend(rows.collect())

    increments_stateful(stream, f"{root}/ck", keep, trigger={"availableNow": True}, only=only).awaitTermination()
    want = volume_increments(quotes.where(only))
    columns = ["symbol", "quote_time", "day_volume", "price", "volume"]
    assert sorted(repr([r[c] for c in columns]) for r in got) == sorted(repr([r[c] for c in columns]) for r in want.collect())
    assert len(plans) == 3 and all("InMemoryRelation" in p for p in plans)


def test_payloads_are_dealt_to_all_slots_before_they_are_parsed(spark, monkeypatch):
    from quotebars.plans import queries as Q
    plans = []
    monkeypatch.setattr(Q, "increments_stateful", lambda rows, *a, **k: plans.append(rows._jdf.queryExecution().analyzed().toString()) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        Q.queries()["publish_pipeline"](spark, "/root/testdata/sf0.001")
    above = plans[0].split("RepartitionByExpression")
    assert len(above) == 2 and "Filter" not in above[0] and "parse_json" in above[0].lower()
