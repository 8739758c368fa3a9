"""Raw table append and the idempotent bar upsert log."""

import datetime as dt

from pyspark.sql import functions as F

from quotebars.operators.reconcile import backfill_bars, late_rows_report, reconcile_counts
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.schemas import BAR, QUOTE
from quotebars.sources.tables import BarStore, ddl_namespace, ddl_tables, read_raw, sink_batch_append

T0 = dt.datetime(2026, 6, 20, 12, 0, 0)


def _quotes(spark, n=50, sym="A", price0=100):
    rows = [(sym, price0 + i % 7, 1 + i % 3, i, T0 + dt.timedelta(seconds=13 * i), "t") for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, "
                                     "quote_time timestamp, source string")
    return df.select("symbol", F.col("price").cast("decimal(38,8)").alias("price"),
                     F.col("volume").cast("decimal(38,8)").alias("volume"), "day_volume", "quote_time",
                     F.col("quote_time").alias("ingest_time"), "source")


def _rows(df):
    return sorted(tuple(r) for r in df.drop("updated_at").collect())


def test_upsert_replaces_inserts_and_replays(spark, scratch):
    q = _quotes(spark).unionByName(_quotes(spark, sym="B"))
    store = BarStore(spark, f"{scratch('bars')}/ohlcv", writer="w1")
    stale = aggregate_ohlcv(q.where(F.col("price") < 103))
    full = aggregate_ohlcv(q)
    assert store.upsert(stale, batch_id=0)
    assert store.upsert(full, batch_id=1)
    before = _rows(store.read())
    assert before == _rows(full)
    assert store.upsert(stale, batch_id=0) is False          # replayed batch: no-op
    assert _rows(store.read()) == before
    assert store.upsert(full.limit(0), batch_id=2)            # empty batch: nothing committed
    assert len(store._commits()) == 2


def test_compaction_keeps_latest(spark, scratch):
    q = _quotes(spark)
    store = BarStore(spark, f"{scratch('bars')}/ohlcv")
    store.upsert(aggregate_ohlcv(q.where(F.col("price") < 102)), batch_id=0)
    store.upsert(aggregate_ohlcv(q), batch_id=1)
    expected = _rows(store.read())
    assert store.compact()
    assert _rows(store.read()) == expected
    assert store._commits()[-1]["base"] is True
    assert _rows(store.read(symbol="A")) == expected


def test_read_prunes_partitions(spark, scratch):
    q = _quotes(spark).unionByName(_quotes(spark, sym="B"))
    store = BarStore(spark, f"{scratch('bars')}/ohlcv")
    store.upsert(aggregate_ohlcv(q), batch_id=0)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = store.read(symbol="A")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "= A)" in filters and "seq#" in filters


def test_raw_append_backfill_reconcile(spark, scratch):
    root = scratch("lake")
    q = _quotes(spark).unionByName(_quotes(spark, sym="B"))
    sink_batch_append(q, f"{root}/raw")
    raw = read_raw(spark, f"{root}/raw").drop("quote_day")
    assert raw.count() == 100
    store = BarStore(spark, f"{root}/ohlcv")
    backfill_bars(raw, store)
    assert _rows(store.read()) == _rows(aggregate_ohlcv(q))
    rc = {r.symbol: r for r in reconcile_counts(raw, store.read()).collect()}
    assert rc["A"].ok and rc["A"].bar_trades == 50
    assert late_rows_report(raw, store.read()).count() == 0
    partial = aggregate_ohlcv(q.where(F.col("price") != 100))
    rep = {r.status for r in late_rows_report(raw, partial).collect()}
    assert rep <= {"differs", "missing"} and rep


def test_backfill_only_closed_windows(spark, scratch):
    q = _quotes(spark)
    store = BarStore(spark, f"{scratch('bars')}/ohlcv")
    wm = T0 + dt.timedelta(minutes=5)
    backfill_bars(q, store, watermark=wm)
    assert all(r.window_end <= wm for r in store.read().collect())


def test_ddl_tables(spark, scratch):
    root = scratch("ddl")
    ddl_tables(spark, "qb_quotes_raw", "qb_ohlcv", location_root=root)
    assert sorted(spark.table("qb_quotes_raw").columns) == sorted([*QUOTE.fieldNames(), "quote_day"])
    assert sorted(spark.table("qb_ohlcv").columns) == sorted([*BAR.fieldNames(), "bar_day"])


def test_namespace_and_day_range(spark, scratch):
    from quotebars.sources.tables import day_range_filter, ddl_namespace
    ddl_namespace(spark, "qb_ns")
    assert "qb_ns" in [r[0] for r in spark.sql("SHOW NAMESPACES").collect()]
    q = _quotes(spark, n=400)                       # 13 s apart: spans the 12:00 .. 13:26 range
    store = BarStore(spark, f"{scratch('bars')}/ohlcv")
    store.upsert(aggregate_ohlcv(q), batch_id=0)
    day = T0.date().isoformat()
    assert store.read(day_lo=day, day_hi=day).count() == store.read().count()
    assert store.read(day_lo="2030-01-01").count() == 0
    raw_root = scratch("raw")
    sink_batch_append(q, f"{raw_root}/raw")
    raw = read_raw(spark, f"{raw_root}/raw")
    lo, hi = "2026-06-20 12:10:00", "2026-06-20 12:20:00"
    sel = day_range_filter(raw, "quote_time", "quote_day", lo, hi)
    assert sel.count() == q.where((F.col("quote_time") >= lo) & (F.col("quote_time") < hi)).count()


def test_day_scoped_compaction(spark, scratch):
    # quotes over three days; compact the first two days only
    rows = [("A", 100 + i % 5, 1, i, T0 + dt.timedelta(hours=7 * i), "t") for i in range(20)]
    q = spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, "
                                    "quote_time timestamp, source string") \
        .select("symbol", F.col("price").cast("decimal(38,8)").alias("price"),
                F.col("volume").cast("decimal(38,8)").alias("volume"), "day_volume", "quote_time",
                F.col("quote_time").alias("ingest_time"), "source")
    store = BarStore(spark, f"{scratch('bars')}/ohlcv")
    store.upsert(aggregate_ohlcv(q.where(F.col("price") < 103)), batch_id=0)
    store.upsert(aggregate_ohlcv(q), batch_id=1)
    expected = _rows(store.read())
    d0 = T0.date()
    assert store.compact(day_lo=d0.isoformat(), day_hi=(d0 + dt.timedelta(days=1)).isoformat())
    assert _rows(store.read()) == expected
    versions = store.versions().where(F.col("bar_day") == F.lit(d0.isoformat()).cast("date"))
    assert versions.select("seq").distinct().count() == 3          # old versions stay on disk ...
    # ... but reads of a compacted day only see the compacted version
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = store.read(day_lo=d0.isoformat(), day_hi=d0.isoformat())._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "element_at" in plan
    later = aggregate_ohlcv(q.where(F.col("price") == 100)).withColumn("trade_count", F.lit(99).cast("bigint"))
    store.upsert(later, batch_id=2)                                 # newer versions still win
    assert {r.trade_count for r in store.read().where(F.col("open") == 100).collect()} == {99}


def test_racing_writers_both_stay(spark, scratch):
    root = scratch("race")
    q = _quotes(spark)
    a, b = BarStore(spark, f"{root}/ohlcv", writer="a"), BarStore(spark, f"{root}/ohlcv", writer="b")
    taken = a.last_seq()
    real = a.last_seq
    a.upsert(aggregate_ohlcv(q), batch_id=0)
    # the second writer has chosen its number before the first one committed
    answers = [taken]
    b.last_seq = lambda: answers.pop() if answers else real()
    b.upsert(aggregate_ohlcv(_quotes(spark, sym="B")), batch_id=0)
    got = _rows(BarStore(spark, f"{root}/ohlcv").read())
    assert got == _rows(aggregate_ohlcv(q.unionByName(_quotes(spark, sym="B"))))
    assert [c["writer"] for c in a._commits()] == ["a", "b"]


def test_leftovers_stay_invisible_under_dynamic_overwrite(spark, scratch):
    root = scratch("left")
    store = BarStore(spark, f"{root}/ohlcv", writer="w")
    stale = aggregate_ohlcv(_quotes(spark, sym="STALE"))
    (stale.withColumn("bar_day", F.to_date("window_start")).write.partitionBy("symbol", "bar_day")
        .parquet(f"{root}/ohlcv/data/seq={1:012d}/attempt=crashed"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.upsert(aggregate_ohlcv(_quotes(spark)), batch_id=0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {r.symbol for r in store.read().collect()} == {"A"}


def test_trade_count_guard_on_the_log(spark, scratch):
    root = scratch("guard")
    full, part = aggregate_ohlcv(_quotes(spark)), aggregate_ohlcv(_quotes(spark).where(F.col("price") < 103))
    for guard in (True, False):
        store = BarStore(spark, f"{root}/{guard}", guard_trade_count=guard)
        store.upsert(full)
        store.upsert(part.withColumn("volume", F.col("volume")))
        kept = {r.window_start: r.trade_count for r in store.read().collect()}
        small = {r.window_start: r.trade_count for r in part.collect()}
        big = {r.window_start: r.trade_count for r in full.collect()}
        assert kept == (big if guard else big | small)


def test_batch_append_shows_next_to_a_stream(spark, scratch):
    from quotebars.sources.tables import sink_raw_append
    root = scratch("both")
    q = _quotes(spark, n=10)
    q.write.parquet(f"{root}/src")
    for ck in ("a", "b"):
        sink_raw_append(spark.readStream.schema(q.schema).parquet(f"{root}/src"), f"{root}/raw", f"{root}/ck-{ck}",
                        trigger={"availableNow": True}).awaitTermination()
    sink_batch_append(_quotes(spark, n=7, sym="B"), f"{root}/raw")
    assert read_raw(spark, f"{root}/raw").count() == 27


def test_a_retried_append_leaves_one_copy(spark, scratch):
    root = scratch("append-id")
    quotes = _quotes(spark)
    n = quotes.count()
    assert sink_batch_append(quotes, f"{root}/raw", append_id="a") and not sink_batch_append(quotes, f"{root}/raw", append_id="a")
    assert read_raw(spark, f"{root}/raw").count() == n
    assert sink_batch_append(quotes, f"{root}/raw", append_id="b") and sink_batch_append(quotes, f"{root}/raw")
    assert read_raw(spark, f"{root}/raw").count() == 3 * n


def test_a_retried_append_to_a_catalog_table(spark, scratch):
    root, name = scratch("append-table"), "qb_append_id"
    ddl_namespace(spark, name)
    ddl_tables(spark, f"{name}.quotes", f"{name}.bars", location_root=root)
    quotes = _quotes(spark)
    n = quotes.count()
    assert sink_batch_append(quotes, table=f"{name}.quotes", append_id="a")
    assert not sink_batch_append(quotes, table=f"{name}.quotes", append_id="a")
    assert sink_batch_append(quotes, table=f"{name}.quotes", append_id="b")
    rows = read_raw(spark, table=f"{name}.quotes")
    assert rows.count() == 2 * n
    day = quotes.agg(F.min(F.to_date("quote_time"))).first()[0]
    plan = rows.where(F.col("quote_day") == F.lit(day))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(quote_day" in plan


def test_a_store_of_many_days_is_listed_in_one_job(spark, scratch):
    store = BarStore(spark, f"{scratch('listed')}/ohlcv")
    quotes = spark.range(40).select(
        F.lit("A").alias("symbol"), F.col("id").cast("decimal(38,8)").alias("price"), F.lit(1).cast("decimal(38,8)").alias("volume"),
        F.lit(0).cast("bigint").alias("day_volume"), F.timestamp_seconds(F.col("id") * 86400).alias("quote_time"))
    both = quotes.unionByName(quotes.withColumn("symbol", F.lit("B")))
    for _ in range(2):
        store.upsert(aggregate_ohlcv(both))
    old = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        bars = store.read()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1            # by default one for each version and symbol
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold") == old
    assert bars.count() == 80 and store.versions().count() == 160
