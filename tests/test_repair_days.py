"""Report and backfill of the days that differ, and what a stopped stream's checkpoint tells."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotebars.operators.reconcile import _divides_a_day, _raw_of, backfill_bars, differing_days, late_rows_report
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.operators.serving import topn_per_symbol
from quotebars.schemas import BAR
from quotebars.sources.folders import BatchState, names, put_once
from quotebars.sources.tables import BarStore, read_raw, sink_batch_append
from quotebars.streaming.app import start_bars_query
from quotebars.streaming.serving import TopBars, read_counters, start_counters_query
from quotebars.streaming.state import open_windows, reconcile_open_windows, watermark_of

T0 = dt.datetime(2026, 6, 1, 0, 0, 0)
SCHEMA = "symbol string, price decimal(38,8), volume decimal(38,8), day_volume long, quote_time timestamp, ingest_time timestamp, source string"


def _quotes(spark, n=600, step=dt.timedelta(minutes=37), symbols=("A", "B", None)):
    rows = [(symbols[i % len(symbols)], 100 + i % 7, 1 + i % 3, i, T0 + i * step, "t") for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, quote_time timestamp, source string").select(
        "symbol", F.col("price").cast("decimal(38,8)").alias("price"), F.col("volume").cast("decimal(38,8)").alias("volume"),
        "day_volume", "quote_time", F.col("quote_time").alias("ingest_time"), "source")


def _statuses(report):
    return sorted((r.symbol or "-", r.window_start, r.status) for r in report.collect())


def test_nothing_differs(spark):
    quotes = _quotes(spark)
    bars = aggregate_ohlcv(quotes)
    assert differing_days(quotes, bars).count() == 0 and differing_days(quotes, bars, thorough=True).count() == 0
    assert late_rows_report(quotes, bars).count() == 0
    assert late_rows_report(quotes.limit(0), bars.limit(0)).count() == 0


def test_missing_differing_and_extra_bars(spark):
    quotes = _quotes(spark)
    day = T0 + dt.timedelta(days=3)
    full = aggregate_ohlcv(quotes)
    on_day = F.to_date("window_start") == F.lit(day.date())
    first = full.where(on_day & F.col("symbol").isNull()).orderBy("window_start").first()
    bars = full.where(~(on_day & F.col("symbol").isNull() & (F.col("window_start") == F.lit(first.window_start))))
    bars = bars.withColumn("trade_count", F.when(on_day & (F.col("symbol") == "A"), F.col("trade_count") + 1).otherwise(F.col("trade_count")))
    extra = full.limit(1).withColumn("window_start", F.lit(T0 - dt.timedelta(days=9)))
    bars = bars.unionByName(extra)
    got = _statuses(late_rows_report(quotes, bars))
    assert {s for _, _, s in got} == {"missing", "differs", "extra"}
    assert [x for x in got if x[2] == "missing"] == [("-", first.window_start, "missing")]
    assert {x[1].date() for x in got if x[2] == "differs"} == {day.date()} and {x[0] for x in got if x[2] == "differs"} == {"A"}
    assert sorted((r.symbol or "-", r.day) for r in differing_days(quotes, bars).collect()) == sorted(
        {(x[0], x[1].date()) for x in got})


def test_rows_in_another_window_of_the_day_show(spark):
    """The day's totals are alike, but a quote is counted in the wrong window."""
    quotes = _quotes(spark, 40, dt.timedelta(seconds=30), ("A",))
    moved = quotes.withColumn("quote_time", F.when(F.col("day_volume") == 7, F.col("quote_time") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("quote_time")))
    report = late_rows_report(quotes, aggregate_ohlcv(moved))
    assert sorted(r.status for r in report.collect()) == ["differs", "extra"]


def test_a_bar_changed_by_hand_shows_to_the_thorough(spark):
    quotes = _quotes(spark)
    bars = aggregate_ohlcv(quotes).withColumn("open", F.when(F.col("window_start") == F.lit(T0), F.lit(1).cast("decimal(38,8)")).otherwise(F.col("open")))
    assert _statuses(late_rows_report(quotes, bars, thorough=True)) == [("A", T0, "differs")]


@pytest.mark.parametrize("width, whole", [("1 minute", True), ("5 minutes", True), ("1 hour", True), ("1 day", True), ("7 minutes", False),
                                          ("2 days", False), ("90 seconds", True)])
def test_windows_of_a_day(spark, width, whole):
    assert _divides_a_day(width) is whole
    quotes = _quotes(spark, 200)
    lost = aggregate_ohlcv(quotes.where(F.col("day_volume") != 50), width)
    report = late_rows_report(quotes.withColumn("quote_day", F.to_date("quote_time")), lost, width)
    assert len(report.collect()) == 1


def test_a_backfill_reads_the_days_of_the_report_only(spark, scratch):
    root = scratch("days")
    quotes = _quotes(spark, 900)
    sink_batch_append(quotes, f"{root}/raw")
    raw = read_raw(spark, f"{root}/raw")
    days = [(T0 + dt.timedelta(days=d)).date() for d in (4, 11)]
    store = BarStore(spark, f"{root}/bars", writer="w")
    backfill_bars(raw.where(~F.to_date("quote_time").isin(days) | (F.col("price") > 103)), store, batch_id=0)
    report = late_rows_report(raw, store)
    assert sorted({r.window_start.date() for r in report.collect()}) == days
    found = differing_days(raw, store)
    part = _raw_of(raw, found, days, "1 minute")
    plan = part._jdf.queryExecution().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert filters == f"quote_day#{filters.split('#')[1].split(' ')[0]} IN (2026-06-05,2026-06-12)"
    before = {(r.symbol, r.window_start): r.updated_at for r in store.read().collect()}
    backfill_bars(raw, store, batch_id=1, report=report)
    assert late_rows_report(raw, store, thorough=True).count() == 0
    changed = {k for k, v in ((((r.symbol, r.window_start)), r.updated_at) for r in store.read().collect()) if before.get(k) != v}
    assert {t.date() for _, t in changed} == set(days)


def _run(spark, root, sink=None, top=None, store=None):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/src")
    query = start_bars_query(stream, store or BarStore(spark, f"{root}/bars"), f"{root}/ck", trigger={"availableNow": True}, top=top)
    query.awaitTermination()


def test_open_windows_and_watermark_of_a_stopped_stream(spark, scratch):
    root = scratch("state")
    assert watermark_of(spark, f"{root}/ck") is None
    quotes = _quotes(spark, 60, dt.timedelta(seconds=20))
    quotes.coalesce(1).write.parquet(f"{root}/src")
    store = BarStore(spark, f"{root}/bars")
    _run(spark, root, store=store)
    last = T0 + 59 * dt.timedelta(seconds=20)
    mark = watermark_of(spark, f"{root}/ck")
    assert mark == last - dt.timedelta(minutes=2)
    held = open_windows(spark, f"{root}/ck")
    want = aggregate_ohlcv(quotes).where(F.col("window_end") > F.lit(mark))
    assert sorted(map(repr, held.collect())) == sorted(map(repr, want.select(*held.columns).collect())) and held.count() > 3
    assert {r.status for r in reconcile_open_windows(held, store.read()).collect()} == {"same"}
    bad = store.read().where("symbol = 'A'").withColumn("close", F.col("close") + 1)
    assert {(r.symbol, r.status) for r in reconcile_open_windows(held, bad).collect()} == {("A", "differs"), ("B", "missing"), (None, "missing")}
    # a backfill up to the watermark leaves the open windows alone
    other = BarStore(spark, f"{root}/backfilled", writer="b")
    backfill_bars(quotes, other, watermark=mark)
    closed = {(r.symbol, r.window_start) for r in other.read().collect()}
    assert closed.isdisjoint({(r.symbol, r.window_start) for r in held.collect()}) and len(closed) + held.count() == store.read().count()


def test_the_serving_table_equals_the_ranked_scan_after_every_batch(spark, scratch):
    root = scratch("top")
    store, top = BarStore(spark, f"{root}/bars"), TopBars(spark, f"{root}/top", 3)
    assert top.read().count() == 0
    minute = dt.timedelta(minutes=1)
    steps = [(0, 4), (3, 9), (7, 8), (5, 6), (20, 22), (1, 2)]      # some of them late, within and beyond the watermark
    for begin, end in steps:
        rows = [(s, 100 + k, 1, k, T0 + k * minute, T0, "t") for k in range(begin, end) for s in ("A", "B", None)]
        spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, quote_time timestamp, ingest_time timestamp, source string").select(
            "symbol", F.col("price").cast("decimal(38,8)").alias("price"), F.col("volume").cast("decimal(38,8)").alias("volume"), "day_volume",
            "quote_time", "ingest_time", "source").coalesce(1).write.mode("append").parquet(f"{root}/src")
        _run(spark, root, top=top, store=store)
        want = topn_per_symbol(store.read(), [F.col("window_start").desc()], 3).drop("rn")
        columns = [c for c in BAR.fieldNames() if c != "updated_at"]
        assert sorted(map(repr, top.read().select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
        assert top.read().count() <= 9


def test_counters_count_a_repeated_batch_once(spark, scratch):
    import glob
    import os
    root = scratch("counters")
    rows = lambda reasons: spark.createDataFrame([(r,) for r in reasons], "reject_reason string")
    assert read_counters(spark, f"{root}/out").count() == 0
    for batch, want in (([None, None, "bad_price"], {"valid": 2, "bad_price": 1}), ([None, "bad_avro"], {"valid": 3, "bad_price": 1, "bad_avro": 1})):
        rows(batch).coalesce(1).write.mode("append").parquet(f"{root}/src")
        for _ in range(2):
            start_counters_query(spark.readStream.schema("reject_reason string").parquet(f"{root}/src"), f"{root}/out", f"{root}/ck",
                                 {"availableNow": True}).awaitTermination()
            assert {r.status: r.n for r in read_counters(spark, f"{root}/out").collect()} == want
            last = max(int(os.path.basename(f)) for f in glob.glob(f"{root}/ck/commits/[0-9]*"))
            for f in (f"{root}/ck/commits/{last}", f"{root}/ck/commits/.{last}.crc"):
                if os.path.exists(f):
                    os.remove(f)


def test_folders_appear_once_and_state_starts_from_before(spark, scratch):
    root = scratch("folders")
    calls = []
    write = lambda folder: (calls.append(folder), spark.range(3).write.mode("overwrite").parquet(folder))
    assert put_once(spark, f"{root}/t", "one", write) and not put_once(spark, f"{root}/t", "one", write)
    assert len(calls) == 1 and names(spark, f"{root}/t") == ["one"] and names(spark, f"{root}/none") == []
    with pytest.raises(Exception):
        put_once(spark, f"{root}/t", "two", lambda folder: (spark.range(2).write.parquet(folder), 1 / 0))
    assert names(spark, f"{root}/t") == ["one"]
    state = BatchState(spark, f"{root}/state", "id long")
    for n in range(4):
        before = state.before(n)
        state.put(before.unionByName(spark.range(n, n + 1)), n)
        state.put(spark.range(99), n)       # a repeated batch changes nothing
    assert sorted(r.id for r in state.read().collect()) == [0, 1, 2, 3] and len(names(spark, f"{root}/state")) == 2
    assert sorted(r.id for r in state.before(3).collect()) == [0, 1, 2]


