"""Run the quote stream job: topic -> raw table (append) + bars (upsert) [+ quarantine].

    spark-submit --py-files quotebars.zip quotebars/streaming/__main__.py --bootstrap host:9092 \\
        --topic market.quotes --raw-path s3a://lake/quotes_raw --bars-path s3a://lake/ohlcv_1m
    python -m quotebars.streaming --source-path /data/topic --raw-path ... --available-now

Checkpoints default to ``<spark.checkpoint.dir>/quotebars-stream/<topic>`` (one sub-folder per query).
With ``--bars-table`` the bars go to a catalog table through MERGE instead of the log.
"""

from __future__ import annotations

import argparse

from quotebars.schemas import WATERMARK_DELAY, WINDOW_DURATION
from quotebars.session import build_session, checkpoint_root
from quotebars.sources.ingest import src_kafka
from quotebars.sources.tables import BarStore, ddl_namespace, ddl_tables
from quotebars.streaming.app import multi_query_app


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quotebars.streaming", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap", help="Kafka bootstrap servers (needs the Kafka connector)")
    src.add_argument("--source-path", help="folder of topic-shaped parquet files (key, value, ...)")
    p.add_argument("--topic", default="market.quotes")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--max-offsets-per-trigger", type=int, default=None, help="Kafka: messages that a micro-batch reads at most")
    raw = p.add_mutually_exclusive_group(required=True)
    raw.add_argument("--raw-path", help="folder of the raw quotes")
    raw.add_argument("--raw-table", help="catalog table of the raw quotes (created if absent)")
    bars = p.add_mutually_exclusive_group(required=True)
    bars.add_argument("--bars-path", help="versioned upsert log folder")
    bars.add_argument("--bars-table", help="catalog table that supports MERGE")
    p.add_argument("--quarantine-path", default=None)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--window", default=WINDOW_DURATION)
    p.add_argument("--watermark", default=WATERMARK_DELAY)
    p.add_argument("--state-partitions", type=int, default=None,
                   help="state store partitions of the rollup (fixed at the first start)")
    p.add_argument("--table-format", default="iceberg", help="format of catalog tables that are created")
    p.add_argument("--writer-id", default=None, help="idempotency scope of bar batches (default: the checkpoint's own)")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> None:
    args = parse_args(argv)
    spark = spark or build_session(app_name="quotebars-stream")
    checkpoint = args.checkpoint or f"{checkpoint_root(spark)}/quotebars-stream/{args.topic}"

    def source():
        return src_kafka(spark, bootstrap=args.bootstrap, topic=args.topic,
                         starting_offsets=args.starting_offsets, path=args.source_path,
                         max_files_per_trigger=args.max_files_per_trigger,
                         max_offsets_per_trigger=args.max_offsets_per_trigger)

    for table in filter(None, (args.raw_table, args.bars_table)):
        if "." in table:
            ddl_namespace(spark, table.rpartition(".")[0])
    ddl_tables(spark, args.raw_table, args.bars_table, using=args.table_format)

    store = BarStore(spark, path=args.bars_path, table=args.bars_table, writer=args.writer_id)
    multi_query_app(spark, source, args.raw_path, store, checkpoint, window_duration=args.window,
                    delay=args.watermark, trigger={"availableNow": True} if args.available_now else None,
                    quarantine_path=args.quarantine_path, raw_table=args.raw_table, num_state_partitions=args.state_partitions)


if __name__ == "__main__":
    main()
