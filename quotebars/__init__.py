"""quotebars: market-quote streams on Spark — decode, validate, increment, roll up, serve.

The main entry points, by task:

* rollup:      ``aggregate_ohlcv``, ``cast_quote_columns``
* sequences:   ``ordered_scan``, ``volume_increments``, ``increments_stateful``
* wire:        ``avro_encode_frame``, ``wire_unframe``, ``avro_decode``, ``read_framed_quotes``
* quality:     ``validate_quotes``, ``split_valid``, ``publish_counters``, ``allowlist_symbols``
* serving:     ``latest_bars``, ``latest_ticks``, ``topn_per_symbol``, ``tick_direction``, ...
* tables:      ``BarStore``, ``sink_raw_append``, ``sink_batch_append``, ``ddl_tables``
* streaming:   ``multi_query_app``, ``bars_stream``
"""

from quotebars.operators.increments import volume_increments
from quotebars.operators.quality import allowlist_symbols, publish_counters, split_valid, validate_quotes
from quotebars.operators.reconcile import backfill_bars, count_rows, late_rows_report, reconcile_counts
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.operators.sequence import ordered_scan
from quotebars.operators.serving import (close_series_summary, latest_bars, latest_bars_all, latest_price,
                                         latest_ticks, recent_bars, tick_direction, topn_per_symbol)
from quotebars.session import build_session, configure
from quotebars.sources.ingest import cast_quote_columns, normalize_quote, src_chart_json, src_kafka, to_quotes
from quotebars.sources.replay import sink_replay_snapshot, src_replay_snapshot
from quotebars.sources.tables import BarStore, ddl_namespace, ddl_tables, sink_batch_append, sink_raw_append
from quotebars.sources.topic import sink_bars_topic, sink_keyed_topic
from quotebars.sources.wire import avro_decode, avro_encode_frame, read_framed_quotes, wire_unframe
from quotebars.streaming.app import bars_stream, multi_query_app
from quotebars.streaming.increments_state import increments_stateful

__version__ = "0.1.0"
