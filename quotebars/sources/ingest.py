"""Inputs: the quotes topic (Kafka or a same-shaped file stream), vendor chart payloads,
raw poll records -> wire quotes -> canonical quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.functions.scalar import (day_volume_sum, default_source, double_text, ms_to_ts,
                                        price_fallback, to_decimal)
from quotebars.schemas import DEFAULT_SOURCE, KAFKA_ROW, QUOTE


def src_kafka(spark: SparkSession, bootstrap: str | None = None, topic: str = "market.quotes",
              starting_offsets: str = "latest", path: str | None = None,
              max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
              options: dict | None = None) -> DataFrame:
    """Streaming quotes topic. With ``bootstrap`` it subscribes via the Kafka source
    (needs the Kafka connector on the classpath); with ``path`` it reads parquet files
    holding the same columns (key, value, topic, partition, offset, timestamp).
    ``max_offsets_per_trigger`` / ``max_files_per_trigger`` bound a micro-batch; ``options``
    are further options of the source (start timestamps, minimum partitions, security)."""
    if bootstrap:
        return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, starting_offsets, max_offsets_per_trigger, options)).load()
    if not path:
        raise ValueError("give either a Kafka bootstrap address or a file path")
    reader = spark.readStream.schema(KAFKA_ROW).option("recursiveFileLookup", "true")     # a folder for each publish
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                  options: dict | None = None) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out | {k: str(v) for k, v in (options or {}).items()}


def normalize_quote(raw: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Raw poll record (symbol, price double, volume long, day_volume long,
    quote_time_ms) -> wire quote: price as the shortest round-trip text of the double,
    volume as integer text, UTC timestamps, ingest_time = quote_time, ``source`` stamped."""
    qt = ms_to_ts("quote_time_ms")
    return raw.select(
        F.col("symbol"),
        double_text(F.col("price").cast("double")).alias("price"),
        F.col("volume").cast("bigint").cast("string").alias("volume"),
        F.col("day_volume").cast("bigint").alias("day_volume"),
        qt.alias("quote_time"),
        qt.alias("ingest_time"),
        default_source(F.lit(source)).alias("source"),
    )


def cast_quote_columns(wire: DataFrame) -> DataFrame:
    """On-wire price and volume text -> decimal(38,8). Text that is no number becomes NULL, so
    one bad row never fails a job; ``validate_quotes`` gives such rows a reason."""
    return wire.withColumns({c: to_decimal(c) for c in ("price", "volume")})


def to_quotes(wire: DataFrame, keep=()) -> DataFrame:
    """Wire quote (strings) -> canonical quote of the QUOTE contract; unparseable -> NULL.
    ``keep`` carries extra columns through (e.g. the frame's ``schema_id``)."""
    made = cast_quote_columns(wire).withColumn("source", default_source(F.col("source")))
    return made.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUOTE.fields])


_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"
_RESULT = "$.chart.result[0]"


def _number(value: Column, kind: str) -> Column:
    """A JSON number as ``kind``; NULL for anything else (text, truth values, objects) and beyond its range."""
    return F.when(F.schema_of_variant(value).rlike(_NUMBER), F.try_variant_get(value, "$", kind))


def _numbers(doc: Column, path: str, kind: str) -> Column:
    """The numbers of the array at ``path``, others as NULL; empty if there is no array."""
    found = F.transform(F.try_variant_get(doc, path, "array<variant>"), lambda x: _number(x, kind))
    return F.coalesce(found, F.array().cast(f"array<{kind}>"))


def src_chart_json(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Vendor chart payload -> price (market price, else last non-null close) and
    day_volume (sum of non-null minute volumes). Rows with no price at all get
    ``reject_reason = 'no_price'`` instead of failing the job.

    The document is taken as it comes: a field of another kind than expected (text where a number
    belongs, an object that is none) is missing, and the others stay. Text that is no JSON, or repeats
    a key, has no fields at all."""
    doc = F.try_parse_json(F.col(payload_col))
    market = _number(F.try_variant_get(doc, f"{_RESULT}.meta.regularMarketPrice", "variant"), "double")
    quote = f"{_RESULT}.indicators.quote[0]"
    price = price_fallback(market, _numbers(doc, f"{quote}.close", "double"))
    volume = day_volume_sum(_numbers(doc, f"{quote}.volume", "decimal(38,6)"))
    keep = [c for c in payloads.columns if c != payload_col]
    return payloads.select(
        *keep,
        price.alias("price"),
        volume.alias("day_volume"),
        F.when(price.isNull(), F.lit("no_price")).alias("reject_reason"),
    )
