"""Validation, quarantine split, counters and the symbol allow-list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.functions.scalar import to_decimal

# Quarantine reasons, in the order they are checked.
REASONS = ("null_value", "short_frame", "bad_magic", "bad_avro", "null_symbol",
           "bad_price", "bad_volume", "negative_volume", "null_quote_time")
VALID = "valid"


def reject_reason(df: DataFrame) -> Column:
    """First failing check of a decoded wire quote, NULL when the row is valid.

    Frame-level reasons come from a ``decode_error`` column when present (set by the
    wire decoder); field checks follow the contract: symbol present, price and volume
    parse as decimals, volume >= 0, quote_time present."""
    checks = []
    if "decode_error" in df.columns:
        checks.append((F.col("decode_error").isNotNull(), F.col("decode_error")))
    price = to_decimal("price")
    volume = to_decimal("volume")
    checks += [
        (F.col("symbol").isNull() | (F.trim(F.col("symbol")) == ""), F.lit("null_symbol")),
        (price.isNull(), F.lit("bad_price")),
        (volume.isNull(), F.lit("bad_volume")),
        (volume < 0, F.lit("negative_volume")),
        (F.col("quote_time").isNull(), F.lit("null_quote_time")),
    ]
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, reason) if expr is None else expr.when(cond, reason)
    return expr


def validate_quotes(df: DataFrame) -> DataFrame:
    """Tag every row with ``reject_reason`` (NULL = valid). Never fails on a bad row."""
    return df.withColumn("reject_reason", reject_reason(df))


def split_valid(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the tag, quarantined rows with their reason)."""
    valid = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    quarantine = tagged.where(F.col("reject_reason").isNotNull())
    return valid, quarantine


def publish_counters(tagged: DataFrame) -> DataFrame:
    """Batch counters: rows per outcome (``valid`` or the reject reason)."""
    return (tagged.groupBy(F.coalesce(F.col("reject_reason"), F.lit(VALID)).alias("status"))
                  .agg(F.count(F.lit(1)).alias("n")))


def observe_counters(tagged: DataFrame, name: str = "quality") -> DataFrame:
    """Streaming counters: attach ``sent``/``dropped`` metrics to each micro-batch
    (read them from ``query.lastProgress['observedMetrics']`` or a listener)."""
    return tagged.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("sent"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("dropped"),
    )


def parse_allowlist(csv: str) -> list[str]:
    """Driver-side form of ``normalize_symbols`` for a configuration string."""
    seen: dict[str, None] = {}
    for part in (csv or "").split(","):
        s = part.strip().upper()
        if s:
            seen.setdefault(s, None)
    return list(seen)


def allowlist_symbols(df: DataFrame, allowed, symbol_col: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected) by upper-cased symbol against the allow-list.

    ``allowed`` is a configuration list (bounded by its own length), so it is applied as
    an ``isin`` literal set: no join, no shuffle. Accepted rows carry the upper-cased
    symbol; rejected rows carry ``allowed`` for the error message."""
    allowed, tagged = tag_allowed(df, allowed, symbol_col)
    accepted = tagged.where("_accepted").drop("_accepted")
    rejected = tagged.where(~F.col("_accepted")).withColumn(symbol_col, F.col("_given")).withColumn(
        "allowed", F.array(*[F.lit(s) for s in allowed]) if allowed else F.array().cast("array<string>"))
    return accepted.drop("_given"), rejected.drop("_accepted", "_given")


def tag_allowed(df: DataFrame, allowed, symbol_col: str = "symbol") -> tuple[list[str], DataFrame]:
    """The allow-list, and every row with its symbol in upper case, the symbol as ``_given`` and
    ``_accepted``: for uses that need both outcomes from one pass."""
    allowed = parse_allowlist(",".join(allowed)) if not isinstance(allowed, str) else parse_allowlist(allowed)
    sym = F.upper(F.col(symbol_col))
    hit = F.coalesce(sym.isin(allowed), F.lit(False)) if allowed else F.lit(False)
    return allowed, df.select("*", F.col(symbol_col).alias("_given"), hit.alias("_accepted")).withColumn(symbol_col, sym)
