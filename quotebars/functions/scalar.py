"""Column-level functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotebars.schemas import DECIMAL, DEFAULT_SOURCE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds (number or numeric string) -> UTC timestamp."""
    return F.timestamp_millis(_c(ms).cast("bigint"))


def ts_to_ms(ts) -> Column:
    """Timestamp -> epoch milliseconds as bigint (exact; sub-millisecond part is floored).

    NTZ input is read as UTC wall-clock (the session time zone is pinned to UTC)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def to_decimal(x) -> Column:
    """Exact decimal(38,8) from a string/number; NULL (not an error) when unparseable."""
    return _c(x).try_cast(DECIMAL)


_SCI = r"^(-?)(\d)\.(\d+)E(-?\d+)$"


def double_text(x) -> Column:
    """A double as text the way the producer writes it: shortest round-trip digits, plain
    notation for 1e-4 <= |x| < 1e16, otherwise 'd.ddde+XX' (e.g. 190.42 -> '190.42',
    1e7 -> '10000000.0', 0.00012 -> '0.00012', 1e16 -> '1e+16'). Spark's cast uses
    exponent notation from 1e7 and below 1e-3, so those forms are rebuilt from its digits."""
    t = _c(x).cast("string")
    sign = F.regexp_extract(t, _SCI, 1)
    lead = F.regexp_extract(t, _SCI, 2)
    frac = F.regexp_extract(t, _SCI, 3)
    exp = F.regexp_extract(t, _SCI, 4).cast("int")
    tail = F.when(frac == "0", F.lit("")).otherwise(frac)
    digits = F.concat(lead, tail)                       # significant digits
    n = F.length(digits)
    large = (F.when(n - 1 <= exp, F.concat(sign, digits, F.repeat(F.lit("0"), exp - n + 1), F.lit(".0")))
              .otherwise(F.concat(sign, F.substring(digits, F.lit(1), exp + 1), F.lit("."),
                                  F.substring(digits, exp + 2, n))))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    mantissa = F.concat(sign, lead, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("."), tail)))
    sci = F.concat(mantissa, F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(exp) < 10, F.concat(F.lit("0"), F.abs(exp).cast("string")))
                    .otherwise(F.abs(exp).cast("string")))
    return (F.when(t == "NaN", F.lit("nan"))
             .when(t == "Infinity", F.lit("inf"))
             .when(t == "-Infinity", F.lit("-inf"))
             .when(~t.rlike(_SCI), t)
             .when((exp >= 0) & (exp < 16), large)
             .when((exp < 0) & (exp >= -4), small)
             .otherwise(sci))


def default_source(src) -> Column:
    """Missing provenance falls back to the contract default."""
    return F.coalesce(_c(src), F.lit(DEFAULT_SOURCE))


def price_fallback(market_price, closes) -> Column:
    """Market price, else the last non-null close of the minute series, else NULL."""
    non_null = F.filter(_c(closes), lambda x: x.isNotNull())
    return F.coalesce(_c(market_price), F.try_element_at(non_null, F.lit(-1)))


def day_volume_sum(volumes) -> Column:
    """Sum of the non-null minute volumes as a bigint (0 when none; fractions are dropped from the sum)."""
    total = F.aggregate(
        F.filter(_c(volumes), lambda x: x.isNotNull()),
        F.lit(0).cast("decimal(38,6)"),
        lambda acc, x: (acc + x.cast("decimal(38,6)")).cast("decimal(38,6)"),
    )
    return total.cast("bigint")


def vwap_case(quote_volume, volume, close) -> Column:
    """VWAP = quote_volume / volume, falling back to close when nothing traded."""
    return F.when(_c(volume) > 0, _c(quote_volume) / _c(volume)).otherwise(_c(close))


def normalize_symbols(csv) -> Column:
    """'aapl, GOOG,,aapl' -> ['AAPL', 'GOOG']: trimmed, upper-case, non-empty, first-seen order."""
    parts = F.transform(F.split(_c(csv), ","), lambda s: F.upper(F.trim(s)))
    return F.array_distinct(F.filter(parts, lambda s: s != F.lit("")))


def tick_side(price, older_price) -> Column:
    """'up' when the tick is >= the next older one (or there is none), else 'down'."""
    return F.when(_c(older_price).isNull() | (_c(price) >= _c(older_price)), F.lit("up")).otherwise(F.lit("down"))
