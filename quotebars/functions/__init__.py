"""Column functions (JVM expressions)."""

from quotebars.functions.scalar import (day_volume_sum, default_source, double_text, ms_to_ts,
                                        normalize_symbols, price_fallback, tick_side, to_decimal, ts_to_ms,
                                        vwap_case)
