"""Per-key sequence scans: running sum and predecessor value, in window functions.

A key may hold a large part of all rows, and ``Window.partitionBy(key)`` puts them into one
task. ``ordered_scan`` therefore takes a ``block``: a column that never falls along the order
(the hour or day of the event time, say). Rows are scanned per (key, block); what a block needs
from those before it (their total and their last value) comes from one small row per block,
joined back. Nothing depends on the number of rows: there is one path with one arithmetic,
Spark's own. Sums never reach across keys, and an overflow raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLOCK, _TOTAL, _LAST = "_block", "_carry_total", "_carry_last"


def ordered_scan(df: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str,
                 running_sum: str | None = None, previous: str | None = None,
                 block: Column | None = None) -> DataFrame:
    """Add a per-group running sum and/or predecessor value of ``value_col``.

    Rows are ordered by ``order_cols`` inside each ``group_cols`` group; the order should be
    total (append a unique column) for a deterministic result. The running sum is inclusive and
    skips NULLs (NULL until the first non-NULL value, like SQL); ``previous`` is the value of the
    preceding row (NULL for the group's first row). A NULL key is a group like any other.

    ``block`` must not fall along the order; a NULL block comes first, as NULLs do. Without one
    a group is scanned in one piece, which suits keys that are bounded by themselves (a symbol's
    day). Rows of one block are scanned by one task, so choose blocks that a task can hold."""
    if not running_sum and not previous:
        raise ValueError("ask for running_sum and/or previous")
    vtype = df.schema[value_col].dataType
    if not isinstance(vtype, (T.LongType, T.IntegerType, T.ShortType, T.DoubleType, T.FloatType)):
        raise TypeError(f"{value_col}: ordered_scan works on integer or floating columns, got {vtype}")
    out_type = T.DoubleType() if isinstance(vtype, (T.DoubleType, T.FloatType)) else T.LongType()
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    keys = list(group_cols)
    rows = df
    if block is not None:
        rows = df.withColumn(_BLOCK, block)
        keys.append(_BLOCK)
    window = Window.partitionBy(*keys).orderBy(*order)
    total = F.sum(value_col).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.lag(value_col).over(window)
    kept = [F.col(f.name) for f in df.schema.fields]
    if block is None:
        return rows.select(*kept, *([total.cast(out_type).alias(running_sum)] if running_sum else []),
                           *([before.cast(out_type).alias(previous)] if previous else []))

    carry = _carries(rows, group_cols, order_cols, value_col)
    first = F.row_number().over(window) == 1
    local = rows.select("*", total.alias("_total"), before.alias("_before"), first.alias("_first"))
    same = [local[c].eqNullSafe(carry[f"_k{i}"]) for i, c in enumerate(keys)]
    joined = local.join(carry, same, "left")
    summed = (F.when(F.col(_TOTAL).isNull(), F.col("_total")).when(F.col("_total").isNull(), F.col(_TOTAL))
              .otherwise(F.col(_TOTAL) + F.col("_total")))
    came = F.when(F.col("_first"), F.col(_LAST)).otherwise(F.col("_before"))
    return joined.select(*[local[f.name] for f in df.schema.fields],
                         *([summed.cast(out_type).alias(running_sum)] if running_sum else []),
                         *([came.cast(out_type).alias(previous)] if previous else []))


def _carries(rows: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str) -> DataFrame:
    """For each (key, block) that is not its key's first: the total of the blocks before, and the
    value of the last row before. One row per block; partial aggregates before the shuffle."""
    place = F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")).alias(f"o{i}") for i, c in enumerate(order_cols)])
    blocks = rows.groupBy(*group_cols, _BLOCK).agg(F.sum(value_col).alias("_sum"), F.max_by(F.struct(value_col), place).alias("_end"))
    along = Window.partitionBy(*group_cols).orderBy(F.col(_BLOCK).asc_nulls_first())
    found = blocks.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group_cols, _BLOCK])],
        F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias(_TOTAL),
        F.lag("_end").over(along).alias("_end"))
    return found.where(F.col("_end").isNotNull()).select("*", F.col(f"_end.{value_col}").alias(_LAST)).drop("_end")
