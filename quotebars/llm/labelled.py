"""Which labelled rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str = "doc_id") -> Column:
    """Rows whose crc32 of the identifier, as text, leaves 1 when divided by 3 are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, target: str, key: str = "doc_id") -> DataFrame:
    """(id, label) of the rows to learn from: known identifiers, labels 0 or 1, one row each
    (the larger label where rows disagree)."""
    rows = labels.where(~held_out(key) & F.col(key).isNotNull() & F.col(target).isin(0, 1))
    return rows.groupBy(F.col(key).alias("id")).agg(F.max(target).cast("int").alias("label"))
