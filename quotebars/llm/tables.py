"""The benchmark tables these operators read, and small helpers that several share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of about ``max_bytes`` of text, each with its texts as
    UTF-8 (null: empty). One longer text makes a slice of its own. Only a slice's texts are made into
    Python objects, so the memory of a task follows the longest text and not the number of rows in a batch."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        begin = held = 0
        for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            if i > begin and held + size > max_bytes:
                yield batch.slice(begin, i - begin), _plain(texts.slice(begin, i - begin))
                begin, held = i, 0
            held += size
        if begin < len(texts):
            yield batch.slice(begin), _plain(texts.slice(begin))


def _plain(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.to_pylist()]


def record_batch(schema: pa.Schema, columns: list[Any]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` under generated column names, the generated name of each column, and the way back: it
    restores the names and leaves out what an operator has added, so no name of its own can clash."""
    plain = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*[quoted(c).alias(p) for c, p in plain.items()]), plain,
            lambda found: found.select(*[F.col(p).alias(c) for c, p in plain.items()]))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
