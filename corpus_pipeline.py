"""The corpus pipeline: from ``documents`` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns
a DataFrame; its result is written as Parquet to the shared folder and read again for the next.
All stages but the last return the columns of their input, whatever their names, as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.llm.decontam import decontaminate
from quotebars.llm.exact_dedup import exact_dedup
from quotebars.llm.near_dedup import near_dedup
from quotebars.llm.piece_bpe import round_trip
from quotebars.llm.quality import keep_good
from quotebars.llm.tables import set_apart, table
from quotebars.session import scratch_dir, ship_package

PIECE_MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least a half)."""
    ship_package(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space aside): the longest, then the first."""
    ship_package(spark)
    plain, names, back = set_apart(docs)
    return back(exact_dedup(plain, names["doc_id"], names["text"]).where("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each component linked by a Jaccard similarity of at
    least 0.8 on shingles of five words."""
    ship_package(spark)
    return near_dedup(docs, size=5, share=(80, 100))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty is in a benchmark passage; they stay as they are."""
    ship_package(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): ids with an end id, joined by a blank, and a digest
    of the text that they decode to."""
    ship_package(spark)
    rows = round_trip(docs.select("doc_id", "text"), public_tokenizers.path(PIECE_MODEL))
    return rows.select("doc_id", (F.length("ids") - F.length(F.translate("ids", " ", "")) + 1).cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("tokens", tokens)]

#: a classifier, exact similarity joins and a tokenizer are beyond SQL; the stages are tested
#: against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
