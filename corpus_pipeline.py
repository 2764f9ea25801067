"""The corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, personal data, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes every result as Parquet into the shared folder and reads it back as the next stage's
``docs``.  All stages but the last return the columns of ``documents``:

* quality: documents that fail the base rules or the trained verdict go;
* near_duplicates: of each group of documents linked by 5-word shingles at a similarity of
  80 % or more, the one with the smallest id stays;
* decontaminate: documents that hold at least 80 % of a benchmark item's 5-word shingles go;
* personal_data: spans of personal data and of terms that disclose it are replaced in the text,
  and n_chars follows the new text;
* byte_bpe: the ids of every text (packed, little-endian unsigned 32 bits) with their number.

No stage can be written as one SQL statement over the tables (trained verdict, generalised
terms, BPE merges), so ``ORACLE_SQL`` is None and the tests hold the run against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide.llm import byte_bpe, decontaminate, jaccard_join, quality, sanitise
from collide.llm.common import table
from collide.session import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.verdict(docs, model, out="__quality").where("__quality.kept").drop("__quality")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicated(docs, k=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitise.sanitised(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = byte_bpe.encode(docs)
    return ids.withColumn("n_tokens", byte_bpe.n_ids(F.col("ids")))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("personal_data", personal_data_stage),
    ("byte_bpe", byte_bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = shared_dir(spark, "llm", f"pipeline-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
