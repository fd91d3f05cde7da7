"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared checkpoint folder
and reads it again as the next stage's docs. All but the last return the columns of documents, whatever further columns docs
has. No stage fails on nulls, empty or very long texts, repeated rows or an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import decontamination, packing, quality_rules, secrets, simhash
from quillmill.llm.common import checkpoint_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep. Null, empty and short texts go; ties (a quality equal to the threshold)
    are kept; repeated rows share one verdict."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id, null doc_ids last; ties by the text's hash,
    then by that of the other columns. Null, empty and blank texts are one group; of repeated rows one stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts have none; repeated rows share one verdict."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced and n_chars counted anew where they were. A null text stays null."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence. A null or empty text is one piece, the end token; repeated rows
    are packed as often as they occur."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate), ("secret_scans", redact), ("best_fit_packing", pack)]

#: The posteriors, MinHashes and token ids have no SQL form; a test compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; a table of documents without rows gives none."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
