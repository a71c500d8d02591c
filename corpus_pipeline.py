"""The corpus pipeline: language, toxicity, near duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``. Null or empty texts:
the first stage rejects them, as no language is found. Repeated rows: the third
stage keeps one. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapforge.llm import language, mixing, packing, simhash, toxicity
from lapforge.llm.common import table, written


#: Bytes of rows that a task hands to Python at a time. The default of 64 MB of whole texts is held several times over, in the
#: executor's buffers and in Python, by every task of every stage.
BATCH = "4m"


def small_batches(spark: SparkSession) -> None:
    """A setting of the job, for this stage's plan and those after it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language.stage(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.stage(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.stage(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.stage(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.stage(docs)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned models and fingerprints have no SQL twin; the tests compare near copies with brute force and check cases of the other stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
