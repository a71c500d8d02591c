"""Queries of this subpackage, by name; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapforge.llm import chat, divergence, language, maxent, mixing, neighbours, packing, runs, sharding, simhash, topk, toxicity, warc
from lapforge.llm.common import table

SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id"), "doc_id", SHARDS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.query(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(table(spark, sf_dir, "conversations"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.query(table(spark, sf_dir, "embeddings"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.query(table(spark, sf_dir, "embeddings"))


def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.query(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.query(table(spark, sf_dir, "documents"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.query(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.query(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_language": op4_language,
    "op5_chat": op5_chat,
    "op6_maxent": op6_maxent,
    "op7_packing": op7_packing,
    "op8_neighbours": op8_neighbours,
    "op9_topk": op9_topk,
    "op10_mixing": op10_mixing,
    "op11_divergence": op11_divergence,
    "op12_runs": op12_runs,
    "op13_warc": op13_warc,
}

#: DuckDB SQL of those that SQL can express.
ORACLES: dict[str, str] = {"op5_chat": chat.ORACLE, "op8_neighbours": neighbours.ORACLE, "op9_topk": topk.ORACLE, "op10_mixing": mixing.ORACLE, "op11_divergence": divergence.ORACLE, "op13_warc": warc.ORACLE}
