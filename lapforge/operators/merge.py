"""Change-aware merge of records into a raw table, and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions.exprs import canon


def dedupe_last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of the rows of each key, the last by ``order``."""
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")


def merge(target: DataFrame, incoming: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """New version of ``target`` with ``_action``: insert, update, noop or keep.

    Rows: keys, payload, source_key, ingested_at, updated_at. ``incoming`` has one
    row a key. Payloads are compared by content, not by key order or number format;
    an update moves source_key and updated_at only, a noop nothing.
    """
    old = target.select(*keys, F.col("payload").alias("t_payload"), F.col("source_key").alias("t_source"), "ingested_at", "updated_at", F.lit(True).alias("t"))
    new = incoming.select(*keys, F.col("payload").alias("i_payload"), F.col("source_key").alias("i_source"), F.lit(True).alias("i"))
    both = old.join(new, keys, "full")
    changed = ~canon("t_payload").eqNullSafe(canon("i_payload"))
    action = F.when(F.col("t").isNull(), "insert").when(F.col("i").isNull(), "keep").when(changed, "update").otherwise("noop")
    both = both.withColumn("_action", action)
    moved = F.col("_action").isin("insert", "update")
    return both.select(
        *keys, F.when(moved, F.col("i_payload")).otherwise(F.col("t_payload")).alias("payload"), F.when(moved, F.col("i_source")).otherwise(F.col("t_source")).alias("source_key"),
        F.coalesce("ingested_at", now).alias("ingested_at"), F.when(moved, now).otherwise(F.col("updated_at")).alias("updated_at"), "_action",
    )


def outcome(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("_action").isin("insert", "update")).groupBy("_action").count()


def amended(raw: DataFrame) -> DataFrame:
    """Rows that changed upstream after they were first loaded."""
    return raw.filter("updated_at > ingested_at")


def load_pattern(raw: DataFrame, entity: str, snapshot: bool = False) -> DataFrame:
    """How an entity behaves, from its amendment rate: immutable, mutable reference or snapshot. Without rows the rate is null."""
    rate = F.try_divide(F.count_if(F.col("updated_at") > F.col("ingested_at")), F.count("*"))
    kind = F.lit("snapshot") if snapshot else F.when(rate > 0, "mutable reference").otherwise("immutable")
    return raw.agg(F.lit(entity).alias("entity"), rate.alias("amendment_rate"), kind.alias("pattern"))
