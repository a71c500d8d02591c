"""Stored marts: tables written once and read by every served query."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a local session gets one of its own; a cluster none."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Store ``df`` as a table in ``path``, replacing what is there, and read it back.

    A ``path`` that ``df`` reads is refused. Readers see nothing while it is replaced:
    where they must, use versions (``lapforge.plans.build``). Columns of
    ``partition_by`` become folders, so that filters on them prune what is read.
    """
    bare = lambda p: "/" + p.split(":", 1)[-1].strip("/")
    if any(f"{bare(f)}/".startswith(f"{bare(path)}/") for f in df.inputFiles()):
        raise ValueError(f"the table reads what is in {path}; store it elsewhere")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_view(df: DataFrame, name: str) -> DataFrame:
    """Name ``df`` for SQL without storing it."""
    df.createOrReplaceTempView(name)
    return df
