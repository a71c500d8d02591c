"""Commit records: which versions of a stored table count. They are written last and read first.

A record is one small file that appears by a rename, so a version is there whole or
not at all: what a crash leaves half written is never read, and is removed later.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "version long, part string, committed_at timestamp"


def read_or_empty(spark: SparkSession, schema: str, *paths: str, base: str | None = None) -> DataFrame:
    """Parquet in ``paths``; no rows where there are none yet."""
    if not paths:
        return spark.createDataFrame([], schema)
    try:
        reader = spark.read.schema(schema)
        return (reader if base is None else reader.option("basePath", base)).parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """version, part, committed_at; a version without parts has one row with a null part."""
    return read_or_empty(spark, _COMMIT, f"{root}/commits")


def commit(spark: SparkSession, root: str, version: int, parts: list[str], at: Column | None = None) -> None:
    """``at``: the time that the version stands for, now if it isn't given."""
    rows = spark.createDataFrame([(version, p) for p in parts or [None]], "version long, part string")
    rows.withColumn("committed_at", F.current_timestamp() if at is None else at).coalesce(1).write.mode("append").parquet(f"{root}/commits")


@dataclass
class Part:
    """The newest committed versions of a part, newest first, and the time that the newest stands for."""

    versions: list[int]
    at: datetime


def state(spark: SparkSession, root: str, keep: int = 2) -> dict[str | None, Part]:
    """What is committed, part by part, up to ``keep`` versions each: as many entries as the table has parts.

    Versions without parts are under None.
    """
    newest = F.slice(F.sort_array(F.collect_set("version"), asc=False), 1, keep)
    rows = commits(spark, root).groupBy("part").agg(newest.alias("versions"), F.max("committed_at").alias("at"))
    return {r["part"]: Part(list(r["versions"]), r["at"]) for r in rows.collect()}


def newest(known: dict[str | None, Part]) -> int:
    """Greatest committed version; 0 before the first."""
    return max((p.versions[0] for p in known.values()), default=0)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system that it is in; whether it was there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(where)] if store.exists(where) else []


def part_path(data: str, version: int, column: str | None, part: str) -> str:
    return f"{data}/version={version}" + ("" if column is None else f"/{column}={part}")


def clean(spark: SparkSession, data: str, column: str | None, kept: dict[str, list[int]]) -> int:
    """Delete versions of parts in ``data`` that are older than the newest of ``kept`` and not in it: replaced ones, and
    what was written but never committed; how many were deleted.

    ``column`` is what folders of parts are named by, None where there is one part only. Only what lies there is looked at.
    """
    deleted = 0
    for folder in children(spark, data):
        if not folder.startswith("version="):
            continue
        number = int(folder.removeprefix("version="))
        parts = ["all"] if column is None else [n.removeprefix(f"{column}=") for n in children(spark, f"{data}/{folder}") if n.startswith(f"{column}=")]
        last = max((v[0] for v in kept.values()), default=0)
        gone = [p for p in parts if number not in kept.get(p, []) and number < (kept[p][0] if p in kept else last)]
        deleted += sum(delete(spark, part_path(data, number, column, p)) for p in gone)
        if len(gone) == len(parts) and number < last:
            delete(spark, f"{data}/{folder}")
    return deleted


def stamp(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of every file in a folder or of a file: what changes when its rows do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    out: list[tuple[str, int, int]] = []
    for s in store.listStatus(where) if store.exists(where) else []:
        out += stamp(spark, s.getPath().toString()) if s.isDirectory() else [(s.getPath().getName(), s.getLen(), s.getModificationTime())]
    return tuple(sorted(out))
