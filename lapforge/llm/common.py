"""Helpers that several operators share: shared storage, text batches, word splitting.

Every operator reads only the columns that it names, so further columns of the
input never matter. Where an operator adds columns, one of the same name is
replaced; where a stage returns the columns it was given, each comes back as it
was, whatever its name (``set_aside``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_CHARS = 4_000_000
#: Ids, of some 8 MB, up to which a list of rows to keep or drop is broadcast.
MOST_SHARED_IDS = 1_000_000


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    # freed arrays go back to the system at once, so that workers that are used again don't keep the peaks of former tasks
    env.setdefault("MALLOC_MMAP_THRESHOLD_", "4194304")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where it is unset and the session is local."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, where all that was made of it is written too, so that it takes no room until the job's end."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def picked(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose uid is (``left_semi``) or isn't (``left_anti``) in ``ids``, a table as read of one column of distinct numbers.

    A list of a checked size is broadcast, so that texts stay where they are; beyond it both sides are shuffled.
    """
    few = ids.count() <= MOST_SHARED_IDS
    return rows.join(F.broadcast(ids) if few else ids, "uid", how)


def remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def text_slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the length of its texts, so that working memory follows one slice."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bounds of each text in the tokens, token indices, distinct words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=ends[1:])
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        kept = np.zeros(len(full) + 1, dtype=np.int64)
        np.cumsum(full, out=kept[1:])
        ends = kept[ends]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return ends, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def give_back() -> None:
    """Return freed memory of Arrow and of malloc to the system, as a worker may be used again by tasks of another kind."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def appended(df: DataFrame, fields: list[T.StructField], work: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with columns computed from slices of its texts; same-named columns are replaced."""
    ready(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    schema = T.StructType([*kept.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *work(part)], names=[*part.schema.names, *(f.name for f in fields)])
        give_back()

    return kept.mapInArrow(run, schema)


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of the names that a stage needs for itself, or that aren't plain names, renamed, and what gives the columns of ``docs`` back from its result."""
    taken = {n.lower() for n in names}
    own = {c: f"_own_{k}" if c.lower() in taken or not c.isidentifier() else c for k, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    return renamed, lambda df: df.select(*[F.col(f"`{n}`").alias(c) for c, n in own.items()])


def window(text: str, chars: int) -> Column:
    """A text of over ``chars`` characters is cut to as many from a place that its hash chooses; others stay whole."""
    over = F.length(text) - F.lit(chars)
    place = F.pmod(F.xxhash64(F.col(text), F.lit(chars)), F.greatest(over, F.lit(0)).cast("long") + 1).cast("int")
    return F.when(over > 0, F.substring(F.col(text), place + 1, F.lit(chars))).otherwise(F.col(text))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
