"""Incremental load: a file stream over the landing folder, merged batch by batch into a raw table.

A raw table lies in ``root/raw`` in parts: a season each where the keys have one, else
a hash of the keys. A batch writes new versions of the parts that it touches and leaves
the others alone; it reads versions below its own only. What couldn't be loaded goes
to ``root/dead_letters``, counts to ``root/outcomes``. The commit record comes last:
readers take what is committed, so a batch that breaks off changes nothing and is done
anew, and one that is committed is not done twice. Then versions that two newer ones
replace, and what broken batches left, are deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapforge.operators.extract import extract, parse_objects
from lapforge.operators.merge import dedupe_last, merge
from lapforge.operators.state import failures
from lapforge.sources import versions
from lapforge.sources.entities import ENTITIES
from lapforge.sources.lake import LANDED, newest_pages

BUCKETS, KEEP = 32, 2
_LETTERS = "id string, entity string, source_key string, error_detail string, fragment string, failed_at timestamp, resolved_at timestamp, batch long"
_OUTCOMES = "parsed long, inserted long, updated long, failed long, batch long"


def _raw_schema(entity: str) -> str:
    keys = ", ".join(f"{k} string" for k in ENTITIES[entity].grain)
    return f"{keys}, payload string, source_key string, ingested_at timestamp, updated_at timestamp, last_action string, version long, bucket string"


def part_of(keys: list[str]) -> Column:
    """Part of a raw table that a row is in: its season; without a usable one, a hash of its keys."""
    hashed = F.concat(F.lit("h"), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("string"))
    if "season" not in keys or len(keys) == 1:
        return hashed
    return F.coalesce(F.concat(F.lit("s"), F.col("season").try_cast("int").cast("string")), hashed)


def _parts(spark: SparkSession, root: str, entity: str, newest: dict[str, int]) -> DataFrame:
    paths = [f"{root}/raw/version={v}/bucket={b}" for b, v in sorted(newest.items())]
    return versions.read_or_empty(spark, _raw_schema(entity), *paths, base=f"{root}/raw")


def latest(spark: SparkSession, root: str, entity: str, seasons: list[int] | None = None) -> DataFrame:
    """The raw table as it is now, of some seasons only if they are given; empty before the first load."""
    newest = {b: p.versions[0] for b, p in versions.state(spark, root).items() if b is not None}
    if seasons is not None:
        newest = {b: v for b, v in newest.items() if not b.startswith("s") or int(b[1:]) in seasons}
    return _parts(spark, root, entity, newest).drop("version", "bucket", "last_action")


def load(spark: SparkSession, pages: DataFrame, root: str, entity: str, batch: int) -> None:
    """Merge pages into the raw table as version ``batch``, record dead letters and the outcome, commit.

    Batches come in order: one that isn't beyond the newest committed is done already.
    """
    known = versions.state(spark, root, KEEP)
    if batch <= versions.newest(known):
        return
    spec = ENTITIES[entity]
    held = f"{root}/pages/batch={batch}"
    pages.select("source_key", "value").repartition("source_key").write.mode("overwrite").parquet(held)  # what lies in many small files is opened once
    pages = spark.read.schema("source_key string, value string").parquet(held)
    docs, unread = parse_objects(pages)
    records, unkeyed = extract(spec, docs)
    records.write.mode("overwrite").parquet(f"{root}/parsed/batch={batch}")
    records = spark.read.schema(records.schema).parquet(f"{root}/parsed/batch={batch}")
    failures(unread.unionByName(unkeyed), entity, F.current_timestamp()).write.mode("overwrite").parquet(f"{root}/dead_letters/batch={batch}")
    pages.select("source_key").distinct().write.mode("overwrite").parquet(f"{root}/seen/batch={batch}")
    last = dedupe_last(records, spec.grain, ["source_key", "pos"]).withColumn("bucket", part_of(spec.grain))
    touched = [r[0] for r in last.select("bucket").distinct().collect()]
    if touched:
        target = _parts(spark, root, entity, {b: known[b].versions[0] for b in touched if b in known})
        merged = merge(target.drop("bucket", "version", "last_action"), last.drop("bucket"), spec.grain, F.current_timestamp())
        merged = merged.withColumnRenamed("_action", "last_action").withColumn("bucket", part_of(spec.grain))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/raw/version={batch}")
    mine = _parts(spark, root, entity, dict.fromkeys(touched, batch))
    counts = [mine.agg(*[F.count_if(F.col("last_action") == a).alias(f"{a}ed" if a == "insert" else f"{a}d") for a in ("insert", "update")])]
    letters = versions.read_or_empty(spark, _LETTERS, f"{root}/dead_letters/batch={batch}")
    counts += [records.agg(F.count("*").alias("parsed")), letters.agg(F.count("*").alias("failed"))]
    one = reduce(DataFrame.crossJoin, counts)
    one.select("parsed", "inserted", "updated", "failed").write.mode("overwrite").parquet(f"{root}/outcomes/batch={batch}")
    versions.commit(spark, root, batch, touched)
    versions.delete(spark, held)
    kept = {b: p.versions for b, p in known.items() if b is not None}
    versions.clean(spark, f"{root}/raw", "bucket", kept | {b: [batch, *kept.get(b, [])][:KEEP] for b in touched})


def _of_batches(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """What committed batches left under a name."""
    rows = versions.read_or_empty(spark, schema, f"{root}/{name}")
    done = versions.commits(spark, root).groupBy(F.col("version").alias("batch")).agg(F.max("committed_at").alias("committed_at"))
    return rows.join(F.broadcast(done), "batch")


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """parsed, inserted, updated, failed of each batch; rows that stayed as they were count in parsed only."""
    return _of_batches(spark, root, "outcomes", _OUTCOMES).drop("committed_at")


def dead_letters(spark: SparkSession, root: str, batch: int | None = None) -> DataFrame:
    """What couldn't be loaded, of one batch, or of all: then each failure once, as it was first met.

    A failure is resolved when its page is read again by a later batch without it.
    """
    rows = _of_batches(spark, root, "dead_letters", _LETTERS).drop("committed_at")
    if batch is not None:
        return rows.filter(F.col("batch") == batch)
    span = Window.partitionBy("id").orderBy("batch", "failed_at")
    once = rows.withColumns({"_rank": F.row_number().over(span), "_last": F.max("batch").over(Window.partitionBy("id"))}).filter("_rank = 1").drop("_rank")
    seen = _of_batches(spark, root, "seen", "source_key string, batch long").select("source_key", F.col("batch").alias("_again"), "committed_at")
    cured = once.join(seen, "source_key").filter("_again > _last").groupBy("id").agg(F.min("committed_at").alias("_cured"))
    return once.join(cured, "id", "left").withColumn("resolved_at", F.coalesce("resolved_at", "_cured")).select(*rows.columns)


def drop_replaced(spark: SparkSession, root: str, entity: str, keep: int = KEEP) -> int:
    """Delete versions of an entity's parts that at least ``keep`` newer ones replace, and what broken batches left; how many were deleted."""
    kept = {b: p.versions for b, p in versions.state(spark, root, keep).items() if b is not None}
    return versions.clean(spark, f"{root}/raw", "bucket", kept)


def stream_load(spark: SparkSession, lake_root: str, root: str, entity: str, checkpoint: str, pages: DataFrame | None = None) -> None:
    """Load what has landed since the last call, and stop. Running it again without new pages changes nothing.

    ``pages`` is another stream of pages, such as that of landed objects.
    """
    if pages is None:
        pages = spark.readStream.schema(LANDED).parquet(lake_root).filter(F.col("entity") == entity)

    def each(batch: DataFrame, number: int) -> None:
        load(spark, newest_pages(batch) if "landing" in batch.columns else batch, root, entity, number + 1)

    pages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replay(spark: SparkSession, pages: DataFrame, root: str, entity: str) -> None:
    """Rebuild a raw table from everything that has landed, day after day, in a root that holds none yet."""
    if not versions.commits(spark, root).isEmpty():
        raise ValueError(f"{root} holds a raw table already; rebuild in another folder")
    days = [r[0] for r in pages.select("ingestion_date").distinct().orderBy("ingestion_date").collect()]
    for k, day in enumerate(days):
        load(spark, pages.filter(F.col("ingestion_date") == day), root, entity, k + 1)
