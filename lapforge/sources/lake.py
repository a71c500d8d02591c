"""Landing zone: deterministic keys, idempotent writes page by page, scoped reads, page audit.

Pages are landed in either of two forms: rows of a parquet table in folders of entity
and day, as many files a landing as tasks write it, or JSON objects, one a page, under
their lake keys.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapforge.functions.exprs import txt, variant
from lapforge.sources.entities import EntitySpec

PAGE = "entity string, ingestion_date date, scope string, offset int, value string, source_key string"
#: Pages as they lie in the landed table: a page is there once for each time that it landed.
LANDED = f"{PAGE}, landing long"


def scope_label(season: Column | None = None, round_: Column | None = None) -> Column:
    """Part of a lake key: all, a season, or a race of a season (rounds padded, so that text order is order)."""
    if season is None:
        return F.lit("all")
    if round_ is None:
        return F.concat(F.lit("season="), season.cast("string"))
    return F.concat(F.lit("season="), season.cast("string"), F.format_string("_round=%02d", round_.cast("int")))


def spec_label(spec: EntitySpec, season: Column | None = None, round_: Column | None = None) -> Column:
    """Label of one request of an entity, by its scope: a season or round that the scope doesn't have is ignored."""
    if spec.scope == "global":
        return scope_label()
    return scope_label(season, round_ if spec.scope == "race" else None)


def lake_key(entity: Column, label: Column, offset: Column, day: Column) -> Column:
    """Key of a page; offsets have five digits at least, more where they need them."""
    name = F.concat(entity, F.lit("_"), label, F.format_string("_offset=%05d.json", offset.cast("long")))
    return F.concat_ws("/", entity, day.cast("string"), name)


def land_pages(pages: DataFrame, root: str) -> None:
    """Add pages (entity, ingestion_date, scope, offset, value) to the landed table.

    Landing a page again replaces it for readers and leaves the other pages of its
    scope alone; another day adds one. Landings are numbered by the clock of the driver.
    """
    key = lake_key(F.col("entity"), F.col("scope"), F.col("offset"), F.col("ingestion_date"))
    (pages.withColumns({"source_key": key, "landing": F.lit(time.time_ns())}).write.partitionBy("entity", "ingestion_date").mode("append").parquet(root))


def newest_pages(pages: DataFrame) -> DataFrame:
    """Of each page (``LANDED``) what landed last."""
    last = Window.partitionBy("source_key").orderBy(F.desc("landing"), F.desc("value"))
    return pages.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank", "landing")


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All landed pages, of every entity and day."""
    return newest_pages(spark.read.schema(LANDED).parquet(root))


def read_lake(spark: SparkSession, root: str, entity: str, day: str, season: int | None = None, round_: int | None = None) -> DataFrame:
    """Landed pages of an entity and day; without a round, every round of the season.

    Only the folder of the entity and day is listed. Nothing landed: no rows.
    """
    try:
        pages = spark.read.schema(LANDED).option("basePath", root).parquet(f"{root}/entity={entity}/ingestion_date={day}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], PAGE)
    if season is not None:
        label = f"season={season}" + ("" if round_ is None else f"_round={round_:02d}")
        exact = F.col("scope") == label
        pages = pages.filter(exact if round_ is not None else exact | F.col("scope").startswith(f"{label}_round="))
    return newest_pages(pages)


def put_objects(pages: DataFrame, root: str) -> int:
    """Write each page (entity, ingestion_date, scope, offset, value) as an object under its lake key; how many were written.

    Tasks put the objects they hold. An object appears by a move, so a reader sees it
    whole or not at all; putting it again replaces it. Keys must be distinct.
    """
    key = lake_key(F.col("entity"), F.col("scope"), F.col("offset"), F.col("ingestion_date"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath

        from pyarrow import fs, record_batch

        store, folder = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)
        made: set[str] = set()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = posixpath.join(folder, name)
                within = posixpath.dirname(place)
                draft = posixpath.join(within, "." + posixpath.basename(place))
                if within not in made:
                    store.create_dir(within, recursive=True)
                    made.add(within)
                with store.open_output_stream(draft, compression=None) as out:
                    out.write((value or "").encode())
                store.move(draft, place)
            yield record_batch({"objects": [batch.num_rows]})

    return pages.select(key.alias("source_key"), "value").mapInArrow(put, "objects long").agg(F.coalesce(F.sum("objects"), F.lit(0))).first()[0]


#: Place of a landed object under the root: entity, day, and a name of entity, scope and offset.
_OBJECT = r"([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/([^/]+)_offset=([0-9]+)\.json$"


def _objects(files: DataFrame) -> DataFrame:
    """Pages from whole files, placed by where they lie."""
    return _placed(files, F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def _placed(rows: DataFrame, path: Column) -> DataFrame:
    part = lambda k: F.regexp_extract(path, _OBJECT, k)
    scope = F.substr(part(3), F.length(part(1)) + 2)
    key = F.regexp_extract(path, r"([^/]+/[^/]+/[^/]+)$", 1)
    return rows.select(part(1).alias("entity"), part(2).try_cast("date").alias("ingestion_date"), scope.alias("scope"), part(4).try_cast("int").alias("offset"), "value", key.alias("source_key"))


def read_objects(spark: SparkSession, root: str, entity: str, day: str = "*", season: int | None = None, round_: int | None = None) -> DataFrame:
    """Landed JSON objects of an entity, one row each, whatever their size: of one day or of all, of a season with
    all its rounds or of one round.

    Only the entity's folders are listed and only files of the scope are opened. An
    object that isn't JSON is a row like others; the parse tells. Objects of no bytes
    are left out by Spark's readers: ``empty_objects`` has them. Nothing landed: no rows.
    """
    label = "" if season is None else f"season={season}_" + ("" if round_ is None else f"round={round_:02d}_")
    try:
        files = spark.read.option("pathGlobFilter", f"{entity}_{label}*offset=*.json").text(f"{root}/{entity}/{day}", wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], PAGE)
    return _objects(files)


def empty_objects(spark: SparkSession, root: str, entity: str, day: str) -> DataFrame:
    """Objects of an entity and day that have no bytes, as pages of empty text: what is to be dead-lettered, not missed."""
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)
    found = store.get_file_info(fs.FileSelector(f"{folder.rstrip('/')}/{entity}/{day}", allow_not_found=True))
    names = [f.base_name for f in found if f.size == 0 and f.base_name.endswith(".json") and not f.base_name.startswith(".")]
    rows = spark.createDataFrame([(f"{entity}/{day}/{n}",) for n in names], "source_key string").withColumn("value", F.lit(""))
    return _placed(rows, F.col("source_key"))


def stream_objects(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Objects of an entity as a stream: each that lands is read once."""
    reader = spark.readStream.option("pathGlobFilter", f"{entity}_*offset=*.json").option("wholetext", True)
    return _objects(reader.text(f"{root}/{entity}/*"))


def page_meta(pages: DataFrame, value: str = "value", limit: Column | None = None, offset: Column | None = None) -> DataFrame:
    """Add total, limit, offset as ints. Text that is none gets 0, the requested limit (-1 if not given) and offset (0)."""
    doc = variant(value)
    number = lambda name, default: F.coalesce(txt(doc, f"MRData.{name}").try_cast("int"), default)
    asked = {"limit": F.lit(-1) if limit is None else limit, "offset": F.lit(0) if offset is None else offset}
    return pages.withColumns({"total": number("total", F.lit(0)), **{name: number(name, default) for name, default in asked.items()}})


def audit_pages(pages: DataFrame, by: list[str]) -> DataFrame:
    """Status of each scope of pages (total, limit, offset): complete, incomplete or invalid, and the first missing offset.

    Offsets must advance by the reported limit until the total is reached; a limit of 0 or less is invalid.
    """
    upto = Window.partitionBy(*by).orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("offset") + F.col("limit")).over(upto), F.lit(0))
    gaps = pages.withColumn("reached", reached).withColumn("gap", F.when(F.col("offset") > F.col("reached"), F.col("reached")))
    end = F.max(F.col("offset") + F.col("limit"))
    out = gaps.groupBy(*by).agg(F.min("gap").alias("gap"), end.alias("end"), F.max("total").alias("total"), F.min("limit").alias("least"))
    missing = F.coalesce("gap", F.when(F.col("end") < F.col("total"), F.col("end")))
    status = F.when(F.col("least") <= 0, "invalid").when(missing.isNotNull(), "incomplete").otherwise("complete")
    return out.select(*by, status.alias("status"), F.when(F.col("least") > 0, missing).alias("missing_from"))
