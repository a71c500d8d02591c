"""Profiling of landed JSON, join coverage, and changes of names behind an id."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.functions.exprs import value_kind, variant
from lapforge.plans.store import ready

#: Distinct values of a field that are listed at most, and its samples.
MOST_VALUES, SAMPLES = 30, 3
_DDL = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}


def _lists(kind: T.DataType, path: str = "") -> list[str]:
    """Dotted paths of lists of objects in a schema; ``[]`` marks a list on the way."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in _lists(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return [path, *_lists(kind.elementType, f"{path}[]")]
    return []


def _depth(kind: T.DataType) -> int:
    """Containers within each other in a schema."""
    if isinstance(kind, T.StructType):
        return 1 + max((_depth(f.dataType) for f in kind), default=0)
    return 1 + _depth(kind.elementType) if isinstance(kind, T.ArrayType) else 0


def _shape(docs: DataFrame, column: str) -> str:
    return docs.agg(F.schema_of_variant_agg(variant(column))).first()[0] or "OBJECT<>"


def infer(docs: DataFrame, column: str = "value") -> T.StructType:
    """Schema of the JSON documents in ``column``, merged over all of them; nulls and mixed values count as text."""
    return _schema(_shape(docs, column))


def _schema(shape: str) -> T.StructType:
    # a name ends in a colon; only types are translated
    ddl = re.sub(r"(`(?:[^`]|``)*`|\w+)(\s*:)?", lambda m: m[0] if m[2] else _DDL.get(m[1], m[1]), shape)
    kind = T.DataType.fromDDL(ddl)
    return kind if isinstance(kind, T.StructType) else T.StructType()


def _field(record: Column, path: str) -> Column:
    for name in path.strip(".").split("."):
        record = record.getField(name)
    return record


def collect_records(docs: DataFrame, schema: T.StructType, path: str, column: str = "value") -> DataFrame:
    """One row (``record``) for each object in the lists at ``path``."""
    rows = docs.select(F.from_json(column, schema).alias("record"))
    for part in path.split("[]"):
        rows = rows.select(F.explode(_field(F.col("record"), part)).alias("record"))
    return rows.filter("record is not null")


def _objects(record: Column, parts: list[str]) -> Column:
    """Number of objects in the lists at a path in one record."""
    inside = F.coalesce(_field(record, parts[0]), F.array())
    if len(parts) == 1:
        return F.size(F.filter(inside, lambda x: x.isNotNull())).cast("long")
    return F.aggregate(inside, F.lit(0).cast("long"), lambda n, x: n + _objects(x, parts[1:]))


def record_lists(docs: DataFrame, column: str = "value") -> DataFrame:
    """path, records: every list of objects in the corpus with the number of its objects, counted in one pass."""
    schema = infer(docs, column)
    paths = _lists(schema)
    if not paths:
        return docs.sparkSession.createDataFrame([], "path string, records long")
    rows = docs.select(F.from_json(column, schema).alias("record"))
    counts = rows.agg(*[F.coalesce(F.sum(_objects(F.col("record"), p.split("[]"))), F.lit(0)).alias(f"n{k}") for k, p in enumerate(paths)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"n{k}").alias("records")) for k, p in enumerate(paths)])).alias("x")).select("x.*")


def grain_path(lists: DataFrame, expected: int) -> DataFrame:
    """The list with the expected number of records (fewest nestings, dots, letters), else the deepest, as a guess."""
    depth, dots = F.length(F.regexp_replace("path", r"[^\[]", "")), F.length(F.regexp_replace("path", r"[^.]", ""))
    hit = F.col("records") == expected
    order = [hit.desc(), F.when(hit, depth).otherwise(-depth), F.when(hit, dots).otherwise(-dots), F.length("path"), F.col("path")]
    return lists.orderBy(*order).limit(1).select("path", "records", (~hit).alias("guess"))


def _children(entry: Column) -> Column:
    """What is directly inside an entry: fields with their paths, or items of a list; null for a value."""
    path, value = entry["path"], entry["value"]
    fields = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda e: F.struct(F.when(path == "", e["key"]).otherwise(F.concat_ws(".", path, e["key"])).alias("path"), e["value"].alias("value"), F.lit(False).alias("item")),
    )
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.struct(F.concat(path, F.lit("[]")).alias("path"), x.alias("value"), F.lit(True).alias("item")))
    return F.coalesce(fields, items)


def _entries(rows: DataFrame, record_id: str, json: str) -> DataFrame:
    """record_id, entries (path, value) of JSON objects, gathered level by level inside the row: documents are neither exploded nor read again for a level."""
    shape = _shape(rows, json)
    depth = _depth(_schema(shape))
    kind = "array<struct<path: string, value: variant, item: boolean>>"
    now = rows.select(record_id, F.array(F.struct(F.lit("").alias("path"), variant(json).alias("value"), F.lit(True).alias("item"))).cast(kind).alias("_0"))
    level = 0
    while True:
        while level < depth:
            opened = F.transform(f"_{level}", lambda e: F.coalesce(_children(e), F.array().cast(kind)))
            now, level = now.withColumn(f"_{level + 1}", F.flatten(opened)), level + 1
        # where values of unlike kinds share a place, the schema doesn't tell how deep they are
        last = F.exists(f"_{level}", lambda e: F.coalesce(F.schema_of_variant(e["value"]).rlike("^(OBJECT|ARRAY)"), F.lit(False)))
        if "VARIANT" not in shape or now.filter(last).isEmpty():
            break
        depth += 1
    found = F.filter(F.concat(*[F.col(f"_{k}") for k in range(1, level + 1)]) if level else F.array().cast(kind), lambda e: ~e["item"])
    return now.select(record_id, found.alias("entries"))


def flatten(rows: DataFrame, record_id: str, json: str) -> DataFrame:
    """record_id, path, value (variant): all fields of JSON objects at any depth, containers included.

    ``[]`` in a path marks a list whose objects are descended into; items of a list
    that aren't objects have no path of their own.
    """
    return _entries(rows, record_id, json).select(record_id, F.explode("entries").alias("e")).select(record_id, "e.path", "e.value")


_PARTIAL = "path string, kind string, n long, present long, texts array<string>"


def _smallest(seen: pa.Table) -> pa.Table:
    """Of distinct (path, text) rows the ``MOST_VALUES + 1`` smallest texts of each path."""
    seen = seen.group_by(["path", "text"]).aggregate([]).select(["path", "text"]).sort_by([("path", "ascending"), ("text", "ascending")])
    path = seen.column("path").combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]])) if len(path) else np.zeros(0, int)
    place = np.arange(len(path)) - np.repeat(first, np.diff(np.append(first, len(path))))
    return seen.filter(pa.array(place <= MOST_VALUES))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the fields that pass through a task: counts by path and kind, and each path's smallest values, never more than these."""
    counts: dict[tuple[str, str | None], int] = {}
    state, waiting = None, []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for r in table.group_by(["path", "kind"]).aggregate([([], "count_all")]).to_pylist():
            counts[r["path"], r["kind"]] = counts.get((r["path"], r["kind"]), 0) + r["count_all"]
        valued = table.filter(pc.is_valid(table.column("text"))).select(["path", "text"])
        waiting.append(valued.group_by(["path", "text"]).aggregate([]).select(["path", "text"]))
        if sum(map(len, waiting)) > 100_000:
            state, waiting = _smallest(pa.concat_tables(waiting if state is None else [state, *waiting])), []
    if state is not None or waiting:
        state = _smallest(pa.concat_tables(waiting if state is None else [state, *waiting]))
    rows = [{"path": p, "kind": k, "n": 0 if k is None else n, "present": n if k is None else 0, "texts": []} for (p, k), n in counts.items()]
    texts: dict[str, list[str]] = {}
    for r in [] if state is None else state.to_pylist():
        texts.setdefault(r["path"], []).append(r["text"])
    rows += [{"path": p, "kind": None, "n": 0, "present": 0, "texts": v} for p, v in texts.items()]
    types = {"path": pa.string(), "kind": pa.string(), "n": pa.int64(), "present": pa.int64(), "texts": pa.list_(pa.string())}
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(types.items())))


def profile_fields(rows: DataFrame, record_id: str, json: str) -> DataFrame:
    """Per path of the JSON records: records and share that have it, occurrences, null or empty, types, samples, values if few.

    ``samples`` are the smallest ``SAMPLES`` values, ``distinct_values`` all of them if
    there are ``MOST_VALUES`` at most, else null. Containers, nulls and empty texts are
    no values. One pass over the records; what is exchanged are a task's sums and at
    most ``MOST_VALUES + 1`` values of each path. No records: no rows.
    """
    ready(rows.sparkSession)
    mark = lambda path, value, here: F.struct(path.alias("path"), value.alias("value"), F.lit(here).alias("here"))
    found = F.transform("entries", lambda e: mark(e["path"], e["value"], False))
    # each path of a record once, and the record itself under the empty path
    once = F.transform(F.array_union(F.array(F.lit("")), F.transform("entries", lambda e: e["path"])), lambda p: mark(p, F.lit(None).cast("variant"), True))
    flat = _entries(rows, record_id, json).select(F.explode(F.concat(found, once)).alias("e")).select("e.*")
    kind = F.when(~F.col("here"), value_kind(F.col("value")))
    text = F.when(~F.col("here") & ~F.col("kind").isin("null", "empty-string", "dict", "list"), F.try_variant_get("value", "$", "string"))
    parts = flat.withColumn("kind", kind).select("path", "kind", text.alias("text")).mapInArrow(_summed, _PARTIAL)
    empty = F.col("kind").isin("null", "empty-string")
    sums = parts.groupBy("path").agg(
        F.sum("present").alias("present_in_records"), F.sum("n").alias("occurrences"), F.sum(F.when(empty, F.col("n")).otherwise(0)).alias("null_or_empty"),
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("types"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("texts")))).alias("v"),
    )
    records = F.max(F.when(F.col("path") == "", F.col("present_in_records"))).over(Window.partitionBy())
    share = F.round(F.col("present_in_records").cast("decimal(18,4)") * 100 / records, 1).cast("decimal(9,1)")
    some = F.when(F.size("v") > 0, F.col("v"))
    return sums.withColumn("present_pct", share).filter("path <> ''").select(
        "path", "present_in_records", "occurrences", "null_or_empty", "types", F.slice(some, 1, SAMPLES).alias("samples"), F.when(F.size("v") <= MOST_VALUES, some).alias("distinct_values"), "present_pct",
    )


def casting_flags(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("types").rlike(r"string\((numeric|date|time)\)")).select("path", "types")


def nullable_fields(profile: DataFrame) -> DataFrame:
    return profile.filter((F.col("present_pct") < 100) | (F.col("null_or_empty") > 0)).select("path", "present_pct", "null_or_empty")


def volumes(pages: DataFrame, size: int = 100) -> DataFrame:
    return pages.groupBy("entity").agg(F.max("total").alias("rows"), F.ceil(F.max("total") / size).cast("long").alias("pages"))


@dataclass(frozen=True)
class Edge:
    """A foreign key: column of a child table, key of a parent table."""

    child: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.key}"


def coverage_edges(tables: dict[str, DataFrame], edges: list[Edge], examples: int = 10) -> DataFrame:
    """edge, checked, missing, coverage_pct, distinct_missing and the most frequent missing values of many foreign keys.

    Every child table is scanned once, its keys stacked and counted together; one join
    meets them with the stacked keys of the parents. Keys compare as the parent's
    type. Without a key to check the share is null.
    """
    spaces = {p: k for k, p in enumerate(sorted({(e.parent, e.key) for e in edges}))}
    stacks, parents = [], []
    for child in sorted({e.child for e in edges}):
        mine = [(k, e) for k, e in enumerate(edges) if e.child == child]
        cells = [F.struct(F.lit(k).alias("id"), F.lit(spaces[e.parent, e.key]).alias("space"), F.col(e.column).cast(tables[e.parent].schema[e.key].dataType).cast("string").alias("value")) for k, e in mine]
        stacks.append(tables[child].select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    for parent in sorted({e.parent for e in edges}):
        cells = [F.struct(F.lit(k).alias("space"), F.col(key).cast("string").alias("value")) for (p, key), k in spaces.items() if p == parent]
        parents.append(tables[parent].select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    counts = reduce(DataFrame.unionByName, stacks).filter("value is not null").groupBy("id", "space", "value").agg(F.count("*").alias("n"))
    keys = reduce(DataFrame.unionByName, parents).filter("value is not null").distinct().withColumn("found", F.lit(True))
    met = counts.join(keys, ["space", "value"], "left")
    gone = F.col("found").isNull()
    sums = met.groupBy("id").agg(F.sum("n").alias("checked"), F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("missing"), F.count_if(gone).alias("distinct_missing"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("n"), "value"))
    top = met.filter(gone).withColumn("rank", rank).filter(F.col("rank") <= examples).groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]), ",").alias("examples"))
    names = tables[edges[0].child].sparkSession.createDataFrame([(k, e.name) for k, e in enumerate(edges)], "id int, edge string")
    out = names.join(sums, "id", "left").join(top, "id", "left").na.fill(0, ["checked", "missing", "distinct_missing"])
    return out.select("edge", "checked", "missing", _covered(F.col("missing"), F.col("checked")).alias("coverage_pct"), "distinct_missing", "examples")


def _covered(missing: Column, total: Column) -> Column:
    return F.round(F.try_divide((total - missing).cast("decimal(18,4)") * 100, total), 4).cast("decimal(9,4)")


def join_coverage(child: DataFrame, column: str, parent: DataFrame, key: str, examples: int = 10) -> DataFrame:
    """checked, missing, coverage_pct, distinct_missing and the most frequent missing values of a foreign key. Without a key to check the share is null."""
    keys = parent.select(F.col(key).alias(column), F.lit(True).alias("found")).distinct()
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).join(keys, column, "left")
    gone = F.col("found").isNull()
    top = counted.filter(gone).orderBy(F.desc("n"), column).limit(examples).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(column).alias("v")))), lambda s: s["v"].cast("string")), ",").alias("examples"))
    missing = F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    pct = _covered(missing, total)
    return counted.agg(total.alias("checked"), missing.alias("missing"), pct.alias("coverage_pct"), F.count_if(gone).alias("distinct_missing")).crossJoin(top)


def presence_by_bucket(rows: DataFrame, bucket: Column, fields: list[str]) -> DataFrame:
    """Rows and non-empty values of each field by bucket; unusable buckets are 'unknown'."""
    full = [F.count_if(F.col(f).isNotNull() & (F.col(f).cast("string") != "")).alias(f) for f in fields]
    return rows.groupBy(F.coalesce(bucket.cast("string"), F.lit("unknown")).alias("bucket")).agg(F.count("*").alias("rows"), *full)


def mutation_spans(rows: DataFrame, id_: str, name: str, season: str) -> DataFrame:
    """Ids with more than one name, and the span of each name."""
    spans = rows.groupBy(id_, name).agg(F.min(season).alias("first_season"), F.max(season).alias("last_season"))
    many = spans.groupBy(id_).agg(F.count(name).alias("names")).filter("names > 1").select(id_)
    return spans.join(many, id_, "left_semi")


def rebrand_chains(rows: DataFrame, chains: DataFrame, id_: str, season: str) -> DataFrame:
    """Spans of the ids of each chain (chain, id) of which two at least occur."""
    spans = rows.groupBy(id_).agg(F.min(season).alias("first_season"), F.max(season).alias("last_season")).join(chains, id_)
    many = spans.groupBy("chain").agg(F.count("*").alias("n")).filter("n > 1").select("chain")
    return spans.join(many, "chain", "left_semi").select("chain", id_, "first_season", "last_season")
