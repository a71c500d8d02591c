"""JSON pages to records: tolerant parse, explode by entity, grain check with dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions.exprs import blank, variant
from lapforge.sources.entities import EntitySpec


#: Bytes that a variant can hold; a longer document is taken apart as text.
MOST_VARIANT = 128 << 20


def parse_objects(pages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Pages that parse (with ``doc``, or ``big``, the text of one that is too long for a variant), and those that don't, as failures."""
    parsed = pages.withColumn("doc", F.explode_outer(F.array(variant(value))))  # generated, so that no filter on it parses once more
    whole = F.col("doc").isNull() & (F.octet_length(value) >= MOST_VARIANT) & F.json_object_keys(value).isNotNull()
    parsed = parsed.withColumn("big", F.when(whole, F.col(value)))
    known = F.col("doc").isNotNull() | F.col("big").isNotNull()
    bad = parsed.filter(~known).select("source_key", F.lit("not valid JSON").alias("error_detail"), F.col(value).alias("fragment"))
    return parsed.filter(known), bad


def _container(spec: EntitySpec, docs: DataFrame) -> Column:
    """The outer list of a document; of a big one each element is parsed by itself."""
    found = F.try_variant_get("doc", f"$.{spec.container}", "array<variant>")
    if "big" not in docs.columns:
        return found
    path = spec.container.split(".")
    shape = "array<string>"
    for name in reversed(path[1:]):
        shape = f"struct<`{name}`: {shape}>"
    texts = F.from_json("big", f"`{path[0]}` {shape}")
    for name in path:
        texts = texts.getField(name)
    return F.when(F.col("big").isNull(), found).otherwise(F.transform(texts, lambda t: F.try_parse_json(t)))


def _shape(paths: dict[str, str]) -> str:
    """Type of an object with what is wanted of it, by dotted path."""
    inner: dict[str, dict[str, str]] = {}
    for path, kind in paths.items():
        name, _, rest = path.partition(".")
        inner.setdefault(name, {})[rest] = kind
    return "struct<" + ", ".join(f"`{name}`: {of.get('') or _shape(of)}" for name, of in inner.items()) + ">"


def _objects(list_: Column, paths: dict[str, str]) -> Column:
    """Elements (x) of a list of variants that are objects, with what is wanted of them (found), taken in one go; anything else, and no list, is skipped."""
    shape = _shape(paths or {"_": "variant"})
    both = F.transform(list_, lambda x: F.struct(x.alias("x"), F.try_variant_get(x, "$", shape).alias("found")))
    return F.filter(both, lambda e: e["found"].isNotNull())


def _at(column: str, path: str) -> Column:
    out = F.col(column)
    for name in path.split("."):
        out = out.getField(name)
    return out


def explode_records(spec: EntitySpec, docs: DataFrame) -> DataFrame:
    """source_key, pos, record, what its keys are (found) and the lifted fields of the outer element, one row a record.

    Exploded are outer lists: for an inner one Spark would evaluate the list, and what it is parsed from, in a filter too.
    """
    lifted = dict.fromkeys(spec.lifted, "string")
    keys = dict.fromkeys((p for _, p in spec.keys), "string")
    of_outer = lifted | (keys if spec.child is None else {spec.child: "array<variant>"})
    outer = docs.select("source_key", F.posexplode_outer(_objects(_container(spec, docs), of_outer)).alias("p", "e")).filter("p is not null")
    kept = [_at("e.found", name).alias(f"lifted_{name}") for name in spec.lifted]
    if spec.child is None:
        return outer.select("source_key", F.col("p").cast("long").alias("pos"), F.col("e.x").alias("record"), F.col("e.found").alias("found"), *kept)
    inner = outer.select("source_key", "p", *kept, F.posexplode_outer(_objects(_at("e.found", spec.child), keys)).alias("q", "r")).filter("q is not null")
    return inner.select("source_key", (F.col("p") * 1_000_000 + F.col("q")).alias("pos"), F.col("r.x").alias("record"), F.col("r.found").alias("found"), *[f"lifted_{n}" for n in spec.lifted])


def extract(spec: EntitySpec, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (grain keys, payload, source_key, pos) and failures (missing keys named, fragment kept).

    A key comes from the record; where it is null or '' there, from the outer element's field of that name.
    """
    rows = explode_records(spec, docs)
    keys = {c: F.coalesce(blank(_at("found", p)), *([blank(F.col(f"lifted_{c}"))] if c in spec.lifted else [])) for c, p in spec.keys}
    rows = rows.withColumns(keys)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(p)) for c, p in spec.keys]))
    rows = rows.withColumn("missing", missing).withColumn("payload", F.to_json("record"))
    good = rows.filter(F.size("missing") == 0).select(*spec.grain, "payload", "source_key", "pos")
    detail = F.concat(F.lit("missing key field(s): "), F.concat_ws(", ", "missing"))
    return good, rows.filter(F.size("missing") > 0).select("source_key", detail.alias("error_detail"), F.col("payload").alias("fragment"))
