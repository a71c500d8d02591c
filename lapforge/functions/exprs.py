"""Column helpers: keys, JSON access, tolerant parsing, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separator and null token of surrogate keys.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


#: Collation that names are ordered by, in ties and reports: letters with accents stand beside those without.
NAME_ORDER = "UNICODE"


def by_name(name: str | Column) -> Column:
    """A name as it is ordered and compared; the text itself stays plain."""
    return F.collate(F.col(name) if isinstance(name, str) else name, NAME_ORDER)


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts as text; a null part has a token of its own."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(KEY_NULL)) for c in cols]))


def unknown_key() -> Column:
    return F.md5(F.lit("-1"))


def variant(json: str | Column) -> Column:
    """Parsed JSON, or null where it can't be parsed."""
    return F.try_parse_json(F.col(json) if isinstance(json, str) else json)


def txt(payload: Column, path: str, kind: str = "string") -> Column:
    """Value at a dotted path as text; missing and JSON null give null."""
    return F.try_variant_get(payload, f"$.{path}", kind)


def canon(json: str | Column) -> Column:
    """JSON text with sorted keys and plain numbers, so that equal content is equal text."""
    return F.to_json(variant(json))


def has_key(json: Column, key: str) -> Column:
    """Whether a top-level key exists, even with a null or empty value."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), key), F.lit(False))


def arr_len(payload: Column, path: str) -> Column:
    return F.size(F.try_variant_get(payload, f"$.{path}", "array<variant>"))


def arr_field(payload: Column, path: str, field: str) -> Column:
    return F.transform(F.try_variant_get(payload, f"$.{path}", "array<variant>"), lambda x: F.variant_get(x, f"$.{field}", "string"))


def blank(value: Column, *also: str) -> Column:
    """Null for '' and further sentinels."""
    out = F.nullif(value, F.lit(""))
    for other in also:
        out = F.nullif(out, F.lit(other))
    return out


def session_timestamp(payload: Column, block: str) -> Column:
    """Timestamp of a session block; null unless date and time are both there."""
    day, time = txt(payload, f"{block}.date"), txt(payload, f"{block}.time")
    return F.when(day.isNotNull() & time.isNotNull(), F.concat(day, F.lit(" "), time).cast("timestamp"))


def duration_seconds(text: Column) -> Column:
    """``ss.sss`` or ``mm:ss.sss`` as decimal seconds; '' is null, any other shape fails."""
    value = blank(text)
    minutes = F.split_part(value, F.lit(":"), F.lit(1)).cast("decimal(12,3)") * 60
    long = minutes + F.split_part(value, F.lit(":"), F.lit(2)).cast("decimal(12,3)")
    return F.when(value.rlike("^[0-9]+:[0-9.]+$"), long).otherwise(F.when(value.isNotNull() & ~value.rlike("^[0-9]+:[0-9.]+$"), value.cast("decimal(12,3)"))).cast("decimal(12,3)")


def decade(season: Column) -> Column:
    """First year of a season's decade; truncates towards zero, so the Unknown season -1 is in decade 0."""
    return (season - season % 10).cast("int")


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Exact decimal share, rounded half up; null where there is nothing to share."""
    return F.round(F.when(whole > 0, part.cast("decimal(18,6)") / whole.cast("decimal(18,6)")), digits).cast(f"decimal(18,{digits})")


def laps_down(status: Column) -> Column:
    return F.nullif(F.regexp_extract(status, r"^\+([0-9]+) Lap", 1), F.lit("")).cast("int")


def value_kind(value: Column) -> Column:
    """Observed type of a JSON value given as text from a variant's schema and content."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    number, date, time = text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?Z?$")
    return (
        F.when(value.isNull() | (kind == "VOID"), "null").when(kind == "BOOLEAN", "bool").when(kind == "BIGINT", "int")
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float").when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "dict")
        .when(text == "", "empty-string").when(number, "string(numeric)").when(date, "string(date)").when(time, "string(time)").otherwise("string")
    )
