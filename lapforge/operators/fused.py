"""Many declared checks in one scan of each table.

Checks that look at rows alone (nulls, accepted values, unknown members, counts, the
newest time) are aggregates observed while the rows of their table flow by. Checks on
keys (unique, unique in combination, relationships) share one grouping: every row is
unfolded into the keys that it holds or refers to, and for each key of each key space
it is counted how often its own table and each referring column have it. One exchange
of keys, combined before it, answers all of them; no table is scanned for each check
and none is joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapforge.functions.exprs import unknown_key

RESULT = "name string, table string, kind string, severity string, failing long, passed boolean"
SCALAR = ("not_null", "accepted_values", "no_unknown", "row_count", "equal_rowcount", "freshness")
KEYED = ("unique", "relationships")


@dataclass(frozen=True)
class Check:
    """One declared check of a table. ``to``: (table, column) that ``relationships`` refers to, (table,) that ``equal_rowcount`` compares with."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    values: tuple = ()
    where: str | None = None
    to: tuple[str, ...] = ()
    equals: int | None = None
    now: datetime | None = None
    warn_hours: int = 36
    error_hours: int = 168

    def __post_init__(self) -> None:
        if self.kind not in SCALAR + KEYED:
            raise ValueError(f"unknown kind of check: {self.kind}")

    @property
    def name(self) -> str:
        more = ["to", *self.to] if self.to else []
        return "_".join([self.kind, self.table, *self.columns, *more])


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns]


def _metric(check: Check) -> Column | None:
    """Aggregate that a check needs of its table beside the number of rows."""
    col = F.col(check.columns[0]) if check.columns else None
    if check.kind == "not_null":
        return F.count_if(col.isNull())
    if check.kind == "accepted_values":
        asked = F.lit(True) if check.where is None else F.coalesce(F.expr(check.where), F.lit(False))
        return F.count_if(asked & col.isNotNull() & ~col.isin(*check.values))
    if check.kind == "no_unknown":
        return F.count_if(col == unknown_key())
    return F.max(F.unix_micros(col.cast("timestamp"))) if check.kind == "freshness" else None


def _metrics(table: str, checks: list[Check]) -> list[Column]:
    mine = [c for c in checks if c.table == table and c.kind in SCALAR]
    return [F.count(F.lit(1)).alias("rows"), *[m.alias(f"m{k}") for k, c in enumerate(mine) if (m := _metric(c)) is not None]]


def observed(df: DataFrame, table: str, checks: list[Check]) -> tuple[DataFrame, Observation, list[Check]]:
    """``df`` that measures, as its rows flow by once, what the row checks of ``table`` need."""
    mine = [c for c in checks if c.table == table and c.kind in SCALAR]
    watch = Observation(f"checks of {table}")
    return df.observe(watch, *_metrics(table, checks)), watch, mine


def measured(watch: Observation, df: DataFrame, table: str, checks: list[Check]) -> dict:
    """What was observed. Where Spark found a branch of the plan empty and cut it, and the observation with it, ``df`` is measured by itself."""
    try:
        return watch.get
    except Py4JJavaError:
        return df.agg(*_metrics(table, checks)).first().asDict()


def judge(found: dict[str, dict], asked: dict[str, list[Check]]) -> list[tuple]:
    """Result rows of row checks from what was measured of each table."""
    out = []
    for table, checks in asked.items():
        for k, c in enumerate(checks):
            rows, severity = found[table]["rows"], c.severity
            failing = found[table].get(f"m{k}") or 0
            if c.kind == "row_count":
                failing = int(rows != c.equals)
            elif c.kind == "equal_rowcount":
                failing = int(rows != found[c.to[0]]["rows"])
            elif c.kind == "freshness":
                newest, now = found[table].get(f"m{k}"), int(c.now.timestamp() * 1_000_000)
                hours = None if newest is None else (now - newest) / 3_600_000_000
                failing = int(hours is None or hours > c.warn_hours)
                severity = "error" if hours is None or hours > c.error_hours else "warn"
            out.append((c.name, table, c.kind, severity, failing, failing == 0))
    return out


def _value(columns: tuple[str, ...], like: DataFrame | None = None, key: str = "") -> Column:
    """A key as text; a column that refers to another is cast to that one's type first. Null: no key."""
    if len(columns) > 1:
        return F.to_json(F.struct(*columns))
    col = F.col(columns[0])
    return (col if like is None else col.cast(like.schema[key].dataType)).cast("string")


def key_counts(tables: dict[str, DataFrame], checks: list[Check]) -> tuple[DataFrame, dict[tuple[int, int], list[Check]]]:
    """space, slot, failing of all key checks, and which checks a space and slot stand for.

    Slot 0 is the key's own table, the others the columns that refer to it. ``tables``
    are scanned once each.
    """
    spaces: dict[tuple[str, tuple[str, ...]], int] = {}
    slots: dict[tuple[int, int], list[Check]] = {}
    stacks: dict[str, list[tuple[int, int, Column]]] = {}
    refers: dict[int, int] = {}

    def space(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in spaces:
            spaces[table, columns] = len(spaces)
            stacks.setdefault(table, []).append((spaces[table, columns], 0, _value(columns)))
        return spaces[table, columns]

    for c in checks:
        if c.kind == "unique":
            slots.setdefault((space(c.table, c.columns), 0), []).append(c)
        elif c.kind == "relationships":
            s = space(c.to[0], c.to[1:])
            refers[s] = refers.get(s, 0) + 1
            slots[s, refers[s]] = [c]
            stacks.setdefault(c.table, []).append((s, refers[s], _value(c.columns, tables[c.to[0]], c.to[1])))
    most = max(refers.values(), default=0)
    parts = []
    for table, stack in stacks.items():
        entries = F.array(*[F.struct(F.lit(s).alias("space"), F.lit(k).alias("slot"), v.alias("value")) for s, k, v in stack])
        parts.append(tables[table].select(F.explode(entries).alias("e")).select("e.*"))
    rows = reduce(DataFrame.unionByName, parts).filter("value is not null")
    counts = rows.groupBy("space", "value").agg(*[F.count_if(F.col("slot") == k).alias(f"c{k}") for k in range(most + 1)])
    twice = F.struct(F.lit(0).alias("slot"), F.when(F.col("c0") > 1, 1).otherwise(0).cast("long").alias("n"))
    lost = [F.struct(F.lit(k).alias("slot"), F.when(F.col("c0") == 0, F.col(f"c{k}")).otherwise(0).cast("long").alias("n")) for k in range(1, most + 1)]
    failing = counts.select("space", F.explode(F.array(twice, *lost)).alias("x")).groupBy("space", "x.slot").agg(F.sum("x.n").alias("failing"))
    return failing, slots


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """name, table, kind, severity, failing, passed of every check, each table scanned once.

    ``failing``: rows for row checks and relationships, keys for unique ones. An empty
    table passes all but row counts and freshness.
    """
    watched, watches, asked = dict(tables), {}, {}
    needed = {c.table for c in checks} | {c.to[0] for c in checks if c.to}
    for table in sorted(needed):
        watched[table], watches[table], asked[table] = observed(tables[table], table, checks)
    keyed = [c for c in checks if c.kind in KEYED]
    found: dict[tuple[int, int], int] = {}
    slots: dict[tuple[int, int], list[Check]] = {}
    if keyed:
        failing, slots = key_counts(watched, keyed)
        found = {(r["space"], r["slot"]): r["failing"] for r in failing.collect()}
    in_keys = {c.table for c in keyed} | {c.to[0] for c in keyed if c.to}
    for table in needed - in_keys:
        watched[table].write.format("noop").mode("overwrite").save()
    rows = judge({t: measured(w, tables[t], t, checks) for t, w in watches.items()}, asked)
    rows += [(c.name, c.table, c.kind, c.severity, n, n == 0) for place, many in slots.items() for c in many for n in [found.get(place, 0)]]
    order = {c.name: k for k, c in enumerate(checks)}
    return spark.createDataFrame(sorted(rows, key=lambda r: order[r[0]]), RESULT)
