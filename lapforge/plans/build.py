"""From raw tables to marts: staging views, then dimensions, facts and the report, in the order of their needs.

Each mart is written as a new version and checked before it counts: row checks are
measured while it is written, key checks of all marts of a step share one scan of
each. A mart with a failing error check is not committed, and marts that need it are
not built: readers go on with the former versions of both. Facts are stored by season,
each season a version of its own, so a refresh writes only the seasons that changed.
Marts of one step are committed together, and a run has one version number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions.exprs import unknown_key
from lapforge.operators import fused
from lapforge.operators.fused import Check
from lapforge.operators.staging import STAGING
from lapforge.plans import marts
from lapforge.sources import versions

KEEP = 2
REPORT = "model string, status string, parts long, failed array<string>, warned array<string>"
Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """A mart: what it is made of, the marts that it needs, the column that its parts follow, the checks that guard it."""

    name: str
    make: Callable[[Tables, Tables], DataFrame]
    staged: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    by: str | None = None
    checks: tuple[Check, ...] = ()


def stage_all(raw: Tables) -> Tables:
    """Staging views of the raw tables that are there."""
    return {name: STAGING[name](table) for name, table in raw.items()}


def _dimension(name: str, key: str, *rest: str) -> tuple[Check, ...]:
    return (Check(name, "unique", (key,)), *fused.not_null(name, key, "is_unknown", *rest))


def _fact(name: str, grain: tuple[str, ...], dims: dict[str, str], *rest: str) -> tuple[Check, ...]:
    refs = [Check(name, "relationships", (key,), to=(dim, key)) for key, dim in dims.items()]
    unknown = [Check(name, "no_unknown", (key,), "warn") for key in dims]
    return (Check(name, "unique", grain), *fused.not_null(name, *dims, "season", "round", *rest), *refs, *unknown)


_RACE, _DRIVER, _TEAM, _STATUS = {"race_key": "dim_race"}, {"driver_key": "dim_driver"}, {"constructor_key": "dim_constructor"}, {"status_key": "dim_status"}
_CATEGORIES = (*marts.CATEGORIES, "mechanical", "unknown")


def models(checkpoints: DataFrame, calls: DataFrame, as_of: Column) -> list[Model]:
    """The marts and their declared checks. An entry without a known team or status is a fact all the same, hence only warned of."""
    result = (("race_key", "driver_key", "constructor_key", "classified_position"), _RACE | _DRIVER | _TEAM | _STATUS, "points", "is_classified")
    raced = ("dim_race", "dim_driver", "dim_constructor", "dim_status")
    return [
        Model("dim_driver", lambda s, m: marts.dim_driver(s["drivers"]), ("drivers",), checks=_dimension("dim_driver", "driver_key", "driver_id", "full_name")),
        Model("dim_constructor", lambda s, m: marts.dim_constructor(s["constructors"]), ("constructors",), checks=_dimension("dim_constructor", "constructor_key", "constructor_id")),
        Model("dim_circuit", lambda s, m: marts.dim_circuit(s["circuits"]), ("circuits",), checks=_dimension("dim_circuit", "circuit_key", "circuit_id")),
        Model("dim_status", lambda s, m: marts.dim_status(s["status"]), ("status",), checks=(*_dimension("dim_status", "status_key", "status"), Check("dim_status", "accepted_values", ("status_category",), values=_CATEGORIES))),
        Model("dim_race", lambda s, m: marts.dim_race(s["races"], m["dim_circuit"], as_of.cast("date")), ("races",), ("dim_circuit",), checks=(
            *_dimension("dim_race", "race_key", "season", "round"), Check("dim_race", "unique", ("season", "round")), Check("dim_race", "relationships", ("circuit_key",), to=("dim_circuit", "circuit_key")))),
        Model("fct_results", lambda s, m: marts.fct_results(s["results"], *[m[n] for n in raced]), ("results",), raced, "season", _fact("fct_results", *result)),
        Model("fct_sprint_results", lambda s, m: marts.fct_sprint_results(s["sprint"], *[m[n] for n in raced]), ("sprint",), raced, "season", _fact("fct_sprint_results", *result)),
        Model("fct_driver_standings", lambda s, m: marts.fct_driver_standings(s["driver_standings"], m["dim_race"], m["dim_driver"]), ("driver_standings",), raced[:2], "season",
              _fact("fct_driver_standings", ("race_key", "driver_key"), _RACE | _DRIVER, "points")),
        Model("fct_constructor_standings", lambda s, m: marts.fct_constructor_standings(s["constructor_standings"], m["dim_race"], m["dim_constructor"]), ("constructor_standings",), ("dim_race", "dim_constructor"), "season",
              _fact("fct_constructor_standings", ("race_key", "constructor_key"), _RACE | _TEAM, "points")),
        Model("rpt_pipeline_freshness", lambda s, m: marts.rpt_pipeline_freshness(m["dim_race"], m["fct_results"], checkpoints, calls, as_of), (), ("dim_race", "fct_results"), checks=(Check("rpt_pipeline_freshness", "row_count", equals=1),)),
    ]


def _kept(known: dict, model: Model) -> dict[str, list[int]]:
    """Committed versions of a model's parts, newest first."""
    start = f"{model.name}/"
    return {p.removeprefix(start): v.versions for p, v in known.items() if p is not None and p.startswith(start)}


def stored(spark: SparkSession, root: str, model: Model, known: dict, columns: list[str] | None = None) -> DataFrame | None:
    """A mart as it is now, None before its first version counts."""
    data, kept = f"{root}/{model.name}", _kept(known, model)
    if not kept:
        return None
    paths = [versions.part_path(data, v[0], model.by, p) for p, v in sorted(kept.items())]
    found = spark.read.option("basePath", data).parquet(*paths).drop("version")
    return found if columns is None else found.select(*columns)


def touched_seasons(model: Model, known: dict, staged: Tables, out: Tables) -> list[int] | None:
    """Seasons whose rows changed since the model was last built, or that refer to what a dimension didn't know; None if it never was."""
    last = max((v.at for p, v in known.items() if p is not None and p.startswith(f"{model.name}/")), default=None)
    if last is None:
        return None
    moved = [staged[s].filter(F.col("updated_at") >= F.lit(last)).select("season") for s in model.staged]
    moved += [out[model.name].filter(F.col(c.columns[0]) == unknown_key()).select("season") for c in model.checks if c.kind == "no_unknown"]
    return sorted(r[0] for r in reduce(DataFrame.union, moved).filter("season is not null").distinct().collect())


def run(spark: SparkSession, chosen: list[Model], raw: Tables, root: str, refresh: bool = False) -> tuple[Tables, DataFrame]:
    """Build models under ``root``; the tables as they are then, and a row a model: built, unchanged, failed or skipped, with the checks that failed.

    ``refresh``: of models stored by season only what changed since their last version.
    """
    staged, by_name = stage_all(raw), {m.name: m for m in chosen}
    started = spark.sql("select current_timestamp()").first()[0]
    known = versions.state(spark, root, KEEP)
    version = versions.newest(known) + 1
    out: Tables = {n: t for n, m in by_name.items() if (t := stored(spark, root, m, known)) is not None}
    stopped: set[str] = set()
    rows: list[tuple] = []
    order = TopologicalSorter({m.name: [n for n in m.needs if n in by_name] for m in chosen})
    order.prepare()
    while order.is_active():
        step = [by_name[n] for n in sorted(order.get_ready())]
        drafts: dict[str, tuple[list[str], list[str]]] = {}
        new, results = dict(out), []
        for m in step:
            if stopped & set(m.needs):
                stopped.add(m.name)
                rows.append((m.name, "skipped", 0, [], []))
                continue
            seasons = touched_seasons(m, known, staged, out) if refresh and m.by else None
            if seasons == []:
                rows.append((m.name, "unchanged", 0, [], []))
                continue
            df = m.make(staged, out)
            df = df if seasons is None else df.filter(F.col(m.by).isin(seasons))
            path = f"{root}/{m.name}/version={version}"
            watched, watch, mine = fused.observed(df, m.name, list(m.checks))
            watched.write.mode("overwrite").partitionBy(*([m.by] if m.by else [])).parquet(path)
            new[m.name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
            results += fused.judge({m.name: fused.measured(watch, new[m.name], m.name, list(m.checks))}, {m.name: mine})
            names = versions.children(spark, path)
            parts = ["all"] if m.by is None else sorted(n.removeprefix(f"{m.by}=") for n in names if n.startswith(f"{m.by}="))
            drafts[m.name] = parts, df.columns
        keyed = [c for n in drafts for c in by_name[n].checks if c.kind in fused.KEYED and set(c.to[:1]) <= set(new)]
        if keyed:
            results += [tuple(r) for r in fused.run_checks(spark, {n: new[n] for n in {c.table for c in keyed} | {c.to[0] for c in keyed if c.to}}, keyed).collect()]
        passed: list[str] = []
        for name, (parts, _) in drafts.items():
            bad = {s: sorted(r[0] for r in results if r[1] == name and not r[5] and r[3] == s) for s in ("error", "warn")}
            rows.append((name, "failed" if bad["error"] else "built", len(parts), bad["error"], bad["warn"]))
            (stopped.add if bad["error"] else passed.append)(name)
        if passed:
            versions.commit(spark, root, version, [f"{n}/{p}" for n in passed for p in drafts[n][0]], F.lit(started))
        for name in passed:
            for p in drafts[name][0]:
                before = known.get(f"{name}/{p}")
                known[f"{name}/{p}"] = versions.Part([version, *(before.versions if before else [])][:KEEP], started)
            now = stored(spark, root, by_name[name], known, drafts[name][1])
            out[name] = new[name] if now is None else now
        order.done(*[m.name for m in step])
    for m in chosen:
        versions.clean(spark, f"{root}/{m.name}", m.by, _kept(known, m))
    return out, spark.createDataFrame(rows, REPORT)


def build(spark: SparkSession, raw: Tables, checkpoints: DataFrame, calls: DataFrame, as_of: Column, root: str) -> Tables:
    """All marts from raw tables by entity, stored under ``root``. ``as_of`` is what has been run is measured by.

    Marts that checks stopped are as they were before; those that never passed are missing.
    """
    return run(spark, models(checkpoints, calls, as_of), raw, root)[0]
