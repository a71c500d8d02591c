"""Pipeline state: dead letters, checkpoints, rounds to run, call budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def failures(bad: DataFrame, entity: str, now: Column) -> DataFrame:
    """Dead letters with an id by content, so that a replay doesn't add them again."""
    key = F.sha2(F.concat_ws("|", F.lit(entity), "source_key", "fragment"), 256)
    return bad.select(key.alias("id"), F.lit(entity).alias("entity"), "source_key", F.substring("error_detail", 1, 2000).alias("error_detail"), "fragment", now.alias("failed_at"), F.lit(None).cast("timestamp").alias("resolved_at"))


def unresolved(letters: DataFrame, entity: str | None = None) -> DataFrame:
    left = letters.filter("resolved_at is null")
    return left if entity is None else left.filter(F.col("entity") == entity)


RANGES = "array<struct<start: int, stop: int>>"


def merge_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, landed: half-open ranges (keys, start, stop) of each group put together where they meet, in order. Empty ones are left out."""
    order = Window.partitionBy(*keys).orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = ranges.filter("start < stop").withColumn("_begins", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    islands = begins.withColumn("_island", F.sum("_begins").over(order)).groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return islands.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).cast(RANGES).alias("landed"))


def advance_checkpoints(known: DataFrame, pages: DataFrame, now: Column) -> DataFrame:
    """Checkpoints (entity, scope) after pages (entity, scope, offset, limit, total); started_at is kept.

    ``landed`` has the ranges of offsets that are there, so pages beyond a gap aren't
    forgotten. ``next_offset`` is where the first gap begins; a scope is complete when
    nothing is missing below its total. Checkpoints without ``landed`` count as landed up to next_offset.
    """
    keys = ["entity", "scope"]
    base = F.array(F.struct(F.lit(0).alias("start"), F.coalesce(F.col("next_offset").cast("int"), F.lit(0)).alias("stop"))).cast(RANGES)
    known = known.withColumn("landed", F.coalesce("landed", base) if "landed" in known.columns else base)
    before = known.select(*keys, F.explode("landed").alias("r")).select(*keys, "r.start", "r.stop")
    fresh = pages.select(*keys, F.col("offset").cast("int").alias("start"), (F.col("offset") + F.greatest("limit", F.lit(0))).cast("int").alias("stop"))
    landed = merge_ranges(before.join(pages.select(*keys).distinct(), keys, "left_semi").unionByName(fresh), keys)
    seen = pages.groupBy(*keys).agg(F.max("total").alias("total_expected")).join(landed, keys, "left").withColumn("landed", F.coalesce("landed", F.array().cast(RANGES)))
    seen = seen.withColumn("next_offset", F.when(F.get("landed", F.lit(0))["start"] == 0, F.get("landed", F.lit(0))["stop"]).otherwise(0))
    done = (F.col("next_offset") >= F.col("total_expected")) | (F.col("total_expected") == 0)
    seen = seen.withColumn("status", F.when(done, "complete").otherwise("in_progress"))
    old = known.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("next_offset", "total_expected", "status", "landed", "started_at", "updated_at")])
    both = old.join(seen, keys, "full")
    pick = [F.coalesce(c, f"_{c}").alias(c) for c in ("next_offset", "total_expected", "status", "landed")]
    return both.select(*keys, *pick, F.coalesce("_started_at", now).alias("started_at"), F.when(F.col("status").isNotNull(), now).otherwise(F.col("_updated_at")).alias("updated_at"))


def resume_gaps(wanted: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """entity, scope, start, stop: ranges of offsets still to fetch, so that nothing landed is fetched again.

    A scope without a checkpoint, or whose total isn't known, ends in an open range (null stop); complete ones have none.
    """
    known = checkpoints.select("entity", "scope", "status", "total_expected", "landed")
    rows = wanted.join(known, ["entity", "scope"], "left").filter(~F.col("status").eqNullSafe("complete"))
    there = F.coalesce("landed", F.array().cast(RANGES))
    gap = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"))
    starts = F.concat(F.array(F.lit(0)), F.transform(there, lambda r: r["stop"]))
    stops = F.concat(F.transform(there, lambda r: r["start"]), F.array(F.col("total_expected").cast("int")))
    gaps = F.filter(F.zip_with(starts, stops, gap), lambda g: g["stop"].isNull() | (g["start"] < g["stop"]))
    return rows.select("entity", "scope", F.explode(gaps).alias("g")).select("entity", "scope", "g.start", "g.stop")


def pending_scopes(wanted: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Scopes still to load and the offset to resume at; complete ones are skipped."""
    known = checkpoints.select("entity", "scope", "status", "next_offset")
    return wanted.join(known, ["entity", "scope"], "left").filter(~F.col("status").eqNullSafe("complete")).select("entity", "scope", F.coalesce("next_offset", F.lit(0)).alias("resume_at"))


def _run(as_of: Column, day: str = "race_date") -> Column:
    return F.coalesce(F.col(day).try_cast("date") <= as_of, F.lit(True))


def run_rounds(races: DataFrame, as_of: Column, include_unrun: bool = False) -> DataFrame:
    """Rounds that have been run by ``as_of``, in the order of their numbers; those without a usable date are kept."""
    kept = races if include_unrun else races.filter(_run(as_of))
    return kept.withColumn("round", F.col("round").cast("int")).orderBy("season", "round")


def round_progress(races: DataFrame, as_of: Column) -> DataFrame:
    return races.groupBy("season").agg(F.count("*").alias("scheduled"), F.count_if(_run(as_of)).alias("run"))


def usage(log: DataFrame, now: Column, seconds: int = 3600) -> DataFrame:
    """Calls in the trailing window, and microseconds until the oldest of them leaves it."""
    at = F.unix_micros("called_at")
    start = F.unix_micros(now) - seconds * 1_000_000
    inside = log.filter((at > start) & (at <= F.unix_micros(now)))
    return inside.agg(F.count("*").alias("calls"), F.coalesce(F.min(at) - start, F.lit(0)).alias("micros_to_free"))


def usage_series(log: DataFrame, budget: int, seconds: int = 3600, by: tuple[str, ...] = ()) -> DataFrame:
    """Calls in the window that ends at each call (its far edge excluded), and whether they exceed the budget.

    With ``by`` each group has its own window. Every call enters the window at its time and
    leaves it a window's length later, so its size is a running sum; the log is cut into
    blocks of that length, and what leaves in a block are the calls of the block before it.
    No task holds the whole log, and the work grows with the calls, however dense they are.
    """
    span = seconds * 1_000_000
    at = log.withColumn("_at", F.unix_micros("called_at")).withColumns({"_block": F.floor(F.col("_at") / F.lit(span)), "_step": F.lit(1)})
    both = at.unionByName(at.withColumns({"_at": F.col("_at") + span, "_block": F.col("_block") + 1, "_step": F.lit(-1)}))
    block = Window.partitionBy(*by, "_block")
    upto = block.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.coalesce(F.sum(F.when((F.col("_step") < 0) & F.col("_at").isNotNull(), 1)).over(block), F.lit(0))
    entered = F.when(F.col("_at").isNotNull(), F.sum("_step").over(upto)).otherwise(F.count_if(F.col("_step") > 0).over(block))
    out = both.withColumn("calls", before + entered).filter("_step > 0").drop("_at", "_block", "_step")
    return out.withColumn("over_budget", F.col("calls") > budget)


def usage_by_entity(log: DataFrame) -> DataFrame:
    return log.groupBy("entity").agg(F.count("*").alias("calls"))


def prune(log: DataFrame, now: Column, keep: int = 7200) -> DataFrame:
    return log.filter(F.unix_micros("called_at") >= F.unix_micros(now) - keep * 1_000_000)
