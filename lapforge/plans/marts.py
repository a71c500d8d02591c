"""Star schema: dimensions with an Unknown member, facts whose keys always resolve.

Joins to dimensions carry no broadcast hint: Spark broadcasts those that are
measured small and shuffles others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions.exprs import laps_down, surrogate_key, unknown_key

#: Aliases of statuses, and statuses by category.
ALIASES = {"Excluded": "Disqualified", "Injured": "Injury", "Driver unwell": "Illness", "Tyre puncture": "Puncture", "Driver Seat": "Seat"}
CATEGORIES = {
    "finished": ["Finished"],
    "lapped": ["Lapped"],
    "collision": ["Accident", "Collision", "Spun off", "Collision damage", "Puncture", "Damage", "Fatal accident"],
    "disqualified": ["Disqualified", "Underweight"],
    "withdrawn_or_dns": ["Withdrew", "Did not start", "Did not qualify", "Did not prequalify"],
    "driver_unavailable": ["Injury", "Eye injury", "Illness", "Physical"],
    "cause_unspecified": ["Retired", "Not classified"],
    "other": ["Debris", "Safety", "Safety concerns", "Eligibility"],
}


def with_unknown_member(dim: DataFrame, key: str, **named: object) -> DataFrame:
    """``dim`` and its Unknown row: the unknown key, the named values, nulls elsewhere."""
    one = dim.sparkSession.range(1)
    values = [unknown_key().alias(key) if f.name == key else F.lit(named.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema]
    return dim.withColumn("is_unknown", F.lit(False)).unionByName(one.select(*values, F.lit(True).alias("is_unknown")))


def dim_driver(drivers: DataFrame) -> DataFrame:
    cols = ["driver_id", "driver_code", "first_name", "last_name", "full_name", "nationality", "date_of_birth", "permanent_number", "wikipedia_url"]
    return with_unknown_member(drivers.select(surrogate_key("driver_id").alias("driver_key"), *cols), "driver_key", driver_id="-1", full_name="Unknown driver")


def dim_constructor(constructors: DataFrame) -> DataFrame:
    cols = ["constructor_id", "constructor_name", "nationality", "wikipedia_url"]
    return with_unknown_member(constructors.select(surrogate_key("constructor_id").alias("constructor_key"), *cols), "constructor_key", constructor_id="-1", constructor_name="Unknown constructor")


def dim_circuit(circuits: DataFrame) -> DataFrame:
    cols = ["circuit_id", "circuit_name", "latitude", "longitude", "country", "locality", "wikipedia_url"]
    return with_unknown_member(circuits.select(surrogate_key("circuit_id").alias("circuit_key"), *cols), "circuit_key", circuit_id="-1", circuit_name="Unknown circuit")


def dim_race(races: DataFrame, circuits: DataFrame, as_of: Column) -> DataFrame:
    """Inner join to circuits on purpose: a race without its circuit drops out and a relationship check reports it."""
    keys = circuits.filter("not is_unknown").select("circuit_id", "circuit_key")
    sessions = ["practice_1_utc", "practice_2_utc", "practice_3_utc", "qualifying_utc", "sprint_utc", "sprint_qualifying_utc"]
    dim = races.join(keys, "circuit_id").select(
        surrogate_key("season", "round").alias("race_key"), "season", "round", "race_name", "circuit_key", "circuit_id", "race_date", "race_start_utc", *sessions,
        "is_sprint_weekend", F.coalesce(F.col("race_date") <= as_of, F.lit(False)).alias("has_been_run"), "wikipedia_url",
    )
    return with_unknown_member(dim, "race_key", season=-1, round=-1, race_name="Unknown race", has_been_run=False, is_sprint_weekend=False)


def canonical_status(status: Column) -> Column:
    out = status
    for old, new in ALIASES.items():
        out = F.when(status == old, new).otherwise(out)
    return F.when(status.rlike(r"^\+[0-9]+ Lap"), "Lapped").otherwise(out)


def status_category(canonical: Column) -> Column:
    out = F.lit("mechanical")
    for name, members in CATEGORIES.items():
        out = F.when(canonical.isin(members), name).otherwise(out)
    return out


def dim_status(statuses: DataFrame) -> DataFrame:
    dim = statuses.withColumn("status_canonical", canonical_status(F.col("status"))).withColumn("status_category", status_category(F.col("status_canonical")))
    dim = dim.select(
        surrogate_key("status").alias("status_key"), "status_id", "status", "status_canonical", laps_down(F.col("status")).alias("laps_down"), "status_category",
        F.col("status_category").isin("finished", "lapped").alias("status_implies_running_at_end"), "source_all_time_count",
    )
    return with_unknown_member(dim, "status_key", status="Unknown", status_canonical="Unknown", status_category="unknown", status_implies_running_at_end=False)


def conform(fact: DataFrame, dims: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Add the key of each dimension (key -> (dimension, natural columns)); what isn't found gets the unknown key."""
    out = fact
    for key, (dim, on) in dims.items():
        known = dim.filter("not is_unknown").select(*on, F.col(key).alias(f"_{key}"))
        out = out.join(known, on, "left").withColumn(key, F.coalesce(f"_{key}", unknown_key())).drop(f"_{key}")
    return out


def _fact(staged: DataFrame, natural: list[str], first: list[str], dims: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    rest = [c for c in staged.columns if c not in natural and c not in ("season", "round")]
    return conform(staged, dims).select(*first, "season", "round", *rest)


def fct_results(results: DataFrame, races: DataFrame, drivers: DataFrame, constructors: DataFrame, statuses: DataFrame) -> DataFrame:
    dims = {"race_key": (races, ["season", "round"]), "driver_key": (drivers, ["driver_id"]), "constructor_key": (constructors, ["constructor_id"]), "status_key": (statuses, ["status"])}
    return _fact(results, ["driver_id", "constructor_id", "status"], list(dims), dims)


fct_sprint_results = fct_results


def fct_driver_standings(standings: DataFrame, races: DataFrame, drivers: DataFrame) -> DataFrame:
    dims = {"race_key": (races, ["season", "round"]), "driver_key": (drivers, ["driver_id"])}
    return _fact(standings, ["driver_id"], list(dims), dims)


def fct_constructor_standings(standings: DataFrame, races: DataFrame, constructors: DataFrame) -> DataFrame:
    dims = {"race_key": (races, ["season", "round"]), "constructor_key": (constructors, ["constructor_id"])}
    return _fact(standings, ["constructor_id"], list(dims), dims)


def rpt_pipeline_freshness(races: DataFrame, results: DataFrame, checkpoints: DataFrame, calls: DataFrame, as_of: Column) -> DataFrame:
    """One row, always: progress of the latest season, run or not, and times of the last run, call and change."""
    known = races.filter("not is_unknown")
    run = F.col("has_been_run")
    latest = known.agg(F.max("season").alias("season"))
    year = latest.join(known.withColumnRenamed("season", "s"), F.col("season") == F.col("s"), "left").groupBy("season").agg(
        F.count_if(run).alias("rounds_run"), F.count("s").alias("rounds_scheduled"),
        F.max(F.when(run, F.col("race_date"))).alias("last_race_date"), F.min(F.when(~run, F.col("race_date"))).alias("next_race_date"),
    )
    scopes = lambda status: F.count_if(F.col("status") == status)
    marks = checkpoints.agg(F.max("updated_at").alias("last_ingestion_at"), scopes("failed").alias("failed_scopes"), scopes("in_progress").alias("unfinished_scopes"))
    hour = F.unix_micros("called_at") > F.unix_micros(as_of) - 3_600_000_000
    used = calls.agg(F.max("called_at").alias("last_api_call_at"), F.count_if(hour).alias("api_calls_last_hour"))
    changed = results.agg(F.max(F.greatest("ingested_at", "updated_at")).alias("last_data_change_at"))
    return year.crossJoin(marks).crossJoin(used).crossJoin(changed).select(
        "season", "rounds_run", "rounds_scheduled", "last_race_date", "next_race_date", "last_ingestion_at", "last_api_call_at",
        "last_data_change_at", "failed_scopes", "unfinished_scopes", "api_calls_last_hour", as_of.alias("model_built_at"),
    )
