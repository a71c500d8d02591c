"""Data-quality checks: each returns the offending rows; none means it passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions.exprs import unknown_key


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once; a single null column doesn't count."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def accepted_values(df: DataFrame, column: str, values: list, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    keys = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def row_count(df: DataFrame, equals: int) -> DataFrame:
    return df.agg(F.count("*").alias("n")).filter(F.col("n") != equals)


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.agg(F.count("*").alias("n_a")).crossJoin(b.agg(F.count("*").alias("n_b"))).filter("n_a <> n_b")


def freshness(df: DataFrame, column: str, now: Column, warn_hours: int = 36, error_hours: int = 168) -> DataFrame:
    age = F.unix_micros(now) - F.unix_micros(F.max(column))
    hours = 3_600_000_000
    return df.agg(F.max(column).alias("latest"), F.when(age.isNull() | (age > error_hours * hours), "error").when(age > warn_hours * hours, "warn").otherwise("pass").alias("status"))


def no_unknown_members(fact: DataFrame, keys: list[str]) -> DataFrame:
    parts = [fact.filter(F.col(k) == unknown_key()).groupBy(F.lit(k).alias("key")).agg(F.count("*").alias("rows")) for k in keys]
    return reduce(DataFrame.unionByName, parts)


def reconcile(official: DataFrame, derived: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Rows whose official and derived ``value`` differ, nulls equal; ``how="full"`` reports both sides."""
    a = official.select(*keys, F.col("value").alias("official"))
    b = derived.select(*keys, F.col("value").alias("derived"))
    return a.join(b, keys, how).filter(~F.col("official").eqNullSafe(F.col("derived")))


def final_rounds(races: DataFrame, first_season: int) -> DataFrame:
    """Last round of each season all of whose races have been run."""
    known = races.filter("not is_unknown")
    return known.groupBy("season").agg(F.bool_and("has_been_run").alias("done"), F.max("round").alias("round")).filter((F.col("season") >= first_season) & F.col("done")).select("season", "round")


def standings_reconcile(standings: DataFrame, results: DataFrame, sprints: DataFrame, races: DataFrame, first_season: int = 1991, how: str = "left") -> DataFrame:
    """Official final standings that results and sprints don't add up to; ``how="full"``: also points without a standing."""
    last = final_rounds(races, first_season)
    official = standings.join(last, ["season", "round"], "left_semi").select("season", "driver_key", F.col("points").alias("value"))
    scored = results.select("season", "driver_key", "points").unionByName(sprints.select("season", "driver_key", "points"))
    derived = scored.join(last.select("season"), "season", "left_semi").groupBy("season", "driver_key").agg(F.sum("points").alias("value"))
    return reconcile(official, derived, ["season", "driver_key"], how)


def status_counts(results: DataFrame, statuses: DataFrame) -> DataFrame:
    seen = results.groupBy("status_key").agg(F.count("*").alias("value"))
    wanted = statuses.filter("not is_unknown").select("status_key", F.col("source_all_time_count").cast("long").alias("value"))
    return reconcile(wanted, seen, ["status_key"])


def drift(races: DataFrame, seasons: DataFrame) -> DataFrame:
    return races.select("season").distinct().join(seasons.select("season"), "season", "left_anti")


def suite(spark: SparkSession, checks: dict[str, tuple[str, DataFrame]], needs: dict[str, list[str]] | None = None) -> DataFrame:
    """One row a check (name -> (severity, offenders)): failing rows, whether it passed, whether it was skipped.

    A check whose ``needs`` name one that failed as an error, or was skipped, is
    skipped itself: its failing rows are null and it hasn't passed.
    """
    one = lambda n: checks[n][1].agg(F.lit(n).alias("name"), F.lit(checks[n][0]).alias("severity"), F.count("*").alias("failing"))
    needs = {n: needs[n] for n in checks if needs and needs.get(n)}
    left, stopped, done, parts = list(checks), set(), set(), []
    while left:
        now = [n for n in left if set(needs.get(n, [])) <= done]
        if not now:
            raise ValueError(f"checks need each other or unknown ones: {left}")
        run = [n for n in now if not stopped & set(needs.get(n, []))]
        if run:
            found = reduce(DataFrame.unionByName, map(one, run))
            if needs:
                rows = [(r["name"], r["severity"], r["failing"]) for r in found.collect()]
                stopped |= {n for n, severity, failing in rows if failing and severity == "error"}
                found = spark.createDataFrame(rows, "name string, severity string, failing long")
            parts.append(found.withColumn("skipped", F.lit(False)))
        if skipped := [(n, checks[n][0], None, True) for n in now if n not in run]:
            stopped |= {n for n, *_ in skipped}
            parts.append(spark.createDataFrame(skipped, "name string, severity string, failing long, skipped boolean"))
        done |= set(now)
        left = [n for n in left if n not in done]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.coalesce(F.col("failing") == 0, F.lit(False)))
