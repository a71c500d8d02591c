"""Served queries over the star schema. Facts carry keys, season and round; names come from dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions.exprs import decade as decade_of
from lapforge.functions.exprs import by_name, ratio

STARTER = "status_category <> 'withdrawn_or_dns'"


def _last_round(standings: DataFrame, season: int | None = None) -> DataFrame:
    """Latest season (or the given one) and its last round: one row."""
    rows = standings if season is None else standings.filter(F.col("season") == season)
    return rows.agg(F.max_by("season", F.struct("season", "round")).alias("season"), F.max_by("round", F.struct("season", "round")).alias("round"))


def _categorised(results: DataFrame, statuses: DataFrame) -> DataFrame:
    """Results with the category of their status. Few statuses hold all results, so these stay where they are and the dimension goes to them."""
    return results.join(F.broadcast(statuses.select("status_key", "status_category")), "status_key")


def championship_progression(standings: DataFrame, drivers: DataFrame, races: DataFrame, season: int, top_n: int = 5) -> DataFrame:
    """Running points of those who end the season in the top n."""
    year = standings.filter(F.col("season") == season)
    final = year.join(_last_round(standings, season), ["season", "round"]).filter(F.col("championship_position") <= top_n)
    final = final.select("driver_key", F.col("championship_position").alias("final_position"))
    named = year.join(final, "driver_key").join(drivers.select("driver_key", "full_name"), "driver_key")
    named = named.join(races.select("season", "round", F.col("race_name").alias("race")), ["season", "round"])
    return named.select("round", "race", F.col("full_name").alias("driver"), "points", "final_position").orderBy("final_position", "round")


def reliability_by_era(results: DataFrame, statuses: DataFrame) -> DataFrame:
    """Retirements per start by decade; those who didn't start count in neither half."""
    by = _categorised(results, statuses).filter(STARTER).groupBy(decade_of(F.col("season")).alias("decade"))
    out = by.agg(F.count("*").alias("starts"), F.count_if(~F.col("is_classified")).alias("dnfs"))
    return out.withColumn("dnf_rate", ratio(F.col("dnfs"), F.col("starts"))).orderBy("decade")


def why_cars_retire(results: DataFrame, statuses: DataFrame, decade: int | None = None) -> DataFrame:
    """Causes of retirements and their shares, of all seasons or of a decade."""
    rows = results if decade is None else results.filter(F.col("season").between(decade, decade + 9))
    rows = _categorised(rows, statuses).filter(STARTER).filter(~F.col("is_classified"))
    out = rows.groupBy(F.col("status_category").alias("cause")).agg(F.count("*").alias("retirements"))
    share = ratio(F.col("retirements"), F.sum("retirements").over(Window.partitionBy()))
    return out.withColumn("share", share).orderBy(F.desc("retirements"), "cause")


def grid_vs_finish(results: DataFrame, drivers: DataFrame, min_races: int = 100, top_n: int = 15) -> DataFrame:
    """Drivers who gain most positions, by mean over the races that count; the Unknown driver is none of them."""
    gained = results.filter("positions_gained is not null").groupBy("driver_key")
    rows = gained.agg(F.count("*").alias("races_counted"), F.sum("positions_gained").alias("g"), F.sum("grid_position").alias("s"), F.max("positions_gained").alias("best_single_race"))
    known = drivers.filter("not is_unknown").select("driver_key", "full_name")
    named = rows.filter(F.col("races_counted") >= min_races).join(known, "driver_key")
    mean = lambda c, d: F.round(F.col(c).cast("decimal(18,6)") / F.col("races_counted").cast("decimal(18,6)"), d).cast(f"decimal(18,{d})")
    out = named.select(F.col("full_name").alias("driver"), "races_counted", mean("g", 2).alias("avg_positions_gained"), mean("s", 1).alias("avg_grid"), "best_single_race")
    return out.orderBy(F.desc("avg_positions_gained"), by_name("driver")).limit(top_n)


def data_freshness(report: DataFrame, as_of: Column) -> DataFrame:
    """When the pipeline ran, data changed and models were built; progress as 'x of y'."""
    age = F.round((F.unix_micros(as_of) - F.unix_micros("last_ingestion_at")).cast("decimal(24,6)") / F.lit(3_600_000_000), 1).cast("decimal(18,1)")
    progress = F.concat(F.col("rounds_run").cast("string"), F.lit(" of "), F.col("rounds_scheduled").cast("string"))
    return report.select(
        "season", progress.alias("season_progress"), F.col("last_race_date").alias("last_race"), F.col("next_race_date").alias("next_race"),
        F.col("last_ingestion_at").alias("pipeline_last_ran"), age.alias("hours_since_run"), F.col("last_data_change_at").alias("data_last_changed"),
        "failed_scopes", "unfinished_scopes", "api_calls_last_hour", F.col("model_built_at").alias("models_last_built"),
    )


def driver_standings_current(standings: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    """Latest snapshot; a driver's teams are joined by name."""
    now = standings.join(_last_round(standings), ["season", "round"])
    teams = now.select("driver_key", F.explode_outer("constructor_ids").alias("constructor_id")).join(constructors.select("constructor_id", "constructor_name"), "constructor_id", "left")
    team = teams.groupBy("driver_key").agg(F.collate(F.array_join(F.array_sort(F.collect_list(by_name("constructor_name"))), " / "), "UTF8_BINARY").alias("team"))
    return now.join(team, "driver_key").join(drivers.select("driver_key", "full_name"), "driver_key").select(F.col("championship_position").alias("position"), F.col("full_name").alias("driver"), "team", "points", "wins", F.col("round").alias("after_round"), "is_unranked").orderBy(F.asc_nulls_last("position"), F.desc("points"), by_name("driver"))


def constructor_standings_current(standings: DataFrame, constructors: DataFrame) -> DataFrame:
    now = standings.join(_last_round(standings), ["season", "round"])
    return now.join(constructors.select("constructor_key", "constructor_name"), "constructor_key").select(F.col("championship_position").alias("position"), F.col("constructor_name").alias("team"), "points", "wins", F.col("round").alias("after_round")).orderBy(F.asc_nulls_last("position"), F.desc("points"), by_name("team"))


def calendar_growth(races: DataFrame) -> DataFrame:
    return races.filter("not is_unknown").groupBy("season").agg(F.count("*").alias("scheduled"), F.count_if("has_been_run").alias("run")).orderBy("season")


def circuit_map(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """Races run at each known circuit, and where it lies."""
    held = races.filter("has_been_run and not is_unknown").groupBy("circuit_key")
    held = held.agg(F.count("*").alias("races_held"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    place = circuits.filter("not is_unknown").select("circuit_key", F.col("circuit_name").alias("circuit"), "locality", "country", "latitude", "longitude")
    return held.join(place, "circuit_key").select("circuit", "locality", "country", "latitude", "longitude", "races_held", "first_season", "last_season").orderBy(F.desc("races_held"), by_name("circuit"))


def duels(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of rows of two sides that share ``on``; the first has the smaller driver key."""
    cols = ["driver_key", "classified_position", "is_classified", "points"]
    left = a.select(*on, *[F.col(c).alias(f"a_{c}") for c in cols])
    right = b.select(*on, *[F.col(c).alias(f"b_{c}") for c in cols])
    return left.join(right, on).filter("a_driver_key < b_driver_key")


def head_to_head(pairs: DataFrame, by: list[str], drivers: DataFrame, min_races: int) -> DataFrame:
    """Record of each pair: wins where both were classified, points over all shared races; leader by wins, then name, as names are ordered."""
    both = F.col("a_is_classified") & F.col("b_is_classified")
    agg = pairs.groupBy(*by, "a_driver_key", "b_driver_key").agg(
        F.count_if(both).alias("races_compared"), F.count_if(both & (F.col("a_classified_position") < F.col("b_classified_position"))).alias("a_wins"),
        F.count_if(both & (F.col("b_classified_position") < F.col("a_classified_position"))).alias("b_wins"), F.sum("a_points").cast("decimal(18,4)").alias("a_points"), F.sum("b_points").cast("decimal(18,4)").alias("b_points"),
    ).filter(F.col("races_compared") >= min_races)
    name = lambda s: drivers.select(F.col("driver_key").alias(f"{s}_driver_key"), F.col("full_name").alias(f"{s}_name"))
    named = agg.join(name("a"), "a_driver_key").join(name("b"), "b_driver_key")
    ahead = (F.col("a_wins") > F.col("b_wins")) | ((F.col("a_wins") == F.col("b_wins")) & (by_name("a_name") < by_name("b_name")))
    pick = lambda c, first: F.when(ahead if first else ~ahead, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))
    return named.select(*by, "races_compared", pick("name", True).alias("leader"), pick("wins", True).alias("leader_wins"), pick("name", False).alias("trailer"), pick("wins", False).alias("trailer_wins"), pick("points", True).alias("leader_points"), pick("points", False).alias("trailer_points"))


def teammate_head_to_head(results: DataFrame, drivers: DataFrame, constructors: DataFrame, season: int, min_races: int = 3) -> DataFrame:
    """Teammates of a season. Groups are the entries of one team in one race, so pairs stay few; unknown members don't pair."""
    year = results.filter(F.col("season") == season)
    pairs = duels(year, year, ["season", "race_key", "constructor_key"])
    record = head_to_head(pairs, ["constructor_key"], drivers, min_races).join(constructors.select("constructor_key", F.col("constructor_name").alias("team")), "constructor_key")
    surname = lambda c: F.split_part(F.col(c), F.lit(" "), F.lit(-1))
    label = F.concat("team", F.lit(": "), surname("leader"), F.lit(" "), F.col("leader_wins").cast("string"), F.lit("-"), F.col("trailer_wins").cast("string"), F.lit(" "), surname("trailer"))
    return record.select(label.alias("pairing"), "team", "races_compared", "leader", "leader_wins", "trailer", "trailer_wins", "leader_points", "trailer_points")


def gap_to_leader(standings: DataFrame, season: int, top_n: int = 3) -> DataFrame:
    year = standings.filter(F.col("season") == season)
    final = year.join(_last_round(standings, season), ["season", "round"]).filter(F.col("championship_position") <= top_n).select("driver_key")
    best = year.groupBy("round").agg(F.max("points").alias("best"))
    return year.join(final, "driver_key").join(best, "round").select("round", "driver_key", "points", (F.col("best") - F.col("points")).cast("decimal(18,4)").alias("gap"))


def _top_two(standings: DataFrame) -> DataFrame:
    by = standings.groupBy("season", "round")
    return by.agg(F.max(F.when(F.col("championship_position") == 1, F.col("points"))).alias("first"), F.max(F.when(F.col("championship_position") == 2, F.col("points"))).alias("second"))


def title_decided(standings: DataFrame, available: DataFrame) -> DataFrame:
    """First round of each season after which the lead exceeds the points still available (season, round, available)."""
    lead = _top_two(standings).join(available, ["season", "round"]).filter(F.col("first") - F.col("second") > F.col("available"))
    return lead.groupBy("season").agg(F.min("round").alias("round"))


def finishing_order(results: DataFrame, race_key: object) -> DataFrame:
    return results.filter(F.col("race_key") == race_key).select("classified_position", "driver_key", "is_classified", "points").orderBy("classified_position")


def scoring_rates(results: DataFrame, statuses: DataFrame, by: list[str], podium: int = 3) -> DataFrame:
    """Wins and podiums per start, points per race."""
    at = lambda k: F.count_if(F.col("is_classified") & (F.col("classified_position") <= k))
    out = _categorised(results, statuses).filter(STARTER).groupBy(*by).agg(F.count("*").alias("starts"), at(1).alias("wins"), at(podium).alias("podiums"), F.sum("points").alias("p"))
    return out.select(*by, "starts", ratio(F.col("wins"), F.col("starts")).alias("win_rate"), ratio(F.col("podiums"), F.col("starts")).alias("podium_rate"), ratio(F.col("p"), F.col("starts")).alias("points_per_race"))


def constructor_points(results: DataFrame) -> DataFrame:
    out = results.groupBy("season", "constructor_key").agg(F.sum("points").cast("decimal(18,4)").alias("points"))
    return out.withColumn("rank", F.rank().over(Window.partitionBy("season").orderBy(F.desc("points"))))


def outcomes(results: DataFrame, statuses: DataFrame, by: str) -> DataFrame:
    return _categorised(results, statuses).groupBy(by, "status_category").agg(F.count("*").alias("entries"), F.count_if("is_classified").alias("classified"))


def pole_to_win(results: DataFrame) -> DataFrame:
    poles = results.filter("grid_position = 1").groupBy("season").agg(F.count("*").alias("poles"), F.count_if(F.col("is_classified") & (F.col("classified_position") == 1)).alias("won"))
    return poles.withColumn("conversion", ratio(F.col("won"), F.col("poles")))


def driver_head_to_head(results: DataFrame, drivers: DataFrame, season: int, one: object, other: object) -> DataFrame:
    year = results.filter(F.col("season") == season)
    low, high = sorted([one, other])
    pairs = duels(year.filter(F.col("driver_key") == low), year.filter(F.col("driver_key") == high), ["race_key"])
    return head_to_head(pairs, [], drivers, 0)


def constructor_head_to_head(results: DataFrame, season: int) -> DataFrame:
    """Points of every two constructors of a season; constructors are few."""
    points = constructor_points(results).filter(F.col("season") == season)
    a, b = (points.select("season", F.col("constructor_key").alias(f"{s}_key"), F.col("points").alias(f"{s}_points")) for s in "ab")
    return a.join(b, "season").filter("a_key < b_key").select("a_key", "b_key", "a_points", "b_points", (F.col("a_points") - F.col("b_points")).cast("decimal(18,4)").alias("margin"))


def circuits_of_driver(results: DataFrame, races: DataFrame, driver_key: object, min_starts: int = 2) -> DataFrame:
    rows = results.filter((F.col("driver_key") == driver_key) & F.col("is_classified")).join(races.select("race_key", "circuit_key"), "race_key")
    out = rows.groupBy("circuit_key").agg(F.count("*").alias("starts"), F.sum("classified_position").alias("s"))
    return out.filter(F.col("starts") >= min_starts).select("circuit_key", "starts", ratio(F.col("s"), F.col("starts"), 2).alias("avg_finish"))


def constructor_trend(results: DataFrame) -> DataFrame:
    back = Window.partitionBy("constructor_key").orderBy("season")
    return constructor_points(results).withColumn("change", (F.col("points") - F.lag("points").over(back)).cast("decimal(18,4)")).select("constructor_key", "season", "points", "change")


def closest_title_fights(standings: DataFrame) -> DataFrame:
    last = standings.groupBy("season").agg(F.max("round").alias("round"))
    return _top_two(standings).join(last, ["season", "round"]).select("season", (F.col("first") - F.col("second")).cast("decimal(18,4)").alias("margin")).orderBy("margin", "season")


def points_by_round(standings: DataFrame) -> DataFrame:
    back = Window.partitionBy("season", "driver_key").orderBy("round")
    return standings.select("season", "round", "driver_key", (F.col("points") - F.coalesce(F.lag("points").over(back), F.lit(0))).cast("decimal(18,4)").alias("scored"))


def qualifying_vs_grid(qualifying: DataFrame, results: DataFrame) -> DataFrame:
    """Entries that start elsewhere than they qualified."""
    both = qualifying.select("race_key", "driver_key", "qualifying_position").join(results.select("race_key", "driver_key", "grid_position"), ["race_key", "driver_key"])
    return both.withColumn("lost", F.col("grid_position") - F.col("qualifying_position")).filter("lost <> 0")
