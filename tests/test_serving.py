"""SQL functions over the marts against their DataFrame forms; the order of names."""

from pyspark.sql import functions as F

from lapforge.functions import exprs
from lapforge.plans import bindings, dashboards, serving

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_functions_and_views(spark):
    b = bindings
    results, statuses, drivers, teams = b.results(spark, SF), b.statuses(spark, SF), b.drivers(spark, SF), b.nations(spark, SF).drop("driver_key")
    standings, calendar = b.standings(spark, SF), b.calendar(spark, SF).withColumns({"is_unknown": F.lit(False), "has_been_run": F.lit(True)})
    served = serving.register(spark, {"fct_results": results, "dim_status": statuses, "dim_driver": drivers, "dim_constructor": teams, "dim_race": calendar})
    assert served == ["why_cars_retire", "grid_vs_finish", "teammate_head_to_head", "reliability_by_era", "calendar_growth"]
    assert rows(spark.sql("SELECT * FROM why_cars_retire()")) == rows(dashboards.why_cars_retire(results, statuses))
    assert rows(spark.sql("SELECT * FROM why_cars_retire(:d)", args={"d": 1990})) == rows(dashboards.why_cars_retire(results, statuses, 1990))
    assert rows(spark.sql("SELECT * FROM grid_vs_finish(5, top_n => 3)")) == rows(dashboards.grid_vs_finish(results, drivers, 5, 3))
    assert rows(spark.sql("SELECT * FROM teammate_head_to_head(min_races => 1, season => 1996)")) == rows(dashboards.teammate_head_to_head(results, drivers, teams, 1996, 1))
    assert rows(spark.sql("SELECT * FROM reliability_by_era")) == rows(dashboards.reliability_by_era(results, statuses))
    named = b.nations(spark, SF)
    serving.register(spark, {"fct_driver_standings": standings, "dim_driver": named, "dim_race": calendar})
    assert rows(spark.sql("SELECT * FROM championship_progression(1997, 3)")) == rows(dashboards.championship_progression(standings, named, calendar, 1997, 3))
    plan = spark.sql("SELECT * FROM championship_progression(1997)")._jdf.queryExecution().executedPlan().toString()
    assert "season" in plan and "1997" in plan


def test_order_of_names(spark):
    """Names with accents stand beside those without, not behind z."""
    names = ["Zoe", "Émile", "Emma", "emil", "Öz", "Ola", "Étienne"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(exprs.by_name("n")).collect()] == ["emil", "Émile", "Emma", "Étienne", "Ola", "Öz", "Zoe"]
    drivers = spark.createDataFrame([(1, "Zoe"), (2, "Émile")], "driver_key int, full_name string")
    pairs = spark.createDataFrame([(1, 2, True, True, k, 3 - k, 1.0, 1.0) for k in (1, 2)], "a_driver_key int, b_driver_key int, a_is_classified boolean, b_is_classified boolean, a_classified_position int, b_classified_position int, a_points double, b_points double")
    got = dashboards.head_to_head(pairs, [], drivers, 1).first()
    assert (got.leader, got.trailer, got.leader_wins) == ("Émile", "Zoe", 1)
    standings = spark.createDataFrame([(2031, 1, 1, 1, 5.0, 1, ["z", "e", "f"], False)], "season int, round int, driver_key int, championship_position int, points double, wins int, constructor_ids array<string>, is_unranked boolean")
    teams = spark.createDataFrame([("z", "Zed"), ("e", "Écurie"), ("f", "Fast")], "constructor_id string, constructor_name string")
    out = dashboards.driver_standings_current(standings, drivers, teams)
    assert out.first().team == "Écurie / Fast / Zed" and dict(out.dtypes)["team"] == "string"
