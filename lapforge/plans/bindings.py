"""The warehouse operators bound to the star-schema test tables, each with its DuckDB twin.

Race = order, season and round = its year and month, driver = supplier,
constructor = supplier's nation, circuit = customer's nation.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapforge.functions import exprs as x
from lapforge.operators import extract, fused, merge, profile, quality, state
from lapforge.plans import dashboards as d
from lapforge.plans import marts, serving, store
from lapforge.sources import lake, versions
from lapforge.sources.entities import EntitySpec
from lapforge.streaming import loader

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = "1998-06-30"
NOW = "2024-01-20 12:00:00"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = _WITH + sql if "results" in sql or "standings" in sql or " races" in sql or "top2" in sql else sql
        return f

    return register


#: Marts stored in this session, by application, table folder and name: what their tables looked like, and the path.
_STORED: dict[tuple[str, str, str], tuple[tuple, str]] = {}
_READ = ("lineitem", "orders", "supplier", "nation")
#: Status text of each outcome of the test tables.
CAUSES = {"withdrawn_or_dns": "Withdrew", "collision": "Collision", "mechanical": "Gearbox", "lapped": "Lapped", "finished": "Finished"}


def mart(*partition_by: str) -> Callable[[Query], Query]:
    """Store the table of a function once a session and folder; every query reads it from there. It is built anew, and the old one deleted, when files of the tables change."""

    def register(build: Query) -> Query:
        def read(spark: SparkSession, sf: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf, build.__name__)
            now = tuple(versions.stamp(spark, f"{sf}/{n}.parquet") for n in _READ)
            known, path = _STORED.get(key, (None, ""))
            if known == now:
                return spark.read.parquet(path)
            if path:
                versions.delete(spark, path)
            path = store.new_folder(spark, build.__name__)
            out = store.write_table(build(spark, sf), path, partition_by)
            _STORED[key] = now, path
            return out

        return read

    return register


#: Bytes of a stored table that a task sorts at a time, so that a task's memory doesn't follow the table.
SORTED_BYTES = 8 << 20


def dealt(rows: DataFrame, key: str, stored: int) -> DataFrame:
    """Rows of a table of ``stored`` bytes by the hash of a key; in as many parts as keep each small where the table is large."""
    parts = -(-stored // SORTED_BYTES)
    session = rows.sparkSession
    if parts <= session.sparkContext.defaultParallelism:
        return rows.repartition(key)
    return rows.repartition(max(parts, int(session.conf.get("spark.sql.shuffle.partitions"))), key)


@mart("season")
def results(spark: SparkSession, sf: str) -> DataFrame:
    """One row an order and supplier: its dearest line. Everything after the one shuffle by order stays in place."""
    order = ["l_extendedprice", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"]
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", *order)
    lines = dealt(lines, "l_orderkey", sum(size for _, size, _ in versions.stamp(spark, f"{sf}/lineitem.parquet")))
    lines = lines.groupBy("l_orderkey", "l_suppkey").agg(F.max(F.struct(*order)).alias("x")).select("l_orderkey", "l_suppkey", "x.*")
    orders = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round"))
    nations = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_suppkey"))
    fine = (F.col("l_returnflag") != "R") & (F.col("l_tax") != 0)
    retired = F.when(F.col("l_linestatus") == "O", CAUSES["collision"]).otherwise(CAUSES["mechanical"])
    status = F.when(F.col("l_tax") == 0, CAUSES["withdrawn_or_dns"]).when(F.col("l_returnflag") == "R", retired)
    status = status.when(F.col("l_returnflag") == "A", CAUSES["lapped"]).otherwise(CAUSES["finished"])
    return lines.withColumn("classified_position", place).join(orders, "l_orderkey").join(nations, "l_suppkey").select(
        F.col("l_orderkey").alias("race_key"), "season", "round", F.col("l_suppkey").alias("driver_key"), F.col("s_nationkey").alias("constructor_key"),
        F.col("l_linenumber").alias("grid_position"), "classified_position", F.col("l_quantity").cast("decimal(12,4)").alias("points"),
        fine.alias("is_classified"), x.surrogate_key(status).alias("status_key"),
    ).withColumn("positions_gained", F.when(F.col("is_classified") & (F.col("grid_position") > 0), F.col("grid_position") - F.col("classified_position")))


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(k, text, 0) for k, text in enumerate(CAUSES.values())]
    return marts.dim_status(spark.createDataFrame(rows, "status_id int, status string, source_all_time_count int"))


@mart()
def standings(spark: SparkSession, sf: str) -> DataFrame:
    """Running points and wins of nations by month."""
    won = F.col("is_classified") & (F.col("classified_position") == 1)
    by = results(spark, sf).groupBy("season", "round", F.col("constructor_key").alias("driver_key")).agg(F.sum("points").alias("p"), F.count_if(won).alias("w"))
    run = Window.partitionBy("season", "driver_key").orderBy("round")
    total = by.select("season", "round", "driver_key", F.sum("p").over(run).cast("decimal(18,4)").alias("points"), F.sum("w").over(run).alias("wins"))
    rank = F.row_number().over(Window.partitionBy("season", "round").orderBy(F.desc("points"), "driver_key"))
    regions = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("driver_key"), F.array("n_regionkey", ((F.col("n_regionkey") + 1) % 5).cast("int")).alias("constructor_ids"))
    return total.withColumn("championship_position", rank).join(regions, "driver_key").withColumn("is_unranked", F.col("championship_position").isNull())


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """A race a month."""
    months = _t(spark, sf, "orders").select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round")).distinct()
    return months.withColumn("race_name", F.format_string("Month %d of %d", "round", "season"))


def races(spark: SparkSession, sf: str) -> DataFrame:
    nations = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("circuit_key"))
    day = F.to_date("o_orderdate")
    return _t(spark, sf, "orders").join(nations, "o_custkey").select(F.col("o_orderkey").alias("race_key"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round"), "circuit_key", day.alias("race_date"), (day <= F.lit(AS_OF).cast("date")).alias("has_been_run"), F.lit(False).alias("is_unknown"))


def drivers(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("driver_key"), F.col("s_name").alias("full_name"), F.lit(False).alias("is_unknown"))


def nations(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation")
    return n.select(*[F.col("n_nationkey").alias(c) for c in ("driver_key", "constructor_key", "circuit_key")], *[F.col("n_name").alias(c) for c in ("full_name", "constructor_name", "circuit_name", "country")], F.concat("n_name", F.lit(" town")).alias("locality"), (F.col("n_nationkey") * 1.5).alias("latitude"), (F.col("n_nationkey") * -2.25).alias("longitude"), F.lit(False).alias("is_unknown"))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "region").select(F.col("r_regionkey").alias("constructor_id"), F.col("r_name").alias("constructor_name"))


_WITH = f"""
WITH li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_extendedprice DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_returnflag DESC, l_linestatus DESC, l_tax DESC) AS rn FROM lineitem),
r0 AS (SELECT l_orderkey AS race_key, year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, l_suppkey AS driver_key, s_nationkey AS constructor_key, l_linenumber AS grid_position,
  (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_suppkey))::INT AS classified_position, l_quantity::DECIMAL(12,4) AS points, (l_returnflag <> 'R' AND l_tax <> 0) AS is_classified,
  CASE WHEN l_tax = 0 THEN 'withdrawn_or_dns' WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'collision' ELSE 'mechanical' END WHEN l_returnflag = 'A' THEN 'lapped' ELSE 'finished' END AS status_category
  FROM li JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE rn = 1),
results AS (SELECT *, CASE WHEN is_classified AND grid_position > 0 THEN grid_position - classified_position END AS positions_gained FROM r0),
s0 AS (SELECT season, round, constructor_key AS driver_key, sum(points) AS p, count(*) FILTER (WHERE is_classified AND classified_position = 1) AS w FROM results GROUP BY ALL),
s1 AS (SELECT season, round, driver_key, (sum(p) OVER (PARTITION BY season, driver_key ORDER BY round))::DECIMAL(18,4) AS points, (sum(w) OVER (PARTITION BY season, driver_key ORDER BY round))::BIGINT AS wins FROM s0),
standings AS (SELECT *, (row_number() OVER (PARTITION BY season, round ORDER BY points DESC, driver_key))::INT AS championship_position FROM s1),
races AS (SELECT o_orderkey AS race_key, year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, c_nationkey AS circuit_key, o_orderdate::DATE AS race_date, o_orderdate::DATE <= DATE '{AS_OF}' AS has_been_run
  FROM orders JOIN customer ON c_custkey = o_custkey),
top2 AS (SELECT season, round, max(points) FILTER (WHERE championship_position = 1) AS first, max(points) FILTER (WHERE championship_position = 2) AS second FROM standings GROUP BY ALL)
"""


def _pct(a: str, b: str, digits: int = 4) -> str:
    """Half-up decimal share in integers, as doubles would round some ties otherwise."""
    scale = 10**digits
    return f"((floor((2 * {scale} * ({a})::HUGEINT + ({b})::HUGEINT)::DECIMAL(38,0) / (2 * ({b}))::DECIMAL(38,0)))::DECIMAL(24,0) / {scale})::DECIMAL(18,{digits})"


@query("v1_progression", "SELECT s.round, 'Month ' || s.round || ' of ' || s.season AS race, n_name AS driver, s.points, f.championship_position AS final_position FROM standings s JOIN (SELECT driver_key, championship_position FROM standings WHERE season = 1997 AND round = (SELECT max(round) FROM standings WHERE season = 1997) AND championship_position <= 5) f USING (driver_key) JOIN nation ON n_nationkey = s.driver_key WHERE s.season = 1997")
def v1(spark: SparkSession, sf: str) -> DataFrame:
    return d.championship_progression(standings(spark, sf), nations(spark, sf), calendar(spark, sf), 1997)


@query("v2_reliability", f"SELECT ((season // 10) * 10)::INT AS decade, count(*) AS starts, count(*) FILTER (WHERE NOT is_classified) AS dnfs, {_pct('count(*) FILTER (WHERE NOT is_classified)', 'count(*)')} AS dnf_rate FROM results WHERE status_category <> 'withdrawn_or_dns' GROUP BY 1")
def v2(spark: SparkSession, sf: str) -> DataFrame:
    return d.reliability_by_era(results(spark, sf), statuses(spark, sf))


@query("v3_causes", f"SELECT status_category AS cause, count(*) AS retirements, {_pct('count(*)', '(sum(count(*)) OVER ())')} AS share FROM results WHERE status_category <> 'withdrawn_or_dns' AND NOT is_classified AND season BETWEEN 1990 AND 1999 GROUP BY 1")
def v3(spark: SparkSession, sf: str) -> DataFrame:
    return d.why_cars_retire(results(spark, sf), statuses(spark, sf), 1990)


@query("v4_grid_vs_finish", "SELECT s_name AS driver, races_counted, round(g::DECIMAL(18,6) / races_counted::DECIMAL(18,6), 2)::DECIMAL(18,2) AS avg_positions_gained, round(s::DECIMAL(18,6) / races_counted::DECIMAL(18,6), 1)::DECIMAL(18,1) AS avg_grid, best_single_race FROM (SELECT driver_key, count(*) AS races_counted, sum(positions_gained) AS g, sum(grid_position) AS s, max(positions_gained) AS best_single_race FROM results WHERE positions_gained IS NOT NULL GROUP BY 1 HAVING count(*) >= 20) JOIN supplier ON s_suppkey = driver_key ORDER BY avg_positions_gained DESC, driver LIMIT 15")
def v4(spark: SparkSession, sf: str) -> DataFrame:
    return d.grid_vs_finish(results(spark, sf), drivers(spark, sf), 20)


def _served(spark: SparkSession, sf: str) -> None:
    """The marts of the test tables under the names that SQL users know."""
    serving.register(spark, {"fct_results": results(spark, sf), "dim_status": statuses(spark, sf), "dim_constructor": nations(spark, sf).drop("driver_key"), "dim_driver": drivers(spark, sf)})


@query("sql_progression", ORACLES["v1_progression"].removeprefix(_WITH))
def sql_progression(spark: SparkSession, sf: str) -> DataFrame:
    """V1 through its SQL function; the season comes as an argument of the statement."""
    months = calendar(spark, sf).withColumns({"is_unknown": F.lit(False), "has_been_run": F.lit(True)})
    serving.register(spark, {"fct_driver_standings": standings(spark, sf), "dim_driver": nations(spark, sf), "dim_race": months})
    return spark.sql("SELECT * FROM championship_progression(season => :season)", args={"season": 1997})


@query("sql_causes", ORACLES["v3_causes"].removeprefix(_WITH))
def sql_causes(spark: SparkSession, sf: str) -> DataFrame:
    _served(spark, sf)
    return spark.sql("SELECT * FROM why_cars_retire(decade => 1990)")


@query("sql_grid", ORACLES["v4_grid_vs_finish"].removeprefix(_WITH))
def sql_grid(spark: SparkSession, sf: str) -> DataFrame:
    _served(spark, sf)
    return spark.sql("SELECT * FROM grid_vs_finish(min_races => 20)")


@query("sql_eras", "SELECT decade, status_category AS cause, count(*) AS retirements FROM results, (SELECT DISTINCT (season // 10 * 10)::INT AS decade FROM results) WHERE season BETWEEN decade AND decade + 9 AND status_category <> 'withdrawn_or_dns' AND NOT is_classified GROUP BY ALL")
def sql_eras(spark: SparkSession, sf: str) -> DataFrame:
    """A served function called for each decade of another query."""
    _served(spark, sf)
    return spark.sql("SELECT d.decade, c.cause, c.retirements FROM (SELECT DISTINCT season - season % 10 AS decade FROM fct_results) AS d, LATERAL why_cars_retire(d.decade) AS c")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("called_at"), F.col("event_type").alias("entity"), "event_id")


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


@query(
    "v5_freshness",
    f"""WITH n AS (SELECT TIMESTAMP '{NOW}' AS t), e AS (SELECT * FROM events, n WHERE ts <= t), y AS (SELECT max(year(o_orderdate)) AS season FROM orders),
    r AS (SELECT o_orderdate::DATE AS day FROM orders, y WHERE year(o_orderdate) = season), c AS (SELECT day <= DATE '{AS_OF}' AS run, day FROM r)
    SELECT (SELECT season FROM y)::INT AS season, (SELECT count(*) FILTER (WHERE run) || ' of ' || count(*) FROM c) AS season_progress,
    (SELECT max(day) FROM c WHERE run) AS last_race, (SELECT min(day) FROM c WHERE NOT run) AS next_race, (SELECT max(ts) FROM e) AS pipeline_last_ran,
    (SELECT floor((20 * (epoch_us(t) - (SELECT max(epoch_us(ts)) FROM e))::HUGEINT + 3600000000)::DECIMAL(38,0) / 7200000000)::DECIMAL(18,0) / 10 FROM n)::DECIMAL(18,1) AS hours_since_run,
    (SELECT max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END) FROM orders)::TIMESTAMP AS data_last_changed,
    (SELECT count(DISTINCT event_type) FROM e WHERE event_type = 'error') AS failed_scopes, (SELECT count(DISTINCT event_type) FROM e WHERE event_type = 'click') AS unfinished_scopes,
    (SELECT count(*) FROM e WHERE ts > t - INTERVAL 1 HOUR) AS api_calls_last_hour, (SELECT t FROM n) AS models_last_built""",
)
def v5(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf).filter(F.col("called_at") <= _now())
    status = F.when(F.col("scope") == "error", "failed").when(F.col("scope") == "click", "in_progress").otherwise("complete")
    marks = log.groupBy(F.col("entity").alias("scope")).agg(F.max("called_at").alias("updated_at")).withColumn("status", status)
    at = F.col("o_orderdate").cast("timestamp")
    changed = _t(spark, sf, "orders").select(at.alias("ingested_at"), F.when(F.col("o_orderkey") % 2 == 0, at + F.expr("interval 1 day")).otherwise(at).alias("updated_at"))
    return d.data_freshness(marts.rpt_pipeline_freshness(races(spark, sf), changed, marks, log, _now()), _now())


@query("v6_driver_standings", "SELECT s.championship_position AS position, n.n_name AS driver, (SELECT string_agg(r_name, ' / ' ORDER BY r_name) FROM region WHERE r_regionkey IN (n.n_regionkey, (n.n_regionkey + 1) % 5)) AS team, s.points, s.wins, s.round AS after_round, false AS is_unranked FROM standings s JOIN nation n ON n_nationkey = driver_key WHERE (season, round) = (SELECT (season, round) FROM standings ORDER BY season DESC, round DESC LIMIT 1)")
def v6(spark: SparkSession, sf: str) -> DataFrame:
    return d.driver_standings_current(standings(spark, sf), nations(spark, sf), regions(spark, sf))


@query("v7_constructor_standings", "SELECT s.championship_position AS position, n.n_name AS team, s.points, s.wins, s.round AS after_round FROM standings s JOIN nation n ON n_nationkey = driver_key WHERE (season, round) = (SELECT (season, round) FROM standings ORDER BY season DESC, round DESC LIMIT 1)")
def v7(spark: SparkSession, sf: str) -> DataFrame:
    return d.constructor_standings_current(standings(spark, sf).withColumnRenamed("driver_key", "constructor_key"), nations(spark, sf).drop("driver_key"))


@query("v8_calendar", "SELECT season, count(*) AS scheduled, count(*) FILTER (WHERE has_been_run) AS run FROM races GROUP BY 1")
def v8(spark: SparkSession, sf: str) -> DataFrame:
    return d.calendar_growth(races(spark, sf))


@query("v9_circuits", "SELECT n_name AS circuit, n_name || ' town' AS locality, n_name AS country, n_nationkey * 1.5::DOUBLE AS latitude, n_nationkey * -2.25::DOUBLE AS longitude, count(*) AS races_held, min(season) AS first_season, max(season) AS last_season FROM races JOIN nation ON n_nationkey = circuit_key WHERE has_been_run GROUP BY ALL")
def v9(spark: SparkSession, sf: str) -> DataFrame:
    return d.circuit_map(races(spark, sf), nations(spark, sf))


_DUEL = """, pairs AS (SELECT a.season, a.constructor_key, a.driver_key AS a, b.driver_key AS b, a.is_classified AND b.is_classified AS ok, a.classified_position AS pa, b.classified_position AS pb, a.points AS qa, b.points AS qb
  FROM results a JOIN results b ON a.race_key = b.race_key AND a.driver_key < b.driver_key {on}),
h AS (SELECT {by} a, b, count(*) FILTER (WHERE ok) AS n, count(*) FILTER (WHERE ok AND pa < pb) AS wa, count(*) FILTER (WHERE ok AND pb < pa) AS wb, sum(qa)::DECIMAL(18,4) AS qa, sum(qb)::DECIMAL(18,4) AS qb FROM pairs WHERE {where} GROUP BY ALL),
w AS (SELECT h.*, x.s_name AS na, y.s_name AS nb, (wa > wb OR (wa = wb AND x.s_name < y.s_name)) AS first FROM h JOIN supplier x ON x.s_suppkey = a JOIN supplier y ON y.s_suppkey = b),
z AS (SELECT *, CASE WHEN first THEN na ELSE nb END AS leader, CASE WHEN first THEN wa ELSE wb END AS leader_wins, CASE WHEN first THEN nb ELSE na END AS trailer, CASE WHEN first THEN wb ELSE wa END AS trailer_wins, CASE WHEN first THEN qa ELSE qb END AS leader_points, CASE WHEN first THEN qb ELSE qa END AS trailer_points, n AS races_compared FROM w)
"""


@query("v10_head_to_head", _DUEL.format(on="AND a.constructor_key = b.constructor_key", by="constructor_key,", where="season = 1997") + "SELECT n_name || ': ' || split_part(leader, ' ', -1) || ' ' || leader_wins || '-' || trailer_wins || ' ' || split_part(trailer, ' ', -1) AS pairing, n_name AS team, races_compared, leader, leader_wins, trailer, trailer_wins, leader_points, trailer_points FROM z JOIN nation ON n_nationkey = constructor_key WHERE races_compared >= 1")
def v10(spark: SparkSession, sf: str) -> DataFrame:
    return d.teammate_head_to_head(results(spark, sf), drivers(spark, sf), nations(spark, sf).drop("driver_key"), 1997, 1)


@query("sql_duels", ORACLES["v10_head_to_head"].removeprefix(_WITH))
def sql_duels(spark: SparkSession, sf: str) -> DataFrame:
    _served(spark, sf)
    return spark.sql("SELECT * FROM teammate_head_to_head(season => 1997, min_races => 1)")


@query("r1_gap", "SELECT s.round, s.driver_key, s.points, (m.best - s.points)::DECIMAL(18,4) AS gap FROM standings s JOIN (SELECT round, max(points) AS best FROM standings WHERE season = 1997 GROUP BY 1) m USING (round) WHERE season = 1997 AND driver_key IN (SELECT driver_key FROM standings WHERE season = 1997 AND round = (SELECT max(round) FROM standings WHERE season = 1997) AND championship_position <= 3)")
def r1(spark: SparkSession, sf: str) -> DataFrame:
    return d.gap_to_leader(standings(spark, sf), 1997)


@query("r2_decided", "SELECT season, min(round) AS round FROM top2 WHERE first - second > (12 - round) * 20 GROUP BY 1")
def r2(spark: SparkSession, sf: str) -> DataFrame:
    s = standings(spark, sf)
    return d.title_decided(s, s.select("season", "round").distinct().withColumn("available", (12 - F.col("round")) * 20))


@query("r3_order", "SELECT classified_position, driver_key, is_classified, points FROM results WHERE race_key = 7")
def r3(spark: SparkSession, sf: str) -> DataFrame:
    return d.finishing_order(results(spark, sf), 7)


@query("r4_rates", f"SELECT driver_key, season, count(*) AS starts, {_pct('count(*) FILTER (WHERE is_classified AND classified_position <= 1)', 'count(*)')} AS win_rate, {_pct('count(*) FILTER (WHERE is_classified AND classified_position <= 3)', 'count(*)')} AS podium_rate, {_pct('sum(points)', 'count(*)')} AS points_per_race FROM results WHERE status_category <> 'withdrawn_or_dns' GROUP BY ALL")
def r4(spark: SparkSession, sf: str) -> DataFrame:
    return d.scoring_rates(results(spark, sf), statuses(spark, sf), ["driver_key", "season"])


@query("r5_constructor_points", ", p AS (SELECT season, constructor_key, sum(points)::DECIMAL(18,4) AS points FROM results GROUP BY ALL) SELECT *, (rank() OVER (PARTITION BY season ORDER BY points DESC))::INT AS rank FROM p")
def r5(spark: SparkSession, sf: str) -> DataFrame:
    return d.constructor_points(results(spark, sf))


@query("r6_outcomes", "SELECT constructor_key, status_category, count(*) AS entries, count(*) FILTER (WHERE is_classified) AS classified FROM results GROUP BY ALL")
def r6(spark: SparkSession, sf: str) -> DataFrame:
    return d.outcomes(results(spark, sf), statuses(spark, sf), "constructor_key")


@query("r7_pole_to_win", f"SELECT season, count(*) AS poles, count(*) FILTER (WHERE is_classified AND classified_position = 1) AS won, {_pct('count(*) FILTER (WHERE is_classified AND classified_position = 1)', 'count(*)')} AS conversion FROM results WHERE grid_position = 1 GROUP BY 1")
def r7(spark: SparkSession, sf: str) -> DataFrame:
    return d.pole_to_win(results(spark, sf))


@query("r8_driver_duel", _DUEL.format(on="", by="", where="season = 1997 AND a = 1 AND b = 2") + "SELECT races_compared, leader, leader_wins, trailer, trailer_wins, leader_points, trailer_points FROM z")
def r8(spark: SparkSession, sf: str) -> DataFrame:
    return d.driver_head_to_head(results(spark, sf), drivers(spark, sf), 1997, 2, 1)


@query("r9_constructor_duel", ", p AS (SELECT constructor_key AS k, sum(points)::DECIMAL(18,4) AS p FROM results WHERE season = 1997 GROUP BY 1) SELECT a.k AS a_key, b.k AS b_key, a.p AS a_points, b.p AS b_points, (a.p - b.p)::DECIMAL(18,4) AS margin FROM p a JOIN p b ON a.k < b.k")
def r9(spark: SparkSession, sf: str) -> DataFrame:
    return d.constructor_head_to_head(results(spark, sf), 1997)


@query("r10_circuits", f"SELECT circuit_key, count(*) AS starts, {_pct('sum(classified_position)', 'count(*)', 2)} AS avg_finish FROM results JOIN races USING (race_key) WHERE driver_key = 3 AND is_classified GROUP BY 1 HAVING count(*) >= 2")
def r10(spark: SparkSession, sf: str) -> DataFrame:
    return d.circuits_of_driver(results(spark, sf), races(spark, sf), 3)


@query("r11_trend", ", p AS (SELECT season, constructor_key, sum(points)::DECIMAL(18,4) AS points FROM results GROUP BY ALL) SELECT constructor_key, season, points, (points - lag(points) OVER (PARTITION BY constructor_key ORDER BY season))::DECIMAL(18,4) AS change FROM p")
def r11(spark: SparkSession, sf: str) -> DataFrame:
    return d.constructor_trend(results(spark, sf))


@query("r12_closest", "SELECT season, (first - second)::DECIMAL(18,4) AS margin FROM top2 WHERE (season, round) IN (SELECT (season, max(round)) FROM standings GROUP BY season)")
def r12(spark: SparkSession, sf: str) -> DataFrame:
    return d.closest_title_fights(standings(spark, sf))


@query("r13_by_round", "SELECT season, round, driver_key, (points - coalesce(lag(points) OVER (PARTITION BY season, driver_key ORDER BY round), 0))::DECIMAL(18,4) AS scored FROM standings")
def r13(spark: SparkSession, sf: str) -> DataFrame:
    return d.points_by_round(standings(spark, sf))


@query("r14_qualifying", ", q AS (SELECT race_key, driver_key, (row_number() OVER (PARTITION BY race_key ORDER BY points DESC, driver_key))::INT AS qualifying_position FROM results) SELECT race_key, driver_key, qualifying_position, grid_position, (grid_position - qualifying_position)::INT AS lost FROM q JOIN results USING (race_key, driver_key) WHERE grid_position <> qualifying_position")
def r14(spark: SparkSession, sf: str) -> DataFrame:
    r = results(spark, sf)
    return d.qualifying_vs_grid(r.withColumn("qualifying_position", F.row_number().over(Window.partitionBy("race_key").orderBy(F.desc("points"), "driver_key"))), r)


@query("stg_events_json", "SELECT event_id, (props->>'k')::INT AS k FROM events")
def stg_events_json(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select("event_id", x.blank(x.txt(x.variant("props"), "k")).cast("int").alias("k"))


@query("json_key_presence", "SELECT event_id, event_id % 4 <> 0 AS has_key, CASE event_id % 4 WHEN 3 THEN props->>'k' END AS value FROM events")
def json_key_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads with the key absent, null, empty, and set."""
    kind = F.pmod("event_id", F.lit(4))
    json = F.when(kind == 0, "{}").when(kind == 1, '{"k": null}').when(kind == 2, '{"k": ""}').otherwise(F.col("props"))
    rows = _t(spark, sf, "events").withColumn("json", json)
    return rows.select("event_id", x.has_key(F.col("json"), "k").alias("has_key"), x.blank(x.txt(x.variant("json"), "k")).alias("value"))


LINES = EntitySpec("lines", "race", "Data.Orders", (("order", "order"), ("line", "Item.line"), ("supplier", "Item.supplier")), "Lines", ("order",))


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """An order with its lines as a landed page; the supplier is blank for every 50th order."""
    item = F.struct(F.col("l_linenumber").alias("line"), F.when(F.col("l_orderkey") % 50 == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("supplier"))
    by = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(item.alias("Item"), F.col("l_quantity").cast("int").alias("quantity")))).alias("Lines"))
    page = F.struct(F.struct(F.array(F.struct(F.col("l_orderkey").cast("string").alias("order"), "Lines")).alias("Orders")).alias("Data"))
    return by.select(F.to_json(page).alias("value"), F.col("l_orderkey").cast("string").alias("source_key"))


@query("explode_envelope", "SELECT l_orderkey::VARCHAR AS \"order\", l_linenumber::VARCHAR AS line, l_suppkey::VARCHAR AS supplier, count(*) AS n FROM lineitem WHERE l_orderkey % 50 <> 0 GROUP BY ALL")
def explode_envelope(spark: SparkSession, sf: str) -> DataFrame:
    docs, _ = extract.parse_objects(_envelopes(spark, sf))
    return extract.extract(LINES, docs)[0].groupBy("order", "line", "supplier").agg(F.count("*").alias("n"))


@query("dead_letter_split", "SELECT l_orderkey::VARCHAR AS source_key, 'missing key field(s): Item.supplier' AS error_detail, count(*) AS failures FROM lineitem WHERE l_orderkey % 50 = 0 GROUP BY 1")
def dead_letter_split(spark: SparkSession, sf: str) -> DataFrame:
    docs, _ = extract.parse_objects(_envelopes(spark, sf))
    return extract.extract(LINES, docs)[1].groupBy("source_key", "error_detail").agg(F.count("*").alias("failures"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of 100 orders a month; of every third month the second page is lost."""
    months = _t(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("scope")).agg(F.count("*").alias("n"))
    pages = months.withColumn("page", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 100).cast("int"))))
    lost = (F.pmod(F.substring("scope", 6, 2).cast("int"), F.lit(3)) == 0) & (F.col("page") == 1)
    meta = F.to_json(F.struct(F.struct(F.col("n").cast("string").alias("total"), F.lit("100").alias("limit"), (F.col("page") * 100).cast("string").alias("offset")).alias("MRData")))
    return lake.page_meta(pages.filter(~lost).select(F.lit("orders").alias("entity"), "scope", meta.alias("value")))


_PAGES = "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS scope, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT *, substr(scope, 6, 2)::INT % 3 = 0 AND n > 100 AS lossy FROM m) "


@query("page_audit", _PAGES + "SELECT scope, CASE WHEN lossy THEN 'incomplete' ELSE 'complete' END AS status, CASE WHEN lossy THEN 100 END::INT AS missing_from FROM a")
def page_audit(spark: SparkSession, sf: str) -> DataFrame:
    return lake.audit_pages(_pages(spark, sf), ["scope"])


@query("volumes", "SELECT 'orders' AS entity, max(n)::INT AS rows, ceil(max(n) / 100.0)::BIGINT AS pages FROM (SELECT count(*) AS n FROM orders GROUP BY strftime(o_orderdate, '%Y-%m'))")
def volumes(spark: SparkSession, sf: str) -> DataFrame:
    return profile.volumes(_pages(spark, sf))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the orders are known; every second one comes in, every tenth with another price."""
    orders = _t(spark, sf, "orders").withColumnRenamed("o_orderkey", "key")
    price = (F.col("o_totalprice") * 100).cast("long")
    old = orders.filter("key % 3 <> 0").select("key", F.to_json(F.struct(price.alias("price"), F.lit(1).alias("a"))).alias("payload"), F.lit("old").alias("source_key"), *[F.lit("2024-01-01 00:00:00").cast("timestamp").alias(c) for c in ("ingested_at", "updated_at")])
    new = orders.filter("key % 2 = 0").select("key", F.to_json(F.struct(F.lit(1).alias("a"), (price + F.when(F.col("key") % 10 == 0, 1).otherwise(0)).alias("price"))).alias("payload"), F.lit("new").alias("source_key"))
    return merge.merge(old, new, ["key"], F.lit("2024-01-02 00:00:00").cast("timestamp"))


_MERGED = "WITH m AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 = 0 THEN 'insert' WHEN o_orderkey % 2 <> 0 THEN 'keep' WHEN o_orderkey % 10 = 0 THEN 'update' ELSE 'noop' END AS a FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0) "


@query("merge_actions", _MERGED + "SELECT a AS _action, count(*) AS count FROM m WHERE a IN ('insert', 'update') GROUP BY 1")
def merge_actions(spark: SparkSession, sf: str) -> DataFrame:
    return merge.outcome(_merged(spark, sf))


@query("merge_state", _MERGED + "SELECT key, CASE WHEN a IN ('insert', 'update') THEN 'new' ELSE 'old' END AS source_key, CASE WHEN a = 'insert' THEN 2 ELSE 1 END::INT AS ingested_day, CASE WHEN a IN ('insert', 'update') THEN 2 ELSE 1 END::INT AS updated_day, a AS _action FROM m")
def merge_state(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("key", "source_key", F.day("ingested_at").alias("ingested_day"), F.day("updated_at").alias("updated_day"), "_action")


@query("amended_rows", _MERGED + "SELECT key FROM m WHERE a = 'update'")
def amended_rows(spark: SparkSession, sf: str) -> DataFrame:
    return merge.amended(_merged(spark, sf)).select("key")


@query("load_pattern", _MERGED + "SELECT 'orders' AS entity, round(count(*) FILTER (WHERE a = 'update') / count(*), 6)::DECIMAL(9,6) AS amendment_rate, 'mutable reference' AS pattern FROM m")
def load_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return merge.load_pattern(_merged(spark, sf), "orders").withColumn("amendment_rate", F.round("amendment_rate", 6).cast("decimal(9,6)"))


@query("merge_idempotent", "SELECT 0::BIGINT AS changed FROM (SELECT 1)")
def merge_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a second merge of the same records would change."""
    once = _merged(spark, sf).drop("_action")
    again = merge.merge(once, once.select("key", "payload", "source_key"), ["key"], F.lit("2024-01-03 00:00:00").cast("timestamp"))
    return again.agg(F.count_if(F.col("_action") != "noop").alias("changed"))


@query("dedupe_last", "SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_suppkey DESC, l_partkey DESC, l_extendedprice DESC) = 1")
def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice"]
    return merge.dedupe_last(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols), ["l_orderkey", "l_linenumber"], cols)


@query("checkpoints", _PAGES + "SELECT scope, (CASE WHEN lossy THEN 100 ELSE ceil(n / 100.0) * 100 END)::INT AS next_offset, n::INT AS total_expected, CASE WHEN lossy THEN 'in_progress' ELSE 'complete' END AS status FROM a")
def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    none = spark.createDataFrame([], "entity string, scope string, next_offset int, total_expected int, status string, started_at timestamp, updated_at timestamp")
    return state.advance_checkpoints(none, _pages(spark, sf), _now()).select("scope", "next_offset", "total_expected", "status")


@query("resume_plan", _PAGES + "SELECT 'orders' AS entity, scope, 100::INT AS resume_at FROM a WHERE lossy")
def resume_plan(spark: SparkSession, sf: str) -> DataFrame:
    marks = checkpoints(spark, sf).withColumn("entity", F.lit("orders"))
    return state.pending_scopes(marks.select("entity", "scope"), marks)


@query("resume_gaps", _PAGES + "SELECT 'orders' AS entity, scope, 100::INT AS start, least(200, n)::INT AS stop FROM a WHERE lossy UNION ALL SELECT 'orders', 'new', 0, NULL")
def resume_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """What is left to fetch after pages landed out of order in two batches, and of a scope that hasn't begun."""
    none = spark.createDataFrame([], "entity string, scope string, next_offset int, total_expected int, status string, started_at timestamp, updated_at timestamp")
    pages = _pages(spark, sf)
    late = state.advance_checkpoints(none, pages.filter("offset % 200 = 0"), _now())
    marks = state.advance_checkpoints(late, pages.filter("offset % 200 <> 0"), _now())
    new = spark.createDataFrame([("orders", "new")], "entity string, scope string")
    return state.resume_gaps(marks.select("entity", "scope").unionByName(new), marks)


_ROUNDS = f"WITH m AS (SELECT DISTINCT year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round FROM orders), g AS (SELECT *, round % 5 = 0 OR make_date(season, round, 1) <= DATE '{AS_OF}' AS go FROM m) "


def _rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Months of orders as rounds; every fifth has a blank date, every tenth an unreadable one."""
    months = _t(spark, sf, "orders").select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").cast("string").alias("round")).distinct()
    n = F.col("round").cast("int")
    day = F.when(n % 10 == 0, "soon").when(n % 5 == 0, "").otherwise(F.concat_ws("-", F.col("season").cast("string"), F.lpad("round", 2, "0"), F.lit("01")))
    return months.withColumn("race_date", day)


@query("run_rounds", _ROUNDS + "SELECT season, round FROM g WHERE go")
def run_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return state.run_rounds(_rounds(spark, sf), F.lit(AS_OF).cast("date")).select("season", "round")


@query("round_progress", _ROUNDS + "SELECT season, count(*) AS scheduled, count(*) FILTER (WHERE go) AS run FROM g GROUP BY 1")
def round_progress(spark: SparkSession, sf: str) -> DataFrame:
    return state.round_progress(_rounds(spark, sf), F.lit(AS_OF).cast("date"))


@query("usage_point", f"SELECT count(*) AS calls, coalesce(min(epoch_us(ts)) - (epoch_us(TIMESTAMP '{NOW}') - 3600000000), 0)::BIGINT AS micros_to_free FROM events WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '{NOW}'")
def usage_point(spark: SparkSession, sf: str) -> DataFrame:
    return state.usage(_log(spark, sf), _now())


@query("usage_series", "SELECT event_id, entity, calls, calls > 15 AS over_budget FROM (SELECT event_id, event_type AS entity, count(*) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS calls FROM events)")
def usage_series(spark: SparkSession, sf: str) -> DataFrame:
    return state.usage_series(_log(spark, sf), 15).select("event_id", "entity", "calls", "over_budget")


@query("usage_by_entity", "SELECT event_type AS entity, count(*) AS calls FROM events GROUP BY 1")
def usage_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    return state.usage_by_entity(_log(spark, sf))


@query("prune", f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR")
def prune(spark: SparkSession, sf: str) -> DataFrame:
    return state.prune(_log(spark, sf), _now()).select("event_id")


@query("surrogate_key", "SELECT s_suppkey, md5(s_suppkey::VARCHAR || '-' || s_nationkey::VARCHAR) AS key, md5('-1') AS unknown FROM supplier")
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "supplier").select("s_suppkey", x.surrogate_key("s_suppkey", "s_nationkey").alias("key"), x.unknown_key().alias("unknown"))


@query("duration_parse", "SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 3 WHEN 0 THEN (l_quantity::INT * 60 + 1)::DECIMAL(12,3) + 0.25::DECIMAL(12,3) WHEN 1 THEN l_quantity::DECIMAL(12,3) + 0.5::DECIMAL(12,3) END::DECIMAL(12,3) AS seconds FROM lineitem")
def duration_parse(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    text = F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit(":01.250"))).when(F.col("l_linenumber") % 3 == 1, F.concat(q, F.lit(".500"))).otherwise("")
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.duration_seconds(text).alias("seconds"))


@query("status_dim", "SELECT status, CASE WHEN status LIKE '+%' THEN 'Lapped' WHEN status = 'Excluded' THEN 'Disqualified' ELSE status END AS status_canonical, nullif(regexp_extract(status, '^\\+([0-9]+) Lap', 1), '')::INT AS laps_down, CASE WHEN status LIKE '+%' THEN 'lapped' WHEN status = 'Excluded' THEN 'disqualified' WHEN status = 'Retired' THEN 'cause_unspecified' ELSE 'mechanical' END AS status_category FROM (SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN '+' || l_linenumber || ' Laps' WHEN l_returnflag = 'R' THEN 'Retired' WHEN l_linestatus = 'O' THEN 'Excluded' ELSE 'Gearbox' END AS status FROM lineitem)")
def status_dim(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("+"), F.col("l_linenumber").cast("string"), F.lit(" Laps"))).when(F.col("l_returnflag") == "R", "Retired").when(F.col("l_linestatus") == "O", "Excluded").otherwise("Gearbox")
    statuses = _t(spark, sf, "lineitem").select(text.alias("status")).distinct().withColumns({"status_id": F.lit(1), "source_all_time_count": F.lit(0)})
    return marts.dim_status(statuses).filter("not is_unknown").select("status", "status_canonical", "laps_down", "status_category")


@query("dim_with_unknown", "SELECT md5(s_suppkey::VARCHAR) AS driver_key, s_suppkey::VARCHAR AS driver_id, s_name AS full_name, false AS is_unknown FROM supplier UNION ALL SELECT md5('-1'), '-1', 'Unknown driver', true")
def dim_with_unknown(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "supplier").select(x.surrogate_key("s_suppkey").alias("driver_key"), F.col("s_suppkey").cast("string").alias("driver_id"), F.col("s_name").alias("full_name"))
    return marts.with_unknown_member(rows, "driver_key", driver_id="-1", full_name="Unknown driver")


def _conformed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines against a supplier dimension from which every seventh is gone."""
    dim = dim_with_unknown(spark, sf).filter("is_unknown or cast(driver_id as long) % 7 <> 0")
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").cast("string").alias("driver_id"))
    return marts.conform(lines, {"driver_key": (dim, ["driver_id"])})


@query("fact_conformed", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 7 = 0 THEN md5('-1') ELSE md5(l_suppkey::VARCHAR) END AS driver_key FROM lineitem")
def fact_conformed(spark: SparkSession, sf: str) -> DataFrame:
    return _conformed(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "driver_key")


@query("dim_race_like", f"SELECT md5(o_orderkey::VARCHAR || '-' || month(o_orderdate)::VARCHAR) AS race_key, o_orderkey, md5(c_nationkey::VARCHAR) AS circuit_key, o_orderdate::DATE <= DATE '{AS_OF}' AS has_been_run FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey <> 3")
def dim_race_like(spark: SparkSession, sf: str) -> DataFrame:
    """Inner join: orders of a nation that isn't in the dimension drop out."""
    circuits = _t(spark, sf, "nation").filter("n_nationkey <> 3").select(F.col("n_nationkey").alias("circuit_id"), x.surrogate_key("n_nationkey").alias("circuit_key"), F.lit(False).alias("is_unknown"))
    none = ["race_start_utc", "practice_1_utc", "practice_2_utc", "practice_3_utc", "qualifying_utc", "sprint_utc", "sprint_qualifying_utc"]
    rows = races(spark, sf).select(F.col("race_key").alias("season"), "round", F.lit("order").alias("race_name"), F.col("circuit_key").alias("circuit_id"), "race_date", F.lit(False).alias("is_sprint_weekend"), F.lit(None).cast("string").alias("wikipedia_url"), *[F.lit(None).cast("timestamp").alias(c) for c in none])
    dim = marts.dim_race(rows, circuits, F.lit(AS_OF).cast("date"))
    return dim.filter("not is_unknown").select("race_key", F.col("season").alias("o_orderkey"), "circuit_key", "has_been_run")


@query("array_standings", "SELECT c_custkey, count(*) AS constructor_count, string_agg(o_orderkey::VARCHAR, '/' ORDER BY o_orderkey) AS ids, count(*) > 1 AS changed FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def array_standings(spark: SparkSession, sf: str) -> DataFrame:
    by = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.struct(k.cast("string").alias("constructorId"))).alias("Constructors"))).alias("payload"))
    doc = x.variant("payload")
    count = x.arr_len(doc, "Constructors").cast("long")
    return by.select("c_custkey", count.alias("constructor_count"), F.array_join(x.arr_field(doc, "Constructors", "constructorId"), "/").alias("ids"), (count > 1).alias("changed"))


def _failing(name: str, sql: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: build(spark, sf).agg(F.count("*").alias("failing"))
    ORACLES[name] = sql


_failing("dq_not_null", "SELECT count(*) AS failing FROM events WHERE props IS NULL", lambda s, f: quality.not_null(_t(s, f, "events"), "props"))
_failing("dq_unique", "SELECT count(*) AS failing FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)", lambda s, f: quality.unique(_t(s, f, "lineitem"), "l_orderkey"))
_failing("dq_unique_combination", "SELECT count(*) AS failing FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)", lambda s, f: quality.unique(_t(s, f, "lineitem"), "l_orderkey", "l_linenumber"))
_failing("dq_accepted_values", "SELECT count(*) AS failing FROM events WHERE value > 5 AND event_type NOT IN ('click', 'view')", lambda s, f: quality.accepted_values(_t(s, f, "events"), "event_type", ["click", "view"], F.col("value") > 5))
_failing("dq_relationships", "SELECT count(*) AS failing FROM lineitem WHERE l_suppkey % 7 = 0", lambda s, f: quality.relationships(_t(s, f, "lineitem"), "l_suppkey", _t(s, f, "supplier").filter("s_suppkey % 7 <> 0"), "s_suppkey"))
_failing("dq_row_count", "SELECT count(*) AS failing FROM (SELECT count(*) AS n FROM orders) WHERE n <> 25", lambda s, f: quality.row_count(_t(s, f, "orders"), 25))
_failing("dq_equal_rowcount", "SELECT count(*) AS failing FROM (SELECT 1 WHERE (SELECT count(*) FROM orders) <> (SELECT count(*) FROM lineitem))", lambda s, f: quality.equal_rowcount(_t(s, f, "orders"), _t(s, f, "lineitem")))
_failing("dq_drift", "SELECT count(*) AS failing FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE y % 2 = 1", lambda s, f: quality.drift(races(s, f), races(s, f).filter("season % 2 = 0").select("season").distinct()))


@query("dq_unknown_members", "SELECT 'driver_key' AS key, count(*) AS rows FROM lineitem WHERE l_suppkey % 7 = 0")
def dq_unknown_members(spark: SparkSession, sf: str) -> DataFrame:
    return quality.no_unknown_members(_conformed(spark, sf), ["driver_key"])


@query("dq_freshness", "SELECT max(ts) AS latest, CASE WHEN TIMESTAMP '2024-02-02 00:00:00' - max(ts) > INTERVAL 168 HOUR THEN 'error' WHEN TIMESTAMP '2024-02-02 00:00:00' - max(ts) > INTERVAL 36 HOUR THEN 'warn' ELSE 'pass' END AS status FROM events")
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.freshness(_t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", F.lit("2024-02-02 00:00:00").cast("timestamp"))


@query("dq_reconcile", ", f AS (SELECT season, max(round) AS round FROM races GROUP BY 1 HAVING bool_and(has_been_run)), o AS (SELECT s.season, s.driver_key, s.points AS official FROM standings s JOIN f USING (season, round)), e AS (SELECT season, constructor_key AS driver_key, sum(points)::DECIMAL(22,4) AS derived FROM results WHERE driver_key % 10 <> 0 GROUP BY ALL) SELECT season, driver_key, official, derived FROM o LEFT JOIN e USING (season, driver_key) WHERE official IS DISTINCT FROM derived")
def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Standings against results from which every tenth supplier is missing."""
    scored = results(spark, sf).filter("driver_key % 10 <> 0").drop("driver_key").withColumnRenamed("constructor_key", "driver_key")
    none = scored.filter("false")
    return quality.standings_reconcile(standings(spark, sf), scored, none, races(spark, sf), 1990)


@query("dq_status_counts", "SELECT l_returnflag AS status_key, 1000::BIGINT AS official, count(*) AS derived FROM lineitem GROUP BY 1 HAVING count(*) <> 1000")
def dq_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    lines = _t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("status_key"))
    return quality.status_counts(lines, lines.distinct().withColumns({"source_all_time_count": F.lit(1000), "is_unknown": F.lit(False)}))


@query("dq_suite", "SELECT 'lines' AS name, 'error' AS severity, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS failing, false AS skipped, false AS passed UNION ALL SELECT 'orders', 'warn', 0, false, true UNION ALL SELECT 'prices', 'error', NULL, true, false")
def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    return quality.suite(spark, {"lines": ("error", quality.unique(_t(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")), "orders": ("warn", quality.unique(_t(spark, sf, "orders"), "o_orderkey")), "prices": ("error", quality.not_null(_t(spark, sf, "lineitem"), "l_extendedprice"))}, {"prices": ["lines"]})


#: Declared checks over the test tables.
CHECKS = [
    *fused.not_null("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"), *fused.not_null("orders", "o_orderkey", "o_custkey", "o_orderdate"), *fused.not_null("events", "props"),
    fused.Check("events", "accepted_values", ("event_type",), "warn", values=("click", "view"), where="value > 5"),
    fused.Check("orders", "accepted_values", ("o_orderstatus",), values=("F", "O", "P")),
    fused.Check("nation", "row_count", equals=24), fused.Check("orders", "equal_rowcount", to=("customer",)),
    fused.Check("events", "freshness", ("ts",), now=datetime(2024, 2, 2, tzinfo=timezone.utc)),
    fused.Check("orders", "unique", ("o_orderkey",)), fused.Check("lineitem", "unique", ("l_orderkey", "l_linenumber")), fused.Check("customer", "unique", ("c_custkey",)), fused.Check("events", "unique", ("user_id",), "warn"),
    fused.Check("lineitem", "relationships", ("l_orderkey",), to=("orders", "o_orderkey")), fused.Check("lineitem", "relationships", ("l_suppkey",), to=("supplier", "s_suppkey")),
    fused.Check("lineitem", "relationships", ("l_partkey",), to=("supplier", "s_suppkey")), fused.Check("orders", "relationships", ("o_custkey",), to=("customer", "c_custkey")),
    fused.Check("customer", "relationships", ("c_nationkey",), to=("supplier", "s_nationkey")),
]


def _row(name: str, kind: str, table: str, failing: str, severity: str = "'error'") -> str:
    return f"SELECT '{name}' AS name, '{table}' AS \"table\", '{kind}' AS kind, {severity} AS severity, ({failing})::BIGINT AS failing"


def _nulls(table: str, *columns: str) -> list[str]:
    return [_row(f"not_null_{table}_{c}", "not_null", table, f"SELECT count(*) FROM {table} WHERE {c} IS NULL") for c in columns]


def _twice(table: str, *columns: str, severity: str = "'error'") -> str:
    return _row(f"unique_{table}_{'_'.join(columns)}", "unique", table, f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {', '.join(columns)} HAVING count(*) > 1)", severity)


def _lost(table: str, column: str, parent: str, key: str) -> str:
    return _row(f"relationships_{table}_{column}_to_{parent}_{key}", "relationships", table, f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})")


_AGE = "(SELECT TIMESTAMP '2024-02-02 00:00:00' - max(ts) FROM events)"


@query("dq_fused", "SELECT *, failing = 0 AS passed FROM (" + " UNION ALL ".join([
    *_nulls("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"), *_nulls("orders", "o_orderkey", "o_custkey", "o_orderdate"), *_nulls("events", "props"),
    _row("accepted_values_events_event_type", "accepted_values", "events", "SELECT count(*) FROM events WHERE value > 5 AND event_type NOT IN ('click', 'view')", "'warn'"),
    _row("accepted_values_orders_o_orderstatus", "accepted_values", "orders", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')"),
    _row("row_count_nation", "row_count", "nation", "SELECT count(*) <> 24 FROM nation"), _row("equal_rowcount_orders_to_customer", "equal_rowcount", "orders", "SELECT (SELECT count(*) FROM orders) <> (SELECT count(*) FROM customer)"),
    _row("freshness_events_ts", "freshness", "events", f"{_AGE} > INTERVAL 36 HOUR", f"CASE WHEN {_AGE} > INTERVAL 168 HOUR THEN 'error' ELSE 'warn' END"),
    _twice("orders", "o_orderkey"), _twice("lineitem", "l_orderkey", "l_linenumber"), _twice("customer", "c_custkey"), _twice("events", "user_id", severity="'warn'"),
    _lost("lineitem", "l_orderkey", "orders", "o_orderkey"), _lost("lineitem", "l_suppkey", "supplier", "s_suppkey"), _lost("lineitem", "l_partkey", "supplier", "s_suppkey"),
    _lost("orders", "o_custkey", "customer", "c_custkey"), _lost("customer", "c_nationkey", "supplier", "s_nationkey"),
]) + ")")
def dq_fused(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty-two declared checks, each table scanned once."""
    names = {c.table for c in CHECKS} | {c.to[0] for c in CHECKS if c.to}
    return fused.run_checks(spark, {n: _t(spark, sf, n) for n in names}, CHECKS)


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON: numbers, texts, a date that is missing at times, objects three deep, and a list of objects."""
    even = F.col("o_orderkey") % 2 == 0
    state = F.struct(F.when(even, "").otherwise(F.col("o_orderstatus")).alias("status"), F.struct(F.lit("1:23:20.000").alias("time")).alias("Time"))
    legs = F.when(even, F.array(*[F.struct(F.lit(k).alias("leg")) for k in (1, 2)]))
    json = F.struct(
        F.col("o_custkey").alias("customer"), F.col("o_custkey").cast("string").alias("code"), F.when(F.col("o_orderkey") % 4 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        state.alias("State"), legs.alias("Legs"),
    )
    rows = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.to_json(json).alias("json"))
    return profile.profile_fields(rows, "id", "json")


@query(
    "profile_fields",
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 4 > 0) AS days, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS blank, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) FILTER (WHERE o_orderkey % 2 <> 0) AS few FROM orders),
    c AS (SELECT string_agg(v, '|') AS v FROM (SELECT DISTINCT o_custkey::VARCHAR AS v FROM orders ORDER BY 1 LIMIT 3)), d AS (SELECT string_agg(v, '|') AS v FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS v FROM orders WHERE o_orderkey % 4 > 0 ORDER BY 1 LIMIT 3)),
    p AS (SELECT n, days, blank, few, round(days * 100.0::DECIMAL(18,4) / n, 1)::DECIMAL(9,1) AS day_pct, round(blank * 100.0::DECIMAL(18,4) / n, 1)::DECIMAL(9,1) AS half FROM t)
    SELECT 'customer' AS path, n AS occurrences, 0::BIGINT AS null_or_empty, 'int' AS types, 100.0::DECIMAL(9,1) AS present_pct, (SELECT v FROM c) AS samples, NULL AS distinct_values FROM p
    UNION ALL SELECT 'code', n, 0, 'string(numeric)', 100.0, (SELECT v FROM c), NULL FROM p UNION ALL SELECT 'day', days, 0, 'string(date)', day_pct, (SELECT v FROM d), NULL FROM p
    UNION ALL SELECT 'State', n, 0, 'dict', 100.0, NULL, NULL FROM p UNION ALL SELECT 'State.status', n, blank, 'empty-string,string', 100.0, few, few FROM p
    UNION ALL SELECT 'State.Time', n, 0, 'dict', 100.0, NULL, NULL FROM p UNION ALL SELECT 'State.Time.time', n, 0, 'string(time)', 100.0, '1:23:20.000', '1:23:20.000' FROM p
    UNION ALL SELECT 'Legs', blank, 0, 'list', half, NULL, NULL FROM p UNION ALL SELECT 'Legs[].leg', 2 * blank, 0, 'int', half, '1|2', '1|2' FROM p""",
)
def profile_fields(spark: SparkSession, sf: str) -> DataFrame:
    joined = [F.array_join(c, "|").alias(c) for c in ("samples", "distinct_values")]
    return _profile(spark, sf).select("path", "occurrences", "null_or_empty", "types", "present_pct", *joined)


@query("casting_flags", "SELECT 'code' AS path, 'string(numeric)' AS types UNION ALL SELECT 'day', 'string(date)' UNION ALL SELECT 'State.Time.time', 'string(time)'")
def casting_flags(spark: SparkSession, sf: str) -> DataFrame:
    return profile.casting_flags(_profile(spark, sf))


@query("nullable_fields", "SELECT 'State.status' AS path UNION ALL SELECT 'day' UNION ALL SELECT 'Legs' UNION ALL SELECT 'Legs[].leg'")
def nullable_fields(spark: SparkSession, sf: str) -> DataFrame:
    return profile.nullable_fields(_profile(spark, sf)).select("path")


@query("record_lists", "SELECT 'Data.Orders' AS path, count(DISTINCT l_orderkey) AS records FROM lineitem UNION ALL SELECT 'Data.Orders[].Lines', count(*) FROM lineitem")
def record_lists(spark: SparkSession, sf: str) -> DataFrame:
    return profile.record_lists(_envelopes(spark, sf))


@query("grain_path", "SELECT 'Data.Orders[].Lines' AS path, count(*) AS records, false AS guess FROM lineitem")
def grain_path(spark: SparkSession, sf: str) -> DataFrame:
    return profile.grain_path(profile.record_lists(_envelopes(spark, sf)), _t(spark, sf, "lineitem").count())


@query("join_coverage", "WITH m AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey % 7 = 0 GROUP BY 1), t AS (SELECT count(*) AS c FROM lineitem) SELECT c AS checked, (SELECT sum(n) FROM m)::BIGINT AS missing, round((c - (SELECT sum(n) FROM m))::DECIMAL(18,4) * 100 / c, 4)::DECIMAL(9,4) AS coverage_pct, (SELECT count(*) FROM m) AS distinct_missing, (SELECT string_agg(l_suppkey::VARCHAR, ',' ORDER BY n DESC, l_suppkey) FROM (SELECT * FROM m ORDER BY n DESC, l_suppkey LIMIT 10)) AS examples FROM t")
def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return profile.join_coverage(_t(spark, sf, "lineitem"), "l_suppkey", _t(spark, sf, "supplier").filter("s_suppkey % 7 <> 0"), "s_suppkey")


EDGES = [profile.Edge("lineitem", "l_suppkey", "seventh", "s_suppkey"), profile.Edge("lineitem", "l_partkey", "orders", "o_orderkey"), profile.Edge("lineitem", "l_orderkey", "orders", "o_orderkey"), profile.Edge("orders", "o_custkey", "customer", "c_custkey")]


def _edge(e: profile.Edge, where: str = "true") -> str:
    parent = "supplier" if e.parent == "seventh" else e.parent
    return f"""SELECT '{e.name}' AS edge, t.c AS checked, coalesce(m.c, 0)::BIGINT AS missing, round((t.c - coalesce(m.c, 0))::DECIMAL(18,4) * 100 / t.c, 4)::DECIMAL(9,4) AS coverage_pct, coalesce(m.d, 0)::BIGINT AS distinct_missing, m.x AS examples
    FROM (SELECT count({e.column}) AS c FROM {e.child}) t, (SELECT sum(n) AS c, count(*) AS d, (SELECT string_agg(v::VARCHAR, ',' ORDER BY n DESC, v::VARCHAR) FROM (SELECT * FROM g ORDER BY n DESC, v::VARCHAR LIMIT 10)) AS x FROM g) m""".replace(
        "FROM g", f"FROM (SELECT {e.column} AS v, count(*) AS n FROM {e.child} WHERE {e.column} NOT IN (SELECT {e.key} FROM {parent} WHERE {where}) GROUP BY 1) g"
    )


@query("coverage_edges", " UNION ALL ".join(_edge(e, "s_suppkey % 7 <> 0" if e.parent == "seventh" else "true") for e in EDGES))
def coverage_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Four foreign keys, three of them of the lines, which are scanned once."""
    tables = {n: _t(spark, sf, n) for n in ("lineitem", "orders", "customer")} | {"seventh": _t(spark, sf, "supplier").filter("s_suppkey % 7 <> 0")}
    return profile.coverage_edges(tables, EDGES)


@query("presence_by_bucket", "SELECT ((year(o_orderdate) // 10) * 10)::INT::VARCHAR AS bucket, count(*) AS rows, count(*) FILTER (WHERE o_orderstatus <> 'O') AS status FROM orders GROUP BY 1")
def presence_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")))
    return profile.presence_by_bucket(rows, x.decade(F.year("o_orderdate")), ["status"])


_BRANDS = "WITH b AS (SELECT p_partkey % 50 AS id, p_brand AS name, p_size AS season FROM part) "


def _brands(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "part").select((F.col("p_partkey") % 50).alias("id"), F.col("p_brand").alias("name"), F.col("p_size").alias("season"))


@query("mutation_spans", _BRANDS + "SELECT id, name, min(season) AS first_season, max(season) AS last_season FROM b WHERE id IN (SELECT id FROM b GROUP BY 1 HAVING count(DISTINCT name) > 1) GROUP BY 1, 2")
def mutation_spans(spark: SparkSession, sf: str) -> DataFrame:
    return profile.mutation_spans(_brands(spark, sf), "id", "name", "season")


@query("rebrand_chains", _BRANDS + "SELECT (id // 10)::BIGINT AS chain, id, min(season) AS first_season, max(season) AS last_season FROM b GROUP BY id")
def rebrand_chains(spark: SparkSession, sf: str) -> DataFrame:
    brands = _brands(spark, sf)
    chains = brands.select("id").distinct().withColumn("chain", F.floor(F.col("id") / 10))
    return profile.rebrand_chains(brands, chains, "id", "season")


SEASONS = EntitySpec("seasons", "global", "MRData.SeasonTable.Seasons", (("season", "season"),))


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of up to 200 orders as seasons, landed on the first of January or, one in two, also on the second."""
    page = (F.floor(F.col("o_orderkey") / 200) * 200).cast("int")
    item = F.struct(F.when(F.col("o_orderkey") % 40 == 0, "").otherwise(F.col("o_orderkey").cast("string")).alias("season"), F.col("o_orderstatus").alias("url"))
    by = _t(spark, sf, "orders").groupBy(page.alias("offset")).agg(F.sort_array(F.collect_list(item)).alias("Seasons"))
    text = F.to_json(F.struct(F.struct(F.struct("Seasons").alias("SeasonTable")).alias("MRData")))
    text = F.when(F.col("offset") % 2000 == 1000, "{broken").otherwise(text)
    days = F.array(*[F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-02")])
    landed = F.explode(F.slice(days, F.lit(1), F.when(F.col("offset") % 400 == 0, 2).otherwise(1)))
    return by.select(F.lit("seasons").alias("entity"), landed.alias("ingestion_date"), F.lit("all").alias("scope"), "offset", text.alias("value"))


_LOADED = "SELECT o_orderkey::VARCHAR AS season, o_orderstatus AS url FROM orders WHERE o_orderkey % 40 <> 0 AND (o_orderkey // 200 * 200) % 2000 <> 1000"


@query("lake_roundtrip", "SELECT 'seasons' AS entity, count(DISTINCT o_orderkey // 200) AS pages, count(DISTINCT o_orderkey // 200) AS keys FROM orders")
def lake_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = store.new_folder(spark, "lake")
    lake.land_pages(_landed(spark, sf), root)
    lake.land_pages(_landed(spark, sf), root)
    return lake.read_lake(spark, root, "seasons", "2024-01-01").groupBy("entity").agg(F.count("*").alias("pages"), F.count_distinct("source_key").alias("keys"))


@query("lake_pages", "SELECT DISTINCT (o_orderkey // 200 * 200)::INT AS \"offset\", 'seasons/2024-01-01/seasons_all_offset=' || lpad((o_orderkey // 200 * 200)::VARCHAR, greatest(5, len((o_orderkey // 200 * 200)::VARCHAR))::INT, '0') || '.json' AS source_key FROM orders")
def lake_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of one scope that land one after the other, some of them again: all are kept."""
    root = store.new_folder(spark, "lake")
    pages = _landed(spark, sf).filter("ingestion_date = date'2024-01-01'")
    for part in (0, 1, 2, 0):
        lake.land_pages(pages.filter(F.floor(F.col("offset") / 200) % 3 == part), root)
    return lake.read_lake(spark, root, "seasons", "2024-01-01").select("offset", "source_key")


@query(
    "lake_json",
    """WITH p AS (SELECT (o_orderkey // 200 * 200)::INT AS "offset", count(*) AS n FROM orders GROUP BY 1)
    SELECT "offset", 'all' AS scope, 'seasons/2024-01-01/seasons_all_offset=' || lpad("offset"::VARCHAR, greatest(5, len("offset"::VARCHAR))::INT, '0') || '.json' AS source_key,
    CASE WHEN "offset" % 2000 = 1000 THEN -1 ELSE n END::INT AS records FROM p""",
)
def lake_json(spark: SparkSession, sf: str) -> DataFrame:
    """Pages put as JSON objects, the first day's read back; records of each, -1 for one that isn't JSON."""
    root = store.new_folder(spark, "objects")
    lake.put_objects(_landed(spark, sf), root)
    found = lake.read_objects(spark, root, "seasons", "2024-01-01")
    return found.select("offset", "scope", "source_key", F.coalesce(x.arr_len(x.variant("value"), "MRData.SeasonTable.Seasons"), F.lit(-1)).alias("records"))


@query("lake_json_load", _LOADED)
def lake_json_load(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of all days streamed into the raw table."""
    base = store.new_folder(spark, "objects")
    lake.put_objects(_landed(spark, sf), f"{base}/lake")
    loader.stream_load(spark, "", f"{base}/seasons", "seasons", f"{base}/marks", lake.stream_objects(spark, f"{base}/lake", "seasons"))
    return loader.latest(spark, f"{base}/seasons", "seasons").select("season", x.txt(x.variant("payload"), "url").alias("url"))


def _loaded(spark: SparkSession, sf: str) -> str:
    base = store.new_folder(spark, "stream")
    lake.land_pages(_landed(spark, sf), f"{base}/lake")
    for _ in range(2):
        loader.stream_load(spark, f"{base}/lake", f"{base}/seasons", "seasons", f"{base}/marks")
    return f"{base}/seasons"


@query("load_outcome", "WITH p AS (SELECT *, o_orderkey // 200 * 200 AS pg, CASE WHEN (o_orderkey // 200 * 200) % 400 = 0 THEN 2 ELSE 1 END AS times FROM orders), g AS (SELECT * FROM p WHERE pg % 2000 <> 1000) SELECT (SELECT sum(times) FROM g WHERE o_orderkey % 40 <> 0)::BIGINT AS parsed, (SELECT count(*) FROM g WHERE o_orderkey % 40 <> 0) AS inserted, 0::BIGINT AS updated, ((SELECT sum(times) FROM g WHERE o_orderkey % 40 = 0) + coalesce((SELECT sum(times) FROM (SELECT DISTINCT pg, times FROM p WHERE pg % 2000 = 1000)), 0))::BIGINT AS failed")
def load_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """What a load parsed, inserted, updated and couldn't use, over all its batches."""
    return loader.outcomes(spark, _loaded(spark, sf)).agg(*[F.sum(c).alias(c) for c in ("parsed", "inserted", "updated", "failed")])


@query("dead_letters", "WITH p AS (SELECT DISTINCT o_orderkey // 200 * 200 AS pg FROM orders) SELECT 'not valid JSON' AS error_detail, count(*) FILTER (WHERE pg % 2000 = 1000) + count(*) FILTER (WHERE pg % 2000 = 1000 AND pg % 400 = 0) AS failures FROM p HAVING count(*) FILTER (WHERE pg % 2000 = 1000) > 0 UNION ALL SELECT 'missing key field(s): season', count(DISTINCT (o_orderkey // 200, d, o_orderstatus)) FROM orders, (VALUES (0), (1)) t(d) WHERE o_orderkey % 40 = 0 AND (o_orderkey // 200 * 200) % 2000 <> 1000 AND (d = 0 OR (o_orderkey // 200 * 200) % 400 = 0)")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Failures still open, each once: by entity, page and content."""
    letters = state.unresolved(loader.dead_letters(spark, _loaded(spark, sf)), "seasons")
    return letters.groupBy("error_detail").agg(F.count("*").alias("failures"))


@query("stream_load", _LOADED)
def stream_load(spark: SparkSession, sf: str) -> DataFrame:
    return loader.latest(spark, _loaded(spark, sf), "seasons").select("season", x.txt(x.variant("payload"), "url").alias("url"))


@query("lake_replay", _LOADED)
def lake_replay(spark: SparkSession, sf: str) -> DataFrame:
    base = store.new_folder(spark, "replay")
    lake.land_pages(_landed(spark, sf), f"{base}/lake")
    loader.replay(spark, lake.read_landed(spark, f"{base}/lake"), f"{base}/seasons", "seasons")
    return loader.latest(spark, f"{base}/seasons", "seasons").select("season", x.txt(x.variant("payload"), "url").alias("url"))
