"""The served queries for SQL users: named arguments where a query has parameters, views where it has none.

``register`` names the marts and defines functions over them; a call is planned like
a query written out, so filters on its result and on its arguments are pushed down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapforge.functions.exprs import NAME_ORDER
from lapforge.plans import dashboards
from lapforge.plans.store import write_view

MARTS = ("dim_driver", "dim_constructor", "dim_circuit", "dim_status", "dim_race", "fct_results", "fct_sprint_results", "fct_driver_standings", "fct_constructor_standings", "rpt_pipeline_freshness")

#: Name, parameters and body of each function; a parameter is written with the function's name before it.
FUNCTIONS = {
    "championship_progression": (
        "season INT, top_n INT DEFAULT 5",
        """WITH year AS (SELECT * FROM fct_driver_standings AS s WHERE s.season = championship_progression.season),
        final AS (SELECT driver_key, championship_position AS final_position FROM year
            WHERE round = (SELECT max(round) FROM year) AND championship_position <= championship_progression.top_n)
        SELECT y.round, r.race_name AS race, d.full_name AS driver, y.points, f.final_position
        FROM year AS y JOIN final AS f ON f.driver_key = y.driver_key JOIN dim_driver AS d ON d.driver_key = y.driver_key
        JOIN dim_race AS r ON r.season = y.season AND r.round = y.round""",
    ),
    "why_cars_retire": (
        "decade INT DEFAULT NULL",
        """WITH causes AS (SELECT t.status_category AS cause, count(*) AS retirements FROM fct_results AS f JOIN dim_status AS t ON t.status_key = f.status_key
            WHERE NOT f.is_classified AND t.status_category <> 'withdrawn_or_dns'
            AND (why_cars_retire.decade IS NULL OR f.season BETWEEN why_cars_retire.decade AND why_cars_retire.decade + 9) GROUP BY t.status_category)
        SELECT cause, retirements,
            CAST(round(CAST(retirements AS DECIMAL(18, 6)) / CAST(sum(retirements) OVER () AS DECIMAL(18, 6)), 4) AS DECIMAL(18, 4)) AS share FROM causes""",
    ),
    "grid_vs_finish": (
        "min_races INT DEFAULT 100, top_n INT DEFAULT 15",
        f"""WITH gained AS (SELECT driver_key, count(*) AS races_counted, sum(positions_gained) AS g, sum(grid_position) AS s, max(positions_gained) AS best_single_race
            FROM fct_results WHERE positions_gained IS NOT NULL GROUP BY driver_key HAVING count(*) >= grid_vs_finish.min_races),
        named AS (SELECT d.full_name AS driver, races_counted,
            CAST(round(CAST(g AS DECIMAL(18, 6)) / CAST(races_counted AS DECIMAL(18, 6)), 2) AS DECIMAL(18, 2)) AS avg_positions_gained,
            CAST(round(CAST(s AS DECIMAL(18, 6)) / CAST(races_counted AS DECIMAL(18, 6)), 1) AS DECIMAL(18, 1)) AS avg_grid, best_single_race
            FROM gained AS g JOIN dim_driver AS d ON d.driver_key = g.driver_key WHERE NOT d.is_unknown),
        placed AS (SELECT *, row_number() OVER (ORDER BY avg_positions_gained DESC, collate(driver, '{NAME_ORDER}')) AS place FROM named)
        SELECT driver, races_counted, avg_positions_gained, avg_grid, best_single_race FROM placed WHERE place <= grid_vs_finish.top_n""",
    ),
    "teammate_head_to_head": (
        "season INT, min_races INT DEFAULT 3",
        f"""WITH year AS (SELECT * FROM fct_results AS f WHERE f.season = teammate_head_to_head.season),
        pairs AS (SELECT a.constructor_key, a.driver_key AS a, b.driver_key AS b, a.is_classified AND b.is_classified AS ok,
            a.classified_position AS pa, b.classified_position AS pb, a.points AS qa, b.points AS qb
            FROM year AS a JOIN year AS b ON a.race_key = b.race_key AND a.constructor_key = b.constructor_key AND a.driver_key < b.driver_key),
        record AS (SELECT constructor_key, a, b, count_if(ok) AS n, count_if(ok AND pa < pb) AS wa, count_if(ok AND pb < pa) AS wb,
            CAST(sum(qa) AS DECIMAL(18, 4)) AS qa, CAST(sum(qb) AS DECIMAL(18, 4)) AS qb FROM pairs GROUP BY constructor_key, a, b HAVING count_if(ok) >= teammate_head_to_head.min_races),
        named AS (SELECT r.*, x.full_name AS na, y.full_name AS nb, c.constructor_name AS team,
            wa > wb OR (wa = wb AND collate(x.full_name, '{NAME_ORDER}') < collate(y.full_name, '{NAME_ORDER}')) AS ahead
            FROM record AS r JOIN dim_driver AS x ON x.driver_key = r.a JOIN dim_driver AS y ON y.driver_key = r.b JOIN dim_constructor AS c ON c.constructor_key = r.constructor_key),
        led AS (SELECT team, n AS races_compared, if(ahead, na, nb) AS leader, if(ahead, wa, wb) AS leader_wins, if(ahead, nb, na) AS trailer, if(ahead, wb, wa) AS trailer_wins,
            if(ahead, qa, qb) AS leader_points, if(ahead, qb, qa) AS trailer_points FROM named)
        SELECT concat(team, ': ', split_part(leader, ' ', -1), ' ', leader_wins, '-', trailer_wins, ' ', split_part(trailer, ' ', -1)) AS pairing, * FROM led""",
    ),
}


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Name the marts that are given for SQL and define what is served from them; the names of functions and views.

    Registering again points everything at the new tables; plans already made keep theirs.
    """
    for name in MARTS:
        if name in tables:
            write_view(tables[name], name)
    there = set(tables)
    served = []
    for name, (parameters, body) in FUNCTIONS.items():
        if {m for m in MARTS if m in body} <= there:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")
            served.append(name)
    views = {
        "reliability_by_era": (dashboards.reliability_by_era, ("fct_results", "dim_status")),
        "driver_standings_current": (dashboards.driver_standings_current, ("fct_driver_standings", "dim_driver", "dim_constructor")),
        "constructor_standings_current": (dashboards.constructor_standings_current, ("fct_constructor_standings", "dim_constructor")),
        "calendar_growth": (dashboards.calendar_growth, ("dim_race",)),
        "circuit_map": (dashboards.circuit_map, ("dim_race", "dim_circuit")),
    }
    for name, (make, needs) in views.items():
        if set(needs) <= there:
            write_view(make(*[tables[n] for n in needs]), name)
            served.append(name)
    return served
