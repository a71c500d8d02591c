"""From invented pages to the served queries, and the pieces in between."""

import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lapforge.functions import exprs
from lapforge.operators import profile, quality, state
from lapforge.plans import bindings, build, dashboards, marts
from lapforge.plans.store import write_table
from lapforge.sources import lake
from lapforge.sources.entities import ENTITIES
from lapforge.streaming import loader

AS_OF = "2032-03-15 12:00:00"
TEAMS = {"ada": "alpha", "bo": "alpha", "cy": "beta", "di": "beta"}


def envelope(box, name, records):
    return {"MRData": {"total": str(len(records)), "limit": "100", "offset": "0", box: {name: records}}}


def result(driver, place, grid, status="Finished", text=None, points=None):
    return {
        "number": "7", "grid": str(grid), "position": str(place), "positionText": text or str(place), "points": points or str(10 - 2 * place), "laps": "50", "status": status,
        "Driver": {"driverId": driver}, "Constructor": {"constructorId": TEAMS.get(driver, "beta")}, "Time": {"millis": "5000000", "time": "1:23:20.000"},
        "FastestLap": {"lap": "9", "rank": "1", "Time": {"time": "1:20.000"}, "AverageSpeed": {"speed": "201.5"}},
    }


#: (season, round) -> results; cy's engine breaks in 2031, di doesn't start in 2032, "zed" is a driver that nobody knows.
RACES = {
    (2031, 1): [result("ada", 1, 2), result("bo", 2, 1), result("cy", 3, 3, "Engine", "R"), result("di", 4, 0, "+1 Lap")],
    (2031, 2): [result("ada", 2, 1), result("bo", 1, 2), result("cy", 4, 4, "Engine", "R"), result("di", 3, 3)],
    (2032, 1): [result("ada", 1, 3), result("bo", 2, 4, points="5.5"), result("zed", 3, 9), result("di", 5, 2, "Did not start", "W")],
}


def standing(points, wins, place, **more):
    return {"points": str(points), "wins": str(wins), "position": place, "positionText": place or "-", **more}


def pages():
    """(entity, scope, document) of everything that lands."""
    yield "seasons", "all", envelope("SeasonTable", "Seasons", [{"season": str(s), "url": f"u{s}"} for s in (2031, 2032)])
    yield "circuits", "all", envelope("CircuitTable", "Circuits", [{"circuitId": c, "circuitName": c.upper(), "url": "u", "Location": {"lat": "1.5", "long": "-2.5", "locality": f"{c} town", "country": "X"}} for c in ("oval", "bend")])
    drivers = [{"driverId": d, "givenName": d.title(), "familyName": "Test", "dateOfBirth": "2000-01-02", "permanentNumber": "" if d == "bo" else "7", "nationality": "N", "url": "u"} for d in TEAMS]
    yield "drivers", "all", envelope("DriverTable", "Drivers", [*drivers, {"givenName": "nobody"}])
    yield "constructors", "all", envelope("ConstructorTable", "Constructors", [{"constructorId": c, "name": f"Team {c}", "nationality": "N", "url": "u"} for c in ("alpha", "beta")])
    yield "status", "all", envelope("StatusTable", "Status", [{"statusId": str(k), "status": s, "count": "2"} for k, s in enumerate(("Finished", "Engine", "+1 Lap", "Did not start"))])
    days = {(2031, 1): "2031-03-01", (2031, 2): "2031-04-01", (2032, 1): "2032-03-01", (2032, 2): "2032-04-01"}
    races = [{"season": str(s), "round": str(r), "raceName": f"Race {s}/{r}", "date": d, "Circuit": {"circuitId": "oval" if r == 1 else "bend"}, "url": "u"} for (s, r), d in days.items()]
    yield "races", "all", envelope("RaceTable", "Races", races)
    for season in (2031, 2032):
        run = {k: v for k, v in RACES.items() if k[0] == season}
        of = lambda child, rows: [{"season": str(s), "round": str(r), child: v} for (s, r), v in rows.items()]
        yield "results", f"season={season}", envelope("RaceTable", "Races", of("Results", run))
        sprint = {(2031, 2): [result("ada", 1, 1, points="2")]} if season == 2031 else {}
        yield "sprint", f"season={season}", envelope("RaceTable", "Races", of("SprintResults", sprint))
        yield "qualifying", f"season={season}", envelope("RaceTable", "Races", of("QualifyingResults", {k: [{"number": "7", "position": str(n + 1), "Q1": "1:20", "Driver": x["Driver"], "Constructor": x["Constructor"]} for n, x in enumerate(v)] for k, v in run.items()}))
    points = {(2031, 1): {"ada": (8, 1), "bo": (6, 0), "cy": (4, 0), "di": (2, 0)}, (2031, 2): {"ada": (16, 1), "bo": (14, 1), "di": (6, 0), "cy": (6, 0)}, (2032, 1): {"ada": (8, 1), "bo": (5.5, 0)}}
    for (s, r), rows in points.items():
        scope = f"season={s}_round={r:02d}"
        drivers = [standing(p, w, str(n + 1), Driver={"driverId": d}, Constructors=[{"constructorId": "beta"}, {"constructorId": TEAMS[d]}] if d == "bo" else [{"constructorId": TEAMS[d]}]) for n, (d, (p, w)) in enumerate(rows.items())]
        yield "driver_standings", scope, envelope("StandingsTable", "StandingsLists", [{"season": str(s), "round": str(r), "DriverStandings": drivers}])
        yield "constructor_standings", scope, envelope("StandingsTable", "StandingsLists", [{"season": str(s), "round": str(r), "ConstructorStandings": [standing(9, 1, "1", Constructor={"constructorId": "alpha"}), standing(3, 0, "", Constructor={"constructorId": "beta"})]}])
        yield "pitstops", scope, envelope("RaceTable", "Races", [{"season": str(s), "round": str(r), "PitStops": [{"driverId": "ada", "stop": str(k), "lap": "9", "time": "15:00:00", "duration": d} for k, d in ((1, "24.500"), (2, "1:02.250"))]}])


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Pages landed, loaded, staged and built into marts."""
    root = str(tmp_path_factory.mktemp("chain"))
    rows = [(e, s, 0, json.dumps(d)) for e, s, d in pages()]
    landed = spark.createDataFrame(rows, "entity string, scope string, offset int, value string").withColumn("ingestion_date", F.lit("2032-03-02").cast("date"))
    lake.land_pages(landed, f"{root}/lake")
    raw = {}
    for entity in ENTITIES:
        loader.load(spark, lake.read_lake(spark, f"{root}/lake", entity, "2032-03-02"), f"{root}/{entity}", entity, 1)
        raw[entity] = loader.latest(spark, f"{root}/{entity}", entity)
    ts = lambda t: F.lit(t).cast("timestamp")
    marks = spark.createDataFrame([("complete",), ("failed",)], "status string").withColumn("updated_at", ts("2032-03-15 06:30:00"))
    calls = spark.createDataFrame([("2032-03-15 11:30:00",), ("2032-03-15 10:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("called_at"))
    return root, raw, build.build(spark, raw, marks, calls, ts(AS_OF), f"{root}/marts")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_staging(spark, chain):
    _, raw, _ = chain
    s = build.stage_all(raw)
    assert sorted(r.season for r in s["seasons"].collect()) == [2031, 2032]
    oval = s["circuits"].filter("circuit_id = 'oval'").first()
    assert (oval.circuit_name, oval.latitude, oval.longitude, oval.locality, oval.country) == ("OVAL", 1.5, -2.5, "oval town", "X")
    drivers = {r.driver_id: r for r in s["drivers"].collect()}
    assert (drivers["ada"].full_name, drivers["ada"].permanent_number, drivers["bo"].permanent_number, str(drivers["bo"].date_of_birth)) == ("Ada Test", 7, None, "2000-01-02")
    assert {(r.constructor_id, r.constructor_name) for r in s["constructors"].collect()} == {("alpha", "Team alpha"), ("beta", "Team beta")}
    assert {(r.status, r.source_all_time_count) for r in s["status"].collect()} >= {("Engine", 2)}
    assert rows(s["sprint"].select("season", "round", "driver_id", "points")) == [(2031, 2, "ada", Decimal("2.0000"))]
    assert {r.duration_seconds for r in s["pitstops"].collect()} == {Decimal("24.500"), Decimal("62.250")}


def test_marts(spark, chain):
    _, _, m = chain
    assert {k: v.count() for k, v in m.items() if k != "rpt_pipeline_freshness"} == {
        "dim_driver": 5, "dim_constructor": 3, "dim_circuit": 3, "dim_status": 5, "dim_race": 5, "fct_results": 12, "fct_sprint_results": 1, "fct_driver_standings": 10, "fct_constructor_standings": 6,
    }
    zed = m["fct_results"].join(m["dim_driver"].filter("is_unknown").select("driver_key"), "driver_key", "left_semi")
    assert rows(zed.select("season", "round", "classified_position")) == [(2032, 1, 3)]
    assert quality.no_unknown_members(m["fct_results"], ["race_key", "driver_key", "constructor_key", "status_key"]).first().rows == 1
    assert [r.has_been_run for r in m["dim_race"].filter("not is_unknown").orderBy("season", "round").collect()] == [True, True, True, False]
    assert "fastest_lap_avg_speed_kph" in m["fct_results"].columns and "fastest_lap_avg_speed_kph" not in m["fct_sprint_results"].columns
    gone = quality.standings_reconcile(m["fct_driver_standings"], m["fct_results"], m["fct_sprint_results"], m["dim_race"])
    assert sorted(rows(gone.select("official", "derived"))) == []


def test_dashboards(spark, chain):
    _, _, m = chain
    d, results, statuses = dashboards, m["fct_results"], m["dim_status"]
    drivers, teams = m["dim_driver"], m["dim_constructor"]
    got = rows(d.championship_progression(m["fct_driver_standings"], drivers, m["dim_race"], 2031, 1))
    assert got == [(1, "Race 2031/1", "Ada Test", Decimal("8.0000"), 1), (2, "Race 2031/2", "Ada Test", Decimal("16.0000"), 1)]
    assert rows(d.reliability_by_era(results, statuses)) == [(2030, 11, 2, Decimal("0.1818"))]
    assert rows(d.why_cars_retire(results, statuses)) == [("mechanical", 2, Decimal("1.0000"))]
    assert {r.driver: (r.races_counted, r.best_single_race) for r in d.grid_vs_finish(results, drivers, 1).collect()} == {"Ada Test": (3, 2), "Bo Test": (3, 2), "Di Test": (1, 0)}
    fresh = d.data_freshness(m["rpt_pipeline_freshness"], F.lit(AS_OF).cast("timestamp")).first()
    assert (fresh.season, fresh.season_progress, str(fresh.last_race), str(fresh.next_race), fresh.hours_since_run) == (2032, "1 of 2", "2032-03-01", "2032-04-01", Decimal("5.5"))
    assert (fresh.failed_scopes, fresh.unfinished_scopes, fresh.api_calls_last_hour) == (1, 0, 1) and fresh.data_last_changed is not None
    assert [(r.driver, r.team) for r in d.driver_standings_current(m["fct_driver_standings"], drivers, teams).collect()] == [("Ada Test", "Team alpha"), ("Bo Test", "Team alpha / Team beta")]
    assert [(r.position, r.team) for r in d.constructor_standings_current(m["fct_constructor_standings"], teams).collect()] == [(1, "Team alpha"), (None, "Team beta")]
    assert rows(d.calendar_growth(m["dim_race"])) == [(2031, 2, 2), (2032, 2, 1)]
    assert rows(d.circuit_map(m["dim_race"], m["dim_circuit"])) == [("OVAL", "oval town", "X", 1.5, -2.5, 2, 2031, 2032), ("BEND", "bend town", "X", 1.5, -2.5, 1, 2031, 2031)]
    assert [r.pairing for r in d.teammate_head_to_head(results, drivers, teams, 2031, 1).collect()] == ["Team alpha: Test 1-1 Test"]
    assert d.scoring_rates(results, statuses, ["season"]).count() == 2 and d.outcomes(results, statuses, "season").count() >= 3


def test_a_season_that_has_not_begun(spark, chain):
    """The report is on the latest season, run or not."""
    _, _, m = chain
    new = m["dim_race"].filter("season = 2032 and round = 2").withColumns({"season": F.lit(2033), "race_date": F.lit("2033-01-01").cast("date")})
    empty = spark.createDataFrame([], "status string, updated_at timestamp"), spark.createDataFrame([], "called_at timestamp")
    got = marts.rpt_pipeline_freshness(m["dim_race"].unionByName(new), m["fct_results"], *empty, F.lit(AS_OF).cast("timestamp")).first()
    assert (got.season, got.rounds_run, got.rounds_scheduled) == (2033, 0, 1)


def test_outcomes_and_dead_letters(spark, chain, tmp_path):
    root, raw, _ = chain
    assert rows(loader.outcomes(spark, f"{root}/drivers").select("parsed", "inserted", "updated", "failed")) == [(4, 4, 0, 1)]
    assert [r.error_detail for r in state.unresolved(loader.dead_letters(spark, f"{root}/drivers")).collect()] == ["missing key field(s): driverId"]
    base = str(tmp_path)
    land = lambda *docs: spark.createDataFrame([("seasons", "all", k, v, f"k{k}") for k, v in docs], "entity string, scope string, offset int, value string, source_key string")
    doc = lambda *pairs: json.dumps(envelope("SeasonTable", "Seasons", [{"season": s, "url": u} for s, u in pairs]))
    loader.load(spark, land((0, doc(("1", "a"), ("2", "b"))), (1, "{bad")), base, "seasons", 1)
    for _ in range(2):  # a batch that is tried again changes nothing
        loader.load(spark, land((0, doc(("1", "a"), ("2", "c"), ("3", "d"))), (1, "{bad")), base, "seasons", 2)
    loader.load(spark, land((2, doc())), base, "seasons", 3)
    assert sorted(rows(loader.outcomes(spark, base).select("batch", "parsed", "inserted", "updated", "failed"))) == [(1, 2, 2, 0, 1), (2, 3, 1, 1, 1), (3, 0, 0, 0, 0)]
    now = loader.latest(spark, base, "seasons")
    assert sorted((r.season, json.loads(r.payload)["url"], r.updated_at > r.ingested_at) for r in now.collect()) == [("1", "a", False), ("2", "c", True), ("3", "d", False)]
    assert loader.dead_letters(spark, base).count() == 1
    assert loader.drop_replaced(spark, base, "seasons", 1) >= 1 and loader.latest(spark, base, "seasons").count() == 3
    with pytest.raises(ValueError, match="holds a raw table"):
        loader.replay(spark, land((0, doc())).withColumn("ingestion_date", F.lit("2031-01-01").cast("date")), base, "seasons")


def test_lake_keys_and_scopes(spark, tmp_path):
    keys = spark.createDataFrame([(0,), (1000,), (10000,), (100000,)], "o int").select(lake.lake_key(F.lit("e"), lake.scope_label(F.lit("2031"), F.lit("3")), F.col("o"), F.lit("2031-01-01")).alias("k"))
    assert [r.k for r in keys.collect()] == [f"e/2031-01-01/e_season=2031_round=03_offset={o}.json" for o in ("00000", "01000", "10000", "100000")]
    labels = spark.range(1).select(*[lake.spec_label(ENTITIES[e], F.lit(2031), F.lit(100)).alias(e) for e in ("races", "results", "pitstops")]).first()
    assert tuple(labels) == ("all", "season=2031", "season=2031_round=100")
    root = str(tmp_path)
    rows = [("pitstops", s, o, f"{s}{o}") for s in ("season=2031_round=01", "season=2031_round=02", "season=2032_round=01") for o in (0, 100)]
    df = spark.createDataFrame(rows, "entity string, scope string, offset int, value string").withColumn("ingestion_date", F.lit("2031-01-01").cast("date"))
    for offset in (0, 100, 0):
        lake.land_pages(df.filter(F.col("offset") == offset), root)
    count = lambda *a: lake.read_lake(spark, root, "pitstops", *a).count()
    assert (count("2031-01-01"), count("2031-01-01", 2031), count("2031-01-01", 2031, 2), count("2031-01-02")) == (6, 4, 2, 0)


def test_checkpoint_stops_at_the_first_gap(spark):
    none = spark.createDataFrame([], "entity string, scope string, next_offset int, total_expected int, status string, started_at timestamp, updated_at timestamp")
    land = lambda *p: spark.createDataFrame([("e", "s", o, 100, 350) for o in p], "entity string, scope string, offset int, limit int, total int")
    now = F.lit("2031-01-01 00:00:00").cast("timestamp")
    first = state.advance_checkpoints(none, land(0, 200, 300), now)
    assert rows(first.select("next_offset", "status")) == [(100, "in_progress")]
    assert rows(state.pending_scopes(first.select("entity", "scope"), first)) == [("e", "s", 100)]
    second = state.advance_checkpoints(first, land(100, 200, 300), now)
    assert rows(second.select("next_offset", "status")) == [(400, "complete")]


def test_usage_over_blocks(spark):
    log = spark.createDataFrame([(int(t),) for t in (0, 1800, 3599, 3600, 5399, 5400, 9100)], "s long").select(F.timestamp_seconds("s").alias("called_at"))
    assert [r.calls for r in state.usage_series(log, 3).orderBy("called_at").collect()] == [1, 2, 3, 3, 4, 4, 1]


def test_kinds_decades_and_names(spark):
    values = {"15:00": "string(time)", "1:23:20.000": "string(time)", "15:00:00Z": "string(time)", "2031-01-02": "string(date)", "-1.5": "string(numeric)", "x": "string", "": "empty-string"}
    df = spark.createDataFrame([(json.dumps({"v": v}),) for v in values], "j string").select(F.get_json_object("j", "$.v").alias("t"), exprs.value_kind(F.variant_get(F.parse_json("j"), "$.v", "variant")).alias("k"))
    assert {r.t: r.k for r in df.collect()} == values
    assert rows(spark.createDataFrame([(-1,), (1999,), (2030,)], "s int").select(exprs.decade(F.col("s")))) == [(0,), (1990,), (2030,)]
    odd = spark.createDataFrame([('{"VOID": [{"OBJECT": 1}], "x": null}',), ('{"VOID": [{"OBJECT": 2}, {"OBJECT": 3}]}',)], "value string")
    assert rows(profile.record_lists(odd)) == [("VOID", 3)]


def test_flatten_at_any_depth(spark):
    doc = {"a": {"b": {"c": [{"d": 1}, {"d": "2", "e": []}, 5]}}, "f": [[{"g": None}]]}
    flat = profile.flatten(spark.createDataFrame([(1, json.dumps(doc))], "id int, j string"), "id", "j")
    assert sorted(r.path for r in flat.collect()) == ["a", "a.b", "a.b.c", "a.b.c[].d", "a.b.c[].d", "a.b.c[].e", "f", "f[][].g"]


def test_suite_skips_dependents(spark):
    bad, good = spark.range(2), spark.range(0)
    got = {r.name: (r.failing, r.skipped, r.passed) for r in quality.suite(spark, {"a": ("error", bad), "b": ("error", good), "c": ("error", good), "d": ("warn", bad), "e": ("error", good)}, {"b": ["a"], "c": ["b"], "e": ["d"]}).collect()}
    assert got == {"a": (2, False, False), "b": (None, True, False), "c": (None, True, False), "d": (2, False, False), "e": (0, False, True)}


def test_reconcile_both_sides(spark):
    a, b = (spark.createDataFrame([(k, v)], "k int, value int") for k, v in ((1, 5), (2, 5)))
    assert len(rows(quality.reconcile(a, b, ["k"]))) == 1 and len(rows(quality.reconcile(a, b, ["k"], "full"))) == 2


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    out = write_table(spark.createDataFrame([(1, 2031), (2, 2032)], "k int, season int"), path, ("season",))
    with pytest.raises(ValueError, match="reads what is in"):
        write_table(out.filter("k = 1"), path)
    assert out.columns == ["k", "season"] and rows(out.filter("season = 2032")) == [(2, 2032)]


def test_checks_gate_the_build(spark, chain, tmp_path):
    """A bad dimension keeps its former version, and so does what needs it; the others are built."""
    root, raw, _ = chain
    out, as_of = str(tmp_path), F.lit(AS_OF).cast("timestamp")
    empty = spark.createDataFrame([], "status string, updated_at timestamp"), spark.createDataFrame([], "called_at timestamp")
    todo = build.models(*empty, as_of)
    status = lambda report: {r.model: r.status for r in report.collect()}
    tables, report = build.run(spark, todo, raw, out)
    assert set(status(report).values()) == {"built"} and {r.model: r.warned for r in report.collect()}["fct_results"] == ["no_unknown_fct_results_driver_key"]
    # a driver twice, and a circuit that is new
    extra = raw["drivers"].filter("driver_id = 'ada'")
    circuit = raw["circuits"].limit(1).withColumn("circuit_id", F.lit("ring"))
    bad = raw | {"drivers": raw["drivers"].unionByName(extra), "circuits": raw["circuits"].unionByName(circuit)}
    tables, report = build.run(spark, todo, bad, out)
    got = status(report)
    assert got["dim_driver"] == "failed" and {r.model: r.failed for r in report.collect()}["dim_driver"] == ["unique_dim_driver_driver_key"]
    assert {n for n, s in got.items() if s == "skipped"} == {"fct_results", "fct_sprint_results", "fct_driver_standings", "rpt_pipeline_freshness"}
    assert {n for n, s in got.items() if s == "built"} == {"dim_constructor", "dim_circuit", "dim_status", "dim_race", "fct_constructor_standings"}
    assert tables["dim_driver"].count() == 5 and tables["dim_circuit"].count() == 4 and tables["fct_results"].count() == 12


def test_refresh_writes_what_changed(spark, chain, tmp_path):
    """An amendment rewrites one season of one fact; a driver that becomes known the season that met him."""
    root, raw, _ = chain
    out, as_of = str(tmp_path), F.lit(AS_OF).cast("timestamp")
    empty = spark.createDataFrame([], "status string, updated_at timestamp"), spark.createDataFrame([], "called_at timestamp")
    todo = [m for m in build.models(*empty, as_of) if m.name != "rpt_pipeline_freshness"]
    build.run(spark, todo, raw, out)
    written = lambda: {str(p.relative_to(out)).rsplit("/", 1)[0] for p in Path(out).rglob("fct_*/*/*/*.parquet")}
    before = written()
    later = F.lit(spark.sql("select current_timestamp()").first()[0])
    hit = (F.col("season") == "2031") & (F.col("round") == "1") & (F.col("driver_id") == "ada")
    amended = raw["results"].withColumns({"payload": F.when(hit, F.regexp_replace("payload", '"points":"8"', '"points":"7.5"')).otherwise(F.col("payload")), "updated_at": F.when(hit, later).otherwise(F.col("updated_at"))})
    known = raw["drivers"].filter("driver_id = 'ada'").withColumn("driver_id", F.lit("zed"))
    tables, report = build.run(spark, todo, raw | {"results": amended}, out, refresh=True)
    assert written() - before == {"fct_results/version=2/season=2031", "fct_results/version=2/season=2032"}  # 2032 holds an unknown driver
    tables, report = build.run(spark, todo, raw | {"results": amended, "drivers": raw["drivers"].unionByName(known)}, out, refresh=True)
    assert {r.model: (r.status, r.parts) for r in report.collect() if r.model.startswith("fct")} == {"fct_results": ("built", 1), "fct_sprint_results": ("unchanged", 0), "fct_driver_standings": ("unchanged", 0), "fct_constructor_standings": ("unchanged", 0)}
    assert quality.no_unknown_members(tables["fct_results"], ["driver_key"]).isEmpty()
    assert sorted(str(r.points) for r in tables["fct_results"].filter("season = 2031 and round = 1").collect()) == ["2.0000", "4.0000", "6.0000", "7.5000"]
    tables, report = build.run(spark, todo, raw | {"results": amended, "drivers": raw["drivers"].unionByName(known)}, out, refresh=True)
    assert {r.status for r in report.collect() if r.model.startswith("fct")} == {"unchanged"}


def test_rounds_in_the_order_of_numbers(spark):
    races = spark.createDataFrame([(2031, r, "2031-01-01") for r in ("10", "2", "1", "11")], "season int, round string, race_date string")
    assert [r.round for r in state.run_rounds(races, F.lit("2032-01-01").cast("date")).collect()] == [1, 2, 10, 11]


def test_stored_marts_follow_their_tables(spark, tmp_path):
    """A table that changes in a session changes what is served from it."""
    for n in ("lineitem", "orders", "supplier", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet").limit(500 if n == "lineitem" else 10_000).write.parquet(f"{tmp_path}/{n}.parquet")
    before = bindings.results(spark, str(tmp_path)).count()
    assert bindings.results(spark, str(tmp_path)).inputFiles() == bindings.results(spark, str(tmp_path)).inputFiles()
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert bindings.results(spark, str(tmp_path)).count() > before
