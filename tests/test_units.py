"""Behaviours of single operators on invented envelopes."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapforge.functions import exprs
from lapforge.operators import extract, merge, staging, state
from lapforge.plans import marts
from lapforge.sources import lake
from lapforge.sources.entities import ENTITIES


def page(*races):
    return json.dumps({"MRData": {"total": "3", "limit": "100", "offset": "0", "RaceTable": {"Races": list(races)}}})


def docs(spark, *values):
    return extract.parse_objects(spark.createDataFrame([(v, f"k{i}") for i, v in enumerate(values)], "value string, source_key string"))


ADA = {"number": "7", "grid": "2", "position": "1", "positionText": "1", "points": "12.5", "status": "Finished", "Driver": {"driverId": "ada"}, "Constructor": {"constructorId": "alpha"}}


def test_extract_lifts_keys_and_splits_dead_letters(spark):
    ok, bad = docs(spark, page({"season": "2031", "round": "1", "Results": [ADA, {"position": "3"}, 5]}, {"round": "2", "Results": [ADA]}), "{bad", "{}", '{"MRData": {"RaceTable": {"Races": {}}}}')
    assert [r.error_detail for r in bad.collect()] == ["not valid JSON"]
    good, failed = extract.extract(ENTITIES["results"], ok)
    got = good.collect()
    assert [(r.season, r.round, r.driver_id) for r in got] == [("2031", "1", "ada")]
    assert json.loads(got[0].payload)["points"] == "12.5"
    assert sorted(r.error_detail for r in failed.collect()) == ["missing key field(s): Driver.driverId", "missing key field(s): season"]


def raw(spark, entity, *payloads, **keys):
    spec = ENTITIES[entity]
    values = {"season": "2031", "round": "1", "driver_id": "ada", "stop": "1"} | keys
    rows = [(*[values.get(k, "x") for k in spec.grain], json.dumps(p), "k") for p in payloads]
    df = spark.createDataFrame(rows, [*spec.grain, "payload", "source_key"])
    return df.withColumns({c: F.lit("2031-01-01 00:00:00").cast("timestamp") for c in ("ingested_at", "updated_at")})


def test_results(spark):
    other = ADA | {"number": "None", "grid": "0", "position": "9", "positionText": "9"}
    a, b, c = staging.stg_results(raw(spark, "results", ADA, other, ADA | {"positionText": "W"})).collect()
    assert (a.points, a.positions_gained, a.car_number, a.is_classified) == (Decimal("12.5000"), 1, 7, True)
    assert (b.car_number, b.positions_gained) == (None, None)
    assert (c.is_withdrawn, c.is_classified, c.positions_gained) == (True, False, None)


def test_qualifying_states(spark):
    base = {"number": "1", "position": "2", "Q1": "1:20"}
    got = staging.stg_qualifying(raw(spark, "qualifying", base, base | {"Q2": ""}, base | {"Q2": "1:19"}, base | {"Q2": None})).collect()
    assert [(r.reached_q2, r.q2_time, r.eliminated_in) for r in got] == [(False, None, "Q1"), (True, None, "Q2"), (True, "1:19", "Q2"), (True, None, "Q2")]


def test_races_and_standings(spark):
    race = {"raceName": "R", "date": "2031-03-02", "Circuit": {"circuitId": "c"}, "FirstPractice": {"date": "2031-03-01"}, "SprintShootout": {"date": "2031-03-01", "time": "15:00:00Z"}, "Sprint": None}
    r = staging.stg_races(raw(spark, "races", race)).first()
    assert (r.race_start_utc, r.practice_1_utc, r.sprint_qualifying_utc.hour, r.is_sprint_weekend) == (None, None, 15, True)
    two = {"position": "", "positionText": "E", "points": "1.5", "wins": "0", "Constructors": [{"constructorId": "b"}, {"constructorId": "a"}]}
    s = staging.stg_driver_standings(raw(spark, "driver_standings", two)).first()
    assert (s.constructor_count, s.constructor_ids, s.is_unranked, s.changed_constructor_in_season) == (2, ["b", "a"], True, True)
    c = staging.stg_constructor_standings(raw(spark, "constructor_standings", two)).first()
    assert c.is_excluded and c.is_unranked


@pytest.mark.parametrize(("text", "seconds"), [("24.500", "24.500"), ("1:02.250", "62.250"), ("41:07.125", "2467.125"), ("", None)])
def test_duration(spark, text, seconds):
    got = spark.createDataFrame([(text,)], "t string").select(exprs.duration_seconds(F.col("t"))).first()[0]
    assert got == (seconds and Decimal(seconds))


def test_duration_of_a_new_shape_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("1:02:03.5x",)], "t string").select(exprs.duration_seconds(F.col("t"))).collect()


def test_status(spark):
    rows = [(i, s, 1) for i, s in enumerate(["+12 Laps", "Lapped", "Excluded", "Eye injury", "Fresh trouble", "Retired"])]
    got = {r.status: (r.status_canonical, r.laps_down, r.status_category) for r in marts.dim_status(spark.createDataFrame(rows, "status_id int, status string, source_all_time_count int")).collect()}
    assert got["+12 Laps"] == ("Lapped", 12, "lapped") and got["Lapped"] == ("Lapped", None, "lapped")
    assert got["Excluded"][0] == "Disqualified" and got["Eye injury"][2] == "driver_unavailable" and got["Fresh trouble"][2] == "mechanical" and got["Unknown"][2] == "unknown"


def test_unknown_keys(spark):
    races = spark.createDataFrame([(1, 1, "k")], "season int, round int, race_key string").withColumn("is_unknown", F.lit(False))
    got = marts.conform(spark.createDataFrame([(1, 1), (1, 2)], "season int, round int"), {"race_key": (races, ["season", "round"])}).orderBy("round").collect()
    assert got[0].race_key == "k" and got[1].race_key == spark.range(1).select(exprs.unknown_key()).first()[0]


def test_merge_ignores_key_order_and_is_idempotent(spark):
    t = "2031-01-01 00:00:00"
    old = spark.createDataFrame([("a", '{"x":1,"y":2.50}', "s"), ("b", '{"x":1}', "s"), ("c", "{}", "s")], "k string, payload string, source_key string").withColumns({c: F.lit(t).cast("timestamp") for c in ("ingested_at", "updated_at")})
    new = spark.createDataFrame([("a", '{"y":2.5,"x":1}', "n"), ("b", '{"x":2}', "n"), ("d", "{}", "n")], "k string, payload string, source_key string")
    once = merge.merge(old, new, ["k"], F.lit("2031-01-02 00:00:00").cast("timestamp"))
    assert {r.k: (r._action, r.source_key, r.updated_at > r.ingested_at) for r in once.collect()} == {"a": ("noop", "s", False), "b": ("update", "n", True), "c": ("keep", "s", False), "d": ("insert", "n", False)}
    again = merge.merge(once.drop("_action"), new, ["k"], F.current_timestamp())
    assert {r._action for r in again.collect()} == {"noop", "keep"}


def test_pages(spark):
    audit = lambda *p: lake.audit_pages(spark.createDataFrame([("s", *x) for x in p], "s string, offset int, limit int, total int"), ["s"]).first()
    assert audit((0, 100, 250), (100, 100, 250), (200, 100, 250)).status == "complete"
    assert audit((0, 100, 250), (200, 100, 250)).missing_from == 100
    assert audit((0, 100, 250)).missing_from == 100
    assert audit((0, 0, 250)).status == "invalid"


def test_rounds_and_window(spark):
    rows = [("1", "2031-01-01"), ("2", "2032-01-01"), ("10", None), ("11", ""), ("12", "soon"), ("13", "2031-06-01")]
    races = spark.createDataFrame([("2031", *r) for r in rows], "season string, round string, race_date string")
    assert sorted(r.round for r in state.run_rounds(races, F.lit("2031-06-01").cast("date")).collect()) == [1, 10, 11, 12, 13]
    log = spark.createDataFrame([("2031-01-01 00:00:00",), ("2031-01-01 01:00:01",)], "t string").select(F.col("t").cast("timestamp").alias("called_at"))
    assert [r.calls for r in state.usage_series(log, 2).orderBy("called_at").collect()] == [1, 1]
