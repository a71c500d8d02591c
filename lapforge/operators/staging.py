"""Staging: one function a raw entity; renames, casts and flags, no join, filter or aggregate.

Casts are strict: a value of a new shape fails loudly instead of becoming null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions.exprs import arr_field, arr_len, blank, duration_seconds, has_key, session_timestamp, txt, variant

_TAIL = ("source_key", "ingested_at", "updated_at")


def _stage(raw: DataFrame, **columns: Column) -> DataFrame:
    doc = raw.withColumn("_p", variant("payload"))
    return doc.select(*[c.alias(n) for n, c in columns.items()], *_TAIL)


def _t(path: str) -> Column:
    return txt(F.col("_p"), path)


def _int(column: Column) -> Column:
    return column.cast("int")


def _season_round() -> dict[str, Column]:
    return {"season": _int(F.col("season")), "round": _int(F.col("round"))}


def stg_seasons(raw: DataFrame) -> DataFrame:
    return _stage(raw, season=_int(F.col("season")), wikipedia_url=_t("url"))


def stg_circuits(raw: DataFrame) -> DataFrame:
    return _stage(raw, circuit_id=F.col("circuit_id"), circuit_name=_t("circuitName"), latitude=_t("Location.lat").cast("double"), longitude=_t("Location.long").cast("double"), country=_t("Location.country"), locality=_t("Location.locality"), wikipedia_url=_t("url"))


def stg_drivers(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, driver_id=F.col("driver_id"), driver_code=_t("code"), first_name=_t("givenName"), last_name=_t("familyName"), full_name=F.concat(_t("givenName"), F.lit(" "), _t("familyName")),
        nationality=_t("nationality"), date_of_birth=_t("dateOfBirth").cast("date"), permanent_number=_int(blank(_t("permanentNumber"))), wikipedia_url=_t("url"),
    )


def stg_constructors(raw: DataFrame) -> DataFrame:
    return _stage(raw, constructor_id=F.col("constructor_id"), constructor_name=_t("name"), nationality=_t("nationality"), wikipedia_url=_t("url"))


def stg_status(raw: DataFrame) -> DataFrame:
    return _stage(raw, status_id=_int(F.col("status_id")), status=_t("status"), source_all_time_count=_int(_t("count")))


def stg_races(raw: DataFrame) -> DataFrame:
    doc = F.col("_p")
    sessions = {name: session_timestamp(doc, block) for name, block in (("practice_1_utc", "FirstPractice"), ("practice_2_utc", "SecondPractice"), ("practice_3_utc", "ThirdPractice"), ("qualifying_utc", "Qualifying"), ("sprint_utc", "Sprint"))}
    start = F.when(_t("time").isNotNull(), F.concat(_t("date"), F.lit(" "), _t("time")).cast("timestamp"))
    return _stage(
        raw, **_season_round(), race_name=_t("raceName"), circuit_id=_t("Circuit.circuitId"), race_date=_t("date").cast("date"), race_start_utc=start, **sessions,
        sprint_qualifying_utc=F.coalesce(session_timestamp(doc, "SprintQualifying"), session_timestamp(doc, "SprintShootout")), is_sprint_weekend=has_key(F.col("payload"), "Sprint"), wikipedia_url=_t("url"),
    )


def result_flags(text: Column, grid: Column, place: Column) -> dict[str, Column]:
    """Flags of a result: numeric text is classified; grid 0 is a pit-lane start and gains nothing."""
    numeric = text.rlike("^[0-9]+$")
    return {
        "is_classified": numeric, "is_retired": text == "R", "is_disqualified": text == "D", "is_withdrawn": text == "W",
        "positions_gained": F.when(numeric & (grid > 0), grid - place),
    }


def _results(raw: DataFrame, number: Column, **more: Column) -> DataFrame:
    grid, place = _int(_t("grid")), _int(_t("position"))
    return _stage(
        raw, **_season_round(), driver_id=F.col("driver_id"), constructor_id=_t("Constructor.constructorId"), car_number=_int(number), grid_position=grid, classified_position=place, position_text=_t("positionText"),
        points=_t("points").cast("decimal(12,4)"), laps_completed=_int(_t("laps")), status=_t("status"), race_time_millis=_t("Time.millis").cast("long"), race_time_display=_t("Time.time"),
        fastest_lap_number=_int(_t("FastestLap.lap")), fastest_lap_rank=_int(_t("FastestLap.rank")), fastest_lap_time_display=_t("FastestLap.Time.time"), **more, **result_flags(_t("positionText"), grid, place),
    )


def stg_results(raw: DataFrame) -> DataFrame:
    return _results(raw, blank(_t("number"), "None"), fastest_lap_avg_speed_kph=_t("FastestLap.AverageSpeed.speed").cast("decimal(8,3)"))


def stg_sprint(raw: DataFrame) -> DataFrame:
    return _results(raw, _t("number"))


def qualifying_flags(json: Column, q1: Column, q2: Column, q3: Column) -> dict[str, Column]:
    """Sessions reached by the presence of their keys, whatever their values."""
    two, three = has_key(json, "Q2"), has_key(json, "Q3")
    return {"reached_q2": two, "reached_q3": three, "decisive_time": F.coalesce(q3, q2, q1), "eliminated_in": F.when(three, F.lit(None).cast("string")).when(two, "Q2").otherwise("Q1"), "set_no_time": q1.isNull()}


def stg_qualifying(raw: DataFrame) -> DataFrame:
    q1, q2, q3 = (blank(_t(q)) for q in ("Q1", "Q2", "Q3"))
    return _stage(
        raw, **_season_round(), driver_id=F.col("driver_id"), constructor_id=_t("Constructor.constructorId"), car_number=_int(_t("number")), qualifying_position=_int(_t("position")),
        q1_time=q1, q2_time=q2, q3_time=q3, **qualifying_flags(F.col("payload"), q1, q2, q3),
    )


def stg_pitstops(raw: DataFrame) -> DataFrame:
    return _stage(raw, **_season_round(), driver_id=F.col("driver_id"), stop_number=_int(F.col("stop")), lap=_int(_t("lap")), stop_time_local=_t("time"), duration_text=_t("duration"), duration_seconds=duration_seconds(_t("duration")))


def _standing() -> dict[str, Column]:
    place = _int(blank(_t("position")))
    return {"points": _t("points").cast("decimal(12,4)"), "wins": _int(_t("wins")), "championship_position": place, "position_text": _t("positionText"), "is_unranked": place.isNull()}


def stg_driver_standings(raw: DataFrame) -> DataFrame:
    count = arr_len(F.col("_p"), "Constructors")
    return _stage(raw, **_season_round(), driver_id=F.col("driver_id"), **_standing(), constructor_count=count, constructor_ids=arr_field(F.col("_p"), "Constructors", "constructorId"), changed_constructor_in_season=count > 1)


def stg_constructor_standings(raw: DataFrame) -> DataFrame:
    return _stage(raw, **_season_round(), constructor_id=F.col("constructor_id"), **_standing(), is_excluded=_t("positionText") == "E")


STAGING = {f.__name__.removeprefix("stg_"): f for f in (stg_seasons, stg_circuits, stg_drivers, stg_constructors, stg_status, stg_races, stg_results, stg_sprint, stg_qualifying, stg_pitstops, stg_driver_standings, stg_constructor_standings)}
