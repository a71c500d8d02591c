"""Landed JSON objects, versions of raw tables and their commit records."""

import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from lapforge.operators import extract, state
from lapforge.sources import lake, versions
from lapforge.sources.entities import ENTITIES
from lapforge.streaming import loader

DAY = "2031-05-01"


def put(root, entity, scope, offset, data, day=DAY):
    path = pathlib.Path(root, entity, day, f"{entity}_{scope}_offset={offset:05d}.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else json.dumps(data).encode())


def results(season, rounds, points="1"):
    races = [{"season": str(season), "round": str(r), "Results": [{"points": points, "Driver": {"driverId": d}} for d in ("ada", "bo")]} for r in rounds]
    return {"MRData": {"total": "4", "limit": "2", "offset": "0", "RaceTable": {"Races": races}}}


def test_objects_by_scope(spark, tmp_path):
    root = str(tmp_path)
    for season in (2031, 2032):
        for r in (1, 2, 11):
            put(root, "pitstops", f"season={season}_round={r:02d}", 0, {"n": r})
        put(root, "results", f"season={season}", 0, {"s": season})
        put(root, "results", f"season={season}", 100, {"s": season})
    put(root, "results", "season=2031", 0, {"s": 0}, "2031-05-02")
    put(root, "results", "season=2031", 0, {"s": 0}, "2031-05-02")
    (tmp_path / "results" / DAY / "notes.txt").write_text("not a page")
    keys = lambda *a: sorted(r.source_key for r in lake.read_objects(spark, root, *a).collect())
    assert keys("pitstops", DAY, 2031, 1) == [f"pitstops/{DAY}/pitstops_season=2031_round=01_offset=00000.json"]
    assert len(keys("pitstops", DAY, 2031)) == 3 and len(keys("pitstops", DAY)) == 6 and len(keys("results", DAY, 2032)) == 2
    assert len(keys("results")) == 5 and keys("results", "2031-05-03") == [] and keys("laps", DAY) == []
    row = lake.read_objects(spark, root, "results", DAY, 2032).orderBy("offset").collect()[1]
    assert (row.entity, str(row.ingestion_date), row.scope, row.offset, json.loads(row.value)) == ("results", DAY, "season=2032", 100, {"s": 2032})


def test_objects_put_by_tasks(spark, tmp_path):
    root = f"{tmp_path}/a b+c"
    rows = [("results", "season=2031", k, json.dumps({"k": k, "name": "é\n"})) for k in (0, 100, 100_000)]
    pages = spark.createDataFrame(rows, "entity string, scope string, offset int, value string").withColumn("ingestion_date", F.lit(DAY).cast("date"))
    assert lake.put_objects(pages, root) == 3 and lake.put_objects(pages.filter("offset = 0"), root) == 1
    assert sorted(os.listdir(f"{root}/results/{DAY}")) == [f"results_season=2031_offset={o}.json" for o in ("00000", "00100", "100000")]
    assert sorted((r.offset, r.value) for r in lake.read_objects(spark, root, "results", DAY).collect()) == [(r[2], r[3]) for r in rows]


def test_broken_empty_and_huge_objects(spark, tmp_path):
    """A broken and an empty object are dead letters; one of over 128 MB is one page."""
    root = str(tmp_path)
    put(root, "results", "season=2031", 0, b"{bad")
    put(root, "results", "season=2031", 100, b"")
    long = json.dumps(results(2031, [2, 3])).encode()
    put(root, "results", "season=2031", 200, long[:-1] + b', "note": "' + b"x" * (130 << 20) + b'"}')
    put(root, "results", "season=2031", 300, results(2031, [1]))
    put(root, "results", "season=2031", 400, long[:-1] + b', "note": "' + b"x" * (130 << 20))
    docs, bad = extract.parse_objects(lake.read_objects(spark, root, "results", DAY).unionByName(lake.empty_objects(spark, root, "results", DAY)))
    assert sorted(r.source_key[-10:-5] for r in bad.select("source_key").collect()) == ["00000", "00100", "00400"]
    good = extract.extract(ENTITIES["results"], docs)[0]
    assert sorted((r.round, r.driver_id) for r in good.collect()) == [(r, d) for r in "123" for d in ("ada", "bo")]


def files(root):
    return {str(p.relative_to(root)) for p in pathlib.Path(root).rglob("*.parquet")}


def test_a_batch_rewrites_only_its_season(spark, tmp_path):
    """Objects stream in; a later page of one season leaves the files of the others alone."""
    lake_root, root = f"{tmp_path}/lake", f"{tmp_path}/raw_results"
    go = lambda: loader.stream_load(spark, "", root, "results", f"{tmp_path}/marks", lake.stream_objects(spark, lake_root, "results"))
    for season in (2030, 2031, 2032):
        put(lake_root, "results", f"season={season}", 0, results(season, [1, 2]))
    go()
    before = files(f"{root}/raw")
    assert {f.split("/")[1] for f in before} == {"bucket=s2030", "bucket=s2031", "bucket=s2032"}
    put(lake_root, "results", "season=2031", 0, results(2031, [1, 2], "7"), "2031-05-02")
    go()
    go()  # nothing new
    new = files(f"{root}/raw") - before
    assert new and {f.rsplit("/", 1)[0] for f in new} == {"version=2/bucket=s2031"} and before <= files(f"{root}/raw")
    now = loader.latest(spark, root, "results")
    points = lambda df: sorted((r.season, json.loads(r.payload)["points"]) for r in df.collect())
    assert points(now) == [("2030", "1")] * 4 + [("2031", "7")] * 4 + [("2032", "1")] * 4
    assert points(loader.latest(spark, root, "results", [2031])) == [("2031", "7")] * 4
    assert sorted(tuple(r) for r in loader.outcomes(spark, root).select("batch", "inserted", "updated").collect()) == [(1, 12, 0), (2, 0, 4)]


def test_what_is_not_committed_does_not_count(spark, tmp_path, monkeypatch):
    """A batch that breaks off before its commit is not read, is done anew, and its rest is cleaned up."""
    root = f"{tmp_path}/r"
    page = lambda points, rounds=(1,): spark.createDataFrame([(json.dumps(results(2031, rounds, points)), "k")], "value string, source_key string")
    loader.load(spark, page("1"), root, "results", 1)

    def broken(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", broken)
        with pytest.raises(OSError, match="lost"):
            loader.load(spark, page("2", (1, 2)), root, "results", 2)
    points = lambda: sorted(json.loads(r.payload)["points"] for r in loader.latest(spark, root, "results").collect())
    assert points() == ["1", "1"] and loader.outcomes(spark, root).count() == 1
    loader.load(spark, page("3"), root, "results", 3)
    assert points() == ["3", "3"] and versions.children(spark, f"{root}/raw/version=2") == []
    loader.load(spark, page("9"), root, "results", 3)  # committed: not done twice
    assert points() == ["3", "3"]
    for k in (4, 5, 6):
        loader.load(spark, page(str(k)), root, "results", k)
    assert points() == ["6", "6"] and {f.split("/")[0] for f in files(f"{root}/raw")} == {"version=5", "version=6"}


def test_letters_are_resolved_by_a_later_load(spark, tmp_path):
    root = f"{tmp_path}/r"
    load = lambda batch, *docs: loader.load(spark, spark.createDataFrame([(v, k) for k, v in docs], "value string, source_key string"), root, "seasons", batch)
    good = json.dumps({"MRData": {"SeasonTable": {"Seasons": [{"season": "1"}]}}})
    load(1, ("a", "{bad"), ("b", "{worse"))
    load(2, ("b", "{worse"), ("c", good))
    assert {r.source_key for r in state.unresolved(loader.dead_letters(spark, root)).collect()} == {"a", "b"}
    load(3, ("a", good))
    letters = {r.source_key: r for r in loader.dead_letters(spark, root).collect()}
    assert letters["a"].resolved_at is not None and letters["b"].resolved_at is None and len(letters) == 2
