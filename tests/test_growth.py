"""What must not grow faster than the input: windows over dense logs, files a landing, a task's share of a sort, parses of a page."""

import json
import pathlib
import time

from pyspark.sql import functions as F

from lapforge.operators import extract, state
from lapforge.plans import bindings
from lapforge.sources import lake
from lapforge.sources.entities import EntitySpec


def test_usage_of_a_dense_log(spark):
    """300,000 calls in one window: counts are running sums, not sums over every call's window."""
    log = spark.range(300_000).select(F.timestamp_micros(F.col("id") * 7_000).alias("called_at"), "id")
    begin = time.time()
    got = state.usage_series(log, 1).agg(F.max("calls"), F.sum("calls"), F.count("*")).first()
    assert tuple(got) == (300_000, 300_000 * 300_001 // 2, 300_000) and time.time() - begin < 60


def test_usage_against_counting(spark):
    """Ties, far edges, gaps, groups and calls without a time."""
    times = [0, 5, 5, 5, 3_599_999_999, 3_600_000_000, 3_600_000_005, 9_000_000_000, -1, -3_600_000_000, None, None]
    rows = [(g, t) for g in ("a", "b") for t in times[: None if g == "a" else 7]]
    log = spark.createDataFrame(rows, "entity string, t long").select("entity", "t", F.timestamp_micros("t").alias("called_at"))
    want = lambda by: sorted(repr((g, t, sum((h == g or not by) and (u is None if t is None else u is not None and t - 3_600_000_000 < u <= t) for h, u in rows))) for g, t in rows)
    for by in ((), ("entity",)):
        got = state.usage_series(log, 2, by=by).select("entity", "t", "calls", "over_budget").collect()
        assert sorted(repr((r.entity, r.t, r.calls)) for r in got) == want(by) and all(r.over_budget == (r.calls > 2) for r in got)


def test_files_follow_tasks_not_pages(spark, tmp_path):
    """A thousand pages are as many files as tasks land them; what lands again replaces, by page."""
    root = str(tmp_path)
    pages = spark.range(0, 1000, 1, 4).select(F.lit("seasons").alias("entity"), F.lit("2031-01-01").cast("date").alias("ingestion_date"), F.lit("all").alias("scope"), (F.col("id") * 100).cast("int").alias("offset"), F.lit("old").alias("value"))
    lake.land_pages(pages, root)
    assert len(list(pathlib.Path(root).rglob("*.parquet"))) == 4
    lake.land_pages(pages.filter("offset < 500").withColumn("value", F.lit("new")), root)
    found = lake.read_lake(spark, root, "seasons", "2031-01-01")
    assert sorted(found.filter("value = 'new'").select("offset").toPandas()["offset"]) == [0, 100, 200, 300, 400] and found.count() == 1000
    assert found.select("offset").distinct().count() == 1000 and lake.read_landed(spark, root).count() == 1000 and set(found.columns) == {c.split()[0] for c in lake.PAGE.split(", ")}


def test_large_tables_are_dealt_finely(spark, monkeypatch):
    rows = spark.range(100)
    assert bindings.dealt(rows, "id", 1000 * bindings.SORTED_BYTES).rdd.getNumPartitions() == 1000
    monkeypatch.setattr(bindings, "SORTED_BYTES", 1000)
    assert bindings.dealt(rows, "id", 20_001).rdd.getNumPartitions() == 21


def test_a_page_is_parsed_once(spark):
    spec = EntitySpec("e", "race", "D.O", (("o", "o"), ("n", "Item.n")), "L", ("o",))
    docs = [{"D": {"O": [{"o": 1, "L": [{"Item": {"n": k}} for k in (1, "", None, {"x": 1}, [2])] + [5, None, [], {"Item": 5}, {"Item": None}, {}, {"o": "own", "Item": {"n": 9}}]}, 7, {"L": 3}, {"o": "x"}]}}, {"D": []}, 5, None, {"D": {"O": {"o": 1}}}]
    pages = spark.createDataFrame([(str(k), json.dumps(d)) for k, d in enumerate(docs)] + [("bad", "{"), ("none", None)], "source_key string, value string")
    parsed, bad = extract.parse_objects(pages)
    good, unkeyed = extract.extract(spec, parsed)
    assert sorted(r.source_key for r in bad.collect()) == ["bad", "none"]
    assert sorted((r.o, r.n, r.pos) for r in good.collect()) == [("1", "1", 0), ("1", "[2]", 4), ("1", '{"x":1}', 3), ("own", "9", 8)]
    assert sorted((r.error_detail, r.fragment) for r in unkeyed.collect()) == sorted(("missing key field(s): Item.n", f) for f in ('{"Item":{"n":""}}', '{"Item":{"n":null}}', '{"Item":5}', '{"Item":null}', "{}"))
    plan = good.select("o", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(value") == 1 and "schema_of_variant" not in plan


def test_results_are_not_dealt_by_status(spark):
    """A handful of statuses would be as many tasks."""
    plan = bindings.QUERIES["r6_outcomes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
