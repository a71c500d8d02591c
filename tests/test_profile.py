"""Profiling in one pass, many foreign keys at once, ranges of offsets, empty tables."""

import json
import random
import re

from pyspark.sql import functions as F

from lapforge.operators import merge, profile, state
from lapforge.operators.profile import Edge


def test_profile_like_a_plain_count(spark):
    rng = random.Random(1)
    docs = []
    for i in range(400):
        d = {"id": i, "code": str(i), "few": rng.choice(["a", "b", "", None]), "list": [{"v": rng.randrange(40), "w": {"x": rng.random() < 0.5}} for _ in range(rng.randrange(4))]}
        if i % 3 == 0:
            d["mixed"] = rng.choice([1, "é", [1, {"deep": {"er": [{"q": 1}]}}], {"k": None}])
        docs.append(d)
    want = {}

    def walk(path, value, here):
        for k, v in value.items() if isinstance(value, dict) else []:
            p = f"{path}.{k}" if path else k
            w = want.setdefault(p, {"records": set(), "n": 0, "empty": 0, "values": set()})
            w["records"].add(here)
            w["n"] += 1
            w["empty"] += v in (None, "")
            if v not in (None, "") and not isinstance(v, (dict, list)):
                w["values"].add(json.dumps(v) if isinstance(v, bool) else str(v))
            walk(p, v, here)
        for v in value if isinstance(value, list) else []:
            walk(f"{path}[]", v, here)

    for i, d in enumerate(docs):
        walk("", d, i)
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k long, j string").repartition(5)
    got = {r.path: r for r in profile.profile_fields(df, "k", "j").collect()}
    assert set(got) == set(want)
    for p, w in want.items():
        r, values = got[p], sorted(w["values"])
        assert (r.present_in_records, r.occurrences, r.null_or_empty) == (len(w["records"]), w["n"], w["empty"])
        assert (r.samples or []) == values[:3] and r.distinct_values == (values if 0 < len(values) <= 30 else None)
    assert got["few"].types == "empty-string,null,string" and got["code"].types == "string(numeric)"


def test_profile_exchanges_paths_only(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 1}}')], "k long, j string")
    plan = profile.profile_fields(df, "k", "j")._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["path"] and plan.count("Generate") == 1
    assert profile.profile_fields(df.filter("false"), "k", "j").collect() == []


def test_collect_records(spark):
    docs = spark.createDataFrame([('{"a": {"l": [{"m": [{"v": 1}, {"v": 2}]}, {"m": [{"v": 3}]}]}}',)], "value string")
    found = profile.collect_records(docs, profile.infer(docs), "a.l[].m")
    assert sorted(r.record.v for r in found.collect()) == [1, 2, 3]


def test_edges_like_single_ones(spark):
    a = spark.createDataFrame([(1, 5), (2, 5), (2, None), (9, 6), (8, 6), (8, 6)], "x int, y long")
    tables = {"a": a, "b": spark.createDataFrame([(1,), (2,), (2,)], "k long"), "none": spark.createDataFrame([], "z int")}
    edges = [Edge("a", "x", "b", "k"), Edge("a", "y", "b", "k"), Edge("none", "z", "b", "k"), Edge("a", "x", "none", "z")]
    got = [tuple(r)[1:] for r in profile.coverage_edges(tables, edges).orderBy("edge").collect()]
    want = [tuple(profile.join_coverage(tables[e.child], e.column, tables[e.parent], e.key).first()) for e in sorted(edges, key=lambda e: e.name)]
    blank = lambda rows: [(*r[:4], r[4] or None) for r in rows]
    assert blank(got) == blank(want) and got[3][:3] == (0, 0, None)
    plan = profile.coverage_edges({k: v.repartition(2) for k, v in tables.items()}, edges[:2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD[x") <= 2


def test_empty_raw_table(spark):
    raw = spark.createDataFrame([], "ingested_at timestamp, updated_at timestamp")
    assert tuple(merge.load_pattern(raw, "e").first()) == ("e", None, "immutable")


NONE = "entity string, scope string, next_offset int, total_expected int, status string, started_at timestamp, updated_at timestamp"


def test_landed_ranges_are_remembered(spark):
    """Pages beyond a gap are not fetched again when the gap is filled."""
    now = F.lit("2031-01-01 00:00:00").cast("timestamp")
    land = lambda *p: spark.createDataFrame([("e", "s", o, 100, 350) for o in p], "entity string, scope string, offset int, limit int, total int")
    gaps = lambda marks: [tuple(r)[2:] for r in state.resume_gaps(marks.select("entity", "scope"), marks).orderBy("start").collect()]
    marks = state.advance_checkpoints(spark.createDataFrame([], NONE), land(0, 200), now)
    assert gaps(marks) == [(100, 200), (300, 350)]
    marks = state.advance_checkpoints(marks, land(300, 300), now)
    assert gaps(marks) == [(100, 200)] and marks.first().next_offset == 100
    marks = state.advance_checkpoints(marks, land(100), now)
    assert tuple(marks.select("next_offset", "status").first()) == (400, "complete") and gaps(marks) == []
    assert [tuple(r) for r in marks.first().landed] == [(0, 400)]


def test_ranges_like_sets(spark):
    rng = random.Random(2)
    rows = [(g, a, a + rng.randrange(-1, 6)) for g in "abc" for a in (rng.randrange(60) for _ in range(15))]
    for r in state.merge_ranges(spark.createDataFrame(rows, "g string, start int, stop int"), ["g"]).collect():
        want = {x for g, a, b in rows if g == r.g for x in range(a, b)}
        assert {x for s in r.landed for x in range(s.start, s.stop)} == want
        assert all(a.stop < b.start for a, b in zip(r.landed[:-1], r.landed[1:], strict=True))
