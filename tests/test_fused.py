"""Checks fused into one scan a table, and the build that they gate."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lapforge.functions.exprs import unknown_key
from lapforge.operators import fused, quality
from lapforge.operators.fused import Check
from lapforge.plans import bindings

SF = "/root/testdata/sf0.001"


def test_one_scan_a_table(spark):
    names = {c.table for c in bindings.CHECKS} | {c.to[0] for c in bindings.CHECKS if c.to}
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in names}
    watched = {n: fused.observed(df, n, bindings.CHECKS)[0] for n, df in tables.items()}
    failing, slots = fused.key_counts(watched, [c for c in bindings.CHECKS if c.kind in fused.KEYED])
    plan = failing._jdf.queryExecution().executedPlan().toString()
    for n in ("lineitem", "orders", "customer", "supplier", "events"):
        assert plan.count(f"{n}.parquet") == 1
    assert plan.count("Join") == 0 and plan.count("Exchange hashpartitioning(space") == 2
    assert len(bindings.CHECKS) >= 20 and sum(map(len, slots.values())) == 9


def results(spark, tables, checks):
    return {r.name: (r.severity, r.failing, r.passed) for r in fused.run_checks(spark, tables, checks).collect()}


def test_like_single_checks(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (2, None, 2.0), (None, "y", None), (None, "y", None), (7, "z", 0.0)], "k int, t string, v double")
    b = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    checks = [
        Check("a", "unique", ("k",)), Check("a", "unique", ("k", "t")), Check("b", "unique", ("id",), "warn"), Check("a", "relationships", ("k",), to=("b", "id")), *fused.not_null("a", "k", "t", "v"),
        Check("a", "accepted_values", ("t",), values=("x", "y")), Check("a", "accepted_values", ("t",), values=("x",), where="v > 1"), Check("a", "row_count", equals=6), Check("a", "equal_rowcount", to=("b",)),
    ]
    got = [(r.failing, r.severity) for r in fused.run_checks(spark, {"a": a, "b": b}, checks).collect()]
    n = lambda df: df.count()
    want = [n(quality.unique(a, "k")), n(quality.unique(a, "k", "t")), n(quality.unique(b, "id")), n(quality.relationships(a, "k", b, "id")), *[n(quality.not_null(a, c)) for c in "ktv"]]
    want += [n(quality.accepted_values(a, "t", ["x", "y"])), n(quality.accepted_values(a, "t", ["x"], F.expr("v > 1"))), n(quality.row_count(a, 6)), n(quality.equal_rowcount(a, b))]
    assert [f for f, _ in got] == want and [s for _, s in got].count("warn") == 1


def test_unknown_members_freshness_and_empty_tables(spark):
    now = datetime(2031, 1, 10, tzinfo=timezone.utc)
    at = lambda *t: spark.createDataFrame([(x,) for x in t], "t string").select(F.col("t").cast("timestamp").alias("t"), unknown_key().alias("k"))
    fresh = [Check(n, "freshness", ("t",), now=now) for n in ("new", "late", "old", "none")]
    got = results(spark, {"new": at("2031-01-09 12:00:00"), "late": at("2031-01-08 00:00:00"), "old": at("2030-12-01 00:00:00"), "none": at()}, [*fresh, Check("old", "no_unknown", ("k",))])
    assert got["freshness_new_t"][1:] == (0, True) and got["freshness_late_t"] == ("warn", 1, False) and got["freshness_old_t"] == ("error", 1, False) and got["freshness_none_t"] == ("error", 1, False)
    assert got["no_unknown_old_k"] == ("error", 1, False)
    empty = spark.createDataFrame([], "k int")
    checks = [Check("e", "unique", ("k",)), Check("e", "relationships", ("k",), to=("e", "k")), *fused.not_null("e", "k"), Check("e", "row_count", equals=0)]
    assert all(passed for _, _, passed in results(spark, {"e": empty}, checks).values())
    nulls = spark.createDataFrame([(None,), (None,)], "k int")
    assert results(spark, {"e": nulls.repartition(2)}, checks)["not_null_e_k"] == ("error", 2, False)
    with pytest.raises(ValueError, match="unknown kind"):
        Check("e", "nonsense")
