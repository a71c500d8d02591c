"""Vector searches against brute force: tight and spread clusters, double input, repeated rows, huge components."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import neighbours, topk

FLOATS, DOUBLES = "vec_id long, embedding array<float>, label int", "vec_id long, embedding array<double>, label int"


def linked(rows, cosine=neighbours.COSINE):
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= cosine) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None, :])
    np.fill_diagonal(near, False)
    return near.sum(axis=1)


def clouds(rng, dims, sizes, spread):
    """Clusters whose members' cosines lie about 1 / (1 + spread ** 2)."""
    out = []
    for n in sizes:
        centre = rng.normal(size=dims)
        out.append(centre + spread * np.linalg.norm(centre) / np.sqrt(dims) * rng.normal(size=(n, dims)))
    return np.concatenate(out)


@pytest.mark.parametrize(("spread", "sizes", "dims"), [(0.1, [1500], 64), (0.26, [1300, 400], 64), (0.28, [60] * 25, 48), (0.26, [40] * 40, 8), (0.2, [3] * 500, 64)])
def test_recall(spark, spread, sizes, dims):
    x = clouds(np.random.default_rng(dims), dims, sizes, spread).astype("f4")
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in neighbours.link(spark.createDataFrame(rows, FLOATS)).collect()}
    want = linked([(i, v, 1) for i, v in enumerate(x)])
    found = np.array([got[i] for i in range(len(rows))])
    assert (found <= want).all() and found.sum() >= 0.93 * want.sum() > 0


def test_mean_far_from_zero(spark):
    """Vectors that all point the same way, below the threshold but for planted pairs."""
    rng = np.random.default_rng(1)
    base = 1.0 + 1.2 * rng.normal(size=(1200, 64))
    x = np.concatenate([base, base[:300] + 0.4 * rng.normal(size=(300, 64))])
    rows = [(i, v.tolist(), i % 1) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in neighbours.link(spark.createDataFrame(rows, DOUBLES)).collect()}
    want = linked(rows)
    found = np.array([got[i] for i in range(len(rows))])
    assert (found <= want).all() and found.sum() >= 0.93 * want.sum() > 0


def test_doubles_are_kept(spark):
    """A pair that is equal in single precision and one that is apart by less than single precision sees."""
    eps = 1e-10
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, eps], 1), (3, [float(np.cos(0.2)), float(np.sin(0.2))], 1)]
    cosine = float(np.cos(0.2)) + 1e-12
    got = {r.vec_id: r.n_links for r in neighbours.link(spark.createDataFrame(rows, DOUBLES), cosine).collect()}
    assert got == dict(zip((1, 2, 3), linked(rows, cosine).tolist(), strict=True)) == {1: 1, 2: 2, 3: 1}


def twin(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    return sorted(con.sql(topk.ORACLE).fetchall())


def test_topk_repeated_rows(spark, monkeypatch):
    """Rows that repeat an id, with their vector or another, are candidates each, over many blocks too."""
    rng = np.random.default_rng(5)
    rows = [(int(i) % 90, (rng.normal(size=24) * 3).tolist(), 1) for i in range(300)]
    rows += rows[:40] + [(1, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (20, [1.0, 1.0], 1), (40, None, 1), (41, [1.0, None], 1), (60, [float("nan")], 1)]
    df = spark.createDataFrame(rows, FLOATS)
    want = twin(rows)
    assert sorted(tuple(r) for r in topk.query(df).select("query_id", "rank", "vec_id", "score").collect()) == want
    monkeypatch.setattr(topk, "BLOCK_COMPONENTS", 1)
    monkeypatch.setattr(topk, "ROW_BLOCK", 1)
    many = topk.search(topk.integers(df.unionByName(df.filter("false"))), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in many.collect()) == want


def test_topk_huge_components(spark):
    """Beyond what doubles hold exactly, scores are still exact."""
    rows = [(0, [2.0**24, 1.0]), (1, [2.0**24, 1.0]), (2, [2.0**24, 1.5]), (3, [2.0**24, 0.5]), (4, [-(2.0**20), 3.0])]
    got = topk.query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    q = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    want = sorted(((-sum(a * b for a, b in zip(q[0], q[i], strict=True)), i) for i in range(1, 5)))
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]


def test_rotations_at_every_size(spark):
    """Small labels are searched by learned codes too, and agree with SQL."""
    rng = np.random.default_rng(11)
    rows = []
    for label in range(12):
        base = rng.normal(size=(30, 24))
        for v in (base, base + rng.normal(size=base.shape) * rng.uniform(0.05, 0.4, size=(30, 1))):
            rows += [(len(rows) + k, x.astype("f4").tolist(), label) for k, x in enumerate(v)]
    rows += [(5000, [float("nan")] * 24, 1), (5001, None, 1), (5002, [0.0] * 24, 1), (5003, rows[0][1], None), (5004, rows[0][1], 0), (5005, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    nodes = df.filter("vec_id < 5000").select(F.col("vec_id").alias("node"), "embedding", "label")
    (project, bits), = neighbours.models(nodes, neighbours.COSINE).values()
    assert bits == neighbours.LEAST_BITS and project.shape[1] // bits >= 20 and np.allclose((project[:, :24] ** 2).sum(axis=0), 1)
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    want = con.sql(neighbours.ORACLE).fetchall()
    got = [tuple(r) for r in neighbours.link(df).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got) == sorted(want) and sum(r[1] for r in want) > 100


def test_extreme_magnitudes(spark):
    rows = [(2 * k + j, [s, s * (1.0 if j else 1.01)], k) for k, s in enumerate((1e200, 1e-200, 1e-310, 1.7e308 / 1.02, 1.0)) for j in (0, 1)]
    got = neighbours.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 1, i - i % 2) for i in range(10)}


def test_results_do_not_switch_by_size(spark):
    """The share of pairs that meet is the same for small labels and large ones."""
    for rows in (2, 62, neighbours.BLOCK, neighbours.BLOCK + 1, 5_000, 200_000):
        bits, tables = neighbours.shape(rows, neighbours.COSINE)
        same = (1 - np.arccos(neighbours.COSINE) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.99999 > 1 - (1 - same) ** (tables - 1)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2000, 64))
    aside = rng.normal(size=base.shape)
    aside -= base * (aside * base).sum(axis=1, keepdims=True) / (base * base).sum(axis=1, keepdims=True)
    x = np.concatenate([base, base + 0.38 * aside * np.linalg.norm(base, axis=1, keepdims=True) / np.linalg.norm(aside, axis=1, keepdims=True)])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in neighbours.link(spark.createDataFrame(rows, DOUBLES)).collect()}
    assert [got[i] for i in range(len(rows))] == linked(rows).tolist() and sum(got.values()) >= 4000
