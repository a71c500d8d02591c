"""Source divergence, periodic runs, archives: brute force, SQL twins, edges, damage."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import divergence, registry, runs, warc

DOCS = "doc_id long, text string, lang string, source string, runs int, term string, start long"


def rows_of(df):
    return sorted(map(repr, (tuple(sorted(r.asDict().items())) for r in df.collect())))


def twin(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    out = con.sql(sql)
    return sorted(map(repr, (tuple(sorted(zip(out.columns, r, strict=True))) for r in out.fetchall())))


def edge_docs(spark):
    rows = [(i, "Wört Abc 12abc über-lange " * (i % 5) + "x" * (300 + i % 3) + " " + "y" * 700, f"l{i % 2}", f"s{i % 4}", 1, "t", 2) for i in range(60)]
    rows += [(None, None, None, None, None, None, None), (99, "", "l1", None, 0, "", 0), (99, "A" * 300 + " " + "a" * 300, "only", "one", 0, "", 0), (100, "ab" * 60_000 + " ab", "l1", "", 0, "", 0)] * 2
    rows += [(101, "a b " * 40_000, None, "q", 0, "", 0), (102, " \t\n\x0b\x0c\r", "l0", "s0", 0, "", 0), (103, "x y z " * 9 + "\x1c x y z  x y z", "l0", "s1", 0, "", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_divergence_like_sql(spark):
    df = edge_docs(spark)
    assert rows_of(divergence.query(df)) == twin(divergence.ORACLE, documents=df)
    assert divergence.query(df.filter("false")).collect() == []


def test_divergence_in_small_tiles(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(divergence.audit(df, 3, tile=3, chunk=50)) == rows_of(divergence.audit(df, 3))


def test_multikey_sort():
    rng = random.Random(1)
    terms = ["".join(rng.choices("abé", k=rng.choice([1, 2, 7, 8, 9, 16, 40]))) for _ in range(3000)] + ["é" * n for n in (200, 300, 300, 301, 128, 128)] + ["a" * 256] * 3
    rng.shuffle(terms)
    raw = [t.encode() for t in terms]
    offsets = np.cumsum([0] + [len(r) for r in raw])  # texts of one term, without anything between
    data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    start, length = divergence.pointers(offsets, data)
    assert (start == offsets[:-1]).all() and (length == np.diff(offsets)).all()
    order, fresh = divergence.multikey_sort(data, start, length)
    got = [raw[k] for k in order]
    assert got == sorted(raw)
    assert fresh.tolist() == [True] + [a != b for a, b in zip(got[:-1], got[1:], strict=True)]


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            seg = w[i : i + size]
            if j > i and size >= max(6, 4 * q) and not any(all(seg[x] == seg[x + r] for x in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


def test_runs_by_brute_force():
    rng = random.Random(2)
    for _ in range(600):
        k, texts = rng.randint(1, 5), []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randrange(k) for _ in range(rng.randint(0, 40))]
            while rng.random() < 0.7:
                w += [rng.randrange(k) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
            texts.append(w)
        ends = np.cumsum([0] + [len(t) for t in texts])
        begin, end, period = runs.find_runs(np.array(sum(texts, []), dtype=np.int64), ends)
        got = sorted(zip(begin.tolist(), (end - begin).tolist(), period.tolist(), strict=True))
        assert got == [(int(ends[k]) + a, z, q) for k, t in enumerate(texts) for a, z, q in brute_runs(t)]


def test_lyndon_array():
    rng = random.Random(3)
    for _ in range(300):
        w = [rng.randrange(3) for _ in range(rng.randint(1, 25))]
        is_lyndon = lambda u: all(u < u[k:] for k in range(1, len(u)))
        want = [max(z for z in range(1, len(w) - i + 1) if is_lyndon(w[i : i + z])) for i in range(len(w))]
        assert runs.lyndon([-1, *w, -1])[1:-1] == want


def test_hashes_that_meet(monkeypatch):
    """Where prefix hashes agree by chance, words decide."""
    monkeypatch.setattr(runs._Extension, "_same", lambda self, i, p, size: np.ones(len(i), bool))
    w = [1, 2, 3] * 6 + [7] + [4, 5] * 5
    begin, end, period = runs.find_runs(np.array(w), np.array([0, len(w)]))
    assert sorted(zip(begin.tolist(), (end - begin).tolist(), period.tolist(), strict=True)) == brute_runs(w)


def digest(row):
    words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
    n, h = len(words), zlib.crc32(b"" if row.doc_id is None else str(row.doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = [(0, n, 2)] if n > 5_000 and row.doc_id == 101 else brute_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {k for a, z, q in found for k in range(a + q, a + z)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (row.doc_id, len(found), *top, sha("".join(f"{a},{z},{q}\n" for a, z, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_runs_of_documents(spark):
    df = edge_docs(spark).unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars < 3000"), allowMissingColumns=True)
    assert zlib.crc32(b"101") % 10  # the long text keeps its words
    got = sorted(map(repr, map(tuple, runs.query(df).collect())))
    assert got == sorted(repr(digest(r)) for r in df.collect())
    assert runs.query(df.filter("false")).collect() == []


def test_runs_replaces_its_columns(spark):
    df = edge_docs(spark).withColumn("collapsed", F.lit("x"))
    got = runs.find(df).filter("doc_id = 101").collect()[0]
    assert got.runs == [(0, 80_000, 2)] and got.collapsed == "a b" and set(got.asDict()) == set(df.columns)


PAGES = "page_id long, url string, html string, hash string, uid int, path string"


def test_archives_like_sql(spark):
    rows = [(1, "u", "x"), (1, "u", "x"), (None, None, None), (3, None, ""), (None, "a\r\nWARC-Type: metadata", "x"), (4, "é", "é\x00" * 5), (5, "u", "\x1f\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, "h", 1, "p") for r in rows * 2 + [(7 + k, "u", "hot") for k in range(300)]], PAGES)
    assert rows_of(warc.query(df)) == twin(warc.ORACLE, pages=df)
    assert warc.query(df.filter("false")).collect() == []


def test_many_groups_and_a_least_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SHARED_GROUPS", 1)
    monkeypatch.setattr(warc, "HEAVY", 5)
    rows = [(f"r{k}", k, "u", f"t{k % 7}".encode() * (1 + k % 7)) for k in range(30)] + [(f"h{k}", 100 + k, "u", b"hot payload") for k in range(20)]
    df = spark.createDataFrame(rows, "record_id string, key long, target_uri string, payload binary")
    for least in (0, 5):
        got = {r.record_id: (r.record_type, r.refers_to) for r in warc.roles(df, least).collect()}
        for name, _, _, data in rows:
            last = max((r[1], r[0]) for r in rows if r[3] == data)[1]
            assert got[name] == (("response", None) if len(data) < least or name == last else ("revisit", last))


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    rng = random.Random(1)
    inner = b"".join(warc.encode_record("response", f"in:{k}", None, None, warc.DATE, rng.randbytes(200), 200, "X") for k in range(30))
    rows = [(f"r{k}", k, "u", inner if k % 7 == 3 else rng.randbytes(rng.randint(0, 3000))) for k in range(120)]
    df = spark.createDataFrame(rows, "record_id string, key long, target_uri string, payload binary")
    return rows, warc.write(warc.roles(df), str(tmp_path_factory.mktemp("warc") / "w"), 30_000).collect()


@pytest.mark.parametrize("size", [700, 5_000, 1 << 20])
def test_ranges_inside_stored_archives(spark, archives, size):
    """Payloads that are archives themselves give no records, wherever the ranges begin."""
    rows, manifest = archives
    back = warc.read(spark, spark.createDataFrame(manifest), size).collect()
    assert sorted(r.record_id for r in back) == sorted(r[0] for r in rows) and all(r.error is None for r in back)
    data = {r[0]: r[3] for r in rows}
    for r in back:
        assert r.payload_bytes == len(data[r.record_id]) and r.payload_digest == warc.sha1_base32(data[r.record_id])
        assert r.record_type == "revisit" and data[r.refers_to] == data[r.record_id] or bytes(r.payload) == data[r.record_id]


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_damaged_archive(spark, tmp_path, size):
    """A damaged member is told of, those around it are read; a cut end and leading rubbish too."""
    rng = random.Random(4)
    members = [warc.encode_record("response", f"d{k}", None, "u", warc.DATE, rng.randbytes(2000), 2000, "X") for k in range(12)]
    broken = bytearray(members[5])
    broken[1500] ^= 0xFF
    data = b"rubbish\x1f\x8b\x08!" + b"".join([*members[:5], bytes(broken), *members[6:11], members[11][:1200]])
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    manifest = spark.createDataFrame([(str(path), len(data), 12)], warc.MANIFEST)
    got = {r.record_id: r.error for r in warc.read(spark, manifest, size).collect()}
    assert set(got) == {f"d{k}" for k in range(12)} and {k for k, e in got.items() if e} == {"d5", "d11"}


def test_gzip_tools_read_what_is_written(archives):
    import gzip

    for m in archives[1]:
        text = gzip.open(m.path).read()
        assert text.count(b"WARC-Record-ID: <r") == m.records


@pytest.mark.parametrize("name", ["op11_divergence", "op12_runs", "op13_warc"])
def test_registered(spark, name):
    got = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and len(set(got.columns)) == len(got.columns)
