"""What once was cut: pairs hidden by a family, rows numbered anew, long labelled texts, rarer dimensions."""

import random

import numpy as np
from pyspark.sql import functions as F

from lapforge.llm import language, mixing, neighbours, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pairs_inside_a_family(spark):
    """Members of a family at a similarity of 0.7 hide no pair at 0.82 from each other."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage, rows, gone = [word() for _ in range(204)], [], set()
    for k in range(500):
        words = passage + [word() for _ in range(39)]
        rows.append((len(rows), " ".join(words)))
        if k < 60:
            gone.add(len(rows))
            rows.append((len(rows), " ".join(words[:-22] + [word() for _ in range(22)])))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = {r.doc_id for r in simhash.stage(df).collect()}
    assert kept | gone == {i for i, _ in rows}
    assert len(kept & gone) <= 1


def _renumbering(spark, monkeypatch, module):
    """Every table written changes how files are packed into partitions from then on."""
    write, turn = module.written, iter(range(1000))

    def shifting(df, tag):
        out = write(df, tag)
        spark.conf.set("spark.sql.files.minPartitionNum", "1" if next(turn) % 2 else "8")
        return out

    monkeypatch.setattr(module, "written", shifting)


def _files(spark, path):
    rng = random.Random(5)
    for k in range(8):
        rows = [(100 * k + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randint(20, 60 + 40 * k))), "en", f"s{i % 3}", 1) for i in range(20 + 5 * k)]
        rows += [(100 * k + 90, rows[3][1], "en", "s0", 1)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def test_near_copies_are_numbered_once(spark, tmp_path, monkeypatch):
    df = _files(spark, str(tmp_path / "d"))
    want = {r.doc_id for r in df.collect()} - {100 * k + 90 for k in range(8)}
    _renumbering(spark, monkeypatch, simhash)
    try:
        assert {r.doc_id for r in simhash.stage(df).collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_mix_is_numbered_once(spark, tmp_path, monkeypatch):
    df = _files(spark, str(tmp_path / "d"))
    words = lambda rows: sorted((r.doc_id, r.text) for r in rows)
    want = words(mixing.stage(df).collect())
    _renumbering(spark, monkeypatch, mixing)
    try:
        assert words(mixing.stage(df).collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


EN, FR = "the of and to in is that it was for with as his on be at by", "le de un et il ne je son que se qui ce dans en du elle au"


def test_language_of_long_texts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices((EN if i % 2 else FR).split(), k=60 if i % 2 else 9_000)), "en" if i % 2 else "fr", "s", 1) for i in range(40)]
    rows += [(98, "12 !?", "en", "s", 1), (99, None, "fr", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.lang_pred for r in language.identify(df, language.fit(df)).collect()}
    assert all(got[i] == ("en" if i % 2 else "fr") for i in range(40)) and got[98] == got[99] == "und"
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in language.stage(unlabelled).collect()} == set(range(40))


def test_toxicity_of_long_texts(spark):
    """Long texts are learned from; ids without a text don't use up the sample."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = rng.choices(EN.split(), k=8_000)
        if i % 3 == 0:
            words[::40] = ["vexoid"] * len(words[::40])
        rows.append((i, " ".join(words), "en", "s", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(i, i % 2) for i in range(10**6, 10**6 + 20_000)], "doc_id long, toxic int")
    assert {r.doc_id for r in toxicity.stage(df, labels).collect()} == {i for i in range(60) if i % 3}


def test_every_dimension_is_indexed(spark):
    rng = np.random.default_rng(9)
    rows = []
    for dims, n in ((64, 600), (32, 300), (5, 20), (3, 1)):
        base = rng.normal(size=(n, dims))
        for v in (base, base + 0.05 * rng.normal(size=(n, dims))):
            rows += [(len(rows) + k, x.astype("f4").tolist(), 1) for k, x in enumerate(v)]
    got = {r.vec_id: r.n_links for r in neighbours.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    for dims in (64, 32, 5, 3):
        some = [r for r in rows if len(r[1]) == dims]
        x = np.array([r[1] for r in some])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= neighbours.COSINE
        np.fill_diagonal(near, False)
        want = near.sum(axis=1)
        found = np.array([got[r[0]] for r in some])
        assert (found <= want).all() and want.sum() and found.sum() >= 0.9 * want.sum()


def test_languages_and_letters_without_a_cap(spark):
    """Eighty languages of four scripts, each with some letters of its own, are all learned and told apart."""
    rng = random.Random(6)
    rows, names = [], [f"l{k:02d}" for k in range(80)]
    for k, n in enumerate(names):
        base = (ord("a"), 0x430, 0x3B1, 0x4E00)[k % 4]
        own = [chr(base + (3 * k + j) % (26 if base < 0x100 else 24 if base < 0x1000 else 900)) for j in range(4)] + [chr(0x5000 + 4 * k + j) for j in range(4)]
        rows += [(100 * k + i, " ".join("".join(rng.choices(own, k=5)) for _ in range(30)), n, "s", 1) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df.filter("doc_id % 100 < 3"))
    assert model.languages == names
    got = {r.doc_id: (r.lang, r.lang_pred) for r in language.identify(df, model).collect()}
    assert sum(a == b for a, b in got.values()) >= 0.97 * len(got)


def test_predictions_by_definition(spark):
    """Phrases counted by plain search in the learned text give the same language."""
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices((EN if i % 2 else FR).split(), k=rng.randint(1, 30))), "en" if i % 2 else "fr", "s", 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df)
    learned = {n: t[: language.TRAIN_CHARS] for n in ("en", "fr") for t in [" ".join(r[1] for r in rows if r[2] == n)]}
    same = 0
    for r in language.identify(df, model).collect():
        cost = {}
        for n, bits in zip(model.languages, model.bits, strict=True):
            count, at, text = 1, 0, r.text[:256]
            for k in range(len(text)):
                if text[at : k + 1] not in learned[n]:
                    count, at = count + 1, k
            cost[n] = count * bits
        same += min(cost, key=lambda n: (cost[n], n)) == r.lang_pred
    assert same >= 58
