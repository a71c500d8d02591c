"""The language model: what it learns from, probabilities that add up, and the merge of rarer words."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapforge.llm import maxent

WORDS = [f"{a}{b}{c}" for a in "tsn" for b in "aeio" for c in ("", "r", "lum", "x9", "ß", "-")]


def corpus(spark, seed, held_out_seed):
    rng, other = random.Random(seed), random.Random(held_out_seed)
    rows = []
    for i in range(120):
        r, words = (other, [f"h{w}" for w in WORDS]) if i % 3 == 0 else (rng, WORDS)
        rows.append((i, " ".join(r.choices(words, weights=range(1, len(words) + 1), k=r.randint(1, 80)))))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(autouse=True, scope="module")
def few_updates():
    before, maxent.UPDATES = maxent.UPDATES, 3
    yield
    maxent.UPDATES = before


TRAIN = "doc_id % 3 != 0"


def test_learns_from_training_rows_only(spark):
    got = [{r.doc_id: (r.base_score, r.score) for r in maxent.fit_and_score(corpus(spark, 1, k), F.expr(TRAIN)).filter("train").collect()} for k in (2, 3)]
    assert got[0].keys() == got[1].keys() and len(got[0]) == 80
    for i, (base, score) in got[0].items():
        assert np.isclose(base, got[1][i][0]) and np.isclose(score, got[1][i][1], rtol=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    return maxent.fit(corpus(spark, 1, 2).filter(TRAIN).select("text"))


def test_probabilities_add_up(model):
    """Over all words, one unknown word a shared leaf and the end, whatever the previous words."""
    model, follow, *_ = model
    counts = {r.word: r.n for r in follow.collect() if r.word}
    words = pa.array(list(counts))
    place = maxent._places(words, model.own)
    leaves = np.where(place >= 0, place, maxent.END + 1 + maxent._crcs(words) % maxent.HASH_CLASSES)
    weight = np.array([counts[w] + 0.5 for w in words.to_pylist()])
    shared = maxent.END + 1 + np.arange(maxent.HASH_CLASSES)
    leaf = np.concatenate([leaves, shared, [maxent.END]])
    weight = np.concatenate([weight, np.full(len(shared), 0.5), [1.0]])
    rng = random.Random(0)
    for _ in range(40):
        at = rng.randrange(len(model.words))
        prev = maxent.START if model.words[at].as_py() == "" else int(maxent._places(pa.array([model.words[at].as_py()]), model.own)[0])
        if rng.random() < 0.3:  # a word without a leaf of its own
            at, prev = -1, maxent.OWN + rng.randrange(maxent.HASH_CONTEXTS)
        row, of_leaf, n = maxent._cells_of(model, np.array([at]))
        factors, of = maxent.class_rows(model, np.array([prev]), row, of_leaf, n)
        zeros = np.zeros(len(leaf), dtype=np.int64)
        hit = maxent._hits(row, of_leaf, n, zeros, leaf)
        logs = maxent.token_logs(model, factors, of, zeros, zeros + prev, zeros + rng.randrange(len(model.own)), leaf, hit)
        assert np.isclose((10**logs * weight).sum(), 1, atol=1e-4)


def test_merged_words_score_alike(spark, monkeypatch):
    """Rows at hand or met in the merge: the same scores; repeated rows are scored each."""
    df = corpus(spark, 1, 2)
    df = df.unionByName(df.filter("doc_id < 9"))
    scores = lambda: sorted((r.doc_id, round(r.base_score, 6), round(r.score, 3), r.n_known) for r in maxent.fit_and_score(df, F.expr(TRAIN)).collect())
    want = scores()
    monkeypatch.setattr(maxent, "MOST_WORDS", 5)
    got = scores()
    assert len(want) == 129 and [w[0] for w in want] == [g[0] for g in got]
    assert np.allclose(np.array(want, dtype=float), np.array(got, dtype=float), atol=2e-3)


def test_context_helps(spark):
    """A text of the word that always follows is likelier than its words alone say."""
    rows = [(i, "alpha beta gamma delta " * 20) for i in range(20)] + [(50, "alpha beta gamma delta"), (51, "delta gamma beta alpha")]
    got = {r.doc_id: r for r in maxent.fit_and_score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 50).collect()}
    assert got[50].score > got[50].base_score and got[50].score > got[51].score
