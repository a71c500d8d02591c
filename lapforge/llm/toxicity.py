"""Toxic spans and document scores by a linear-chain conditional random field.

Two tags, toxic and clean. A token's emission is the sum of hashed features of
its word; transitions are learned with them from labelled tokens. Where only
documents carry labels, ``token_labels`` marks the words that explain them: it
takes, one after another, the word that occurs in most toxic documents not yet
explained and hardly in clean ones. Forward-backward marginals give toxic spans;
the document's score is a logistic function of the odds that any token is toxic.
"""

from __future__ import annotations

import pickle
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.llm.common import appended, ready, remainder, set_aside, texts_of, window, words_of

#: Bounds of the training sample.
TRAIN_DOCS = 1_000
TRAIN_DOC_CHARS = 20_000
BUCKETS = 1 << 16
WINDOW = 64
PREFIXES = (3, 4, 5, 6)
STEPS = 60
LEAST_DOCS = 3
PRECISION = 0.9
MEMO = 200_000
_CORE = re.compile(r"^[\W_]+|[\W_]+$")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    doc: np.ndarray  # of the document's logistic: two slopes, shift
    fitted: bool = True
    memo: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}


def units(core: str) -> list[str]:
    """What a word may be recognised by: itself and its beginnings."""
    return [f"w{core}", *(f"{n}{core[:n]}" for n in PREFIXES if len(core) >= n)]


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word, without its surrounding marks; always of the same number."""
    core = _CORE.sub("", word)
    found = units(core)
    found += ["-"] * (len(PREFIXES) + 1 - len(found)) + ["b", f"m{len(core) != len(word)}", f"n{min(len(core), 12)}"]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in found]


def emissions(words: list[str], model: Model) -> np.ndarray:
    memo, out = model.memo, np.empty(len(words))
    for k, w in enumerate(words):
        got = memo.get(w)
        if got is None:
            got = float(model.weights[features(w)].sum())
            if len(memo) >= MEMO:
                memo.clear()
            memo[w] = got
        out[k] = got
    return out


def odds(logit: np.ndarray, ends: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of tag 1 from both sides: forward with the token, backward without it, and the emission itself.

    Sequences advance in step, the longest first, so that each step is one vector operation.
    """
    e = np.exp(np.clip(logit, -30, 30))
    lengths = np.diff(ends)
    order = np.argsort(-lengths, kind="stable")
    first, lens = ends[:-1][order], lengths[order]
    t = np.exp(np.clip(trans, -30, 30))
    fwd, bwd = np.empty(len(e)), np.empty(len(e))
    most = int(lens[0]) if len(lens) else 0
    active = np.searchsorted(-lens, -np.arange(most), side="left")
    r = np.full(len(lens), np.exp(start[1] - start[0]))
    for k in range(most):
        n = active[k]
        at = first[:n] + k
        r = e[at] * (r[:n] if k == 0 else (t[0, 1] + t[1, 1] * r[:n]) / (t[0, 0] + t[1, 0] * r[:n]))
        np.clip(r, 1e-200, 1e200, out=r)
        fwd[at] = r
    last = first + lens - 1
    s = np.empty(0)
    for k in range(most):
        n = active[k]
        at = last[:n] - k
        if k == 0:
            s = np.ones(n)
        else:
            x = e[at + 1] * s[:n]
            s = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
        bwd[at] = s
    return fwd, bwd, e


def marginals(logit: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    fwd, bwd, _ = odds(logit, ends, model.trans, model.start)
    both = np.minimum(fwd * bwd, 1e200)
    return both / (1 + both)


def token_labels(docs: list[list[str]], toxic: list[bool]) -> list[np.ndarray]:
    """Weak labels of tokens from labels of documents, by the words or beginnings that explain the toxic ones."""
    where: dict[str, set[int]] = {}
    clean: dict[str, int] = {}
    for k, (words, bad) in enumerate(zip(docs, toxic, strict=True)):
        for u in {u for w in set(words) if (core := _CORE.sub("", w)) for u in units(core)}:
            if bad:
                where.setdefault(u, set()).add(k)
            else:
                clean[u] = clean.get(u, 0) + 1
    ratio = max(1, sum(toxic)) / max(1, len(toxic) - sum(toxic))
    able = {u: s for u, s in where.items() if len(s) >= LEAST_DOCS and len(s) / (len(s) + ratio * clean.get(u, 0)) >= PRECISION}
    unexplained, chosen = {k for k, bad in enumerate(toxic) if bad}, set()
    least = max(LEAST_DOCS, len(unexplained) // 200)
    while able:
        best = max(able, key=lambda u: (len(able[u] & unexplained) - ratio * clean.get(u, 0), len(able[u]), u))
        if len(able[best] & unexplained) < least:
            break
        chosen.add(best)
        unexplained -= able.pop(best)
    # units about as widespread as the chosen ones belong to them, though others explain their documents
    if chosen:
        usual = 0.6 * float(np.median([len(where[u]) for u in chosen]))
        chosen |= {u for u, s in able.items() if len(s) >= max(usual, least)}
    return [np.array([bad and not chosen.isdisjoint(units(_CORE.sub("", w))) for w in words], dtype=np.float64) for words, bad in zip(docs, toxic, strict=True)]


def train(docs: list[list[str]], labels: list[np.ndarray], toxic: list[bool]) -> Model:
    """Maximise the conditional likelihood of token labels (Adam on exact gradients), then fit the document's logistic."""
    zero = Model(np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(2), np.array([0.0, 0.0, -2.0]), False)
    if not any(toxic) or all(toxic):
        zero.doc[2] = 2.0 if toxic and all(toxic) else -2.0
        return zero
    vocab = {w: k for k, w in enumerate(sorted({w for d in docs for w in d}))}
    feats = np.array([features(w) for w in vocab])
    ids = np.array([vocab[w] for d in docs for w in d], dtype=np.int64)
    y = np.concatenate(labels)
    bounds = np.cumsum([0, *map(len, docs)])
    cuts = np.unique(np.concatenate([np.arange(a, b, WINDOW) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] + [bounds[-1:]]))
    inner = np.ones(len(ids), dtype=bool)
    inner[cuts[:-1]] = False
    yi = y.astype(np.int64)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (yi[:-1][inner[1:]], yi[1:][inner[1:]]), 1)
    starts = np.bincount(yi[cuts[:-1]], minlength=2).astype(float)
    w, trans, start = np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(2)
    w[zlib.crc32(b"b") % BUCKETS] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    params = [w, trans, start]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    n = len(ids)
    for step in range(1, STEPS + 1):
        unit = w[feats].sum(axis=1)
        fwd, bwd, e = odds(unit[ids], cuts, trans, start)
        p = np.minimum(fwd * bwd, 1e200)
        p = p / (1 + p)
        err = np.bincount(ids, weights=p - y, minlength=len(vocab))
        g_w = np.zeros(BUCKETS)
        np.add.at(g_w, feats, err[:, None])
        at = np.flatnonzero(inner)
        x = e[at] * bwd[at]
        t = np.exp(trans)
        joint = np.stack([np.full(len(at), t[0, 0]), t[0, 1] * x, t[1, 0] * fwd[at - 1], t[1, 1] * fwd[at - 1] * x])
        joint /= joint.sum(axis=0)
        g_t = joint.sum(axis=1).reshape(2, 2) - pairs
        p0 = p[cuts[:-1]]
        g_s = np.array([(1 - p0).sum(), p0.sum()]) - starts
        scale = max(1.0, y.sum())
        for k, (par, g) in enumerate(zip(params, (g_w / scale + 1e-3 * w, g_t / n + 1e-2 * trans, g_s / n + 1e-2 * start), strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            par -= 0.2 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    model = Model(w, trans, start, np.zeros(3))
    x = doc_features(marginals(w[feats].sum(axis=1)[ids], bounds, model), bounds)
    z = np.array(toxic, dtype=float)
    side = np.where(z == 1, 0.5 / max(z.sum(), 1), 0.5 / max((1 - z).sum(), 1))
    for _ in range(60):  # Newton on a balanced, slightly shrunken logistic
        q = 1 / (1 + np.exp(-np.clip(x @ model.doc, -30, 30)))
        grad = x.T @ (side * (q - z)) + 1e-4 * model.doc
        hess = (x * (side * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(3)
        model.doc = model.doc - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return model


def any_toxic(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log odds that at least one token of a text is toxic."""
    none = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
    total = np.minimum(none[ends[1:]] - none[ends[:-1]], -1e-12)
    return np.log(-np.expm1(total)) - total


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    A bounded sample: of each label the ``TRAIN_DOCS`` ids with the smallest
    hashes among those that have a text; of texts of over ``TRAIN_DOC_CHARS``
    characters a window is read. One task learns from the sample, so that the driver
    holds none of it. Null labels are ignored, of contradicting ones
    the highest counts. Without both labels every score is constant. Ids are
    numbers or texts; where docs and labels differ in that, they meet as texts.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    if docs.schema["doc_id"].dataType != labels.schema["doc_id"].dataType:
        docs, labels = (df.withColumn("doc_id", F.col("doc_id").cast("string")) for df in (docs, labels))
    ids = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    near = ids.join(docs.filter("text is not null").select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    picked = [r for k in (0, 1) for r in near.filter(F.col("toxic") == k).orderBy("h", "doc_id").limit(TRAIN_DOCS).collect()]
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("toxic", T.IntegerType())])
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in picked], kind)
    texts = docs.select("doc_id", window("text", TRAIN_DOC_CHARS).alias("text")).filter("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumns({"h": F.xxhash64("doc_id"), "sample": F.lit(0)})

    def learned(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([(c, "ascending") for c in ("toxic", "h", "doc_id")])
        words = [_WORD.findall(_lower(t)) for t in sample.column("text").to_pylist()]
        toxic = [k == 1 for k in sample.column("toxic").to_pylist()]
        return pa.table({"model": pa.array([pickle.dumps(train(words, token_labels(words, toxic), toxic))], pa.binary())})

    ready(docs.sparkSession)
    found = rows.groupBy("sample").applyInArrow(learned, "model binary").first()
    return train([], [], []) if found is None else pickle.loads(found["model"])


def _lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def doc_features(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each text: log odds of any toxic token, log share of toxic tokens, one; a text without tokens has the lowest values."""
    total = np.concatenate([[0.0], np.cumsum(p)])
    n = np.diff(ends)
    some = np.where(n > 0, np.clip(any_toxic(p, ends), -15, 15), -15)
    share = np.log((total[ends[1:]] - total[ends[:-1]] + 1e-3) / (n + 10))
    return np.stack([some, np.where(n > 0, share, -15), np.ones(len(n))], axis=1)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def tag_batch(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[list[dict[str, int]]]]:
    ends, idx, words = words_of(texts)
    unit = emissions(words.to_pylist(), model)
    p = marginals(unit[idx], ends, model)
    score = 1 / (1 + np.exp(-np.clip(doc_features(p, ends) @ model.doc, -30, 30)))
    spans: list[list[dict[str, int]]] = [[] for _ in range(len(texts))]
    hot = np.flatnonzero(p >= 0.5) if model.fitted else np.empty(0, dtype=np.int64)
    doc = np.searchsorted(ends, hot, side="right") - 1
    for d in np.unique(doc).tolist():
        bounds = [m.span() for m in _WORD.finditer(texts[d].as_py())]
        for k in (hot[doc == d] - ends[d]).tolist():
            a, b = bounds[k]
            if spans[d] and bounds[k - 1][1] == spans[d][-1]["end"]:
                spans[d][-1]["end"] = b
            else:
                spans[d].append({"start": a, "end": b})
    return score, spans


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``toxic_score`` (0 to 1) and ``toxic_spans`` (character offsets) from whole texts.

    Null and empty texts have no token and get the score of the least suspicious
    text. Tokens in a row make one span.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        score, spans = tag_batch(texts_of(part), shared.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array(score), pa.array(spans, kind)]

    return appended(docs, [T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_spans", SPANS)], work)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = remainder("doc_id", 5) == 0
    model = fit(docs.filter(~held), labels.filter(~held))
    scored = tag(docs.select("doc_id", "text", held.alias("held_out")), model)
    score = F.col("toxic_score")
    return scored.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.col("toxic_spans").alias("spans"))


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep the documents that score under 0.5.

    Null and empty texts have no token and are kept, repeated rows are handled each; columns come back as they were.
    """
    rows, given = set_aside(docs, "toxic_score", "toxic_spans")
    return given(tag(rows, fit(rows, labels)).filter("toxic_score < 0.5"))


__all__ = ["Model", "fit", "marginals", "query", "stage", "tag", "tag_batch", "token_labels", "train"]
