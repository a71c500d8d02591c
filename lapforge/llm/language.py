"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A document is
parsed into longest phrases that occur in that text: the automaton is followed
until a letter has no transition, where a phrase ends and the next one begins.
The language whose text yields the fewest bits (phrases times the log of the
length of its text) wins. Text is lower-cased; everything but letters becomes a
single blank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.llm.common import appended, ready, remainder, set_aside, texts_of, window

#: Bounds of the training sample: texts a language, characters a language, of one text, and of all languages.
TRAIN_DOCS = 160
TRAIN_CHARS = 30_000
TRAIN_DOC_CHARS = 20_000
ALL_CHARS = 600_000
#: Letters that each language tells apart, its most frequent ones; all others are one symbol to it.
ALPHABET = 250
SALTS = 16
#: A phrase begins anew at each block of a text, so that all blocks are parsed side by side.
BLOCK = 256
BLANK, OTHER = 0, 1


@dataclass
class Model:
    languages: list[str]
    letters: dict[str, int]  # of all languages
    own: list[np.ndarray]  # code of each of these letters in a language
    tables: list[np.ndarray]
    bits: list[float]


_code_cache: dict[int, np.ndarray] = {}


def _codes_table(letters: dict[str, int]) -> np.ndarray:
    """Code of each code point: blank, a letter of any sample, or another letter."""
    key = hash(tuple(sorted(letters.items())))
    if key not in _code_cache:
        out = np.zeros(0x110000, dtype=np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                out[cp] = letters.get(c.lower(), OTHER)
        _code_cache.clear()
        _code_cache[key] = out
    return _code_cache[key]


def _squeeze(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop blanks that follow a blank or begin a text; new bounds of the texts."""
    keep = codes != BLANK
    keep[1:] |= codes[:-1] != BLANK
    if len(codes):
        starts = ends[:-1][ends[:-1] < ends[1:]]
        keep[starts] = codes[starts] != BLANK
    at = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(keep, out=at[1:])
    return codes[keep], at[ends]


def _encode(texts: pa.Array, letters: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), out=ends[1:])
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _squeeze(_codes_table(letters)[points], ends)


def automaton(codes: np.ndarray, size: int) -> np.ndarray:
    """Parsing table of the suffix automaton of ``codes``: entry = next row * 2, plus 1 where a phrase ends.

    A row has ``size`` letters and one more for padding, which changes nothing.
    """
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    width = size + 1
    root = np.ones(width, dtype=np.int32)
    for c, s in nxt[0].items():
        root[c] = s * width * 2 + 1
    table = np.tile(root, (len(nxt), 1))
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            table[s, c] = t * width * 2
    table[:, size] = np.arange(len(nxt), dtype=np.int32) * width * 2
    return table.ravel()


def phrases(codes: np.ndarray, ends: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Phrases of each text under one automaton, all blocks in step."""
    lengths = np.diff(ends)
    blocks = -(-lengths // BLOCK)
    doc = np.repeat(np.arange(len(lengths)), blocks)
    first = np.cumsum(blocks) - blocks
    start = ends[:-1][doc] + (np.arange(len(doc)) - first[doc]) * BLOCK
    stop = np.minimum(start + BLOCK, ends[1:][doc])
    padded = np.concatenate([codes, np.full(BLOCK, size, dtype=np.uint8)])
    count = np.ones(len(doc), dtype=np.int32)
    state = np.zeros(len(doc), dtype=np.int32)
    for j in range(BLOCK if len(doc) else 0):
        at = start + j
        step = table[state + np.where(at < stop, padded[at], size)]
        count += step & 1
        state = step >> 1
    return np.bincount(doc, weights=count, minlength=len(lengths)).astype(np.int64)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from rows with text and language; every language that has a labelled letter is learned.

    A bounded sample: of each language up to ``TRAIN_DOCS`` texts with the smallest
    hashes, longer ones cut to a window of ``TRAIN_DOC_CHARS`` characters, of which
    ``TRAIN_CHARS`` characters at most are taken, fewer where ``ALL_CHARS`` would be
    passed over all languages. Each language has an alphabet of its own. No labelled
    text: a model that answers ``und`` for everything.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and length(text) > 0")
    rows = rows.withColumn("text", window("text", TRAIN_DOC_CHARS))
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    most = max(1, min(TRAIN_CHARS, ALL_CHARS // max(1, len(names))))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("salt", F.pmod(F.shiftright("h", 8), F.lit(SALTS)))
    near = Window.partitionBy("lang", "salt").orderBy("h", "text")
    some = rows.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= TRAIN_DOCS // SALTS)
    before = F.sum(F.length("text")).over(near.rowsBetween(Window.unboundedPreceding, -1))
    picked = some.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < most).select("lang", "h", "text").collect()
    texts: dict[str, list[str]] = {n: [] for n in names}
    for r in sorted(picked, key=lambda r: (r["h"], r["text"])):
        if r["text"] not in texts[r["lang"]][-1:]:
            texts[r["lang"]].append(r["text"])
    letters = {c: k + 2 for k, c in enumerate(sorted({c for ts in texts.values() for t in ts for c in t.lower() if c.isalpha()}))}
    own, tables, bits, kept = [], [], [], []
    for n in names:
        codes, _ = _encode(pa.array([" ".join(texts[n]) or " "]), letters)
        codes = codes[:most]
        if len(codes):
            count = np.bincount(codes, minlength=len(letters) + 2)
            count[:2] = 0
            first = np.lexsort((np.arange(len(count)), -count))[: min(ALPHABET, int((count > 0).sum()))]
            mine = np.full(len(count), OTHER, dtype=np.uint8)
            mine[first] = np.arange(2, len(first) + 2)
            mine[BLANK] = BLANK
            kept.append(n)
            own.append(mine)
            tables.append(automaton(mine[codes], len(first) + 2))
            bits.append(float(np.log2(len(codes) + 1)))
    return Model(kept, letters, own, tables, bits)


def predict_batch(texts: pa.Array, model: Model) -> tuple[pa.Array, np.ndarray]:
    codes, ends = _encode(texts, model.letters)
    lettered = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(codes != BLANK, out=lettered[1:])
    none = lettered[ends[1:]] == lettered[ends[:-1]]
    if not model.languages:
        return pa.array(["und"] * len(texts), pa.string()), np.zeros(len(texts))
    cost = np.stack([phrases(m[codes], ends, t, int(m.max()) + 1 if (m > OTHER).any() else 2) * b for m, t, b in zip(model.own, model.tables, model.bits, strict=True)], axis=1)
    best = cost.argmin(axis=1)
    share = np.exp2(-(cost - cost.min(axis=1, keepdims=True)) / 4)
    score = np.where(none, 0.0, 1 / share.sum(axis=1))
    return pa.array([*model.languages, "und"], pa.string()).take(pa.array(np.where(none, len(model.languages), best))), score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``lang_score`` (0 to 1) from the text alone.

    Null texts and texts without a letter: ``und`` with score 0. Ties between
    languages go to the first by name. Texts of any length are parsed whole.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        lang, score = predict_batch(texts_of(part), shared.value)
        return [lang, pa.array(score)]

    return appended(docs, [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())], work)


def query(docs: DataFrame) -> DataFrame:
    held = remainder("doc_id", 5) == 0
    model = fit(docs.filter(~held))
    return identify(docs.select("doc_id", "text", held.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def stage(docs: DataFrame) -> DataFrame:
    """Reject the documents without any letter: ``und``, or, where no language could be learned, so by their text.

    Null and empty texts are rejected, repeated rows handled each; columns come back as they were, an empty table stays empty.
    """
    model = fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    rows, given = set_aside(docs, "lang_pred", "lang_score")
    return given(identify(rows, model).filter(F.col("lang_pred") != "und"))


__all__ = ["Model", "automaton", "fit", "identify", "phrases", "predict_batch", "query", "stage"]
