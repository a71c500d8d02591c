"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class in its context, times that of its leaf in
the class after the previous word, times that of the word in its leaf. The ``OWN``
most frequent training words are leaves of their own, the end of a text is one, and
all other words share ``HASH_CLASSES`` leaves by a hash of their first letters. The
``OWN_CLASSES`` most frequent words and the end are classes of their own; every hash
leaf makes a class with the other leaves of its hash.

* Classes are log-linear in the previous word, the skipped word before it and the
  hashed pair of both. Words beyond the ``OWN`` share ``HASH_CONTEXTS`` rows of these
  weights; each has a row of its own on top, from what follows it in the corpus, so
  what is gathered grows with the vocabulary. Shared weights climb the likelihood of
  the whole corpus: in every update Spark sums the gradient over all contexts. A word's
  own row is one scaling update, its smoothed counts over those that its shared row
  expects.
* A leaf in its class has a unigram and a previous-word feature, for which the
  maximum-entropy solution under smoothed counts has a closed form.
* In a shared leaf a word has its smoothed share.

Everything is counted in training texts only. Rows of the most frequent words are
broadcast, up to bounds on words, bytes and cells; occurrences of all others meet
their rows in a sorted merge by word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.llm.common import ready, remainder, text_slices, texts_of, words_of, written

#: What is broadcast of the vocabulary at most: words, their bytes, and cells of what follows them.
MOST_WORDS, MOST_BYTES, MOST_CELLS = 100_000, 4_000_000, 6_000_000
LETTERS = 2
OWN = 256
OWN_CLASSES, HASH_CLASSES = 24, 39
CLASSES = OWN_CLASSES + 1 + HASH_CLASSES
LEAVES = OWN + 1 + HASH_CLASSES
END = OWN
HASH_CONTEXTS = 32
CONTEXTS = OWN + HASH_CONTEXTS + 1
START = CONTEXTS - 1
PAIRS = 4_096
ROWS = 1 + 2 * CONTEXTS + PAIRS
UPDATES = 15
RATE = 0.08
#: Pseudo-counts of the shared row behind a word's own class row, and of the class behind a word's own leaf row.
CLASS_PRIOR, LEAF_PRIOR = 6.0, 4.0
FLUSH = 1_200_000
SLICE = 1_000_000
#: Contexts that one task of an update works on.
TASK_CONTEXTS = 150_000
_NONE = -40.0


def _crcs(words: pa.Array) -> np.ndarray:
    """crc32 of the first letters of each word."""
    coded = pc.utf8_slice_codeunits(words, 0, LETTERS).dictionary_encode()
    crc = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    return crc[coded.indices.to_numpy(zero_copy_only=False)] if len(crc) else np.empty(0, dtype=np.int64)


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def leaf_classes(own: pa.Array) -> np.ndarray:
    """Class of each leaf; those of words that don't exist have none (-1)."""
    out = np.full(LEAVES, -1, dtype=np.int64)
    out[: len(own)] = np.where(np.arange(len(own)) < OWN_CLASSES, np.arange(len(own)), OWN_CLASSES + 1 + _crcs(own) % HASH_CLASSES)
    out[END] = OWN_CLASSES
    out[END + 1 :] = OWN_CLASSES + 1 + np.arange(HASH_CLASSES)
    return out


@dataclass
class Tokens:
    """Texts as tokens with ends: distinct words, and of every token its text, leaf, and the previous and skipped ones."""

    ends: np.ndarray  # bounds of the texts in idx
    idx: np.ndarray  # words only
    words: pa.Array
    ctx: np.ndarray  # of each distinct word
    doc: np.ndarray
    leaf: np.ndarray
    word: np.ndarray  # place of the previous word in words; -1 at a start
    prev: np.ndarray
    skip: np.ndarray


def _tokens(texts: pa.Array, own: pa.Array) -> Tokens:
    ends, idx, words = words_of(texts)
    words = words.cast(pa.string())
    place, crc = _places(words, own), _crcs(words)
    leaf = np.where(place >= 0, place, END + 1 + crc % HASH_CLASSES)
    ctx = np.where(place >= 0, place, OWN + crc % HASH_CONTEXTS)
    n, docs = len(idx), len(texts)
    doc = np.repeat(np.arange(docs), np.diff(ends))
    at, stops, first = np.arange(n) + doc, ends[1:] + np.arange(docs), ends[:-1] + np.arange(docs)
    all_leaf, all_doc, word, all_ctx = (np.full(n + docs, x, dtype=np.int64) for x in (END, 0, -1, START))
    all_leaf[at], all_doc[at], all_doc[stops], word[at], all_ctx[at] = leaf[idx], doc, np.arange(docs), idx, ctx[idx]
    # an end is the start of what follows it, so texts don't see each other through one previous word
    prev = np.concatenate([[START], all_ctx[:-1]])[: n + docs]
    skip = np.concatenate([[START, START], all_ctx[:-2]])[: n + docs]
    skip[first] = START
    return Tokens(ends, idx, words, ctx, all_doc, all_leaf, np.concatenate([[-1], word[:-1]])[: n + docs], prev, skip)


def _summed_tables(held: list[pa.Table], keys: list[str]) -> list[pa.RecordBatch]:
    """The rows held, summed by keys; ``held`` is emptied."""
    if not held:
        return []
    total = pa.concat_tables(held).group_by(keys).aggregate([("n", "sum")])
    held.clear()
    pa.default_memory_pool().release_unused()
    return total.select([*keys, "n_sum"]).rename_columns([*keys, "n"]).combine_chunks().to_batches(max_chunksize=100_000)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> partial counts of words, summed in the task."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for part in text_slices(batch, chars=SLICE):
            _, idx, words = words_of(texts_of(part))
            held.append(pa.table({"word": words.cast(pa.string()), "n": np.bincount(idx, minlength=len(words)).astype(np.int64)}))
            rows += len(words)
            if rows > FLUSH:
                yield from _summed_tables(held, ["word"])
                rows = 0
    yield from _summed_tables(held, ["word"])


def count_words(rows: DataFrame) -> DataFrame:
    """word, n over whole texts of rows (text)."""
    ready(rows.sparkSession)
    return rows.select("text").mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame) -> pa.Array:
    """The ``OWN`` most frequent words, ties in code-point order."""
    return pa.array([r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(OWN).collect()], pa.string())


def gather(rows: DataFrame, own: pa.Array) -> DataFrame:
    """What follows what in the training texts: a row for each word, and one for each context.

    A word's row (ctx null) holds leaves and their counts, a context's row (word
    null) classes; starts of texts are the word ''. Sums are made in the task before
    the one shuffle, which both groupings share.
    """
    shared = rows.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        cls = leaf_classes(own)
        names = ["word", "ctx", "leaf", "n"]
        follow: list[pa.Table] = []
        met: list[pa.Table] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for b in _summed_tables(follow, ["word", "leaf"]):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.nulls(b.num_rows, pa.int32()), b.column(1), b.column(2)], names=names)
            for b in _summed_tables(met, ["key"]):
                key = b.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.nulls(len(key), pa.string()), pa.array((key // CLASSES).astype(np.int32)), pa.array((key % CLASSES).astype(np.int16)), b.column(1)], names=names)

        for batch in batches:
            for part in text_slices(batch, chars=SLICE):
                t = _tokens(texts_of(part), own)
                key, n = np.unique((t.word + 1) * LEAVES + t.leaf, return_counts=True)
                words = pa.concat_arrays([pa.array([""], pa.string()), t.words])
                follow.append(pa.table({"word": words.take(pa.array(key // LEAVES)), "leaf": (key % LEAVES).astype(np.int16), "n": n.astype(np.int64)}))
                size += len(key)
                key, n = np.unique((t.prev * CONTEXTS + t.skip) * CLASSES + cls[t.leaf], return_counts=True)
                met.append(pa.table({"key": key, "n": n.astype(np.int64)}))
                size += len(key)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    parts = rows.select("text").mapInArrow(run, "word string, ctx int, leaf short, n long").repartition("word", "ctx")
    cells = parts.groupBy("word", "ctx", "leaf").agg(F.sum("n").alias("n"))
    return cells.groupBy("word", "ctx").agg(F.sum("n").alias("n"), F.collect_list(F.struct("leaf", F.col("n").cast("float").alias("n"))).alias("cells"))


def _rows_of(prev: np.ndarray, skip: np.ndarray) -> list[np.ndarray]:
    """Rows of the weights that a context activates: bias, previous word, skipped word, hashed pair."""
    return [np.zeros(len(prev), dtype=np.int64), 1 + prev, 1 + CONTEXTS + skip, 1 + 2 * CONTEXTS + _pair(prev, skip)]


def _pair(prev: np.ndarray, skip: np.ndarray) -> np.ndarray:
    return ((prev * 2_654_435_761 + skip * 40_503 + 12_345) >> 7) % PAIRS


def log_softmax(weights: np.ndarray, prev: np.ndarray, skip: np.ndarray) -> np.ndarray:
    logits = sum(weights[r] for r in _rows_of(prev, skip))
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _summed(contexts: DataFrame, weights: np.ndarray | None) -> np.ndarray:
    """Sum over all contexts of what each adds to its weights' rows: the gradient, or, without weights, class counts.

    A task sums its contexts' rows, Spark the tasks'; one row a weights' row reaches the driver.
    """
    shared = contexts.sparkSession.sparkContext.broadcast(weights)
    names = [f"g{k}" for k in range(CLASSES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ROWS, CLASSES))
        for batch in batches:
            if not batch.num_rows:
                continue
            ctx, lists = batch.column(0).to_numpy().astype(np.int64), batch.column(1)
            prev, skip = ctx // CONTEXTS, ctx % CONTEXTS
            entries = lists.flatten()
            row = np.repeat(np.arange(len(ctx)), pc.list_value_length(lists).to_numpy())
            n = np.zeros((len(ctx), CLASSES))
            n[row, entries.field(0).to_numpy()] = entries.field(1).to_numpy()
            add = n if shared.value is None else n - np.exp(log_softmax(shared.value, prev, skip)) * n.sum(axis=1, keepdims=True)
            for r in _rows_of(prev, skip):
                order = np.argsort(r, kind="stable")
                starts = np.flatnonzero(np.diff(r[order], prepend=-1))
                total[r[order][starts]] += np.add.reduceat(add[order], starts, axis=0)
        some = np.flatnonzero(total.any(axis=1))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(np.ascontiguousarray(total[some, k])) for k in range(CLASSES)]], names=["row", *names])

    sums = contexts.mapInArrow(run, f"row int, {', '.join(f'{c} double' for c in names)}").groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    got = sums.toArrow()
    out = np.zeros((ROWS, CLASSES))
    if got.num_rows:
        out[got.column(0).to_numpy()] = np.stack([got.column(1 + k).to_numpy() for k in range(CLASSES)], axis=1)
    shared.unpersist()
    return out


def train(contexts: DataFrame, exists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the class model and class counts of its rows.

    Starts from smoothed marginals, then climbs the likelihood of the whole corpus.
    Classes that don't exist have no share.
    """
    seen = _summed(contexts, None)
    total = max(1.0, seen[0].sum())
    share = np.where(exists, (seen[0] + 0.5) / (total + 0.5 * exists.sum()), 1.0)
    local = np.log((seen + 20 * share) / (seen.sum(axis=1, keepdims=True) + 20)) - np.log(share)
    weights = np.where(exists, local, 0.0)
    weights[0] = np.where(exists, np.log(share), _NONE)
    weights[1 + CONTEXTS : 1 + 2 * CONTEXTS] *= 0.5
    weights[1 + 2 * CONTEXTS :] = 0
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, UPDATES + 1):
        g = _summed(contexts, weights) / total
        g[1:] -= 1e-6 * weights[1:]
        g[:, ~exists] = 0
        m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
        weights = weights + RATE * step**-0.5 * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-9)
    return weights, seen


@dataclass
class Model:
    own: pa.Array
    cls: np.ndarray  # class of a leaf
    mass: np.ndarray  # smoothed count of a leaf; what its words' smoothed counts add up to
    share: np.ndarray  # of a leaf in its class
    prev: np.ndarray  # exponentials of the weights, bias included: contexts x classes
    skip: np.ndarray
    pair: np.ndarray
    expects: np.ndarray  # class shares after each shared context, smoothed
    words: pa.Array  # words whose rows are at hand
    seen: np.ndarray  # their training counts
    bounds: np.ndarray  # of their cells
    leaf: np.ndarray  # sorted in each word
    n: np.ndarray


def class_rows(model: Model, prev: np.ndarray, row: np.ndarray, leaf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous-word factors of the classes and class counts of words, given their contexts and cells (row, leaf, n)."""
    of = np.bincount(row * CLASSES + model.cls[leaf], weights=n, minlength=len(prev) * CLASSES).reshape(-1, CLASSES).astype(np.float32)
    out = model.prev[prev]
    shared = (prev >= OWN) & (prev < START)
    q = model.expects[prev[shared]]
    out[shared] *= (of[shared] + CLASS_PRIOR * q) / ((of[shared].sum(axis=1, keepdims=True) + CLASS_PRIOR) * q)
    return out, of


def token_logs(model: Model, factors: np.ndarray, of: np.ndarray, word: np.ndarray, prev: np.ndarray, skip: np.ndarray, leaf: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """log10 of class, leaf and, but for its smoothed count, word of tokens.

    ``word``: row of the previous word in ``factors`` and ``of``; ``hit``: count of the leaf after it.
    """
    out = np.empty(len(leaf))
    cls = model.cls[leaf]
    for a in range(0, len(leaf), 32_768):
        s = slice(a, a + 32_768)
        p = factors[word[s]]
        p *= model.skip[skip[s]]
        pair = model.pair[_pair(prev[s], skip[s])]
        at = np.arange(len(p))
        inside = (hit[s] + LEAF_PRIOR * model.share[leaf[s]]) / (of[word[s], cls[s]] + LEAF_PRIOR)
        chosen = p[at, cls[s]].astype(np.float64) * pair[at, cls[s]] / np.einsum("ij,ij->i", p, pair)
        out[s] = np.log10(chosen * inside)
    return out - np.where(leaf == END, 0.0, np.log10(model.mass[leaf]))


def _cells_of(model: Model, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (row, leaf, n) of the words at ``places``; rows follow places, -1 has none."""
    sizes = np.where(places >= 0, model.bounds[places + 1] - model.bounds[places], 0)
    row = np.repeat(np.arange(len(places), dtype=np.int32), sizes)
    at = np.arange(len(row))
    at += np.repeat(model.bounds[np.maximum(places, 0)] - (np.cumsum(sizes) - sizes), sizes)
    return row, model.leaf[at].astype(np.int32), model.n[at]


def _hits(row: np.ndarray, leaf: np.ndarray, n: np.ndarray, ask_row: np.ndarray, ask_leaf: np.ndarray) -> np.ndarray:
    """Counts of the asked (row, leaf) among cells sorted by row and leaf, 0 where there is none."""
    key, n = np.append(row * LEAVES + leaf, -1), np.append(n, 0)
    ask = ask_row * LEAVES + ask_leaf
    at = np.searchsorted(key[:-1], ask)
    return np.where(key[at] == ask, n[at], 0)


def known_words(follow: DataFrame) -> pa.Table:
    """Rows of the most frequent words within the bounds: all with at least the least count that fits.

    The count is found from sums over the words of each count, so no task or driver
    sorts the whole vocabulary. The start is always among them.
    """
    order = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    sizes = follow.groupBy("n").agg(F.count("*").alias("words"), F.sum(F.octet_length("word")).alias("bytes"), F.sum(F.size("cells")).alias("cells"))
    upto = sizes.select("n", *[F.sum(c).over(order).alias(c) for c in ("words", "bytes", "cells")])
    least = upto.filter((F.col("words") <= MOST_WORDS) & (F.col("bytes") <= MOST_BYTES) & (F.col("cells") <= MOST_CELLS)).agg(F.min("n")).first()[0]
    least = 1 << 62 if least is None else least
    return follow.filter((F.col("n") >= least) | (F.col("word") == "")).withColumn("cells", F.array_sort("cells")).toArrow()


def fit(rows: DataFrame) -> tuple[Model, DataFrame, int, int, int]:
    """Model, the rows of all words (word, n, cells), and the numbers of texts, of words and of distinct words in ``rows`` (text)."""
    counts = written(count_words(rows), "counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    texts = rows.count()
    own = most_frequent(counts)
    gathered = written(gather(rows, own), "gathered")
    contexts = gathered.filter("word is null").select("ctx", "cells")
    contexts = written(contexts.coalesce(max(1, -(-contexts.count() // TASK_CONTEXTS))), "contexts")
    cls = leaf_classes(own)
    exists = np.zeros(CLASSES, dtype=bool)
    exists[cls[cls >= 0]] = True
    weights, seen = train(contexts, exists)
    size, kinds = np.zeros(LEAVES), np.zeros(LEAVES)
    hashed = F.pmod(F.crc32(F.substring("word", 1, LETTERS).cast("binary")), F.lit(HASH_CLASSES)).cast("int").alias("k")
    for r in counts.groupBy(hashed).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        size[END + 1 + r["k"]], kinds[END + 1 + r["k"]] = r["n"], r["v"]
    top = {r["word"]: r["n"] for r in counts.orderBy(F.desc("n"), "word").limit(OWN).collect()}
    shared = END + 1 + _crcs(own) % HASH_CLASSES
    for k, w in enumerate(own.to_pylist()):
        size[shared[k]] -= top[w]
        kinds[shared[k]] -= 1
        size[k] = top[w]
    mass = np.where(cls < 0, 0.0, np.where(np.arange(LEAVES) < OWN, size + 0.5, size + 0.5 * (kinds + 1)))
    mass[END] = 1.0
    inside = np.bincount(np.maximum(cls, 0), weights=mass, minlength=CLASSES)
    share = mass / np.maximum(inside[np.maximum(cls, 0)], 1e-300)
    q = seen[1 : 1 + CONTEXTS] + 20 * np.where(exists, (seen[0] + 0.5) / max(1.0, seen[0].sum() + 0.5 * CLASSES), 1e-12)
    follow = gathered.filter("word is not null").select("word", "n", "cells")
    known = known_words(follow)
    lists = pa.concat_arrays(known.column("cells").chunks) if known.num_rows else pa.array([], pa.list_(pa.struct([("leaf", pa.int16()), ("n", pa.float32())])))
    entries = lists.flatten()
    words = pa.concat_arrays([c.cast(pa.string()) for c in known.column("word").chunks]) if known.num_rows else pa.array([], pa.string())
    model = Model(
        own, cls, np.maximum(mass, 1e-300), share,
        np.exp(weights[0] + weights[1 : 1 + CONTEXTS]).astype(np.float32), np.exp(weights[1 + CONTEXTS : 1 + 2 * CONTEXTS]).astype(np.float32), np.exp(weights[1 + 2 * CONTEXTS :]).astype(np.float32),
        (q / q.sum(axis=1, keepdims=True)).astype(np.float32), words, known.column("n").to_numpy(),
        np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64), entries.field(0).to_numpy(zero_copy_only=False), entries.field(1).to_numpy(zero_copy_only=False),
    )
    return model, follow, texts, totals["n"], totals["v"]


_TAIL = ["doc_id", "h", "word", "leaf", "skip", "times", "n", "cells"]


def score(rows: DataFrame, shared) -> DataFrame:  # noqa: ANN001
    """A row for each text (sums over its known words and what follows them) and one for each occurrence of other words."""
    kind = dict(rows.dtypes)["doc_id"]
    names = ["doc_id", "h", "train", "n_tokens", "n_known", "logs", "classes", "word", "leaf", "skip", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        logs = np.log10(model.seen + 0.5)
        start = int(_places(pa.array([""], pa.string()), model.words)[0])
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for part in text_slices(batch, chars=SLICE // 2):
                docs = part.num_rows
                t = _tokens(texts_of(part), model.own)
                place = _places(t.words, model.words)
                own = np.repeat(np.arange(docs), np.diff(t.ends))
                at = place[t.idx]
                top = at >= 0
                sums = np.bincount(own[top], weights=logs[at[top]], minlength=docs)
                known = np.bincount(own[top], minlength=docs)
                # rows of the known words, the start's last; others' tokens are left to the merge
                places = np.append(place, start)
                mine = (t.word < 0) | (np.append(place, 0)[t.word] >= 0)
                here, rest = np.flatnonzero(mine), np.flatnonzero(~mine)
                word = np.where(t.word[here] < 0, len(place), t.word[here])
                row, leaf, n = _cells_of(model, places)
                factors, of = class_rows(model, np.append(t.ctx, START), row, leaf, n)
                got = token_logs(model, factors, of, word, t.prev[here], t.skip[here], t.leaf[here], _hits(row, leaf, n, word, t.leaf[here]))
                classes = np.bincount(t.doc[here], weights=got, minlength=docs)
                key = ((t.doc[rest] * max(1, len(place)) + t.word[rest]) * LEAVES + t.leaf[rest]) * CONTEXTS + t.skip[rest]
                key, times = np.unique(key, return_counts=True)
                key, skip = np.divmod(key, CONTEXTS)
                key, after = np.divmod(key, LEAVES)
                doc, which = np.divmod(key, max(1, len(place)))
                ids, h = part.column("doc_id"), part.column("h")
                yield pa.RecordBatch.from_arrays(
                    [ids, h, part.column("train"), pa.array(np.diff(t.ends) + 1), pa.array(known.astype(np.int64)), pa.array(sums), pa.array(classes), *(pa.nulls(docs, x) for x in (pa.string(), pa.int16(), pa.int16(), pa.int32()))], names=names
                )
                pick, k = pa.array(doc), len(key)
                none = [pa.nulls(k, x) for x in (pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pick), h.take(pick), *none, t.words.take(pa.array(which)), pa.array(after.astype(np.int16)), pa.array(skip.astype(np.int16)), pa.array(times.astype(np.int32))], names=names
                )

    schema = f"doc_id {kind}, h long, train boolean, n_tokens long, n_known long, logs double, classes double, word string, leaf short, skip short, times int"
    return written(rows.select("doc_id", "h", "text", "train").mapInArrow(run, schema), "scored")


def _merged(occurrences: DataFrame, follow: DataFrame, shared) -> DataFrame:  # noqa: ANN001
    """doc_id, h, logs, n_known, classes of the occurrences of words whose rows aren't at hand.

    Rows of words and their occurrences are sorted together by word; a row comes
    before its occurrences and is held while they stream by, so it isn't copied.
    """
    kind = dict(occurrences.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            row_at = np.flatnonzero(table.column("times").is_null().to_numpy(zero_copy_only=False))
            held = table.slice(int(row_at[-1]), 1).combine_chunks().to_batches()[0] if len(row_at) else held
            rows, asks = table.take(pa.array(row_at)).combine_chunks(), table.filter(pc.is_valid(table.column("times"))).combine_chunks()
            if not asks.num_rows:
                continue
            coded = asks.column("word").combine_chunks().dictionary_encode()
            words, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            found = _places(words, rows.column("word").combine_chunks()) if rows.num_rows else np.full(len(words), -1)
            lists = rows.column("cells").combine_chunks() if rows.num_rows else None
            if lists is not None and found.max(initial=-1) >= 0:
                some = np.flatnonzero(found >= 0)
                mine = lists.take(pa.array(found[some]))
                sizes = pc.list_value_length(mine).to_numpy(zero_copy_only=False)
                entries = mine.flatten()
                row, leaf, n = np.repeat(some, sizes), entries.field(0).to_numpy(zero_copy_only=False).astype(np.int64), entries.field(1).to_numpy(zero_copy_only=False)
                order = np.lexsort((leaf, row))
                row, leaf, n = row[order], leaf[order], n[order]
                seen = np.zeros(len(words), dtype=np.int64)
                seen[some] = rows.column("n").to_numpy()[found[some]]
            else:
                row, leaf, n, seen = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32), np.zeros(len(words), np.int64)
            ctx = np.where((p := _places(words, model.own)) >= 0, p, OWN + _crcs(words) % HASH_CONTEXTS)
            factors, of = class_rows(model, ctx, row, leaf, n)
            after, skip, times = (asks.column(c).to_numpy().astype(np.int64) for c in ("leaf", "skip", "times"))
            got = token_logs(model, factors, of, word, ctx[word], skip, after, _hits(row, leaf, n, word, after))
            yield pa.RecordBatch.from_arrays(
                [asks.column("doc_id").combine_chunks(), asks.column("h").combine_chunks(), pa.array(times * np.log10(seen[word] + 0.5)), pa.array(np.where(seen[word] > 0, times, 0)), pa.array(times * got)],
                names=["doc_id", "h", "logs", "n_known", "classes"],
            )

    asked = occurrences.select("doc_id", "h", "word", "leaf", "skip", "times", F.lit(None).cast("long").alias("n"), F.lit(None).cast(dict(follow.dtypes)["cells"]).alias("cells"))
    known = follow.select(F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("h"), "word", *[F.lit(None).cast(t).alias(c) for c, t in (("leaf", "short"), ("skip", "short"), ("times", "int"))], "n", "cells")
    both = known.select(*_TAIL).unionByName(asked.select(*_TAIL)).repartition("word").sortWithinPartitions(F.col("word"), F.col("times").asc_nulls_first())
    return both.mapInArrow(run, f"doc_id {kind}, h long, logs double, n_known long, classes double")


def fit_and_score(docs: DataFrame, train_rows: Column) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score for rows doc_id, text.

    Learns from the rows for which ``train_rows`` holds, and from nothing else. Null
    texts are empty, and an empty text is its end alone. Repeated rows are scored
    each. Without training rows every token is unknown.
    """
    ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"), F.coalesce(train_rows, F.lit(False)).alias("train"))
    model, follow, texts, words, distinct = fit(rows.filter("train").select("text"))
    tokens, distinct = words + texts, distinct + (texts > 0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = score(rows, shared)
    sums = ("logs", "n_known", "classes")
    other = _merged(scored.filter("word is not null"), follow, shared).groupBy("doc_id", "h").agg(*[F.sum(c).alias(c) for c in sums])
    own = scored.filter("word is null").groupBy("doc_id", "h").agg(F.count("*").alias("rows"), *[F.max(c).alias(c) for c in ("train", "n_tokens", *sums)])
    both = own.withColumn("own", F.lit(True)).unionByName(other.withColumn("own", F.lit(False)), allowMissingColumns=True)
    # rows that repeat are alike, so what the merge adds up for all of them is shared out evenly
    whole = {c: F.max(F.when(F.col("own"), F.col(c))) + F.coalesce(F.sum(F.when(~F.col("own"), F.col(c))), F.lit(0)) / F.max("rows") for c in sums}
    summed = both.groupBy("doc_id", "h").agg(F.max("rows").alias("rows"), F.max("train").alias("train"), F.max("n_tokens").alias("n_tokens"), *[v.alias(c) for c, v in whole.items()])
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    base = F.col("logs") + F.lit(float(np.log10(texts + 0.5))) - F.col("n_tokens") * F.lit(float(np.log10(tokens + 0.5 * (distinct + 1))))
    return each.select(
        "doc_id", "train", "n_tokens", (F.round("n_known").cast("long") + F.lit(int(texts > 0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("logs") + F.col("classes")).alias("score"),
    )


def query(docs: DataFrame) -> DataFrame:
    out = fit_and_score(docs, remainder("doc_id", 5) != 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
