"""Audit of how sources of a language differ in their terms, from sorted pointers to the starts of terms.

A task goes through slices of documents. In the lower-cased Arrow buffer of a slice
it points to the start of every term and sorts the pointers by multikey quicksort:
eight bytes are one key, pointers that agree in it are a slice of their own, sorted
by the next eight, until their terms end. Equal terms thus lie side by side; one pass
over their runs gives a row a language and term: its documents, and its occurrences by
source. Spark brings the rows of a language and term together in order, and tasks add
them up as they pass and let rare terms go; no term or group is held whole.

Where groups are compared, a term that a group lacks has the group's least
probability. So only terms that occur are dealt out, in tiles of sources and chunks
of terms; what two sources both lack is added by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapforge.llm.common import give_back, ready, text_slices, texts_of, written

LEAST_DOCS, TOP, BASE = 10, 10, 1_000_000_000
#: Sources of a tile and terms of a chunk that are compared in one group of rows.
TILE, CHUNK = 256, 4_096
#: Bytes of a term after which the few slices left are sorted as whole byte strings.
DEEP = 256
#: Characters of a slice, and rows that leave a task at a time.
SLICE_CHARS, ROWS = 8_000_000, 20_000
PART = "lang string, term string, docs long, sources array<string>, ns array<long>"
KEPT = "lang string, source string, term string, n long, lang_n long, turn long"
_PART = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[:0x80] = [ord(chr(c).lower()) if chr(c).isalpha() else 0 for c in range(0x80)]
_MASK = np.array([0] + [(1 << 64) - (1 << (64 - 8 * r)) for r in range(1, 9)], dtype=np.uint64)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of texts, lower-cased, with 0 for every byte that is in no term."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])


def pointers(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every term; none goes over the end of a text."""
    inside = data[: offsets[-1]] != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    border = np.unique(offsets[(offsets > 0) & (offsets < offsets[-1])])
    first[border] |= inside[border]
    last[border - 1] |= inside[border - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start


def multikey_sort(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by their terms' bytes, and where in it a run of equal terms begins."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)

    def key(which: np.ndarray, depth: int) -> np.ndarray:
        block = np.ascontiguousarray(view[start[which] + depth]).view(">u8").ravel().astype(np.uint64)
        return block & _MASK[np.minimum(length[which] - depth, 8)]

    def open_slices(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Of places ``at`` those whose term goes on and whose slice has another."""
        after = np.concatenate([fresh[1:], [True]])[at]
        return at[((keys & np.uint64(0xFF)) != 0) & ~(fresh[at] & after)]

    keys = key(np.arange(len(start)), 0)
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = keys[1:] != keys[:-1]
    at, depth = open_slices(np.arange(len(order)), keys), 8
    while len(at) and depth < DEEP:
        goes_on = length[order[at]] > depth
        keys = np.zeros(len(at), np.uint64)
        keys[goes_on] = key(order[at[goes_on]], depth)
        part = np.cumsum(fresh)[at]
        within = np.lexsort((keys, part))
        order[at], keys = order[at[within]], keys[within]
        fresh[at[1:]] |= keys[1:] != keys[:-1]
        at, depth = open_slices(at, keys), depth + 8
    part = np.cumsum(fresh)[at]
    for places in np.split(at, np.flatnonzero(np.diff(part)) + 1) if len(at) else []:
        terms = sorted((data[start[k] : start[k] + length[k]].tobytes(), k) for k in order[places].tolist())
        order[places] = [k for _, k in terms]
        fresh[places[1:]] = [a[0] != b[0] for a, b in zip(terms[:-1], terms[1:], strict=True)]
    return order, fresh


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[place]))


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = pc.fill_null(column.cast(pa.string()), "").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def count_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row a language and term of a slice: documents, and occurrences by source."""
    lang, langs = _codes(batch.column("lang"))
    source, sources = _codes(batch.column("source"))
    pairs, group = np.unique(lang * len(sources) + source, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    rank = np.empty(len(group), np.int64)
    rank[by_group] = np.arange(len(group))
    offsets, data = _buffer(texts_of(batch))
    start, length = pointers(offsets, data)
    if len(start) == 0:
        return pa.RecordBatch.from_pylist([], _PART)
    order, fresh = multikey_sort(data, start, length)
    heads = order[fresh]
    hits = rank[np.searchsorted(offsets, start[order], side="right") - 1]
    hits += (np.cumsum(fresh) - 1) * len(group)
    hits.sort()
    # a hit is a term and a document; documents of a language, and of a source in it, follow each other
    new_doc = np.ones(len(hits), bool)
    new_doc[1:] = hits[1:] != hits[:-1]
    term, owner = hits // len(group), pairs[group[by_group]][hits % len(group)]
    cell = np.ones(len(hits), bool)
    cell[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    first_cell = np.flatnonzero(cell)
    n = np.diff(np.append(first_cell, len(hits)))
    term, owner = term[first_cell], owner[first_cell]
    row = np.ones(len(term), bool)
    row[1:] = (term[1:] != term[:-1]) | (owner[1:] // len(sources) != owner[:-1] // len(sources))
    first = np.flatnonzero(row)
    docs = np.add.reduceat(new_doc, first_cell[first], dtype=np.int64)
    bounds = pa.array(np.append(first, len(term)).astype(np.int32))
    terms = _strings(data, start[heads], length[heads])
    return pa.RecordBatch.from_arrays([
        langs.take(pa.array(owner[first] // len(sources))), terms.take(pa.array(term[first])), pa.array(docs),
        pa.ListArray.from_arrays(bounds, sources.take(pa.array(owner % len(sources)))), pa.ListArray.from_arrays(bounds, pa.array(n)),
    ], schema=_PART)


class _Sums:
    """Rows of equal language and term in a batch, added up by source; ``rows`` begin the runs."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        lang, term = batch.column("lang"), batch.column("term")
        new = np.ones(batch.num_rows, bool)
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
        self.rows = np.flatnonzero(new)
        self.lang, self.term = lang.take(pa.array(self.rows)), term.take(pa.array(self.rows))
        self.docs = np.add.reduceat(batch.column("docs").to_numpy(), self.rows)
        of_run = np.repeat(np.cumsum(new) - 1, pc.list_value_length(batch.column("sources")).to_numpy(zero_copy_only=False))
        coded = batch.column("sources").flatten().dictionary_encode()
        rank = np.argsort(np.argsort(np.array([s.encode() for s in coded.dictionary.to_pylist()], dtype=object)))
        self.names = coded.dictionary.take(pa.array(np.argsort(rank)))
        key = of_run * len(rank) + rank[coded.indices.to_numpy(zero_copy_only=False)]
        cells, place = np.unique(key, return_inverse=True)
        self.n = np.zeros(len(cells), np.int64)
        np.add.at(self.n, place, batch.column("ns").flatten().to_numpy())
        self.run, self.source = cells // len(rank), cells % len(rank)

    def kept(self, upto: int, least_docs: int) -> pa.RecordBatch:
        """Cells of the first ``upto`` runs that have documents enough."""
        runs = self.docs >= least_docs
        runs[upto:] = False
        cells = np.flatnonzero(runs[self.run])
        run = pa.array(self.run[cells])
        total = np.add.reduceat(self.n, np.searchsorted(self.run, np.arange(len(self.rows))))
        turn = cells - np.searchsorted(self.run, self.run[cells]) + 1
        return pa.RecordBatch.from_arrays(
            [self.lang.take(run), self.names.take(pa.array(self.source[cells])), self.term.take(run), pa.array(self.n[cells]), pa.array(total[self.run[cells]]), pa.array(turn)],
            names=["lang", "source", "term", "n", "lang_n", "turn"],
        )

    def last(self) -> pa.RecordBatch:
        """The last run as one row, to go on with."""
        cells = np.flatnonzero(self.run == len(self.rows) - 1)
        bounds = pa.array(np.array([0, len(cells)], np.int32))
        return pa.RecordBatch.from_arrays([
            self.lang[-1:], self.term[-1:], pa.array(self.docs[-1:]), pa.ListArray.from_arrays(bounds, self.names.take(pa.array(self.source[cells]))), pa.ListArray.from_arrays(bounds, pa.array(self.n[cells])),
        ], schema=_PART)


def _merged(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Add up rows in order of language and term; the run that a batch ends in goes on in the next."""
    open_run: pa.RecordBatch | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        parts = [b.cast(_PART) for b in ([batch] if open_run is None else [open_run, batch])]
        sums = _Sums(pa.concat_batches(parts))
        yield sums.kept(len(sums.rows) - 1, least_docs)
        open_run = sums.last()
    if open_run is not None:
        yield _Sums(open_run).kept(1, least_docs)
    give_back()


def count(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, n of the terms in at least ``least_docs`` documents of their language, with lang_n, the
    language's sum, and turn, from 1 over the sources of a term by their bytes.

    Null text, lang or source is read as the empty string; each row is a document, repeated ones too.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, chars=SLICE_CHARS):
                rows = count_slice(part)
                yield from (rows.slice(k, ROWS) for k in range(0, rows.num_rows, ROWS))
        give_back()

    parts = docs.select("lang", "source", "text").mapInArrow(run, PART)
    together = parts.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return together.mapInArrow(lambda batches: _merged(batches, least_docs), KEPT)


def compare_tile(rows: pa.Table, tile: int) -> pa.Table:
    """Of one chunk of terms: for each pair of sources of two tiles the sum of divergences, and the number of terms seen.

    ``term`` is null in rows that give a source's least probability.
    """
    lang, lo, hi = (rows.column(c)[0].as_py() for c in ("lang", "lo", "hi"))
    i, p = rows.column("i").to_numpy(), rows.column("p").to_numpy()
    coded = rows.column("term").combine_chunks().dictionary_encode()
    term = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
    least = term < 0
    columns = np.sort(i[least])
    base = np.empty(len(columns), np.int64)
    base[np.searchsorted(columns, i[least])] = p[least]
    table = np.repeat(base[:, None], len(coded.dictionary), axis=1)
    table[np.searchsorted(columns, i[~least]), term[~least]] = p[~least]
    left, right = np.flatnonzero(columns // tile == lo), np.flatnonzero(columns // tile == hi)
    first, second, value = [], [], []
    for a in left:
        others = right[right > a]
        difference = table[others] - table[a]
        value.append((difference * difference // (table[others] + table[a])).sum(axis=1))
        first.append(np.full(len(others), columns[a]))
        second.append(columns[others])
    made = np.concatenate([[], *value]).astype(np.int64)
    return pa.table({
        "lang": pa.array([lang] * len(made), pa.string()), "i": pa.array(np.concatenate([[], *first]).astype(np.int64)), "j": pa.array(np.concatenate([[], *second]).astype(np.int64)),
        "value": pa.array(made), "seen": pa.array(np.full(len(made), table.shape[1], np.int64)),
    })


def _probability(n: str, total: str) -> str:
    """1 + floor(BASE * (n + 2) / (total + 2 V)), exact for any count; 1 where no term is kept."""
    return f"if(v = 0, 1L, 1 + (cast({BASE} as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0))) div cast({total} + 2 * greatest(v, 1) as decimal(20, 0)))"


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.filter(F.col("rank") <= most)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs from each other one (``pair``) and
    which ``top`` terms it has more of than its language (``term``). ``tile`` sources and ``chunk`` terms are compared at a time;
    they change no result.

    Ties go by the item's bytes. No documents: no rows. A language without a kept term: pairs of value 0.
    """
    kept = written(count(docs, least_docs), "kept")
    names = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    of_lang = kept.groupBy("lang").agg(F.sum(F.when(F.col("turn") == 1, 1)).alias("v"), F.sum("n").alias("lang_total"))
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbered = names.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    groups = numbered.join(of_lang, "lang", "left").join(of_source, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "total"])
    groups = written(groups.withColumn("z", F.expr(_probability("0", "total"))), "groups")
    priced = kept.join(groups, ["lang", "source"]).withColumns({"p": F.expr(_probability("n", "total")), "q": F.expr(_probability("lang_n", "lang_total"))})

    above = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    tiles = groups.groupBy("lang").agg(F.floor(F.max("i") / tile).alias("last"), F.max("v").alias("v")).withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("v") / chunk)))
    entries = priced.select("lang", "i", "term", "p").join(tiles, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    least = groups.select("lang", "i", F.lit(None).cast("string").alias("term"), F.col("z").alias("p")).join(tiles, "lang")
    least = least.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = entries.unionByName(least).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).withColumn("own", F.floor(F.col("i") / tile))
    dealt = dealt.select("lang", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "chunk", "i", "term", "p")
    sums = dealt.groupBy("lang", "lo", "hi", "chunk").applyInArrow(lambda rows: compare_tile(rows, tile), "lang string, i long, j long, value long, seen long")
    sums = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    a, b = (groups.select("lang", F.col("source").alias(f"source_{k}"), F.col("i").alias(k), F.col("z").alias(f"z_{k}"), *(["v"] if k == "i" else [])) for k in "ij")
    both = sums.join(a, ["lang", "i"]).join(b, ["lang", "j"]).withColumn("value", F.expr("value + (v - seen) * ((z_i - z_j) * (z_i - z_j) div (z_i + z_j))"))
    turned = F.explode(F.array(F.struct(F.col("source_i").alias("source"), F.col("source_j").alias("item")), F.struct(F.col("source_j").alias("source"), F.col("source_i").alias("item"))))
    pairs = both.withColumn("t", turned).select("lang", "t.source", F.lit("pair").alias("part"), "t.item", "value")
    return _ranked(pairs).unionByName(_ranked(above, top))


def query(docs: DataFrame) -> DataFrame:
    return audit(docs)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY t.lang, t.source, t.term),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
e AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // (coalesce(s.total, 0) + 2 * l.v) AS p, 1 + 1000000000 * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
a AS (SELECT e.lang, e.source, o.source AS item, sum((e.p - o.p) * (e.p - o.p) // (e.p + o.p)) AS value FROM e JOIN e o ON o.lang = e.lang AND o.term = e.term AND o.source <> e.source GROUP BY e.lang, e.source, o.source),
p AS (SELECT g.lang, g.source, h.source AS item, coalesce(a.value, 0)::BIGINT AS value FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source LEFT JOIN a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source),
r AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM e WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM p
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM r) WHERE rank <= 10
"""
