"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Bits of a fingerprint get random vectors of ``radius + 1`` bits; the mask of a
non-zero vector v keeps the bits whose vectors have odd parity with v. The
positions in which two fingerprints differ, if at most ``radius``, span less than
the whole space, so some v is orthogonal to all of them: its mask hides every
difference, and the pair collides in that table. With radius 4 these are 31
tables, each keeping about half of the bits, and no pair is missed.

Two operators use it. ``group`` links fingerprints of 64 bits that differ in at
most 4. ``alike`` finds texts whose sets of five-word shingles have a similarity
of 0.8 or more: of a sketch of 512 bits, the first four parts of 32 bits get 31 tables
each, so pairs that differ in at most 19 of these 128 bits surely collide (in one
part they differ in at most 4) and most others do; of what collides, 128 bits
choose the nearest pairs. All 512 accept a pair, reject it, or, between, leave it
to the sets of shingles themselves.

Equal fingerprints are one node. A table entry of up to ``BLOCK`` nodes is
compared in one pass; larger ones are cut into blocks and dealt out by pairs of
blocks. What leaves a task is a spanning tree of the near nodes of an entry, not
their pairs. For fingerprints that is all there is to know. In ``alike`` a link of a
tree may yet be rejected, so the trees only make families: all pairs of a family are
decided in tasks that hold the sets of two of its blocks (``_decided``), and what
leaves them again is a forest. Groups that a rejected link leaves apart look for
nodes of other families once more (``_apart``); families that find each other are
decided likewise. Comparisons grow with the square of a family, rows don't.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.llm.common import appended, discarded, give_back, picked, ready, set_aside, texts_of, written
from lapforge.llm.components import components

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCK = 1024
#: Of the five-word sketch: lanes of 64 bits, bits that may differ among the first 128 and among all. At a similarity
#: of 0.8 some 78 of all bits differ (deviation 8), or 96 for sets of four and five. Up to SURE_ALL none are compared.
ALIKE_SHINGLE = 5
SIMILAR = 0.8
LANES = 8
NEAR_128 = 34
NEAR_ALL = 116
SURE_ALL = 48
#: Hashes that a block of a family holds on average; a task holds two blocks.
BLOCK_HASHES = 500_000
#: What the tables of the sketch are built of (lane, first bit, bits).
PARTS = ((0, 0, 32), (0, 32, 32), (1, 0, 32), (1, 32, 32))
_SIGN = 1 << 63


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The covering masks; every non-zero vector occurs nearly equally often among the bits' vectors."""
    vectors = list(range(1, 1 << (radius + 1)))
    pool = (vectors * (bits // len(vectors) + 1))[:bits]
    random.Random(SEED).shuffle(pool)
    return [sum(1 << i for i, m in enumerate(pool) if (m & v).bit_count() & 1) for v in vectors]


def _shingles(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle of a text whose A-Z is lower-cased already; empty without words."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(whole[a:b], SEED) for a, b in spans], dtype=np.uint64)


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the rows of hashes (rows x lanes), as unsigned longs."""
    lanes = hashes.shape[1]
    total = np.zeros(64 * lanes, dtype=np.int64)
    for k in range(0, len(hashes), 255):  # as many bytes add up to at most a byte
        part = np.ascontiguousarray(hashes[k : k + 255].astype(">u8")).view(np.uint8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(hashes)).view(">u8").astype(np.uint64)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash of a text whose A-Z is lower-cased already; 0 without words."""
    return int(_majority(_shingles(text, width)[:, None])[0])


def sketch(text: bytes, width: int = ALIKE_SHINGLE, lanes: int = LANES) -> np.ndarray:
    """SimHash of the set of shingles in ``lanes`` longs, whose hashes are mixed anew for each; zeros without words."""
    found = np.unique(_shingles(text, width))
    out = np.zeros(lanes, dtype=np.uint64)
    x = found[:, None] + np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return _majority(x ^ (x >> np.uint64(31))) if len(found) else out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fp``, the fingerprint as a signed long. Null and blank texts get 0."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        found = [fingerprint(t.as_py().encode("utf-8", "surrogatepass").lower()) for t in texts_of(part, text)]
        return [pa.array(np.array(found, dtype=np.uint64).view(np.int64))]

    return appended(docs, [T.StructField("fp", T.LongType())], work)


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``codes``, the sketch as signed longs. Null and blank texts get zeros."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        found = [sketch(t.as_py().encode("utf-8", "surrogatepass").lower()) for t in texts_of(part, text)]
        flat = pa.array(np.array(found, dtype=np.uint64).reshape(-1).view(np.int64))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * LANES), flat)]

    return appended(docs, [T.StructField("codes", T.ArrayType(T.LongType()))], work)


def shingle_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``shingles``, the hashes of the distinct five-word shingles; empty without words."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        found = [np.unique(_shingles(t.as_py().encode("utf-8", "surrogatepass").lower(), ALIKE_SHINGLE)) for t in texts_of(part, text)]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.uint64), *found]).view(np.int64)))]

    return appended(docs, [T.StructField("shingles", T.ArrayType(T.LongType()))], work)


def _tree(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the nearest links within ``limit`` (Prim's algorithm)."""
    left = np.arange(1, len(codes))
    best = np.full(len(left), 1 << 20)
    by = np.zeros(len(left), dtype=np.int64)
    at, froms, tos = 0, [], []
    while len(left):
        far = np.bitwise_count(codes[left] ^ codes[at]).sum(axis=1, dtype=np.int64)
        closer = far < best
        best[closer], by[closer] = far[closer], at
        k = int(best.argmin())
        at = int(left[k])
        if best[k] <= limit:
            froms.append(int(by[k]))
            tos.append(at)
        left, best, by = np.delete(left, k), np.delete(best, k), np.delete(by, k)
    return np.array(froms, dtype=np.int64), np.array(tos, dtype=np.int64)


def _entry_links(node: np.ndarray, codes: np.ndarray, bounds: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the entries that ``bounds`` cut out of the rows, all entries at a time."""
    sizes = np.diff(bounds)
    group = np.repeat(np.arange(len(sizes)), sizes)
    after = bounds[1:][group] - 1 - np.arange(len(node))
    near = np.zeros(len(node), dtype=bool)
    rows, shift = np.flatnonzero(after >= 1), 1
    while len(rows):
        hit = rows[np.bitwise_count(codes[rows] ^ codes[rows + shift]).sum(axis=1, dtype=np.int64) <= limit]
        near[hit] = near[hit + shift] = True
        shift += 1
        rows = rows[after[rows] >= shift]
    rows = np.flatnonzero(near)
    cuts = np.flatnonzero(np.diff(group[rows])) + 1
    froms, tos = [], []
    for some in np.split(rows, cuts) if len(rows) else []:
        a, b = (some[:1], some[1:]) if len(some) == 2 else (some[x] for x in _tree(codes[some], limit))
        froms.append(node[a])
        tos.append(node[b])
    empty = np.empty(0, dtype=np.int64)
    return np.concatenate([empty, *froms]), np.concatenate([empty, *tos])


def _family_links(family: np.ndarray, codes: np.ndarray, bounds: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the families that pairs within ``NEAR_ALL`` bits join; of rows with blocks (``own``) only pairs of two blocks count."""
    names, of = np.unique(family, return_inverse=True)
    sizes = np.diff(bounds)
    mixed = np.minimum.reduceat(of, bounds[:-1]) < np.maximum.reduceat(of, bounds[:-1])
    after = np.repeat(bounds[1:], sizes) - 1 - np.arange(len(family))
    label = np.arange(len(names))
    froms, tos = [], []
    at, shift = np.flatnonzero(np.repeat(mixed, sizes) & (after >= 1)), 1
    while len(at):
        some = label[of[at]] != label[of[at + shift]]
        a = at[some if own is None else some & (own[at] != own[at + shift])]
        a = a[np.bitwise_count(codes[a] ^ codes[a + shift]).sum(axis=1, dtype=np.int64) <= NEAR_ALL]
        for x, y in zip(of[a].tolist(), of[a + shift].tolist(), strict=True):
            if label[x] != label[y]:
                froms.append(x)
                tos.append(y)
                label[label == label[y]] = label[x]
        shift += 1
        at = at[after[at] >= shift]
    return names[np.array(froms, dtype=np.int64)], names[np.array(tos, dtype=np.int64)]


Linking = Callable[..., tuple[np.ndarray, np.ndarray]]
#: Links (a, b) without a key; blocks of large entries with one: their number, packed rows (id, codes), least and greatest id.
MET = "a long, b long, key int, part int, rows binary"


def _compare(linked: Linking, block: int):  # noqa: ANN202
    """Streams rows (key, id, codes) sorted by key into rows of ``MET``: the links of ids in entries of up to ``block`` rows.

    Of larger entries every ``block`` rows are a block: its links, and all of it in one row. At most a block is held.
    """
    names = ["a", "b", "key", "part", "rows"]

    def joined(rows: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = linked(rows[:, 1], rows[:, 2:].view(np.uint64), bounds)
        if n := len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        begun, part = None, 0  # the key of the entry that blocks were cut from last, and their number
        for batch in chain(batches, [None]):
            rows = [] if batch is None else [np.stack([x.to_numpy().astype(np.int64, copy=False) for x in batch.columns], axis=1)]
            rows = np.concatenate([*([] if held is None else [held]), *rows]) if rows or held is not None else np.empty((0, 2), dtype=np.int64)
            if not len(rows):
                continue
            key = rows[:, 0]
            bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(rows)]])
            sizes = np.diff(bounds)
            wide = sizes > block
            wide[0] |= begun == key[0]
            whole = ~wide
            held = None
            if batch is not None and not wide[-1]:  # it may go on
                held, whole[-1] = rows[bounds[-2] :], False
            if whole.any():
                yield from joined(rows[np.repeat(whole, sizes)], np.concatenate([[0], np.cumsum(sizes[whole])]))
            for e in np.flatnonzero(wide).tolist():
                entry, now = rows[bounds[e] : bounds[e + 1]], int(key[bounds[e]])
                begun, part = now, part if begun == now else 0
                end = len(entry)
                if batch is not None and e == len(sizes) - 1:
                    end -= end % block
                    held = entry[end:]
                for s in range(0, end, block):
                    cut = entry[s : min(s + block, end)]
                    yield from joined(cut, np.array([0, len(cut)]))
                    ids = cut[:, 1]
                    columns = ([ids.min()], pa.int64()), ([ids.max()], pa.int64()), ([now], pa.int32()), ([part], pa.int32()), ([cut[:, 1:].tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], names=names)
                    part += 1

    return run


def _all_links(entries: DataFrame, linked: Linking, lanes: int, block: int) -> DataFrame:
    """Links (a, b) of the ids of rows (key, id, codes) that are dealt out and sorted by key; pairs of blocks of large entries meet in tasks, a row each block."""
    met = written(entries.mapInArrow(_compare(linked, block), MET), "met")
    blocks = met.filter("key is not null").select("key", "part", "rows", F.col("a").alias("least"), F.col("b").alias("most"))
    large = blocks.groupBy("key").agg(F.count("*").cast("int").alias("parts"), F.min("least").alias("lo"), F.max("most").alias("hi")).filter("parts > 1 and lo < hi")
    other = blocks.join(large.select("key", "parts"), "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("other <> part")
    dealt = other.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rows")

    def across(pair: pa.Table) -> pa.Table:
        both = [np.frombuffer(x, dtype=np.int64).reshape(-1, 1 + lanes) for x in pair.column("rows").to_pylist()]
        rows = np.concatenate(both)
        a, b = linked(rows[:, 0], rows[:, 1:].view(np.uint64), np.array([0, len(rows)]), np.repeat([0, 1], [len(x) for x in both]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    more = dealt.groupBy("key", "i", "j").applyInArrow(across, "a long, b long")
    return met.filter("key is null").select("a", "b").unionByName(more).distinct()


def links(nodes: DataFrame, lanes: int = 1, parts: tuple[tuple[int, int, int], ...] = ((0, 0, 64),), limit: int = RADIUS, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) pairs of near rows of ``nodes`` (node, c0, c1, ...: ``lanes`` longs) that connect all near ones that collide.

    ``parts`` (lane, first bit, bits) are what the tables are built of. Nodes are
    distinct, and so are their codes. Each pair returned differs in at most
    ``limit`` bits; any two that do so and differ in at most ``radius`` bits of
    some part are in one component of the result.
    """
    ready(nodes.sparkSession)
    codes = [f"c{k}" for k in range(lanes)]
    spread, key = _spread(nodes.select("node", *codes), codes, _tables(parts, radius))
    spread = spread.select(key.alias("key"), "node", *codes).sortWithinPartitions("key", "node")  # blocks, hence trees, are the same in every run
    return _all_links(spread, lambda node, codes, bounds, own=None: _entry_links(node, codes, bounds, limit), lanes, block)


def _tables(parts: tuple[tuple[int, int, int], ...], radius: int) -> list[tuple[int, int]]:
    """Lane and mask (as a signed long) of each table."""
    return [(lane, m - 2 * _SIGN if m >= _SIGN else m) for lane, first, bits in parts for m in (m << first for m in masks(radius, bits))]


def _spread(rows: DataFrame, codes: list[str], tables: list[tuple[int, int]]) -> tuple[DataFrame, Column]:
    """A row for each table, dealt out by the key of its entry, and the key; it is made on both sides, as the number of a table takes a byte in the shuffle."""
    lane, mask = (F.get(F.array(*[F.lit(t[k]) for t in tables]), "k") for k in (0, 1))
    key = F.hash("k", F.get(F.array(*codes), lane).bitwiseAND(mask))
    return rows.select(F.explode(F.sequence(F.lit(0), F.lit(len(tables) - 1))).alias("k"), *rows.columns).repartition(key), key


def _apart(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): families of ``nodes`` (node, codes, family) that connect all those of which nodes collide and differ in at most ``NEAR_ALL`` bits."""
    ready(nodes.sparkSession)
    codes = [f"c{k}" for k in range(LANES)]
    rows = nodes.select("family", *[F.col("codes")[k].alias(c) for k, c in enumerate(codes)])
    spread, key = _spread(rows, codes, _tables(PARTS, RADIUS))
    return _all_links(spread.select(key.alias("key"), "family", *codes).sortWithinPartitions("key"), _family_links, LANES, block)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (node, parts, ...) of entries cut into ``parts`` blocks: ``own``, and a row for each pair of blocks ``i``, ``j`` that it is in."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    return rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "parts")


def group(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that a document reaches over near fingerprints.

    Documents with equal fingerprints are linked, those with fingerprint 0 (no
    words, null texts) among themselves too. A null doc_id is kept as a row; it
    doesn't name a component unless no other id is in it.
    """
    prints = written(fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select(F.col("fp").alias("node"), F.col("fp").alias("c0")), limit=radius, radius=radius)).select(F.col("node").alias("fp"), "root")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp")


def query(docs: DataFrame) -> DataFrame:
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return group(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def _bits_apart(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)


def alike(docs: DataFrame) -> DataFrame:
    """uid, doc_id, codes' component for rows (uid, doc_id, text): one row per distinct sketch.

    Columns: ``best``, the row that stands for the sketch (least doc_id, nulls
    last, then uid), and ``root``, the same for all sketches that reach each other
    over links of a similarity of 0.8 or more, which is counted unless sketches
    are so near that it is surely that high. Texts with equal sets of shingles
    share a sketch; texts without words share one too.
    """
    found = sketches(docs.select("uid", "doc_id", "text")).select("uid", "doc_id", "codes")
    nodes = found.groupBy("codes").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("best"))
    nodes = written(nodes.withColumn("node", F.col("best.uid")), "sketches")
    pairs = links(nodes.select("node", F.col("codes")[0].alias("c0"), F.col("codes")[1].alias("c1")), lanes=2, parts=PARTS, limit=NEAR_128)
    pairs = written(pairs, "pairs")
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("codes").alias(f"codes_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", _bits_apart("codes_a", "codes_b").alias("apart"))
    near = written(near.filter(F.col("apart") <= NEAR_ALL), "near")
    placed = nodes.select("node", F.col("node").alias("root"), F.col("node").alias("family"))
    placed = _merged(_merged(placed, near.filter(F.col("apart") <= SURE_ALL), "root"), near, "family")
    placed = _merged(placed, _decided(placed.withColumn("done", F.col("root")), nodes, docs), "root")
    again = written(_open_roots(pairs, placed), "open")
    if not again.isEmpty():
        left = placed.join(again, "root", "left_semi")
        rest = written(_apart(nodes.select("node", "codes").join(left, "node")), "rest")
        if not rest.isEmpty():
            wide = _merged(left.withColumn("done", F.col("family")), rest, "family")
            placed = _merged(placed, _decided(wide, nodes, docs), "root")
    return nodes.join(placed, "node").select("best", "root")


def _merged(placed: DataFrame, met: DataFrame, column: str) -> DataFrame:
    """``placed`` with the values of a column that links (a, b) connect replaced by their least."""
    whole = components(met).select(F.col("node").alias(column), F.col("root").alias("whole"))
    return written(placed.join(whole, column, "left").withColumn(column, F.coalesce("whole", column)).drop("whole"), "placed")


def _near_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (family, i, j, root, done, own, codes, shingles) sorted by family, i, j -> (a, b), a spanning forest of the roots that are near."""
    held: pa.Table | None = None
    for batch in chain(batches, [None]):
        parts = [x for x in (held, None if batch is None else pa.Table.from_batches([batch])) if x is not None and x.num_rows]
        held = None
        if not parts:
            continue
        rows = pa.concat_tables(parts).combine_chunks()
        key = np.stack([rows.column(k).to_numpy() for k in range(3)])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
        if batch is None:
            cuts.append(rows.num_rows)
        else:
            held = rows.slice(cuts[-1])
        found = [_near_in(rows.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b"])
    give_back()


def _near_in(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links of one pair of blocks: sketches accept or reject a pair, or else the common part of the sets is counted; of what is joined already nothing is."""
    i, j, root, done, own = (rows.column(k).to_numpy() for k in range(1, 6))
    codes = np.stack([rows.column(6 + k).to_numpy().view(np.uint64) for k in range(LANES)], axis=1)
    lists = rows.column(6 + LANES)
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    held, ids = np.unique(pc.list_flatten(lists).to_numpy(), return_inverse=True)
    mine = np.zeros(len(held), dtype=bool)
    label = np.unique(root, return_inverse=True)[1]
    froms, tos = [], []
    for x in range(len(root) - 1):
        y = np.arange(x + 1, len(root))
        y = y[(label[y] != label[x]) & (done[y] != done[x]) & ((i[0] == j[0]) | (own[y] != own[x]))]
        apart = np.bitwise_count(codes[y] ^ codes[x]).sum(axis=1, dtype=np.int64)
        y, apart = y[apart <= NEAR_ALL], apart[apart <= NEAR_ALL]
        mine[ids[ends[x] : ends[x + 1]]] = True
        for k, bits in zip(y.tolist(), apart.tolist(), strict=True):
            if label[k] == label[x]:
                continue
            if bits > SURE_ALL:
                common = np.count_nonzero(mine[ids[ends[k] : ends[k + 1]]])
                if common / (sizes[x] + sizes[k] - common) < SIMILAR:
                    continue
            froms.append(x)
            tos.append(k)
            label[label == label[k]] = label[x]
        mine[ids[ends[x] : ends[x + 1]]] = False
    return root[np.array(froms, dtype=np.int64)], root[np.array(tos, dtype=np.int64)]


def _decided(placed: DataFrame, nodes: DataFrame, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): roots that connect all those of a family of which nodes are near and differ in ``done``; rows (node, root, family, done).

    Large families are cut into blocks by rows and by the hashes that their sets hold, and
    dealt out by pairs of blocks, so that a task holds two blocks whatever their number.
    """
    ready(nodes.sparkSession)
    mixed = placed.groupBy("family").agg((F.min("root") < F.max("root")).alias("mixed")).filter("mixed").select("family")
    asked = written(placed.join(mixed, "family", "left_semi").select(F.col("node").alias("uid"), "family", "root", "done"), "asked")
    sets = written(shingle_sets(picked(docs.select("uid", "text"), asked.select("uid"), "left_semi")).select("uid", "shingles"), "sets")
    codes = [F.col("codes")[k].alias(f"c{k}") for k in range(LANES)]
    sizes = sets.select("uid", F.size("shingles").alias("hashes")).join(asked, "uid").groupBy("family").agg(F.count("*").alias("n"), F.sum("hashes").alias("hashes"))
    shares = sizes.select("family", F.ceil(F.greatest(F.lit(1.0), F.col("n") / block, F.col("hashes") / BLOCK_HASHES)).cast("int").alias("parts"))
    known = asked.join(shares, "family").join(nodes.select(F.col("node").alias("uid"), *codes), "uid")
    dealt = _dealt(known.join(sets, "uid").withColumnRenamed("uid", "node"))
    dealt = dealt.select("family", "i", "j", "root", "done", "own", *[f"c{k}" for k in range(LANES)], "shingles")
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    out = written(dealt.mapInArrow(_near_roots, "a long, b long").distinct(), "decided")
    discarded(sets)
    return out


def _open_roots(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """Roots of the groups that a rejected link leaves apart from others, unless these are two single nodes and so decided."""
    of = lambda x: placed.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    cross = pairs.join(of("a"), "a").join(of("b"), "b").filter("root_a <> root_b")
    cross = written(cross.select("root_a", "root_b").distinct(), "cross")  # it is read from several sides
    cross = cross.select(F.col("root_a").alias("root"), F.col("root_b").alias("other")).unionByName(cross.select(F.col("root_b").alias("root"), F.col("root_a").alias("other")))
    met = cross.groupBy("root").agg((F.min("other") == F.max("other")).alias("one"), F.min("other").alias("other"))
    lone = placed.groupBy("root").agg((F.count("*") == 1).alias("lone"))
    met = met.join(lone, "root").select("root", "other", (F.col("one") & F.col("lone")).alias("lone"))
    decided = met.filter("lone").select("root", "other")
    back = decided.select(F.col("other").alias("root"), F.col("root").alias("other"))
    return met.select("root").join(decided.join(back, ["root", "other"], "left_semi"), "root", "left_anti")


def stage(docs: DataFrame) -> DataFrame:
    """Keep one document of each group of near copies: the least doc_id, nulls last.

    Near are texts whose sets of five-word shingles have a similarity of 0.8 or
    more (``alike``), directly or by way of others. Repeated rows are copies;
    rows that share an id (or have none) but not their text are not. Rows are
    numbered once and written, as numbers given anew follow how files are dealt out.
    Columns come back as they were; an empty table stays empty.
    """
    docs, given = set_aside(docs, "uid")
    numbered = written(docs.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    kept = alike(numbered).groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.uid").alias("uid"))
    gone = written(numbered.select("uid").join(kept, "uid", "left_anti"), "gone")
    return given(picked(numbered, gone, "left_anti"))
