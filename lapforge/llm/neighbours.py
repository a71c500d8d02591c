"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

For vectors of each dimension rotations are learned so that the signs of the rotated
unit vector lose as little as possible (alternating between codes and an orthogonal
Procrustes step). Vectors are not centred: the angle of a pair then bounds how many
of its bits differ, however tight the cluster that it lies in. The code is cut into
chunks, one table each; rows of one label and dimension with an equal chunk meet in
an entry of its table. Two vectors at the threshold differ in a bit with a chance of
angle / pi, so bits a chunk follow the largest label, that entries stay small, and
the number of chunks follows from the bits and ``RECALL``, which is the same for
labels of every size. What meets is reranked
with the original vectors in double precision; a pair counts in the first table only
in which it meets.

Equal vectors are one node with a multiplicity. Tables hold keys and nodes; only
nodes that meet another are joined with their vectors. Large entries are cut into
blocks and dealt out by pairs of blocks; what leaves a task are counts and a spanning
forest of the links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.llm.common import ready, written
from lapforge.llm.components import components

COSINE = 0.93
#: Expected share of the pairs at the threshold that meet, for labels of every size; closer ones meet more surely.
RECALL = 0.99999
#: Bits a chunk: SPARE more than number the largest label, so that few vectors meet that aren't near.
LEAST_BITS, SPARE_BITS, MOST_BITS = 8, 2, 28
TRAIN_ROWS = 4_096
ROUNDS = 30
#: Vectors of more dimensions are first projected at random to as many.
WIDE = 1_024
BLOCK = 1_024


def shape(rows: int, cosine: float) -> tuple[int, int]:
    """Bits a chunk and number of chunks for labels of up to ``rows`` vectors."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(rows - 1).bit_length() + SPARE_BITS))
    same = (1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi) ** bits
    return bits, max(1, int(np.ceil(np.log(1 - RECALL) / np.log(1 - min(same, 1 - 1e-12)))))


def learn(sample: np.ndarray, bits: int) -> np.ndarray:
    """Projection (dimensions x bits) by iterative quantisation of unit vectors, from as many starts as the bits need."""
    dims = sample.shape[1]
    rng = np.random.default_rng(7)
    mix = np.linalg.qr(rng.standard_normal((dims, WIDE)))[0] if dims > WIDE else np.eye(dims)
    flat = sample @ mix
    width = flat.shape[1]
    out: list[np.ndarray] = []
    while width * len(out) < bits:
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(ROUNDS):
            codes = np.where(flat @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(codes.T @ flat)
            turn = (u @ v).T
        out.append(mix @ turn)
    return np.hstack(out)[:, :bits]


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; they are first divided by their largest component, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray, project: np.ndarray, bits: int) -> np.ndarray:
    """Chunks (rows x tables) of the codes of unit vectors."""
    signs = (unit @ project >= 0).reshape(len(unit), -1, bits)
    return signs.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def _keys(label: np.ndarray, dims: int, chunks: np.ndarray) -> np.ndarray:
    """Table entries of the chunks: a mix of label, dimension, table and chunk."""
    x = chunks.astype(np.uint64) | (np.arange(chunks.shape[1], dtype=np.uint64) << np.uint64(32)) | (np.uint64(dims) << np.uint64(48))
    for seed in (label.view(np.uint64)[:, None], np.uint64(0x9E3779B97F4A7C15)):
        x = x + seed
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x.view(np.int64)


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of a symmetric boolean matrix."""
    left = np.flatnonzero(near.any(axis=0))
    froms, tos, queue = [], [], []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        hit = near[at, left]
        got, left = left[hit], left[~hit]
        queue += got.tolist()
        froms += [at] * len(got)
        tos += got.tolist()
    return np.array(froms, dtype=np.int64), np.array(tos, dtype=np.int64)


def models(nodes: DataFrame, cosine: float) -> dict[int, tuple[np.ndarray, int]]:
    """Projection and bits a chunk of each dimension that two nodes (node, label, embedding) at least have.

    Each is learned in a task of its own from the ``TRAIN_ROWS`` vectors with the
    smallest hashes; hashes that are surely too large are left out before these are
    ranked.
    """
    sized = nodes.select("node", "label", "embedding", F.size("embedding").alias("dims"), F.xxhash64("node").alias("h"))
    counted = sized.groupBy("dims", "label").agg(F.count("*").alias("n")).groupBy("dims").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    sizes = {r["dims"]: (r["n"], r["most"]) for r in counted.filter("most > 1").collect()}
    share: Column = F.lit(0.0)
    for d, (n, _) in sizes.items():
        share = F.when(F.col("dims") == d, F.lit(min(1.0, 2.0 * TRAIN_ROWS / n))).otherwise(share)
    small = (F.col("h").cast("double") / 2.0**64 + 0.5) <= share
    nearest = Window.partitionBy("dims").orderBy("h", "node")
    sample = sized.filter(F.col("dims").isin(list(sizes)) & small).withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= TRAIN_ROWS)

    def learned(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("h", "ascending"), ("node", "ascending")])
        dims = rows.column("dims")[0].as_py()
        x = np.array(rows.column("embedding").to_pylist(), dtype=np.float64).reshape(-1, dims)
        bits, tables = shape(sizes[dims][1], cosine)
        project = learn(unit_vectors(x), bits * tables)
        return pa.table({"dims": pa.array([dims], pa.int32()), "project": pa.array([project.astype("<f8").tobytes()], pa.binary())})

    found = sample.select("node", "embedding", "dims", "h").groupBy("dims").applyInArrow(learned, "dims int, project binary").collect()
    return {r["dims"]: (np.frombuffer(r["project"]).reshape(r["dims"], -1), shape(sizes[r["dims"]][1], cosine)[0]) for r in found}


def _rerank(cosine: float, kind: str, shared: Broadcast[dict[int, tuple[np.ndarray, int]]]):  # noqa: ANN202
    """Rows (key, dims, i, j, own, node, label, table, copies, vector) sorted by the first four -> (a, b, links).

    Chunks are worked out anew, of vectors with a near one only, as they would be most of what is shuffled.
    """

    def finish(rows: list[pa.RecordBatch], key: tuple) -> pa.RecordBatch | None:
        at = pa.Table.from_batches(rows)
        own, node, label, table, copies = (at.column(c).to_numpy() for c in ("own", "node", "label", "table", "copies"))
        _, dims, i, j = key
        x = np.frombuffer(b"".join(at.column("vector").to_pylist()), dtype=kind).reshape(-1, dims).astype(np.float64)
        x = unit_vectors(x)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return None
        a, b = np.nonzero(x[left] @ x[right].T >= cosine)
        a, b = left[a], right[b]
        some = (a < b) if i == j else np.ones(len(a), dtype=bool)
        some &= (label[a] == label[b]) & (table[a] == table[b])
        a, b = a[some], b[some]
        if not len(a):
            return None
        met, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        project, bits = shared.value[dims]
        chunks = np.concatenate([encode(x[met[s : s + BLOCK]], project, bits) for s in range(0, len(met), BLOCK)])
        place = place.reshape(2, -1)
        some = np.empty(len(a), dtype=bool)
        for s in range(0, len(a), 1 << 17):  # a pair counts in the first table where it meets
            p = slice(s, s + (1 << 17))
            some[p] = (chunks[place[0, p]] == chunks[place[1, p]]).argmax(axis=1) == table[a[p]]
        a, b = a[some], b[some]
        if not len(a):
            return None
        linked = np.bincount(a, weights=copies[b], minlength=len(node)) + np.bincount(b, weights=copies[a], minlength=len(node))
        near = np.zeros((len(node), len(node)), dtype=bool)
        near[a, b] = near[b, a] = True
        met = np.flatnonzero(linked)
        a, b = _forest(near)
        counts = np.concatenate([linked[met].astype(np.int64), np.zeros(len(a), dtype=np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[met], node[a]])), pa.array(np.concatenate([node[met], node[b]])), pa.array(counts)], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now: tuple = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(keys[:, a].tolist())
                if key != now:
                    if held and (out := finish(held, now)):
                        yield out
                    held, now = [], key
                held.append(batch.slice(a, b - a))
        if held and (out := finish(held, now)):
            yield out

    return run


def _finite(column: str) -> Column:
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & ~bad


def link(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for rows vec_id, embedding (array of numbers), label.

    Rows link if their labels are equal and not null and their cosine is at least
    ``cosine``, computed in double precision. Null, empty and zero vectors, and those
    with null or non-finite components, link with nothing; nor do vectors of unlike
    dimensions. Repeated rows are vectors of their own, so equal ones link. The
    rotations of each dimension are learned from its ``TRAIN_ROWS`` vectors with the
    smallest hashes; all are indexed.
    """
    spark = vectors.sparkSession
    ready(spark)
    kind, sql = ("<f4", "float") if dict(vectors.dtypes)["embedding"] == "array<float>" else ("<f8", "double")
    x = F.col("embedding").cast(f"array<{sql}>")
    some = F.exists("embedding", lambda v: v != 0)
    able = F.coalesce(_finite("embedding") & F.col("label").isNotNull() & some, F.lit(False))
    rows = vectors.select("vec_id", x.alias("embedding"), "label").withColumn("able", able)
    good = rows.filter("able").groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = written(good.withColumn("node", F.xxhash64("label", "embedding")), "nodes")
    shared = spark.sparkContext.broadcast(models(nodes, cosine))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = pc.list_value_length(batch.column(2)).to_numpy()
            for dims in np.unique(width).tolist():
                if dims not in shared.value:  # no other vector of its label has as many
                    continue
                part = batch.filter(pa.array(width == dims))
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)
                x = flat.astype(np.float64)
                project, bits = shared.value[dims]
                chunks = encode(unit_vectors(x), project, bits)
                keys = _keys(part.column(1).to_numpy(), dims, chunks)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * chunks.shape[1])
                raw = pa.array([r.tobytes() for r in flat], pa.binary())
                wide = pa.array(np.full(len(x), dims, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), wide, part.column(3), pa.ListArray.from_arrays(ends, pa.array(keys.ravel())), raw], names=["node", "label", "dims", "copies", "keys", "vector"])

    coded = nodes.select("node", F.xxhash64("label").alias("label"), "embedding", "copies").mapInArrow(codes, "node long, label long, dims int, copies long, keys array<long>, vector binary")
    coded = written(coded, "codes")
    entries = coded.select("node", F.posexplode("keys").alias("table", "key"))
    large = written(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "entries")
    meet = entries.join(large, "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int"))
    dealt = meet.join(coded.drop("keys"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", "dims", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "table", "copies", "vector")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "dims", "i", "j")
    found = written(dealt.mapInArrow(_rerank(cosine, kind, shared), "a long, b long, links long"), "links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("a <> b"))
    placed = nodes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = named.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    out = rows.filter("able").join(named, ["label", "embedding"]).select("vec_id", F.col("links").alias("n_links"), "component_id")
    out = out.unionByName(rows.filter("not able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


query = link

ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) AS able FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.able AND b.able AND a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
c AS (SELECT vec_id AS a, vec_id AS root FROM v UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.a WHERE l.b > c.root),
m AS (SELECT a AS vec_id, min(root) AS component_id FROM c GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN m USING (vec_id)
"""
