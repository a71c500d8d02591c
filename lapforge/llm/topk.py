"""Exact top-k inner products by columnar branch and bound.

Components become integers. Candidates are dealt evenly into blocks and held in
vertical layout, dimension after dimension; every query meets every block. For a
query the partial products of a few dimensions are added for all candidates still
alive, what the remaining dimensions can add is bounded by the product of the
remaining norms, and candidates whose upper bound is under the k-th best lower bound
are dropped from the columns. Candidates are shuffled once, queries once a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.llm.common import ready, written

K = 20
SCALE = 64
EVERY = 20
#: Candidates of a block, and components that it holds at most if vectors are long.
ROW_BLOCK, BLOCK_COMPONENTS = 32_768, 4_194_304
STRIDE = 16
#: Queries whose first stride is multiplied at once.
TOGETHER = 16
#: Up to this, sums of integers are exact in doubles.
EXACT = float(2**52)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, q: floor(scale * x) of each component, as longs.

    Rows that are null, empty or hold null or non-finite components are left out,
    and so are those without an id.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    clean = vectors.select("vec_id", "embedding").filter(x.isNotNull() & (F.size(x) > 0) & F.col("vec_id").isNotNull()).filter(~bad)
    return clean.select("vec_id", F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("q"))


class Block:
    """Candidates of one dimension in vertical layout, with norms of what follows each stride."""

    def __init__(self, ids: list[np.ndarray], rows: list[np.ndarray]) -> None:
        self.ids = np.concatenate(ids)
        self.whole = np.concatenate(rows)
        self.columns = np.ascontiguousarray(self.whole.T, dtype=np.float64)
        dims = len(self.columns)
        squares = np.zeros(len(self.ids))
        rest = []
        for d in range((dims - 1) // STRIDE * STRIDE, -1, -STRIDE):
            rest.append(np.sqrt(squares))
            squares = squares + (self.columns[d : d + STRIDE] ** 2).sum(axis=0)
        self.rest = rest[::-1]
        self.norms = np.sqrt(squares)
        self.longest = float(self.norms.max(initial=0.0))


def bounded(query: np.ndarray, columns: np.ndarray, rest: list[np.ndarray], k: int, first: np.ndarray | None = None, slack: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the candidates that can be among the k best; those that are, are among them.

    ``columns``: dimensions x candidates; ``rest``: norms of what follows each stride;
    ``first``: products of the first stride, if at hand; ``slack``: by how much scores may be off.
    """
    alive = np.arange(columns.shape[1])
    score = np.zeros(len(alive))
    for s, d in enumerate(range(0, len(query), STRIDE)):
        part = columns[d : d + STRIDE]
        add = first if d == 0 and first is not None else query[d : d + STRIDE] @ (part if len(alive) == columns.shape[1] else part[:, alive])
        score = score + add
        left = np.sqrt((query[d + STRIDE :] ** 2).sum())
        if len(alive) > k:
            bound = left * rest[s][alive] * (1 + 1e-9) + 1e-6 + (0 if slack is None else slack[alive])
            lower = np.partition(score - bound, len(score) - k)[len(score) - k]
            keep = score + bound >= lower
            if not keep.all():
                alive, score = alive[keep], score[keep]
    return alive, score


def best(block: Block, ids: np.ndarray, asks: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best candidates of a block for each query (id, row of integers) but those with its own id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    values = asks.astype(np.float64)
    for start in range(0, len(ids), TOGETHER):
        some = values[start : start + TOGETHER]
        firsts = some[:, :STRIDE] @ block.columns[:STRIDE]
        for q, first in enumerate(firsts, start):
            same = int((block.ids == ids[q]).sum())
            size = float(np.sqrt((values[q] ** 2).sum()))
            exact = size * block.longest < EXACT
            alive, score = bounded(values[q], block.columns, block.rest, k + same, first, None if exact else 1e-12 * size * block.norms)
            if same:
                other = block.ids[alive] != ids[q]
                alive, score = alive[other], score[other]
            if not exact:
                score = block.whole[alive].astype(object) @ asks[q].astype(object)
                order = np.array(sorted(range(len(alive)), key=lambda x: (-score[x], block.ids[alive[x]]))[:k], dtype=np.int64)
            else:
                order = np.lexsort((block.ids[alive], -score))[:k]
            out.append((np.full(len(order), ids[q]), block.ids[alive[order]], np.array([int(v) for v in score[order]], dtype=np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])


def search(rows: DataFrame, asked: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row for which ``asked`` holds.

    ``rows``: vec_id, q (array of longs). Every row is a candidate, and rows that
    repeat an id are candidates each; rows with the query's own id are not. Queries
    that repeat an id are answered together, k rows an id. Ties go to the smaller
    vec_id; fewer than k others: all of them. Rows of other dimensions than the
    query's are no candidates. A score beyond 64 bits fails.
    """
    ready(rows.sparkSession)
    sized = written(rows.withColumn("dims", F.size("q")), "rows")
    counted = sized.groupBy("dims").agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("q", lambda v: F.abs(v)))).alias("most")).collect()
    most = max((r["most"] for r in counted), default=0)
    kind = "smallint" if most < 2**15 else "int" if most < 2**31 else "bigint"
    parts: Column = F.lit(1)
    for r in counted:
        size = max(1_024, min(ROW_BLOCK, BLOCK_COMPONENTS // r["dims"]))
        parts = F.when(F.col("dims") == r["dims"], F.lit(-(-r["n"] // size))).otherwise(parts)
    sized = sized.select("vec_id", "dims", F.col("q").cast(f"array<{kind}>").alias("q"))
    # rows are dealt by their place in the table, not by id or content, as a third of them may be alike
    held = sized.select("dims", F.pmod(F.monotonically_increasing_id(), parts).cast("int").alias("part"), F.lit(0).alias("asks"), "vec_id", "q")
    queries = sized.filter(asked).select("dims", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)).alias("part"), F.lit(1).alias("asks"), "vec_id", "q")
    met = held.unionByName(queries).repartition("dims", "part").sortWithinPartitions("dims", "part", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, kept, block = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                dims, part, asks = keys[:, a].tolist()
                if (dims, part) != now:
                    now, ids, kept, block = (dims, part), [], [], None
                some = batch.slice(a, b - a)
                own, q = some.column(3).to_numpy(), some.column(4).flatten().to_numpy().reshape(-1, dims)
                if not asks:
                    ids.append(own)
                    kept.append(q)
                elif ids:
                    block = block or Block(ids, kept)
                    yield best(block, own, q, k)

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    return search(integers(vectors), F.col("vec_id") % EVERY == 0)


ORACLE = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
