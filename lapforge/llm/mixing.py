"""Mixing sources to target weights by weighted fair queueing; DataFrame functions only.

A source's documents queue up in a hashed order, twice, since no document is
taken more than twice. A copy's virtual finish time is the source's running
number of words up to and with it, divided by the source's target, so every
source reaches its target at time 1. All copies are ranged by that time and the
mix takes them until the total budget is reached.

Running sums are made in two steps: sums of small ranges of the order, a running
sum over the ranges, and an exact sum inside a range. A source with a third of
all rows is thereby spread over as many ranges as it needs; of the global order
only the one range in which the budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.llm.common import set_aside, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Rows that one range of an order holds on average.
RANGE_ROWS = 2_000
TIMES = 2_048
#: Steps of virtual time up to which their walk, at most four rows a step, is broadcast; beyond it is joined.
MOST_SHARED = 65_536


def sized(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """uid, doc_id, source, size, and the text's digest. Rows are numbered here, for this table only, unless a column with their uid is given."""
    uid = F.monotonically_increasing_id() if uid is None else uid
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(uid.alias("uid"), "doc_id", "source", size.alias("size"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source: rank, source_size, target, and the total budget.

    Sources in code-point order, null last, get the weights in turn. Targets share
    the budget by weight; those over ``most`` times their source stop there and
    the rest is shared anew. In order of cap by weight the level of the others
    after k capped ones is known; the first level under the next cap holds.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights)))
    weight = F.lit(float(weights[-1]))
    for k, w in enumerate(weights[:-1]):
        weight = F.when(turn == k, F.lit(float(w))).otherwise(weight)
    ranked = total.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    upto = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    level = ranked.withColumns({
        "budget": F.sum("source_size").over(every) * F.lit(float(share)),
        "before": F.sum("cap").over(upto) - F.col("cap"),
        "left": F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"),
    }).withColumn("level", (F.col("budget") - F.col("before")) / F.col("left"))
    holds = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(every)
    return level.select("source", "rank", "source_size", F.least(F.col("weight") * F.coalesce(holds, F.lit(0.0)), F.col("cap")).alias("target"), "budget")


def _ranges(rows: int) -> int:
    return max(64, rows // RANGE_ROWS)


def _part(key: Column, parts: int) -> Column:
    """Range of a hexadecimal key among equal ranges, in the order of the keys."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * F.lit(float(parts))).cast("long")


def take(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """Add source_size, target and ``taken`` (words, repeats counted) to every row of ``sizes``.

    Whole copies are taken, at most two of a document. Documents without words
    take part in nothing: taken is 0. Order within a source: hash of id, text and copy,
    so that rows without an id or with the same one are spread too, then id, size,
    row; equal rows can stand for each other.
    """
    parts = _ranges(sizes.count())
    joined = sizes.join(goal, sizes["source"].eqNullSafe(goal["source"]), "left").drop(goal["source"])
    copies = joined.filter("size > 0").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    key = F.md5(F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", "copy"))
    copies = copies.withColumn("key", key).withColumn("part", _part(F.col("key"), parts))
    sums = copies.groupBy("rank", "copy", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rank").orderBy("copy", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("rank", "copy", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "copy", "part").orderBy("key", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    run = copies.withColumn("inside", F.sum("size").over(inside)).join(starts, ["rank", "copy", "part"])
    timed = run.select("uid", "doc_id", "rank", "copy", "key", "size", "budget", ((F.col("start") + F.col("inside")) / F.col("target")).alias("time"))
    steps = max(TIMES, parts // 8)
    timed = written(timed.withColumn("step", F.floor(F.least("time", F.lit(4.0)) * steps).cast("long")), "timed")
    walk = timed.groupBy("step").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    walk = walk.withColumn("start", F.coalesce(F.sum("words").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    walk = walk.filter("start <= budget").select("step", "start", (F.col("start") + F.col("words") <= F.col("budget")).alias("whole"))
    near = timed.join(F.broadcast(walk) if steps <= MOST_SHARED else walk, "step")
    order = Window.partitionBy("step").orderBy("time", "rank", "copy", "key", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    last = near.filter("not whole").withColumn("at", F.col("start") + F.sum("size").over(order)).filter("at <= budget")
    chosen = near.filter("whole").select("uid", "size").unionByName(last.select("uid", "size"))
    got = chosen.groupBy("uid").agg(F.sum("size").alias("taken"))
    return joined.join(got, "uid", "left").select("uid", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def query(docs: DataFrame) -> DataFrame:
    sizes = written(sized(docs), "sizes")
    return take(sizes, targets(sizes)).select("doc_id", "size", "source_size", "target", "taken")


def stage(docs: DataFrame) -> DataFrame:
    """Documents of the mix, each as many times as it is taken. Rows are numbered once and written.

    Null and empty texts have no words and are not taken, repeated rows are taken each;
    columns come back as they were, an empty table stays empty.
    """
    docs, given = set_aside(docs, "uid", "copy", "copies")
    numbered = written(docs.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    sizes = written(sized(numbered, F.col("uid")), "sizes")
    copies = take(sizes, targets(sizes)).filter("taken > 0").select("uid", (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    return given(numbered.join(copies, "uid").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(text, '')) AS digest, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
  sum(cap) OVER (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING) - cap AS before,
  sum(weight) OVER () - sum(weight) OVER (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING) + weight AS remains FROM w),
v AS (SELECT *, (budget - before) / remains AS level FROM l),
t AS (SELECT source, rank, source_size, budget, least(weight * (SELECT coalesce(max(level), 0) FROM v WHERE level <= cap / weight), cap) AS target FROM v),
c AS (SELECT d.rid, d.doc_id, d.size, t.rank, t.target, t.budget, k.copy, md5(concat(coalesce(d.doc_id::VARCHAR, ''), '#', d.digest, '#', k.copy)) AS key
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (1), (2)) k(copy) WHERE d.size > 0),
f AS (SELECT *, (sum(size) OVER (PARTITION BY rank ORDER BY copy, key, doc_id, size, rid ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS time FROM c),
g AS (SELECT *, sum(size) OVER (ORDER BY time, rank, copy, key, doc_id, size, rid ROWS UNBOUNDED PRECEDING) AS reached FROM f),
m AS (SELECT rid, sum(size)::BIGINT AS taken FROM g WHERE reached <= budget GROUP BY rid)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(m.taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN m USING (rid)
"""
