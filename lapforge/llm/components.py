"""Connected components of a large graph by alternating star operations.

Every round links each node's larger neighbours to its smallest one, then each
node and its smaller neighbours to the smallest; after a number of rounds that
grows with the log of the longest path every node hangs on the smallest of its
component. Each round is two grouped minima and two joins; it is written to the
shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.llm.common import written

MOST_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = _both(edges)
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return pairs.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    joined = pairs.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): the smallest node that each linked node reaches.

    Loops, repeated and reversed links do no harm; nulls are dropped. Nodes
    without a link to another node don't appear.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    last = None
    for _ in range(MOST_ROUNDS):
        now = written(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
