"""Connected components by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node around it, small-star every
smaller one. Both keep the components and shrink the graph to stars around their smallest nodes. The
steps are an aggregate and a join each, so a node with many neighbours is never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for nodes that are not the smallest themselves.

    ``edges``: pairs ``a``, ``b`` of whole numbers. Loops, repeats and null ends are ignored; no edges give no rows.
    """
    stage = Stage(edges.sparkSession, "components")
    now = stage.keep("edges", edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        after = stage.keep("edges", _small_star(_large_star(now)))
        # Equal stars in two rounds: nothing moves any more.
        new = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 30)), F.sum(F.xxhash64("b", "a") % F.lit(1 << 30))).first()
        now = after
        if new == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = new
