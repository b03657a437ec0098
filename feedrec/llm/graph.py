"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import store


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): component is
    the smallest node reachable. Alternating star contraction: each round links
    larger neighbours, then smaller ones, to the least node known; the edge
    count never grows and the rounds are about the logarithm of the longest
    path. Every round is a written table, so no lineage builds up. A hub's
    minimum is a partial aggregate, so a node that holds a third of all edges
    does not meet in one task, and its row is joined back by a skew-split join."""
    e = store(_ordered(edges), "components")
    mark = None
    while True:
        # large star: every neighbour above the node goes to the least of the node and its neighbours
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: the node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        e = store(_ordered(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                           .unionByName(least.select("a", F.col("m").alias("b")))), "components")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
