"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected `edges` (a, b); root is the component's smallest node.

    Alternates two star steps (Kiveris and others, 2014): each hangs the neighbours of a node on the
    smallest one, first the larger neighbours, then the smaller. Rounds grow with the logarithm of the
    longest chain; the edges never grow in number. Each round is written to the shared folder. Loops, null
    ends and repeated edges are ignored; an empty table gives an empty one.
    """
    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = written(current.where("a is not null and b is not null and u > v").distinct(), "edges")
    before = _signature(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = written(moved.union(low).distinct(), "small-star")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
