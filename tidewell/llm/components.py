"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of `edges` (a, b); the label is the least node reachable.

    Alternating large-star and small-star: each step hangs every node's neighbours on the least of
    them, until nothing changes. A node with very many neighbours is reduced to a minimum, never
    collected; the join that gives the minimum back reads a stored table, so that adaptive execution
    splits such a node's edges. An edge with a null end or from a node to itself gives no link.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    edges = materialize(edges.distinct(), "edges")
    seen = _mark(edges)
    while seen[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = (
            both.filter("v > u")
            .join(least.withColumn("m", F.least("u", "m")), "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        large = materialize(large, "large-star")
        least = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = large.join(least, "hi").select(
            F.explode(
                F.array(
                    F.struct(F.col("hi"), F.col("m").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                )
            ).alias("e")
        )
        edges = materialize(small.select("e.*").filter("hi <> lo").distinct(), "small-star")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(roots)
