"""Connected components of a graph given by links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): for each node of a link the smallest node that links lead to.

    Alternates large-star and small-star rounds until the links are stars about their roots. Each round is written to
    the shared folder. Minima are combined before the shuffle and written before they are joined, so that both sides of
    a join are plain shuffles and adaptive execution can deal out a node with very many links. Nulls and links to oneself
    are left out.
    """
    spark = links.sparkSession
    u, v = F.col(left).cast("long"), F.col(right).cast("long")
    first = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(u.isNotNull() & v.isNotNull() & (u != v)).distinct()
    edges = materialize(first, spark)
    state = _state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), spark)
        large = materialize(both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), spark)
        lower = materialize(large.groupBy("u").agg(F.min("v").alias("m")), spark)
        moved = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = materialize(moved.unionAll(lower.select("u", F.col("m").alias("v"))).distinct(), spark)
        discard(least, spark)
        discard(lower, spark)
        discard(large, spark)
        discard(edges, spark)
        edges, before, state = small, state, _state(small)
        if state == before:
            break
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out._skein_path = edges._skein_path  # the caller may discard() it when done
    return out
