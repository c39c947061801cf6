"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratings_engine.sources import storage


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge, root the least node of its component.

    Each round replaces edges by edges to smaller neighbours and writes them to the shared folder;
    minima are pre-aggregated and joined back, so a node of high degree is split like any skewed join."""
    u, v = F.col("u"), F.col("v")
    edges, path = storage.stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v)
                                .distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionAll(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v)
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        edges, written = storage.stage(small, "edges")
        storage.delete(edges.sparkSession, path)
        path = written
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(u.alias("node"), v.alias("root")).unionAll(
        edges.select(v.alias("node"), v.alias("root")).distinct())
