"""Connected components of an edge table by alternating stars, without a hot task at a hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.work import WorkTables


def components(edges: DataFrame) -> DataFrame:
    """node and the least node of its component, for every node of the edges (a, b); loops and repeated edges change nothing.

    In a step each node's least neighbour is counted with map-side combine and stored, and only then joined with the
    edges: both sides of the join are then plain shuffles, so that Spark splits the edges of a hub over several tasks.
    """
    work = WorkTables(edges.sparkSession, "components")

    def star(e: DataFrame, name: str, larger: bool) -> DataFrame:
        if larger:
            e = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = work.store(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-least")
        joined = e.join(least, "a")
        if larger:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return work.store(out.filter("a <> b").distinct(), name)

    edges, state = work.store(edges.filter("a <> b").select("a", "b").distinct(), "edges"), None
    while True:
        edges = star(star(edges, "large", True), "small", False)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            work.drop(edges)
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
