"""Connected components of an edge table by large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import discard, store

#: Far above the rounds that any real graph needs (they grow with the logarithm of its size).
MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node of its neighbourhood."""
    both = _both_ways(edges)
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Table (node, root): every node of an edge with the smallest node of its component.

    ``edges`` has columns u and v of one orderable type; loops and repeated edges do no harm,
    edges with a NULL end are ignored.  Each round is written to the shared folder, so lost
    executors cost no earlier round, and nothing but two numbers a round reaches the driver.
    """
    now = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        before, now = now, store(_small_star(_large_star(now)), "edges")
        discard(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return _with_roots(now)
        seen = tuple(state)
    raise RuntimeError("components did not settle")


def _with_roots(stars: DataFrame) -> DataFrame:
    return (
        stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .union(stars.select(F.col("v").alias("node"), F.col("v").alias("root")))
        .distinct()
    )
