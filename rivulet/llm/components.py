"""Connected components by contraction, every round on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b): the smallest id it reaches.

    In each round a vertex joins the neighbour (or itself) of the smallest hash, seeded by
    the round, and links between joined vertices are contracted; links shrink by a constant
    factor on average, long chains too. Minima are combined before the shuffle, so a vertex
    with many links is no single task. Ids must not be null.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "components-links")
    joined = None
    seed = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        low = both.groupBy("u").agg(F.min(rank("v")).alias("low"))
        to = written(
            low.select("u", F.least("low", rank("u"))["id"].alias("to")), f"components-join{seed}"
        )
        if joined is None:
            joined = to.select(F.col("u").alias("id"), F.col("to").alias("label"))
        else:
            step = to.select(F.col("u").alias("label"), "to")
            joined = joined.join(step, "label", "left").select(
                "id", F.coalesce("to", "label").alias("label")
            )
        joined = written(joined, f"components-labels{seed}")
        ends = edges.join(to.select(F.col("u").alias("a"), F.col("to").alias("x")), "a").join(
            to.select(F.col("u").alias("b"), F.col("to").alias("y")), "b"
        )
        edges = written(
            ends.where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            f"components-links{seed}",
        )
        seed += 1
    if joined is None:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component"))
    smallest = joined.groupBy("label").agg(F.min("id").alias("component"))
    return joined.join(smallest, "label").select("id", "component")
