"""Connected components by star contraction (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators.skew import heavy_pieces, join_spread, materialize_sketched


def _smallest_neighbour(edges: DataFrame, include_self: bool) -> DataFrame:
    smallest = F.min("v")
    if include_self:
        smallest = F.least(F.col("u"), smallest)
    return edges.groupBy("u").agg(smallest.alias("m"))


def _large_star(edges: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = _smallest_neighbour(both, include_self=True)
    # The hub of a star must not be one task's work.
    joined = join_spread(both, smallest, ["u"], "v", heavy=heavy)
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = _smallest_neighbour(edges, include_self=False)
    joined = join_spread(edges, smallest, ["u"], "v", heavy=heavy)
    moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node points to exactly one node, and that one points nowhere."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("is_root"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("is_root"))
    )
    nodes = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("is_root").alias("is_root"))
    return nodes.where(F.col("out") + F.col("is_root") > 1).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` of every node with an edge; the label is the smallest id it reaches.

    ``edges`` has two long columns. The result of each star step is written to the work folder; the
    number of rounds grows with the logarithm of the component sizes. While a step is written, a
    sketch finds the hubs, and the next step cuts these alone. Only their counts, which are bounded,
    and the answer whether another round is needed come back to the driver.
    """
    a, b = edges.columns
    current = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    current, counts = materialize_sketched(current, "edges", ["u", "v"])
    settled = False
    while not settled:
        # A node of an edge is looked at from both ends.
        stars = _large_star(current, heavy_pieces(counts["u"], counts["v"]))
        stars, counts = materialize_sketched(stars, "large-stars", ["u"])
        stars = _small_star(stars, heavy_pieces(counts["u"]))
        current, counts = materialize_sketched(stars, "small-stars", ["u", "v"])
        settled = _is_settled(current)
    roots = current.select(F.col("v").alias("id")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        roots.select("id", F.col("id").alias("label"))
    )
