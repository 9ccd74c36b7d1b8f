"""Stories: articles grouped by similar titles published close together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.operators.similarity import USUAL, Limits, title_components, title_nodes, title_rows
from tidings.operators.skew import join_spread
from tidings.session import hand_over, scratch


def story_clusters(articles: DataFrame, limits: Limits = USUAL) -> DataFrame:
    """``(url_hash, cluster_id)`` for every article.

    Articles are linked when their titles have a Jaccard index of at least 1/2 and their times
    are at most 24 hours apart or one is unknown. A story is a connected set of articles; its
    id is the key of its earliest member (unknown time first, then smallest key). A story may
    span more than 24 hours through intermediate articles.
    """
    rows = title_rows(articles)
    with scratch(articles.sparkSession):
        nodes = title_nodes(rows)
        labels = title_components(nodes, limits)
        stories = hand_over(_story_of_nodes(nodes, labels), "stories")
    # A title of the day may have any number of copies: with a written table on one side and
    # the articles on the other, the skew join can split its rows.
    return (
        rows.select("url_hash", "title_key", "day")
        .join(stories, ["title_key", "day"], "left")
        .select("url_hash", F.coalesce("cluster_id", "url_hash").alias("cluster_id"))
    )


def _story_of_nodes(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Story of each node; only linked nodes are aggregated, the others are their own story."""
    heads = (
        labels.join(nodes.select("id", "first"), "id")
        .groupBy("label")
        .agg(F.min("first").alias("head"))
    )
    linked = join_spread(labels, heads, ["label"], "id").select("id", "head")
    return nodes.select("id", "title_key", "day", "first").join(linked, "id", "left").select(
        "title_key", "day", F.coalesce("head", "first")["url_hash"].alias("cluster_id")
    )


def assignment_rows(clusters: DataFrame, computed_at: Column) -> DataFrame:
    """Rows to append to the assignment table."""
    return clusters.select("url_hash", "cluster_id", computed_at.alias("computed_at"))
