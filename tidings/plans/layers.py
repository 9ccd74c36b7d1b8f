"""Raw rows to stage, deduplicated articles and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.text import is_truncated
from tidings.functions.urls import url_host
from tidings.operators.keyed import above_watermark, delete_insert, latest
from tidings.operators.skew import join_spread
from tidings.schemas import MART_ARTICLES, STAGE_ARTICLES

UNKNOWN_SOURCE = "Unknown"


def current_articles(raw: DataFrame, sequence: str | None = None) -> DataFrame:
    """Newest version of each article; of equal times the one inserted last."""
    order = ["fetched_at"] + ([sequence] if sequence else [])
    return latest(raw, ["url_hash"], order)


def stage_articles(raw: DataFrame) -> DataFrame:
    """Cleaned article columns; one map step without a shuffle."""
    return raw.select(
        "url_hash", "source_id", "source_name", "author",
        F.trim("title").alias("title"),
        F.trim("description").alias("description"),
        "content",
        is_truncated(F.col("content")).alias("is_content_truncated"),
        "url",
        url_host(F.col("url")).alias("url_domain"),
        "url_to_image", "published_at", "category", "source_provider", "fetched_at",
        "ingestion_run_id",
    ).select(*STAGE_ARTICLES.fieldNames())


def ods_articles(stage: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Deduplicated articles after an incremental step.

    Takes the stage rows newer than every existing row; on the first build all of them.
    """
    if existing is None:
        return stage
    return delete_insert(existing, above_watermark(stage, existing, "fetched_at"), "url_hash")


def source_dimension(ods: DataFrame) -> DataFrame:
    """One row per outlet; a missing name is one outlet of its own.

    The smallest known id and host stand for "any", so that the result is repeatable.
    """
    return ods.groupBy(
        F.coalesce("source_name", F.lit(UNKNOWN_SOURCE)).alias("source_name")
    ).agg(F.min("source_id").alias("source_id"), F.min("url_domain").alias("sample_domain"))


def mart_articles(ods: DataFrame, dimension: DataFrame) -> DataFrame:
    """Articles with the outlet id of the dimension.

    An outlet may hold a large share of the articles, so its rows are spread before the join;
    the dimension is broadcast only if it turns out small at run time.
    """
    articles = ods.drop("source_id").withColumn(
        "_outlet", F.coalesce("source_name", F.lit(UNKNOWN_SOURCE))
    )
    ids = dimension.select(F.col("source_name").alias("_outlet"), "source_id")
    joined = join_spread(articles, ids, ["_outlet"], "url_hash", "left")
    return joined.select(*MART_ARTICLES.fieldNames())


def daily_stats(mart: DataFrame) -> DataFrame:
    """Articles per publish date and outlet; a missing outlet is a group of its own."""
    return (
        mart.where(F.col("published_at").isNotNull())
        .groupBy(F.to_date("published_at").alias("published_date"), "source_name")
        .agg(F.count(F.lit(1)).alias("article_count"))
    )
