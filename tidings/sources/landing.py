"""Landed provider items: write, read, normalise, insert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.text import parse_time
from tidings.functions.urls import url_key
from tidings.operators.keyed import first_seen
from tidings.schemas import LANDED_ITEM, PROVIDER_ARTICLE, RAW_ARTICLES

# Names of the providers, in the order their batches are inserted.
PROVIDERS = ("newsapi", "gnews")

#: Items of one landed file at most: a compressed file is read by one task.
FILE_ITEMS = 20_000


def landing_date(logical_date: Column | None = None) -> Column:
    """Landing date of a run: its logical date, or today for a run without one."""
    now = F.current_timestamp()
    at = now if logical_date is None else F.coalesce(logical_date, now)
    return F.date_format(at, "yyyy-MM-dd")


def write_landing(items: DataFrame, path: str) -> None:
    """Write items as compressed JSON lines under ``dt=/run_id=/provider=``.

    The files of a date, run and provider are replaced as a whole, so a rerun leaves one copy.
    ``article`` is a struct or variant and is written as a nested object.
    """
    (
        items.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ITEMS)
        .partitionBy("dt", "run_id", "provider")
        .json(path)
    )


def read_landing(
    spark: SparkSession, path: str, dt: str | None = None, run_id: str | None = None
) -> DataFrame:
    """Landed items, of one date or run if given; only their folders are listed and read.

    ``article`` is read as text, so the provider's object stays as it was landed.
    """
    items = spark.read.schema(LANDED_ITEM).json(path)
    if dt is not None:
        items = items.where(F.col("dt") == dt)
    if run_id is not None:
        items = items.where(F.col("run_id") == run_id)
    return items


def read_array_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed items of files that each hold one JSON array of provider, category, article.

    The position in the array is the ordinal. Such a file is one API call's worth of items; it
    cannot be split, so collectors of much data should write JSON lines.
    """
    element = "array<struct<provider:string,category:string,article:string>>"
    files = spark.read.option("wholetext", True).text(path)
    folders = [name for name in files.columns if name != "value"]
    items = files.select(
        F.posexplode(F.from_json("value", element)).alias("ordinal", "item"), *folders
    )
    return items.select(F.col("ordinal").cast("long").alias("ordinal"), "item.*", *folders)


def tag_items(articles: DataFrame, provider: str, category: Column) -> DataFrame:
    """Envelope of a provider batch: each article with its provider and category."""
    return articles.withColumn("provider", F.lit(provider)).withColumn("category", category)


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of the batches; ``batch`` keeps the order in which they were given."""
    ranked = [df.withColumn("batch", F.lit(rank)) for rank, df in enumerate(batches)]
    result = ranked[0]
    for df in ranked[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def provider_rank(provider: Column) -> Column:
    """Place of a provider in the insert order; unknown providers come last."""
    place = F.array_position(F.array(*[F.lit(name) for name in PROVIDERS]), provider)
    return F.when(place == 0, len(PROVIDERS) + 1).otherwise(place)


def normalise_items(items: DataFrame) -> DataFrame:
    """Common article columns of landed items, without items that have no URL.

    Only one provider has its own field names; all others are read by the common ones. Rows
    keep ``batch_rank`` and ``ordinal``, the order in which they count as seen.
    """
    rows = _article_columns(items)
    with_url = rows.where(F.col("url").isNotNull() & (F.col("url") != ""))
    return with_url.withColumn("url_hash", url_key(F.col("url")))


def _article_columns(items: DataFrame, *kept: str) -> DataFrame:
    """Common article columns of each landed item, and the columns ``kept``."""
    article = F.from_json("article", PROVIDER_ARTICLE)
    read = items.withColumn("_a", article)
    is_gnews = F.col("provider") == "gnews"
    at = F.col("_a.publishedAt")
    return read.select(
        F.when(~is_gnews, F.col("_a.source.id")).alias("source_id"),
        F.col("_a.source.name").alias("source_name"),
        F.when(~is_gnews, F.col("_a.author")).alias("author"),
        F.col("_a.title").alias("title"),
        F.col("_a.description").alias("description"),
        F.col("_a.content").alias("content"),
        F.col("_a.url").alias("url"),
        F.when(is_gnews, F.col("_a.image")).otherwise(F.col("_a.urlToImage")).alias(
            "url_to_image"
        ),
        parse_time(at).alias("published_at"),
        (at.isNotNull() & parse_time(at).isNull()).alias("has_bad_time"),
        "category",
        F.col("provider").alias("source_provider"),
        F.col("article").alias("raw_payload"),
        provider_rank(F.col("provider")).alias("batch_rank"),
        "ordinal",
        *kept,
    )


def item_keys(items: DataFrame, *kept: Column | str) -> DataFrame:
    """Key and insert order of the items that have a URL, and the columns ``kept``.

    Only the URLs are read from the articles.
    """
    url = F.from_json("article", PROVIDER_ARTICLE)["url"]
    rank = provider_rank(F.col("provider")).alias("batch_rank")
    return items.where(url != "").select(url_key(url).alias("url_hash"), rank, "ordinal", *kept)


def insert_rows(
    rows: DataFrame, target: DataFrame | None, run_id: Column, fetched_at: Column
) -> DataFrame:
    """Rows to append to the raw table: the first of each key the table does not hold yet.

    NewsAPI items come before GNews items, then the landed order counts. Inserting the same
    batch again yields nothing, and known rows keep the run that inserted them.
    """
    fresh = first_seen(rows, target, "url_hash", ["batch_rank", "ordinal"])
    return _stamped(fresh, run_id, fetched_at)


def insert_items(
    items: DataFrame, target: DataFrame | None, run_id: Column, fetched_at: Column
) -> DataFrame:
    """:func:`insert_rows` of landed items: an article is shuffled as its payload and read afterwards."""
    keyed = item_keys(items, "category", "provider", "article")
    fresh = first_seen(keyed, target, "url_hash", ["batch_rank", "ordinal"])
    # No filter after the fold asks for the articles, so that a count of the rows does not shuffle them.
    return _stamped(_article_columns(fresh, "url_hash"), run_id, fetched_at)


def _stamped(fresh: DataFrame, run_id: Column, fetched_at: Column) -> DataFrame:
    stamped = (
        fresh.withColumn("ingestion_run_id", run_id)
        .withColumn("fetched_at", fetched_at)
        .withColumn("created_at", fetched_at)
    )
    return stamped.select(*RAW_ARTICLES.fieldNames())


def insert_counts(rows: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: articles with a URL, newly inserted ones, and duplicates."""
    seen = rows.agg(F.count(F.lit(1)).alias("rows_seen")).scalar()
    counted = inserted.agg(F.count(F.lit(1)).alias("rows_new"))
    return counted.select(
        seen.alias("rows_seen"), "rows_new", (seen - F.col("rows_new")).alias("rows_duplicate")
    )


def run_rows(source: DataFrame, run_id: str, columns: list[str] | None = None) -> DataFrame:
    """One run's rows of ``source``, to append to another table.

    The filter reaches the scan of ``source``: its folder when the table is partitioned by run.
    A run without rows appends nothing.
    """
    names = columns or RAW_ARTICLES.fieldNames()
    return source.where(F.col("ingestion_run_id") == run_id).select(*names)


def item_counts(items: DataFrame) -> tuple[int, int]:
    """Landed items, and those with a URL; only the URLs are read from the articles."""
    url = F.from_json("article", PROVIDER_ARTICLE)["url"]
    row = items.agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(url != "").alias("with_url")
    ).first()
    return row.fetched, row.with_url
