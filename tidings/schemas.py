"""Table schemas. The comment of a field is its entry in the column catalog."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name, kind, comment, nullable=True):
    return T.StructField(name, kind, nullable, {"comment": comment})


_TEXT = T.StringType()
_TIME = T.TimestampType()
_INT = T.IntegerType()
_LONG = T.LongType()
_TEXTS = T.ArrayType(T.StringType(), containsNull=False)

SOURCE = T.StructType([T.StructField("id", _TEXT), T.StructField("name", _TEXT)])

#: Superset of the article objects of all providers; a field a provider lacks reads as NULL.
PROVIDER_ARTICLE = T.StructType(
    [
        T.StructField("source", SOURCE),
        T.StructField("author", _TEXT),
        T.StructField("title", _TEXT),
        T.StructField("description", _TEXT),
        T.StructField("content", _TEXT),
        T.StructField("url", _TEXT),
        T.StructField("urlToImage", _TEXT),
        T.StructField("image", _TEXT),
        T.StructField("publishedAt", _TEXT),
    ]
)

#: One landed item. ``article`` is read as text, so the provider's object is kept as it came.
LANDED_ITEM = T.StructType(
    [
        _field("ordinal", T.LongType(), "position of the item in its provider's batch"),
        _field("category", _TEXT, "category the item was requested under"),
        _field("article", _TEXT, "the provider's article object as JSON text"),
        _field("dt", _TEXT, "landing date"),
        _field("run_id", _TEXT, "ingestion run"),
        _field("provider", _TEXT, "provider of the item"),
    ]
)

RAW_ARTICLES = T.StructType(
    [
        _field("url_hash", _TEXT, "SHA-256 of the canonical URL, the key of every layer", False),
        _field("source_id", _TEXT, "provider's id of the outlet, often missing"),
        _field("source_name", _TEXT, "outlet name"),
        _field("author", _TEXT, "author line"),
        _field("title", _TEXT, "headline as delivered"),
        _field("description", _TEXT, "short summary as delivered"),
        _field("content", _TEXT, "article body as delivered"),
        _field("url", _TEXT, "article URL as delivered", False),
        _field("url_to_image", _TEXT, "image URL"),
        _field("published_at", _TIME, "publish time stated by the outlet"),
        _field("category", _TEXT, "category the article was requested under"),
        _field("source_provider", _TEXT, "provider that delivered the article"),
        _field("fetched_at", _TIME, "time of the fetch; the version of a row", False),
        _field("raw_payload", _TEXT, "provider's article object as JSON text", False),
        _field("ingestion_run_id", _TEXT, "run that inserted the row", False),
        _field("created_at", _TIME, "time the row was written", False),
    ]
)

STAGE_ARTICLES = T.StructType(
    [
        _field("url_hash", _TEXT, "key of the article", False),
        _field("source_id", _TEXT, "provider's id of the outlet"),
        _field("source_name", _TEXT, "outlet name"),
        _field("author", _TEXT, "author line"),
        _field("title", _TEXT, "headline without surrounding spaces"),
        _field("description", _TEXT, "short summary without surrounding spaces"),
        _field("content", _TEXT, "article body as delivered"),
        _field("is_content_truncated", T.BooleanType(), "body is 260 bytes or longer"),
        _field("url", _TEXT, "article URL as delivered", False),
        _field("url_domain", _TEXT, "host of the URL, empty when there is none"),
        _field("url_to_image", _TEXT, "image URL"),
        _field("published_at", _TIME, "publish time stated by the outlet"),
        _field("category", _TEXT, "category the article was requested under"),
        _field("source_provider", _TEXT, "provider that delivered the article"),
        _field("fetched_at", _TIME, "time of the fetch", False),
        _field("ingestion_run_id", _TEXT, "run that inserted the row", False),
    ]
)

MART_ARTICLES = T.StructType(
    [
        _field("url_hash", _TEXT, "key of the article", False),
        _field("title", _TEXT, "headline"),
        _field("description", _TEXT, "short summary"),
        _field("content", _TEXT, "article body"),
        _field("is_content_truncated", T.BooleanType(), "body is 260 bytes or longer"),
        _field("url", _TEXT, "article URL", False),
        _field("url_domain", _TEXT, "host of the URL"),
        _field("url_to_image", _TEXT, "image URL"),
        _field("published_at", _TIME, "publish time"),
        _field("category", _TEXT, "category"),
        _field("source_provider", _TEXT, "provider"),
        _field("source_id", _TEXT, "id of the outlet from the source dimension"),
        _field("source_name", _TEXT, "outlet name of the article, may be missing"),
        _field("fetched_at", _TIME, "time of the fetch", False),
    ]
)

SOURCE_DIMENSION = T.StructType(
    [
        _field("source_name", _TEXT, "outlet name; Unknown stands for a missing one", False),
        _field("source_id", _TEXT, "one provider id seen for the outlet"),
        _field("sample_domain", _TEXT, "one host seen for the outlet"),
    ]
)

DAILY_STATS = T.StructType(
    [
        _field("published_date", T.DateType(), "publish date (UTC)"),
        _field("source_name", _TEXT, "outlet name"),
        _field("article_count", T.LongType(), "articles of that outlet on that date"),
    ]
)

ARTICLE_CLUSTERS = T.StructType(
    [
        _field("url_hash", _TEXT, "key of the article", False),
        _field("cluster_id", _TEXT, "key of the earliest member of the story", False),
        _field("computed_at", _TIME, "version of the assignment", False),
    ]
)

STORY_MEDIA = T.StructType(
    [
        _field("cluster_id", _TEXT, "key of the story", False),
        _field("first_published_at", _TIME, "earliest publish time of its articles"),
        _field("image_url", _TEXT, "one image of its articles"),
    ]
)

PERSPECTIVE = T.StructType([T.StructField("url_hash", _TEXT), T.StructField("focus", _TEXT)])

SUMMARY_CLUSTERS = T.StructType(
    [
        _field("cluster_id", _TEXT, "key of the story", False),
        _field("summary", _TEXT, "summary of the story", False),
        _field("keywords", _TEXTS, "keywords", False),
        _field("topic", _TEXT, "topic label", False),
        _field("sentiment", _TEXT, "sentiment label", False),
        _field("sentiment_score", T.FloatType(), "sentiment from -1 to 1, not checked"),
        _field("llm_model", _TEXT, "model that produced the response", False),
        _field("enrichment_status", _TEXT, "success or failed", False),
        _field("raw_llm_response", _TEXT, "response or error text of a failed attempt"),
        _field("article_count", _LONG, "members at the time of the enrichment", False),
        _field("enriched_at", _TIME, "version of the row", False),
        _field("key_facts_organizations", _TEXTS, "organisations named", False),
        _field("key_facts_locations", _TEXTS, "places named", False),
        _field("key_facts_people", _TEXTS, "people named", False),
        _field("why_it_matters", _TEXT, "analysis", False),
        _field("before_state", _TEXT, "situation before the event"),
        _field("after_state", _TEXT, "situation after the event"),
        _field("consensus_points", _TEXTS, "points the sources agree on", False),
        _field("disagreement_points", _TEXTS, "points the sources disagree on", False),
        _field("source_perspectives", T.ArrayType(PERSPECTIVE), "focus of each source", False),
    ]
)

FEEDBACK = T.StructType(
    [
        _field("user_id", T.LongType(), "reader", False),
        _field("cluster_id", _TEXT, "story", False),
        _field("vote", T.ShortType(), "1 or -1", False),
        _field("created_at", _TIME, "time of the last vote", False),
    ]
)

RUN_LOG = T.StructType(
    [
        _field("run_id", _TEXT, "run", False),
        _field("task_id", _TEXT, "task of the run", False),
        _field("try_number", _INT, "attempt of the task", False),
        _field("dag_id", _TEXT, "job the task belongs to", False),
        _field("execution_date", _TIME, "logical date of the run", False),
        _field("started_at", _TIME, "start of the attempt", False),
        _field("finished_at", _TIME, "end of the attempt"),
        _field("status", _TEXT, "running, success or failed", False),
        _field("rows_fetched", _LONG, "rows read"),
        _field("rows_new", _LONG, "rows added"),
        _field("rows_duplicate", _LONG, "rows already known"),
        _field("rows_failed", _LONG, "rows that failed"),
        _field("error_message", _TEXT, "error text, at most 4000 characters"),
        _field("extra_metadata", _TEXT, "further facts as JSON text"),
    ]
)

#: Tables by layer; one namespace per layer.
LAYERS = {
    "raw.newsapi_articles": RAW_ARTICLES,
    "stage.stg_articles": STAGE_ARTICLES,
    "ods.ods_articles": STAGE_ARTICLES,
    "mart.mart_articles": MART_ARTICLES,
    "mart.dim_source": SOURCE_DIMENSION,
    "mart.mart_daily_stats": DAILY_STATS,
    "mart.article_clusters": ARTICLE_CLUSTERS,
    "mart.story_media": STORY_MEDIA,
    "mart.summary_clusters": SUMMARY_CLUSTERS,
    "feedback": FEEDBACK,
    "run_log": RUN_LOG,
}
