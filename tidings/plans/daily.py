"""The daily job on catalog tables: landed files to marts, stories, prompts and summaries.

Each step reads tables, writes one table and returns its counts, so that a failed step can be
run again. Rerunning a finished step adds nothing.
"""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators.keyed import above_watermark, fold_runs, fold_votes, split_votes
from tidings.operators.quality import quality_report
from tidings.plans import enrichment, history, layers, serving
from tidings.plans.stories import assignment_rows, story_clusters
from tidings.session import materialize, scratch
from tidings.sources import landing, tables

RAW = "raw.newsapi_articles"
#: Buckets of the index of the raw table's keys; one number for the life of the table.
KEY_BUCKETS = 64
STAGE = "stg_articles"
ODS = "ods.ods_articles"
SOURCES = "mart.dim_source"
MART = "mart.mart_articles"
DAILY = "mart.mart_daily_stats"
CLUSTERS = "mart.article_clusters"
MEDIA = "mart.story_media"
SUMMARIES = "mart.summary_clusters"
RUN_EVENTS = "raw.run_events"
FEEDBACK_EVENTS = "raw.feedback_events"
ANSWERS = "raw.llm_answers"
KEY = "url_hash"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _step(function: Callable[..., dict]) -> Callable[..., dict]:
    """The tables on the way of a step are deleted at its end."""
    @wraps(function)
    def run(spark: SparkSession, *given, **named) -> dict:
        with scratch(spark):
            return function(spark, *given, **named)

    return run


@contextmanager
def track(
    spark: SparkSession, run_id: str, task_id: str, try_number: int = 1, dag_id: str = "daily",
    execution_date: datetime | None = None,
) -> Iterator[dict]:
    """Log a step: an open event at its start, a close event with its counts at its end.

    The step puts its counts into the yielded dictionary. An error is logged and raised again.
    """
    start = _now()
    number = int(start.timestamp() * 1_000_000)
    opened = history.open_event(
        spark, run_id, task_id, try_number, dag_id, start, number, execution_date
    )
    tables.append_table(opened, RUN_EVENTS)
    counts: dict = {}
    status, error = "success", None
    try:
        yield counts
    except Exception:
        status, error = "failed", traceback.format_exc()
        raise
    finally:
        extra = json.dumps(counts.get("metadata", {}))
        closed = history.close_event(
            spark, run_id, task_id, try_number, _now(), number + 1, status, counts, error, extra
        )
        tables.append_table(closed, RUN_EVENTS)


def run_log(spark: SparkSession) -> DataFrame:
    return fold_runs(tables.read(spark, RUN_EVENTS))


@_step
def ingest(spark: SparkSession, path: str, run_id: str, dt: str | None = None) -> dict:
    """Insert a run's landed items into the raw table."""
    items = landing.read_landing(spark, path, dt, run_id)
    now = F.lit(_now()).cast("timestamp")
    # The stored side of the anti-join is read by bucket, without a shuffle.
    known = tables.known_keys(spark, RAW, KEY, "ingestion_run_id", KEY_BUCKETS)
    fresh = landing.insert_items(items, known, F.lit(run_id), F.date_trunc("second", now))
    # The rows of a run share a folder, so a copy of one run reads that folder only.
    new = tables.append_table(fresh, RAW, "ingestion_run_id")
    fetched, with_url = landing.item_counts(items)
    return {"fetched": fetched, "new": new, "duplicate": with_url - new}


@_step
def refresh_layers(spark: SparkSession, buckets: int = 0) -> dict:
    """Stage view, incremental ODS, dimension, mart and daily counts.

    The ODS table is append-only: a step appends the newest version of every raw row above the
    watermark, and its readers take the newest version of a key. That equals replacing the
    keys, without writing the whole table again. Versions are chosen after the watermark
    filter, which keeps the newest version of a key whenever it is new, so that old raw rows
    are not shuffled. With buckets the readers need no shuffle either.
    """
    stage = layers.stage_articles(tables.read(spark, RAW))
    tables.publish_view(stage, STAGE)
    known = tables.stored(spark, ODS)
    fresh = stage if known is None else above_watermark(stage, known, "fetched_at")
    tables.append_table(
        layers.current_articles(fresh), ODS, key=KEY, buckets=buckets, sequence=True, sources=[STAGE]
    )
    ods = current_ods(spark)
    sources = tables.publish_table(layers.source_dimension(ods), SOURCES)
    mart = tables.publish_table(layers.mart_articles(ods, sources), MART, KEY, buckets)
    tables.publish_table(layers.daily_stats(mart), DAILY)
    named = {"articles": MART, "sources": SOURCES, "days": DAILY}
    return {key: tables.rows_published(spark, name) for key, name in named.items()}


def current_ods(spark: SparkSession) -> DataFrame:
    """Newest version of each deduplicated article."""
    return layers.current_articles(tables.read(spark, ODS), tables.SEQUENCE).drop(tables.SEQUENCE)


def check_layers(spark: SparkSession) -> DataFrame:
    """Data tests of the layers."""
    return quality_report(
        {
            "stage": (tables.read(spark, STAGE), [KEY, "url"], [KEY]),
            "ods": (current_ods(spark), [KEY, "title", "url"], [KEY]),
            "mart": (tables.read(spark, MART), [KEY, "url"], [KEY]),
            "dim_source": (tables.read(spark, SOURCES), ["source_name"], ["source_name"]),
        }
    )


@_step
def cluster(spark: SparkSession, buckets: int = 0) -> dict:
    """Publish the assignment of all articles to stories, and the media of each story.

    Every run assigns every article, so the table is replaced; its rows are the newest version
    of each key without a fold. The media are a table, so that a page of the feed reads stories
    and not all articles.
    """
    found = story_clusters(tables.read(spark, MART))
    rows = assignment_rows(found, F.date_trunc("second", F.lit(_now()).cast("timestamp")))
    assigned = tables.publish_table(rows, CLUSTERS, KEY, buckets)
    tables.publish_table(serving.story_media(assigned, tables.read(spark, MART)), MEDIA)
    written = tables.rows_published(spark, CLUSTERS)
    return {"fetched": written, "new": written}


def feed(spark: SparkSession) -> DataFrame:
    """Cards of all successful stories, for the pages and rankings of ``serving``."""
    return serving.cards(_summaries(spark), tables.read(spark, MEDIA))


def _summaries(spark: SparkSession) -> DataFrame:
    known = tables.stored(spark, SUMMARIES)
    if known is None:
        known = spark.createDataFrame([], enrichment.SUMMARY_CLUSTERS)
        return enrichment.current_summaries(known)
    return enrichment.current_summaries(known, tables.SEQUENCE).drop(tables.SEQUENCE)


def pending(spark: SparkSession) -> DataFrame:
    """Numbered member articles of the stories without a summary."""
    return enrichment.pending_members(
        tables.read(spark, CLUSTERS), tables.read(spark, MART), _summaries(spark)
    )


def receive_answers(spark: SparkSession, responses: DataFrame) -> int:
    """Append answers of the model as they arrive; an attempt may come again."""
    columns = ["cluster_id", "attempt", "raw_text", "error"]
    return tables.append_table(responses.select(*columns), ANSWERS, sequence=True)


@_step
def record_answers(spark: SparkSession, responses: DataFrame | None, model: str) -> dict:
    """Append one outcome per pending story and count them.

    Without ``responses`` the received answers count, and of one attempt the one received last.
    Put the counts into the run log, then call :func:`require_success` on them.
    """
    now = F.date_trunc("second", F.lit(_now()).cast("timestamp"))
    if responses is None:
        responses = tables.read(spark, ANSWERS)
    order = [tables.SEQUENCE] if tables.SEQUENCE in responses.columns else []
    rows = enrichment.outcomes(pending(spark), responses, F.lit(model), now, order)
    rows = materialize(rows, "outcomes")
    tables.append_table(rows, SUMMARIES, sequence=True, sources=[CLUSTERS, MART, ANSWERS])
    counts = enrichment.enrichment_counts(rows).first()
    return {"fetched": counts.attempted, "new": counts.succeeded, "failed": counts.failed,
            "is_over_limit": counts.is_over_limit}


def require_success(counts: dict) -> None:
    """Raise when too many stories failed."""
    if counts["is_over_limit"]:
        raise RuntimeError(f"enrichment failed for {counts['failed']} of {counts['fetched']}")


def current_votes(spark: SparkSession) -> DataFrame:
    allowed, _ = split_votes(tables.read(spark, FEEDBACK_EVENTS))
    return fold_votes(allowed)
