"""The registered queries: each operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import views as v
from tidings.functions import text, urls
from tidings.functions.labels import age_label
from tidings.operators import keyed, quality
from tidings.operators.similarity import Limits
from tidings.plans import daily, enrichment, history, layers, serving, stories
from tidings.schemas import DAILY_STATS, LANDED_ITEM, MART_ARTICLES, SOURCE_DIMENSION
from tidings.session import configure, materialize, scratch, temporary_path
from tidings.sources import landing, tables
from tidings.streaming import jobs

AS_OF = "2024-01-20 00:00:00"
HOT_LIMITS = Limits(group=4, pivots=2, pieces=4)


def _joined(column):
    """An array of texts as one text, so that results compare as scalars."""
    return F.array_join(column, "|")


# ---- landing and layers

def _land(spark: SparkSession, folder: str) -> str:
    path = temporary_path(spark, "landing")
    batches = landing.union_batches(
        v.landed_objects(v.page_batch(spark, folder), "newsapi").withColumn(
            "article", F.to_variant_object("article")
        ),
        v.landed_objects(v.second_page_batch(spark, folder), "gnews").withColumn(
            "article", F.to_variant_object("article")
        ),
    )
    landing.write_landing(batches.drop("batch"), path)
    return path


def landed_items(spark: SparkSession, folder: str) -> DataFrame:
    items = landing.read_landing(spark, _land(spark, folder), dt="2024-01-01", run_id="run-1")
    rows = landing.normalise_items(items)
    return rows.select(
        "source_provider", F.col("ordinal").cast("long").alias("ordinal"), "url_hash",
        "source_id", "source_name", "author", "title", "description",
        F.md5("content").alias("content_md5"), "url", "url_to_image",
        v.time_text("published_at").alias("published_at"), "has_bad_time", "category",
    )


def first_seen_pages(spark: SparkSession, folder: str) -> DataFrame:
    items = landing.read_landing(spark, _land(spark, folder))
    rows = landing.normalise_items(items)
    inserted = landing.insert_rows(rows, None, F.lit("run-1"), F.current_timestamp())
    return inserted.select("url_hash", "url", "source_provider", "ingestion_run_id")


def landed_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The provider's own object of each item, as it was landed, with the tags of its batch."""
    batches = []
    for rows, provider in ((v.page_batch, "newsapi"), (v.second_page_batch, "gnews")):
        objects = v.landed_objects(rows(spark, folder), provider)
        own = objects.withColumn("article", F.to_variant_object("article"))
        batches.append(landing.tag_items(own.drop("provider", "category"), provider, F.lit("wire")))
    path = temporary_path(spark, "landing")
    landing.write_landing(landing.union_batches(*batches).drop("batch"), path)
    rows = landing.normalise_items(landing.read_landing(spark, path))
    payload = F.col("raw_payload")
    names = F.array_join(F.array_sort(F.json_object_keys(payload)), "|")
    return rows.select(
        "source_provider", F.col("ordinal").cast("long").alias("ordinal"), "category",
        names.alias("names"), F.get_json_object(payload, "$.source.name").alias("outlet"),
        F.get_json_object(payload, "$.url").alias("url"),
        F.get_json_object(payload, "$.publishedAt").alias("published"),
        F.md5(F.get_json_object(payload, "$.content")).alias("content_md5"),
    )


def rerun_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of inserting one provider's pages, then both providers' into the same table."""
    items = landing.read_landing(spark, _land(spark, folder))
    # The counts need no texts; those are read for the insert alone.
    seen = materialize(landing.item_keys(items, "provider"), "seen")
    now, early = F.current_timestamp(), F.col("provider") == "newsapi"
    path = temporary_path(spark, "known")
    inserted = landing.insert_items(items.where(early), None, F.lit("run-1"), now)
    tables.append_files(inserted, path)
    known = spark.read.schema(inserted.schema).parquet(path)
    late = landing.insert_items(items, known, F.lit("run-2"), now)
    first = landing.insert_counts(seen.where(early), known).withColumn("run_id", F.lit("run-1"))
    second = landing.insert_counts(seen, late).withColumn("run_id", F.lit("run-2"))
    return first.unionByName(second)


def page_keys(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return v.table(spark, folder, "pages").select(
        "page_id", urls.canonical_url(url).alias("canonical"), urls.url_key(url).alias("url_hash"),
        urls.url_host(url).alias("host"),
    )


def run_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Copy of the runs of both article versions into an empty table, one run at a time.

    The runs are the two versions, so that both copies together hold every row.
    """
    columns = ["url_hash", "title", "ingestion_run_id"]
    run = F.concat(F.lit("run-"), F.col("seq").cast("string"))
    source = v.article_versions(spark, folder).withColumn("ingestion_run_id", run)
    path = temporary_path(spark, "copy")
    counts = [
        tables.append_files(landing.run_rows(source, name, columns), path)
        for name in ("run-0", "run-1")
    ]
    copied = F.when(F.col("ingestion_run_id") == "run-0", counts[0]).otherwise(counts[1])
    rows = spark.read.schema(source.select(*columns).schema).parquet(path)
    return rows.withColumn("rows_copied", copied.cast("long"))


def evolved_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Old rows with a renamed and two added columns, united with current ones."""
    current = v.articles(spark, folder).select(
        "url_hash", "category", "source_provider", "url_to_image"
    )
    old = current.select("url_hash", F.col("category").alias("search_keyword"), "url_to_image")
    upgraded = tables.evolve(
        old, {"search_keyword": "category"},
        {"source_provider": F.lit("newsapi"), "key_facts": F.lit("")},
    )
    both = tables.union_versions(upgraded, current)
    return both.groupBy("category", "source_provider", "key_facts").agg(
        F.count(F.lit(1)).alias("rows"), F.count("url_to_image").alias("images")
    )


def column_catalog(spark: SparkSession, folder: str) -> DataFrame:
    stage = layers.stage_articles(v.articles(spark, folder))
    return tables.column_counts(stage, "stage.stg_articles").select(
        "table_name", F.col("position").cast("long").alias("position"), "column_name", "type",
        "rows", "nulls",
    )


def latest_articles(spark: SparkSession, folder: str) -> DataFrame:
    current = layers.current_articles(v.article_versions(spark, folder), "seq")
    return current.select(
        "url_hash", "title", v.time_text("fetched_at").alias("fetched_at"),
        F.col("seq").cast("long").alias("seq"),
    )


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database of its own; a query that is run again finds no table of the run before."""
    name = f"suite_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def appended_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Newest rows of a table that had two appends; of equal times the later append counts."""
    versions = v.article_versions(spark, folder).select("url_hash", "title", "fetched_at", "seq")
    with _database(spark) as database:
        name = f"{database}.versions"
        for seq in (0, 1):
            tables.append_table(versions.where(F.col("seq") == seq), name, sequence=True)
        current = layers.current_articles(spark.table(name), tables.SEQUENCE)
        rows = current.select(
            "url_hash", "title", F.col("seq").cast("long").alias("seq"),
            F.col(f"{tables.SEQUENCE}.commit").alias("append_no"),
        )
        return materialize(rows, "current")


def appended_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of which one attempt came twice: the one received last is the attempt's answer."""
    with _database(spark) as database:
        name = f"{database}.answers"
        for arrival in v.repeated_answers(spark, folder):
            tables.append_table(arrival, name, sequence=True)
        chosen = enrichment.checked_responses(spark.table(name), [tables.SEQUENCE])
        rows = chosen.select(
            "cluster_id", F.col("attempt").cast("long").alias("attempt"),
            F.col("answer.valid").alias("is_valid"), F.md5("raw_text").alias("raw_md5"),
        )
        return materialize(rows, "settled")


def layer_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Published layers: every column with its comment, its table's rows and what it was built from."""
    with _database(spark) as database:
        stage, dim, mart, daily = (
            f"{database}.{name}" for name in ("stage", "dim_source", "mart_articles", "daily_stats")
        )
        tables.append_table(layers.stage_articles(v.articles(spark, folder)), stage)
        source = spark.table(stage)
        sources = tables.publish_table(
            layers.source_dimension(source), dim, schema=SOURCE_DIMENSION
        )
        articles = tables.publish_table(
            layers.mart_articles(source, sources), mart, schema=MART_ARTICLES
        )
        tables.publish_table(layers.daily_stats(articles), daily, schema=DAILY_STATS)
        found = tables.published(spark, database)
        rows = reduce(DataFrame.unionAll, [
            spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), "rows") for name in found])
        built = tables.lineage(spark, [database]).groupBy("table_name").agg(
            F.array_join(F.array_sort(F.collect_list(F.split_part("source_name", F.lit("."), F.lit(2)))),
                         "|").alias("sources"))
        columns = tables.catalog(spark, found).join(rows, "table_name")
        columns = columns.join(built, "table_name", "left").select(
            F.split_part("table_name", F.lit("."), F.lit(2)).alias("table_name"), "column_name", "type",
            "comment", F.coalesce("sources", F.lit("")).alias("sources"), "rows",
        )
        return materialize(columns, "catalog")


def daily_job(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs of the daily job on landed pages, the last over files that are known; its run log.

    Each run lands its pages, inserts them and rebuilds the layers, and the last one groups stories.
    """
    path = temporary_path(spark, "landing")
    batches = [(v.page_batch, "newsapi"), (v.second_page_batch, "gnews"), (v.second_page_batch, "gnews")]
    with tables.namespace(f"suite_{uuid.uuid4().hex}_"):
        try:
            tables.create_namespaces(spark)
            for number, (pages, provider) in enumerate(batches, start=1):
                run = f"run-{number}"
                landed = v.landed_objects(pages(spark, folder), provider)
                landing.write_landing(landed.withColumn("run_id", F.lit(run)), path)
                with daily.track(spark, run, "ingest") as counts:
                    counts.update(daily.ingest(spark, path, run))
                with daily.track(spark, run, "layers") as counts:
                    written = daily.refresh_layers(spark)
                    counts.update(fetched=written["articles"], new=written["days"],
                                  metadata={"sources": written["sources"]})
            with daily.track(spark, run, "cluster") as counts:
                counts.update(daily.cluster(spark))
            log = daily.run_log(spark).select(
                "run_id", "task_id", "status", "rows_fetched", "rows_new", "rows_duplicate",
                F.get_json_object("extra_metadata", "$.sources").cast("long").alias("n_sources"),
            )
            return materialize(log, "log")
        finally:
            tables.drop_namespaces(spark)


def stage_articles(spark: SparkSession, folder: str) -> DataFrame:
    stage = layers.stage_articles(v.articles(spark, folder))
    return stage.select(
        "url_hash", "source_id", "source_name", "title", "description",
        F.md5("content").alias("content_md5"), "is_content_truncated", "url", "url_domain",
        v.time_text("published_at").alias("published_at"), "category", "source_provider",
    )


def _ods(spark: SparkSession, folder: str) -> DataFrame:
    versions = v.article_versions(spark, folder)
    existing = layers.stage_articles(versions.where("seq = 0"))
    return layers.ods_articles(layers.stage_articles(versions.where("seq = 1")), existing)


def ods_increment(spark: SparkSession, folder: str) -> DataFrame:
    return _ods(spark, folder).select(
        "url_hash", "title", v.time_text("fetched_at").alias("fetched_at")
    )


def _mart(spark: SparkSession, folder: str) -> DataFrame:
    ods = layers.stage_articles(v.articles(spark, folder))
    # The dimension is a table of its own; its known size decides about a broadcast.
    dimension = materialize(layers.source_dimension(ods), "dim_source")
    return layers.mart_articles(ods, dimension)


def source_dim(spark: SparkSession, folder: str) -> DataFrame:
    return layers.source_dimension(layers.stage_articles(v.articles(spark, folder)))


def mart_articles(spark: SparkSession, folder: str) -> DataFrame:
    return _mart(spark, folder).select(
        "url_hash", "title", "source_id", "source_name", "url_domain", "is_content_truncated",
        v.time_text("published_at").alias("published_at"),
    )


def _date_text(stats: DataFrame) -> DataFrame:
    return stats.withColumn("published_date", F.date_format("published_date", "yyyy-MM-dd"))


def daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _date_text(layers.daily_stats(_mart(spark, folder)))


def daily_stats_page(spark: SparkSession, folder: str) -> DataFrame:
    return _date_text(serving.daily_page(layers.daily_stats(_mart(spark, folder)), 100))


# ---- stories and enrichment

def title_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = text.title_tokens(F.col("title"))
    return v.articles(spark, folder).select(
        "url_hash", F.size(tokens).cast("long").alias("n_tokens"),
        F.array_join(tokens, " ").alias("tokens"),
    )


def story_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return stories.story_clusters(v.articles(spark, folder))


def story_clusters_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Stories of titles made of frequent words; small limits, so that groups are large and split."""
    return stories.story_clusters(v.busy_articles(spark, folder), HOT_LIMITS)


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.current_assignment(v.assignments(spark, folder))


def _summaries(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.current_summaries(v.summaries(spark, folder))


def _pending(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.pending_members(
        _assigned(spark, folder), v.articles(spark, folder), _summaries(spark, folder)
    )


def pending_clusters(spark: SparkSession, folder: str) -> DataFrame:
    members = _pending(spark, folder)
    return enrichment.pending_clusters(members).select(
        "cluster_id", F.col("article_count").cast("long").alias("article_count")
    )


def refreshed_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Pending stories after the summaries of one topic were removed."""
    current = _summaries(spark, folder)
    removed = current.where(F.col("topic") == "en").select("cluster_id")
    kept = keyed.remove_keys(current, removed, "cluster_id")
    members = enrichment.pending_members(
        _assigned(spark, folder), v.articles(spark, folder), kept
    )
    return enrichment.pending_clusters(members).select(
        "cluster_id", F.col("article_count").cast("long").alias("article_count")
    )


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """All prompts, put together from their lines as they are stored and read back."""
    lines = enrichment.prompts(_pending(spark, folder), "Story:\n{articles_block}\nEnd {{}}.")
    path = temporary_path(spark, "prompts")
    enrichment.write_prompts(lines, path)
    return enrichment.prompt_parts(spark.read.schema(lines.schema).parquet(path))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.outcomes(
        _pending(spark, folder), v.responses(spark, folder), F.lit("model"),
        F.lit("2024-04-01 00:00:00").cast("timestamp"),
    )


def responses_checked(spark: SparkSession, folder: str) -> DataFrame:
    chosen = enrichment.checked_responses(v.responses(spark, folder))
    return chosen.select(
        "cluster_id", F.col("attempt").cast("long").alias("attempt"),
        F.col("answer.valid").alias("is_valid"),
        F.when(F.col("answer.valid"), F.col("answer.summary")).alias("summary"),
        F.when(F.col("answer.valid"), F.col("answer.topic")).alias("topic"),
        F.when(F.col("answer.valid"), F.col("answer.sentiment_score").cast("double")).alias(
            "sentiment_score"
        ),
    )


def enrichment_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    perspectives = F.transform(
        "source_perspectives", lambda p: F.concat(p["url_hash"], F.lit(":"), p["focus"])
    )
    return _outcomes(spark, folder).select(
        "cluster_id", "summary", _joined("keywords").alias("keywords"), "topic",
        "enrichment_status", "raw_llm_response",
        F.col("article_count").cast("long").alias("article_count"),
        _joined(perspectives).alias("perspectives"),
    )


def enrichment_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of calls that failed: the error text, cut, or the text for an empty answer."""
    rows = enrichment.outcomes(
        _pending(spark, folder), v.failed_responses(spark, folder), F.lit("model"),
        F.lit("2024-04-01 00:00:00").cast("timestamp"),
    )
    raw = F.col("raw_llm_response")
    return rows.select(
        "cluster_id", "enrichment_status", F.length(raw).cast("long").alias("n_chars"),
        F.md5(raw).alias("raw_md5"),
    )


def enrichment_gate(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.enrichment_counts(_outcomes(spark, folder))


# ---- serving

def _media(spark: SparkSession, folder: str) -> DataFrame:
    return serving.story_media(_assigned(spark, folder), v.articles(spark, folder))


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    return serving.cards(_summaries(spark, folder), _media(spark, folder))


def _shown(cards: DataFrame, *more: str) -> DataFrame:
    return cards.select(
        *more, "cluster_id", "summary", "topic", "sentiment",
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        _joined("keywords").alias("keywords"),
        F.col("article_count").cast("long").alias("article_count"),
        v.time_text("enriched_at").alias("enriched_at"),
        v.time_text("first_published_at").alias("first_published_at"), "image_url",
    )


def story_cards(spark: SparkSession, folder: str) -> DataFrame:
    labelled = serving.card_labels(_feed(spark, folder), F.lit(AS_OF).cast("timestamp"))
    return _shown(labelled, "consensus", "age", "coverage")


def feed_page(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(serving.feed_page(_feed(spark, folder), 20, 5))


def feed_search(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(serving.feed_page(_feed(spark, folder), 100, 0, topic="en", q="TH_N"))


def feed_keyset_page(spark: SparkSession, folder: str) -> DataFrame:
    after = F.lit("2024-03-01 05:00:00").cast("timestamp")
    return _shown(serving.feed_after(_feed(spark, folder), after, F.lit(""), 20))


def topic_stats(spark: SparkSession, folder: str) -> DataFrame:
    return serving.topic_stats(_summaries(spark, folder))


def story_detail(spark: SparkSession, folder: str) -> DataFrame:
    detail = serving.story_detail(_summaries(spark, folder), _media(spark, folder))
    return detail.select(
        "cluster_id", "summary", "why_it_matters", "before_state", "after_state",
        _joined("key_facts_organizations").alias("organizations"),
        _joined("consensus_points").alias("consensus"),
        "has_analysis", "has_change", "has_key_facts", "has_consensus",
    )


def story_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A story by its id, the first one of the feed, and an id that does not exist."""
    summaries, media = _summaries(spark, folder), _media(spark, folder)
    known = _feed(spark, folder).agg(F.min("cluster_id")).first()[0]
    found = serving.story_detail(summaries, media, known)
    missing = serving.story_detail(summaries, media, "no such story")
    return found.unionByName(missing).select("cluster_id", "summary", "why_it_matters")


def story_head_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """How alike each article and the head of its story are."""
    tokens = text.title_tokens(F.col("title")).alias("tokens")
    titles = v.articles(spark, folder).select("url_hash", tokens)
    heads = titles.select(F.col("url_hash").alias("cluster_id"), F.col("tokens").alias("head"))
    joined = _assigned(spark, folder).join(titles, "url_hash").join(heads, "cluster_id")
    own, head = F.col("tokens"), F.col("head")
    return joined.select(
        "url_hash", "cluster_id", F.round(text.jaccard(own, head), 6).alias("jaccard"),
        text.is_similar(own, head).alias("is_similar"),
    )


def story_sources(spark: SparkSession, folder: str) -> DataFrame:
    sources = serving.story_sources(
        _assigned(spark, folder), _mart(spark, folder), _summaries(spark, folder)
    )
    age = age_label(F.col("published_at"), F.lit(AS_OF).cast("timestamp"))
    return sources.select(
        "cluster_id", "url_hash", "source_name", "source_label", "source_provider", "title",
        "url", "url_to_image", v.time_text("published_at").alias("published_at"),
        age.alias("age"), "category", "source_summary",
    )


def valid_feedback(spark: SparkSession, folder: str) -> DataFrame:
    allowed, refused = keyed.split_votes(v.feedback(spark, folder))

    def counted(events, name):
        return events.groupBy("vote").agg(F.count(F.lit(1)).alias("events")).select(
            F.lit(name).alias("verdict"), F.col("vote").cast("long").alias("vote"), "events"
        )

    return counted(allowed, "valid").unionByName(counted(refused, "invalid"))


def _votes(spark: SparkSession, folder: str) -> DataFrame:
    allowed, _ = keyed.split_votes(v.feedback(spark, folder))
    return keyed.fold_votes(allowed)


def _vote_rows(votes: DataFrame) -> DataFrame:
    return votes.select(
        "user_id", "cluster_id", F.col("vote").cast("long").alias("vote"),
        v.micro_text("created_at").alias("created_at"),
    )


def current_votes(spark: SparkSession, folder: str) -> DataFrame:
    return _vote_rows(_votes(spark, folder))


def toggled_votes(spark: SparkSession, folder: str) -> DataFrame:
    return _vote_rows(keyed.toggle_votes(v.clicks(spark, folder)))


def liked_page(spark: SparkSession, folder: str) -> DataFrame:
    page = serving.liked_page(_votes(spark, folder), _feed(spark, folder), 10, 2)
    return page.select(
        "user_id", F.col("like_rank").cast("long").alias("like_rank"), "cluster_id", "summary",
        F.col("my_vote").cast("long").alias("my_vote"),
    )


def affinity_profile(spark: SparkSession, folder: str) -> DataFrame:
    topics, keywords = serving.affinity_profiles(
        _votes(spark, folder), _summaries(spark, folder)
    )
    kinds = topics.select("user_id", F.lit("topic").alias("kind"), F.col("topic").alias("name"),
                          "weight")
    return kinds.unionByName(
        keywords.select("user_id", F.lit("keyword").alias("kind"),
                        F.col("keyword").alias("name"), "weight")
    )


def affinity_feed(spark: SparkSession, folder: str) -> DataFrame:
    page = serving.affinity_feed(
        _feed(spark, folder), _votes(spark, folder), _summaries(spark, folder), 20, 3
    )
    return page.select(
        "user_id", F.col("rank").cast("long").alias("rank"),
        F.col("score").cast("long").alias("score"), "cluster_id", "topic",
        F.col("my_vote").cast("long").alias("my_vote"),
    )


def affinity_feed_deep(spark: SparkSession, folder: str) -> DataFrame:
    """A long page of a feed of every labelled article alone, which is longer than the window."""
    every = _summaries(spark, folder).withColumn("enrichment_status", F.lit("success"))
    articles = v.articles(spark, folder)
    alone = articles.select("url_hash", F.col("url_hash").alias("cluster_id"))
    page = serving.affinity_feed(
        serving.cards(every, serving.story_media(alone, articles)), _votes(spark, folder), every,
        100, 3,
    )
    return page.select(
        "user_id", F.col("rank").cast("long").alias("rank"),
        F.col("score").cast("long").alias("score"), "cluster_id",
    )


# ---- run log and quality

def _log(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.fold_runs(v.run_events(spark, folder))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder).select(
        "run_id", "task_id", F.col("try_number").cast("long").alias("try_number"), "dag_id",
        v.time_text("execution_date").alias("execution_date"),
        v.micro_text("started_at").alias("started_at"),
        v.micro_text("finished_at").alias("finished_at"), "status",
        *[F.col(f"rows_{n}").cast("long").alias(f"rows_{n}")
          for n in ("fetched", "new", "duplicate", "failed")],
        F.length("error_message").cast("long").alias("error_length"), "extra_metadata",
    )


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    page = history.run_history(_log(spark, folder), 20)
    return page.select(
        "run_id", "task_id", F.col("try_number").cast("long").alias("try_number"), "status",
        v.micro_text("started_at").alias("started_at"),
        F.col("rows_fetched").cast("long").alias("rows_fetched"),
    )


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    stage = layers.stage_articles(v.article_versions(spark, folder))
    ods = _ods(spark, folder)
    return quality.quality_report(
        {
            "stage": (stage, ["url_hash", "url", "published_at"], ["url_hash"]),
            "ods": (ods, ["url_hash", "title", "url", "source_name"], ["url_hash"]),
            "mart": (_mart(spark, folder), ["url_hash", "url"], ["url_hash"]),
            "dim_source": (source_dim(spark, folder), ["source_name"], ["source_name"]),
        }
    )


def member_audit(spark: SparkSession, folder: str) -> DataFrame:
    audit = quality.member_audit(_assigned(spark, folder), _summaries(spark, folder))
    return audit.select(
        "cluster_id", F.col("article_count").cast("long").alias("article_count"), "members"
    )


# ---- streaming forms

def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """The two providers' pages arriving one after the other."""
    path, out = temporary_path(spark, "arriving"), temporary_path(spark, "seen")
    checkpoint = temporary_path(spark, "seen-checkpoint")
    arrivals = [
        v.landed_objects(v.page_batch(spark, folder), "newsapi"),
        v.landed_objects(v.second_page_batch(spark, folder), "gnews"),
    ]
    for arrival in arrivals:
        landing.write_landing(arrival, path)
        stream = jobs.landing_stream(spark, path)
        jobs.ingest_first_seen(stream, out, checkpoint).awaitTermination()
    items = spark.createDataFrame([], LANDED_ITEM)
    rows = jobs.read_batches(spark, out, landing.normalise_items(items).schema)
    return rows.select("url_hash", "url", "source_provider")


def _stream_of(df: DataFrame, name: str, files: int = 4) -> DataFrame:
    """A stream over a table written in several files, read one file per batch."""
    spark, path = df.sparkSession, temporary_path(df.sparkSession, name)
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_votes(spark: SparkSession, folder: str) -> DataFrame:
    events, _ = keyed.split_votes(v.feedback(spark, folder))
    out = temporary_path(spark, "votes")
    stream = _stream_of(events, "vote-events")
    jobs.fold_vote_stream(
        stream, out, temporary_path(spark, "votes-checkpoint"), every=2
    ).awaitTermination()
    return _vote_rows(jobs.current_votes(spark, out, events.schema))


def stream_daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    articles = v.articles(spark, folder).select("published_at", "source_name")
    out = temporary_path(spark, "daily")
    stream = _stream_of(articles, "daily-articles")
    query = jobs.run_daily_counts(stream, "400 days", out, temporary_path(spark, "daily-checkpoint"))
    query.awaitTermination()
    schema = jobs.daily_counts(articles, "400 days").schema
    rows = jobs.read_batches(spark, out, schema)
    current = keyed.latest(rows, ["published_date", "source_name"], ["batch"])
    return _date_text(current.drop("batch"))


def stream_daily_late(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counts with two days of lateness, of articles of which many come later."""
    path, out = temporary_path(spark, "day-articles"), temporary_path(spark, "days")
    checkpoint = temporary_path(spark, "days-checkpoint")
    counts = jobs.DayCounts(spark, out, timedelta(days=2), every=2)
    for arrival in v.day_arrivals(spark, folder):
        arrival.write.mode("append").parquet(path)
        counts.run(spark.readStream.schema(arrival.schema).parquet(path), checkpoint).awaitTermination()
    return _date_text(counts.read())


def stream_responses(spark: SparkSession, folder: str) -> DataFrame:
    answers = v.responses(spark, folder)
    out = temporary_path(spark, "answers")
    stream = _stream_of(answers, "answer-files")
    jobs.check_response_stream(
        stream, out, temporary_path(spark, "answers-checkpoint"), every=2
    ).awaitTermination()
    settled = jobs.settled_responses(spark, out, answers.schema)
    return settled.select(
        "cluster_id", F.col("attempt").cast("long").alias("attempt"),
        F.col("answer.valid").alias("is_valid"),
    )


QUERIES = [
    landed_items, first_seen_pages, rerun_counts, page_keys, run_copy, evolved_schema,
    column_catalog, latest_articles, stage_articles, ods_increment, source_dim, mart_articles,
    daily_stats, daily_stats_page, title_tokens, story_clusters, story_clusters_hot,
    pending_clusters,
    refreshed_clusters, prompts, responses_checked, enrichment_outcomes, enrichment_gate,
    story_lookup, story_head_jaccard, story_cards, feed_page, feed_search, feed_keyset_page, topic_stats, story_detail,
    story_sources, valid_feedback, current_votes, toggled_votes, liked_page, affinity_profile,
    affinity_feed, run_log, run_history, quality_report, member_audit, stream_first_seen,
    stream_votes, stream_daily_stats, stream_responses, landed_payloads, enrichment_errors,
    affinity_feed_deep, stream_daily_late, appended_versions, appended_answers, layer_catalog,
    daily_job,
]


def registered():
    def prepared(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with scratch(configure(spark)):
                return materialize(query(spark, folder), query.__name__, keep=True)

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        return run

    return {query.__name__: prepared(query) for query in QUERIES}
