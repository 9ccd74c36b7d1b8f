"""News-shaped views of the given tables, in Spark.

``suite/oracle.py`` states the same views in SQL. Every view covers its whole table; expressions
on the ids only vary the values, so that missing fields, ties and repeats occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.plans.history import metadata_json

JAN, FEB, MAR = 1704067200, 1706745600, 1709251200  # first days of 2024, UTC


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def time_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def micro_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def doc_key(doc_id: Column | str) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.sha2(column.cast("string"), 256)


def _at(start: int, seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(start) + seconds)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw articles; the first line is the title, the second the description."""
    doc = F.col("doc_id")
    line = F.split_part("text", F.lit("\n"), F.lit(1))
    url = F.concat(
        F.lit("https://"), "source", F.lit(".example.com/"), "lang", F.lit("/"),
        doc.cast("string"),
    )
    rows = table(spark, folder, "documents").select(
        "doc_id",
        doc_key("doc_id").alias("url_hash"),
        F.when(doc % 5 == 0, F.col("source")).alias("source_id"),
        F.when(doc % 41 != 0, F.col("source")).alias("source_name"),
        F.lit(None).cast("string").alias("author"),
        F.when(doc % 6 == 0, F.concat(F.lit("  "), line, F.lit(" "))).otherwise(line).alias(
            "title"
        ),
        F.when(doc % 7 != 0, F.split_part("text", F.lit("\n"), F.lit(2))).alias("description"),
        F.col("text").alias("content"),
        url.alias("url"),
        F.col("lang").alias("category"),
        F.when(doc % 3 == 0, "gnews").otherwise("newsapi").alias("source_provider"),
        F.when(doc % 53 != 0, _at(JAN, (doc % 240) * 3600)).alias("published_at"),
        _at(FEB, F.floor(doc / 100) * 3600).alias("fetched_at"),
    )
    return rows.select(
        "*",
        F.when(doc % 4 != 0, F.concat("url", F.lit(".jpg"))).alias("url_to_image"),
        F.concat(F.lit("run-"), time_text("fetched_at")).alias("ingestion_run_id"),
        F.lit(0).alias("seq"),
    )


def busy_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles of two days whose titles are made of a few frequent words."""
    doc = F.col("doc_id")
    words = [
        F.concat(F.lit(f"{word} tag{word}"), (doc % n).cast("string"))
        for word, n in (("five", 5), ("seven", 7), ("three", 3), ("forty", 40), ("ninety", 90))
    ]
    short = F.concat_ws(" ", *(F.split_part(w, F.lit(" "), F.lit(2)) for w in words))
    return table(spark, folder, "documents").select(
        doc_key("doc_id").alias("url_hash"),
        F.when(doc % 10 == 0, F.concat_ws(" ", *words)).otherwise(short).alias("title"),
        F.when(doc % 97 != 0, _at(JAN, (doc % 48) * 3600)).alias("published_at"),
    )


def article_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every article twice; the second version is fetched a day earlier, together, or later."""
    first = articles(spark, folder)
    shift = F.make_dt_interval(days=(F.col("doc_id") % 3 - 1).cast("int"))
    second = (
        first.withColumn("title", F.concat(F.lit("second "), "title"))
        .withColumn("fetched_at", F.col("fetched_at") + shift)
        .withColumn("seq", F.lit(1))
    )
    return first.unionByName(second)


def page_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as the first provider's batch."""
    page = F.col("page_id")
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    published = F.when(page % 11 == 0, "not a time").otherwise(
        F.date_format(_at(JAN, page * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return table(spark, folder, "pages").select(
        "page_id",
        F.lit("2024-01-01").alias("dt"),
        F.lit("run-1").alias("run_id"),
        F.col("page_id").alias("ordinal"),
        F.split_part("url", F.lit("/"), F.lit(4)).alias("category"),
        "url",
        title.alias("title"),
        F.col("html").alias("content"),
        published.alias("published"),
    )


def second_page_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as the second provider's batch: other spellings, new URLs, missing URLs."""
    page, url = F.col("page_id"), F.col("url")
    joint = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    bare = F.split_part(url, F.lit("#"), F.lit(1))
    respelled = (
        F.when(page % 17 == 0, "")
        .when(page % 19 == 0, None)
        .when(page % 3 == 0, F.concat(bare, joint, F.lit("utm_medium=x&fbclid=7")))
        .when(page % 3 == 1, F.regexp_replace(url, "^http", "HTTP"))
        .otherwise(F.concat(F.lit("https://wire.example.org/"), page.cast("string")))
    )
    return page_batch(spark, folder).withColumn("url", respelled)


def landed_objects(batch: DataFrame, provider: str) -> DataFrame:
    """A page batch as envelope rows with the provider's article object."""
    common = [
        F.struct(F.lit("wire").alias("id"), F.col("category").alias("name")).alias("source"),
        F.concat(F.lit("author "), F.col("page_id").cast("string")).alias("author"),
        F.col("title"), F.col("title").alias("description"), F.col("content"), F.col("url"),
    ]
    image = "image" if provider == "gnews" else "urlToImage"
    article = F.struct(
        *common,
        F.concat(F.lit("img-"), F.col("page_id").cast("string")).alias(image),
        F.col("published").alias("publishedAt"),
    )
    return batch.select(
        "ordinal", "category", article.alias("article"), "dt", "run_id",
        F.lit(provider).alias("provider"),
    )


def assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of a simple assignment: alone first, then three documents to a story."""
    docs = table(spark, folder, "documents").select("doc_id", doc_key("doc_id").alias("url_hash"))
    alone = docs.select(
        "url_hash", F.col("url_hash").alias("cluster_id"), _at(FEB, F.lit(0)).alias("computed_at")
    )
    grouped = docs.select(
        "url_hash",
        doc_key(F.col("doc_id") - F.col("doc_id") % 3).alias("cluster_id"),
        _at(MAR, F.lit(0)).alias("computed_at"),
    )
    return alone.unionByName(grouped)


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Two summary rows per labelled document: an older success, then one by quality."""
    doc = F.col("doc_id")
    words = F.regexp_extract_all(F.lower("title"), F.lit("([a-z0-9]+)"), F.lit(1))
    no_texts = F.array().cast("array<string>")
    rows = (
        table(spark, folder, "labels")
        .join(articles(spark, folder), "doc_id")
        .select(
            "doc_id", "quality", "toxic",
            F.col("url_hash").alias("cluster_id"),
            F.trim("title").alias("summary"),
            F.filter(words, lambda w: F.length(w) >= 3).alias("keywords"),
            F.col("category").alias("topic"),
            F.when(F.col("toxic") == 1, "negative").otherwise("neutral").alias("sentiment"),
            ((doc % 21 - 10) / 10).cast("float").alias("sentiment_score"),
            (1 + doc % 6).cast("int").alias("article_count"),
            F.when(doc % 5 == 0, F.array("category")).otherwise(no_texts).alias(
                "key_facts_organizations"
            ),
            no_texts.alias("key_facts_locations"),
            no_texts.alias("key_facts_people"),
            F.when(doc % 2 == 0, F.concat(F.lit("matters to "), "category")).otherwise("").alias(
                "why_it_matters"
            ),
            F.when(doc % 3 == 0, F.lit("before")).alias("before_state"),
            F.when(doc % 4 == 0, F.lit("after")).alias("after_state"),
            F.when(doc % 6 > 0, F.array(F.trim("title"))).otherwise(no_texts).alias(
                "consensus_points"
            ),
            no_texts.alias("disagreement_points"),
            F.array(
                F.struct(doc_key("doc_id").alias("url_hash"), F.lit("first").alias("focus")),
                F.struct(doc_key(doc + 1).alias("url_hash"), F.lit("next").alias("focus")),
                F.struct(doc_key("doc_id").alias("url_hash"), F.lit("last").alias("focus")),
            ).alias("source_perspectives"),
        )
    )
    old = (
        rows.withColumn("enriched_at", _at(MAR, doc * 60 - 86400))
        .withColumn("enrichment_status", F.lit("success"))
        .withColumn("topic", F.lit("old"))
    )
    status = F.when(F.col("quality") == 1, "success").otherwise("failed")
    new = rows.withColumn("enriched_at", _at(MAR, doc * 60)).withColumn(
        "enrichment_status", status
    )
    return old.unionByName(new)


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Two model answers per document; some broken, some without a topic."""
    doc = F.col("doc_id")

    def quoted(column):
        safe = F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        safe = F.replace(safe, F.lit("\t"), F.lit("\\t"))
        return F.concat(F.lit('"'), safe, F.lit('"'))

    title, lang = quoted(F.trim("title")), quoted(F.col("category"))
    topic = F.when(doc % 11 != 0, F.concat(F.lit(', "topic": '), lang)).otherwise("")
    score = F.when(doc % 5 == 0, ', "sentiment_score": 0.5').otherwise("")
    body = F.concat(
        F.lit('{"summary": '), title, topic, F.lit(', "sentiment": "neutral"'), score,
        F.lit(', "keywords": ['), lang, F.lit(", "), lang,
        F.lit('], "source_perspectives": [{"index": 1, "focus": "one"}, {"index": 9, "focus": '),
        F.lit('"none"}, {"index": 1, "focus": "again"}]}'),
    )
    broken = F.replace(body, F.lit('"neutral"'), F.lit(""))
    first = F.when(doc % 9 == 0, broken).when(
        doc % 4 == 0, F.concat(F.lit("Here it is:\n"), body, F.lit("\nDone."))
    ).otherwise(body)
    second = F.when(doc % 2 == 0, body).otherwise(broken)
    rows = articles(spark, folder)

    def answers(attempt, text):
        return rows.select(
            F.col("url_hash").alias("cluster_id"), F.lit(attempt).alias("attempt"),
            text.alias("raw_text"), F.lit(None).cast("string").alias("error"),
        )

    return answers(1, first).unionByName(answers(2, second))


def failed_responses(spark: SparkSession, folder: str) -> DataFrame:
    """A call of the model per document that failed with a long error text, or without any."""
    error = F.repeat(F.concat(F.trim("title"), F.lit("; ")), F.lit(100))
    return articles(spark, folder).select(
        F.col("url_hash").alias("cluster_id"), F.lit(1).alias("attempt"),
        F.lit(None).cast("string").alias("raw_text"),
        F.when(F.col("doc_id") % 7 != 0, error).alias("error"),
    )


def day_arrivals(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Articles in three arrivals: half of the late days, all early days, the rest."""
    doc = F.col("doc_id")
    rows, early = articles(spark, folder), doc % 240 < 120
    parts = [~early & (doc % 2 == 0), early, ~early & (doc % 2 == 1)]
    return [rows.where(part).select("published_at", "source_name") for part in parts]


def repeated_answers(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Both appends of a table of answers: every answer, then one attempt of every document again."""
    rows = responses(spark, folder)
    again = articles(spark, folder).select(
        F.col("url_hash").alias("cluster_id"), (1 + F.col("doc_id") % 2).cast("int").alias("attempt"),
        F.lit("taken back").alias("raw_text"), F.lit(None).cast("string").alias("error"),
    )
    return [rows, again]


def _stories(spark: SparkSession, folder: str) -> int:
    """One story in three documents, so that events reach all of them at every scale."""
    return table(spark, folder, "documents").count() // 3 + 1


def _event_story(stories: int) -> Column:
    k = F.get_json_object("props", "$.k").cast("long")
    return doc_key(3 * ((7 * k + 13 * F.col("user_id")) % stories))


def feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Events as votes: likes, dislikes, removals, and a value that is not allowed."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    vote = (
        F.when(kind.isin("click", "purchase"), 1)
        .when(kind == "error", -1)
        .when(kind == "signup", 5)
    )
    return events.select(
        "user_id",
        _event_story(_stories(spark, folder)).alias("cluster_id"),
        vote.cast("short").alias("vote"),
        F.col("ts").cast("timestamp").alias("created_at"),
        "event_id",
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as presses of the two vote buttons, on few stories so that presses repeat."""
    up = F.col("event_type").isin("click", "purchase", "view")
    few = max(4, _stories(spark, folder) // 80)
    return table(spark, folder, "events").select(
        "user_id",
        doc_key(F.get_json_object("props", "$.k").cast("long") % few).alias("cluster_id"),
        F.when(up, 1).otherwise(-1).alias("vote"),
        F.col("ts").cast("timestamp").alias("created_at"),
        "event_id",
    )


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as opens and closes of task attempts."""
    event = F.col("event_id")
    closes = event % 4 != 0
    failed = F.col("value") > 100
    count = F.floor("value").cast("int")
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.col("event_type").alias("task_id"),
        (1 + F.col("user_id") % 3).cast("int").alias("try_number"),
        F.when(closes, "close").otherwise("open").alias("kind"),
        F.lit("daily").alias("dag_id"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("execution_date"),
        F.col("ts").cast("timestamp").alias("at"),
        "event_id",
        F.when(failed, "failed").otherwise("success").alias("status"),
        count.alias("rows_fetched"),
        k.alias("rows_new"),
        F.lit(0).alias("rows_duplicate"),
        F.when(failed, 1).otherwise(0).alias("rows_failed"),
        F.when(failed, F.repeat(F.concat(F.col("event_type"), F.lit(" ")), F.lit(900))).alias(
            "error_message"
        ),
        metadata_json(k.alias("k"), "user_id").alias("extra_metadata"),
    )
