"""Enrichment of stories: what is pending, prompts, outcomes, failure gate.

The model itself is not called here. Its answers arrive as a table
``(cluster_id, attempt, raw_text, error)``; prompts go out as a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.responses import with_answer
from tidings.operators.keyed import latest
from tidings.operators.numbering import number_within
from tidings.operators.skew import join_spread
from tidings.schemas import SUMMARY_CLUSTERS
from tidings.session import materialize

# Answers asked for, share of failures that stops a run, name of a missing outlet.
MAX_ATTEMPTS = 3
MAX_FAILURE_RATE = 0.2
UNKNOWN_SOURCE = "unknown source"
#: Articles of one part of a prompt; the text of a story of any size is in no row whole.
LINES_PER_PART = 500

# Fixed value: error text stored for an empty answer.
EMPTY_ANSWER = "No JSON object found in LLM response: ''"

TEMPLATE = """Several outlets report the same story. Read the numbered articles and answer with one
JSON object with the keys summary, keywords, topic, sentiment, sentiment_score (-1 to 1),
key_facts (organizations, locations, people), why_it_matters, before_state, after_state,
consensus_points, disagreement_points and source_perspectives (index, focus).

{articles_block}

Answer with the JSON object only."""



def current_assignment(assignments: DataFrame) -> DataFrame:
    """Newest story of each article."""
    return latest(assignments, ["url_hash"], ["computed_at"])


def current_summaries(summaries: DataFrame, sequence: str | None = None) -> DataFrame:
    """Newest summary row of each story, whatever its status."""
    order = ["enriched_at"] + ([sequence] if sequence else [])
    return latest(summaries, ["cluster_id"], order)


def successful(summaries: DataFrame) -> DataFrame:
    """Stories whose newest row is a success; the status counts after the versions."""
    return summaries.where(F.col("enrichment_status") == "success")


def pending_members(
    assignments: DataFrame, articles: DataFrame, summaries: DataFrame
) -> DataFrame:
    """Member articles of the stories without a successful summary, one row per article.

    ``assignments`` and ``summaries`` are the current rows. ``member_no`` numbers the members
    of a story by key; it is the number an answer refers to. Members stay rows instead of being
    collected per story, since a story may be of any size.
    """
    done = successful(summaries).select("cluster_id")
    open_articles = join_spread(
        assignments.select("url_hash", "cluster_id"), done, ["cluster_id"], "url_hash", "left_anti"
    )
    # Written, so that its size is known: few open keys are broadcast to the article scan.
    open_articles = materialize(open_articles, "open")
    texts = articles.select("url_hash", "title", "description", "source_name")
    members = open_articles.join(texts, "url_hash")
    return number_within(members, "cluster_id", "url_hash", "member_no")


def pending_clusters(members: DataFrame) -> DataFrame:
    """Pending stories with their number of members."""
    return members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("article_count"))


def member_line(number: Column, source: Column, title: Column, description: Column) -> Column:
    """Entry of one article in a prompt: number, outlet and title, description below."""
    outlet = F.coalesce(F.nullif(source, F.lit("")), F.lit(UNKNOWN_SOURCE))
    return F.concat(
        number.cast("string"), F.lit(". ["), outlet, F.lit("] "),
        F.coalesce(title, F.lit("")), F.lit("\n   "), F.coalesce(description, F.lit("")),
    )


def prompts(members: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The prompt of each pending story as lines: ``(cluster_id, line_no, text)``.

    Line 0 is the template before the articles, lines 1 to n are the articles, line n + 1 is the
    rest of the template. The texts of a story, one after the other, are its prompt. Lines have one
    form at every size, so a story of any size is neither collected nor cut.
    """
    head, tail = [
        text.replace("{{", "{").replace("}}", "}")
        for text in template.split("{articles_block}", 1)
    ]
    line = member_line(
        F.col("member_no"), F.col("source_name"), F.col("title"), F.col("description")
    )
    number = F.col("member_no").cast("long").alias("line_no")
    before = F.when(F.col("member_no") > 1, "\n").otherwise("")
    entries = members.select("cluster_id", number, F.concat(before, line).alias("text"))
    frames = F.array(
        F.struct(F.lit(0).cast("long").alias("line_no"), F.lit(head).alias("text")),
        F.struct((F.col("article_count") + 1).alias("line_no"), F.lit(tail).alias("text")),
    )
    frame = pending_clusters(members).select("cluster_id", F.inline(frames))
    return entries.unionByName(frame)


def write_prompts(lines: DataFrame, path: str) -> None:
    """Store the lines of :func:`prompts` in the order in which they are sent.

    Files are ranges of stories and lines, sorted, so that one prompt is one stretch of rows and a
    large one goes on in the next file.
    """
    order = ["cluster_id", "line_no"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("error").parquet(path)


def prompt_text(spark: SparkSession, path: str, cluster_id: str) -> Iterator[str]:
    """The stored prompt of one story, text by text; only the row groups that hold it are read."""
    stored = spark.read.schema("cluster_id string, line_no long, text string").parquet(path)
    own = stored.where(F.col("cluster_id") == cluster_id).orderBy("line_no")
    for row in own.toLocalIterator():
        yield row.text


def prompt_parts(lines: DataFrame, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """The prompts put together: ``(cluster_id, part, parts, article_count, prompt)``.

    ``lines`` are those of :func:`prompts`, stored or not. A story of up to ``lines_per_part``
    articles has one part, its whole prompt. That of a larger one comes in consecutive parts, which
    joined in order are the whole prompt.
    """
    counts = lines.groupBy(F.col("cluster_id").alias("story")).agg(
        (F.max("line_no") - 1).alias("article_count")
    )
    # Plain shuffles on both sides: the skew join can split the lines of a large story.
    own = F.col("cluster_id").eqNullSafe(F.col("story"))
    placed = lines.join(counts, own).drop("story")
    last = F.floor((F.col("article_count") - 1) / lines_per_part)
    part = F.least(F.greatest(F.floor((F.col("line_no") - 1) / lines_per_part), F.lit(0)), last)
    parts = placed.groupBy("cluster_id", "article_count", part.alias("part"))
    texts = F.sort_array(F.collect_list(F.struct("line_no", "text")))["text"]
    return parts.agg(F.array_join(texts, "").alias("prompt")).select(
        "cluster_id", "part", (last + 1).alias("parts"), "article_count", "prompt"
    )


def settled(parsed: DataFrame, sequence: Sequence[str] = ()) -> DataFrame:
    """The parsed answer that counts for each story, with all its columns.

    The first valid attempt counts, otherwise the last one; of answers of one attempt the last by
    ``sequence``. Settling parts first and the results again gives the same answers.
    """
    valid = F.col("answer.valid")
    attempt = F.when(valid, -F.col("attempt")).otherwise(F.col("attempt"))
    rank = F.struct(valid, attempt.alias("attempt"), *sequence)
    rest = [c for c in parsed.columns if c != "cluster_id"]
    return (
        parsed.groupBy("cluster_id")
        .agg(F.max_by(F.struct(*rest), rank).alias("chosen"))
        .select("cluster_id", "chosen.*")
    )


def checked_responses(responses: DataFrame, sequence: Sequence[str] = ()) -> DataFrame:
    """The answer that counts for each story, parsed; up to three attempts are looked at."""
    checked = with_answer(responses.where(F.col("attempt") <= MAX_ATTEMPTS), "raw_text")
    chosen = settled(checked.select("cluster_id", "attempt", "raw_text", "error", "answer", *sequence), sequence)
    return chosen.select("cluster_id", "attempt", "raw_text", "error", "answer")


def _perspectives(chosen: DataFrame, members: DataFrame) -> DataFrame:
    """Focus texts with the key of the article they refer to, in the order of the answer.

    Numbers outside the story's members find no partner; repeated numbers are kept. One array
    holds the entries of one answer.
    """
    entries = chosen.where("answer.valid").select(
        "cluster_id", F.posexplode("answer.perspectives").alias("place", "entry")
    )
    named = entries.select(
        "cluster_id", "place", F.col("entry.index").alias("member_no"),
        F.col("entry.focus").alias("focus"),
    )
    keys = members.select("cluster_id", F.col("member_no").cast("long"), "url_hash")
    return (
        named.join(keys, ["cluster_id", "member_no"])
        .groupBy("cluster_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "url_hash", "focus"))).alias("found"))
        .select(
            "cluster_id",
            F.transform(
                "found",
                lambda e: F.struct(e["url_hash"].alias("url_hash"), e["focus"].alias("focus")),
            ).alias("source_perspectives"),
        )
    )


def outcomes(
    members: DataFrame, responses: DataFrame, model: Column, enriched_at: Column,
    sequence: Sequence[str] = (),
) -> DataFrame:
    """One summary row per pending story, to append to the summary table.

    A story with a valid answer succeeds with all its fields; any other gets a failed row with
    empty fields and the answer or error text. One bad answer never touches another story. Of
    answers of one attempt the last by ``sequence`` counts.
    """
    # Both are used twice: for the stories and for the articles their answers refer to.
    members = materialize(members.select("cluster_id", "url_hash", "member_no"), "members")
    chosen = materialize(checked_responses(responses, sequence), "chosen")
    stories = (
        pending_clusters(members)
        .join(chosen, "cluster_id", "left")
        .join(_perspectives(chosen, members), "cluster_id", "left")
    )
    ok = F.coalesce(F.col("answer.valid"), F.lit(False))
    no_texts = F.array().cast("array<string>")

    def text(name):
        return F.when(ok, F.col(f"answer.{name}")).otherwise("").alias(name)

    def texts(name):
        return F.when(ok, F.col(f"answer.{name}")).otherwise(no_texts).alias(name)

    def optional(name):
        return F.when(ok, F.col(f"answer.{name}")).alias(name)

    error = F.substring(F.coalesce("error", F.lit(EMPTY_ANSWER)), 1, 2000)
    raw = F.coalesce(F.nullif("raw_text", F.lit("")), error)
    rows = stories.select(
        "cluster_id", text("summary"), texts("keywords"), text("topic"), text("sentiment"),
        optional("sentiment_score"), model.alias("llm_model"),
        F.when(ok, "success").otherwise("failed").alias("enrichment_status"),
        F.when(~ok, raw).alias("raw_llm_response"),
        "article_count", enriched_at.alias("enriched_at"),
        texts("key_facts_organizations"), texts("key_facts_locations"),
        texts("key_facts_people"), text("why_it_matters"),
        optional("before_state"), optional("after_state"),
        texts("consensus_points"), texts("disagreement_points"),
        F.coalesce(
            "source_perspectives", F.array().cast("array<struct<url_hash:string,focus:string>>")
        ).alias("source_perspectives"),
    )
    return rows.select(*SUMMARY_CLUSTERS.fieldNames())


def enrichment_counts(rows: DataFrame) -> DataFrame:
    """Attempted, succeeded and failed stories, and whether too many failed."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("enrichment_status") == "success").alias("succeeded"),
        F.count_if(F.col("enrichment_status") == "failed").alias("failed"),
    )
    rate = F.col("failed") / F.nullif("attempted", F.lit(0))
    return counts.withColumn(
        "is_over_limit", F.coalesce(rate > MAX_FAILURE_RATE, F.lit(False))
    )

