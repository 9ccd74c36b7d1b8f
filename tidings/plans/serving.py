"""Serving queries on the summary, assignment, article and vote tables.

``summaries`` and ``assignments`` are current rows (one per story, one per article).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.labels import age_label, consensus_label, coverage_label, source_label
from tidings.functions.text import contains_pattern
from tidings.operators.keyed import latest
from tidings.operators.skew import join_spread
from tidings.plans.enrichment import successful
from tidings.session import materialize

# Candidates of the personal feed, weight of a topic, and columns of cards and details.
CANDIDATES = 200
TOPIC_WEIGHT = 2
#: pieces a reader's likes are cut in
PIECES = 64
CARD = [
    "cluster_id", "summary", "topic", "sentiment", "sentiment_score", "keywords",
    "article_count", "enriched_at", "first_published_at", "image_url",
]
DETAIL = [
    "key_facts_organizations", "key_facts_locations", "key_facts_people", "why_it_matters",
    "before_state", "after_state", "consensus_points", "disagreement_points",
]


def _check(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be between {low} and {high}")


def _check_page(limit: int, offset: int) -> None:
    _check("limit", limit, 1, 100)
    _check("offset", offset, 0)


def story_media(assignments: DataFrame, articles: DataFrame) -> DataFrame:
    """First publish time and one image of each story that has articles."""
    return (
        assignments.select("url_hash", "cluster_id")
        .join(articles.select("url_hash", "published_at", "url_to_image"), "url_hash")
        .groupBy("cluster_id")
        .agg(
            F.min("published_at").alias("first_published_at"),
            F.min("url_to_image").alias("image_url"),
        )
    )


def cards(summaries: DataFrame, media: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Cards of the successful stories that still exist."""
    joined = successful(summaries).join(media, "cluster_id")
    return joined.select(*CARD, *(extra or []))


def matching(feed: DataFrame, topic: str | None = None, q: str | None = None) -> DataFrame:
    """Cards of a topic (exact) and with a text in summary or a keyword (any case)."""
    if topic:
        feed = feed.where(F.col("topic") == topic)
    if q:
        pattern = contains_pattern(q)
        feed = feed.where(
            F.col("summary").ilike(pattern)
            | F.exists("keywords", lambda word: word.ilike(pattern))
        )
    return feed


def _newest() -> list[Column]:
    """Newest enrichment first; the id settles equal times."""
    return [F.desc("enriched_at"), F.asc("cluster_id")]


def feed_page(
    feed: DataFrame,
    limit: int = 20,
    offset: int = 0,
    topic: str | None = None,
    q: str | None = None,
) -> DataFrame:
    """A page of the anonymous feed, newest enrichment first."""
    _check_page(limit, offset)
    return matching(feed, topic, q).orderBy(*_newest()).offset(offset).limit(limit)


def feed_after(
    feed: DataFrame, enriched_at: Column | None = None, cluster_id: Column | None = None,
    limit: int = 20,
) -> DataFrame:
    """The page after a given card, without reading the pages before it."""
    _check_page(limit, 0)
    if enriched_at is not None:
        later = (F.col("enriched_at") < enriched_at) | (
            (F.col("enriched_at") == enriched_at) & (F.col("cluster_id") > cluster_id)
        )
        feed = feed.where(later)
    return feed.orderBy(*_newest()).limit(limit)


def user_votes(votes: DataFrame, user_id: int) -> DataFrame:
    return votes.where(F.col("user_id") == user_id).select("cluster_id", "vote")


def liked(votes: DataFrame) -> DataFrame:
    return votes.where(F.col("vote") == 1)


def affinity_profiles(
    votes: DataFrame, summaries: DataFrame, among: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Weights of topics and of keywords per reader, from the stories they like.

    A keyword counts once per occurrence. The status of a summary does not matter here. With
    ``among(keyword)``, a bounded set, weights of other keywords are left out before they are counted.
    """
    words = summaries.select("cluster_id", "topic", "keywords")
    likes = liked(votes).select("user_id", "cluster_id")
    known = join_spread(likes, words, ["cluster_id"], "user_id")
    topics = known.groupBy("user_id", "topic").agg(F.count(F.lit(1)).alias("weight"))
    words_liked = known.select("user_id", F.explode("keywords").alias("keyword"))
    if among is not None:
        words_liked = words_liked.join(F.broadcast(among), "keyword", "left_semi")
    keywords = words_liked.groupBy("user_id", "keyword").agg(F.count(F.lit(1)).alias("weight"))
    return topics, keywords


def affinity_feed(
    feed: DataFrame,
    votes: DataFrame,
    summaries: DataFrame,
    limit: int = 20,
    offset: int = 0,
    topic: str | None = None,
    q: str | None = None,
    readers: DataFrame | None = None,
) -> DataFrame:
    """The page of the personal feed for every reader: one row per reader and card.

    ``readers`` are the ``user_id`` to rank for; without it, those who have voted. A reader
    without likes gets the order of the feed.

    The candidates are the 200 newest matching cards. A card scores twice the weight of its
    topic plus the weights of its keywords, each less the card's own share if the reader likes
    it; equal scores keep the order of the feed. ``rank`` is the place in the ranked list.

    All readers are ranked in one job: scores come from joins on topic and keyword with the
    candidates, which are broadcast since there are 200 at most. A reader's weights of the
    candidates' words are bounded as well; they come together before they meet the cards, so that
    scores are summed up before they are shuffled. The own share of a liked card is taken off
    where the profile has the word: every weight is at least 1. Cards without a score matter
    only up to the end of the page, so a reader gets the scored ones and the first
    ``offset + limit`` of the feed.
    """
    _check_page(limit, offset)
    top = matching(feed, topic, q).orderBy(*_newest()).limit(CANDIDATES)
    place = F.row_number().over(Window.orderBy(*_newest())) - 1
    # Written once, since it is used several times and the feed behind it is large.
    window = materialize(top.withColumn("place", place), "candidates")
    end = min(offset + limit, CANDIDATES)
    if readers is not None:
        readers = readers.select("user_id").distinct()
        votes = votes.join(readers, "user_id", "left_semi")
    # Written once; the fold of the votes is used for readers, profiles, and the own votes.
    votes = materialize(votes.select("user_id", "cluster_id", "vote"), "votes", codec="zstd")
    if readers is None:
        readers = votes.select("user_id").distinct()
    card_topics = F.broadcast(window.select("place", "topic"))
    words = (
        window.select("place", F.explode("keywords").alias("keyword"))
        .groupBy("place", "keyword")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    card_words = F.broadcast(words)
    topics, keywords = affinity_profiles(votes, summaries, words.select("keyword").distinct())
    # Written too: the weights meet all cards, and the own ones once more.
    keywords = materialize(keywords.repartition("user_id"), "keywords", codec="zstd")

    by_topic = topics.join(card_topics, "topic").select(
        "user_id", "place", (F.col("weight") * TOPIC_WEIGHT).alias("score")
    )
    by_word = keywords.join(card_words, "keyword").select(
        "user_id", "place", (F.col("weight") * F.col("times")).alias("score")
    )
    own = liked(votes).join(F.broadcast(window), "cluster_id")
    own_topics = own.select("user_id", "place", "topic").join(topics, ["user_id", "topic"])
    own_words = own.select("user_id", "place").join(card_words, "place")
    own_words = own_words.join(keywords, ["user_id", "keyword"])
    scored = by_topic.unionByName(by_word)
    for taken, times in ((own_topics, F.lit(TOPIC_WEIGHT)), (own_words, F.col("times"))):
        scored = scored.unionByName(
            taken.select("user_id", "place", (-times).cast("long").alias("score"))
        )
    first_places = F.explode(F.sequence(F.lit(0), F.lit(end - 1))).alias("place")
    unscored = readers.select("user_id", first_places, F.lit(0).cast("long").alias("score"))
    scores = (
        scored.unionByName(unscored).groupBy("user_id", "place").agg(F.sum("score").alias("score"))
    )
    # A reader has at most 200 rows here.
    ranked = scores.join(F.broadcast(window.select("place")), "place", "left_semi").withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("score"), "place")),
    )
    page = ranked.where((F.col("rank") > offset) & (F.col("rank") <= offset + limit))
    shown = page.join(F.broadcast(window), "place").select("user_id", "rank", "score", *CARD)
    on_cards = votes.join(F.broadcast(window.select("cluster_id")), "cluster_id", "left_semi")
    return with_own_vote(shown, on_cards)


def with_own_vote(shown: DataFrame, votes: DataFrame) -> DataFrame:
    """Add the reader's vote on each card, NULL when there is none."""
    own = votes.select("user_id", "cluster_id", F.col("vote").alias("my_vote"))
    return shown.join(own, ["user_id", "cluster_id"], "left")


def liked_page(votes: DataFrame, feed: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """The page of liked cards of every reader, newest like first.

    The page is cut before the cards are joined, so likes of stories without a card leave it
    short. A reader's likes are cut in pieces, each piece is reduced to the page, and what is left
    is ranked, so that a reader with very many likes is no single task.
    """
    _check_page(limit, offset)
    end = offset + limit
    newest = [F.desc("created_at"), F.asc("cluster_id")]
    likes = liked(votes).select("user_id", "cluster_id", "created_at")
    likes = likes.withColumn("piece", F.pmod(F.xxhash64("cluster_id"), F.lit(PIECES)))
    of_piece = Window.partitionBy("user_id", "piece").orderBy(*newest)
    likes = likes.withColumn("place", F.row_number().over(of_piece))
    likes = likes.where(F.col("place") <= end).drop("piece", "place")
    order = Window.partitionBy("user_id").orderBy(*newest)
    ranked = likes.withColumn("like_rank", F.row_number().over(order))
    page = ranked.where(F.col("like_rank") <= end).where(F.col("like_rank") > offset)
    shown = join_spread(
        page.select("user_id", "cluster_id", "like_rank"), feed, ["cluster_id"], "user_id"
    )
    return shown.select("user_id", "like_rank", *CARD, F.lit(1).alias("my_vote"))


def card_labels(feed: DataFrame, as_of: Column) -> DataFrame:
    """Texts shown on a card."""
    return feed.withColumns(
        {
            "consensus": consensus_label(F.col("article_count")),
            "age": age_label(F.col("first_published_at"), as_of),
            "coverage": coverage_label(F.col("article_count")),
        }
    )


def story_detail(
    summaries: DataFrame, media: DataFrame, cluster_id: str | None = None
) -> DataFrame:
    """Detail rows of all stories, or of one; no row means the story does not exist.

    The flags tell which optional sections have something to show.
    """
    if cluster_id is not None:
        summaries = summaries.where(F.col("cluster_id") == cluster_id)
        media = media.where(F.col("cluster_id") == cluster_id)

    def filled(*names):
        sizes = [F.size(name) > 0 for name in names]
        result = sizes[0]
        for size in sizes[1:]:
            result = result | size
        return result

    def given(name):
        return F.coalesce(F.col(name) != "", F.lit(False))

    has_analysis = given("why_it_matters")
    return cards(summaries, media, DETAIL).withColumns(
        {
            "has_analysis": has_analysis,
            "has_change": has_analysis & given("before_state") & given("after_state"),
            "has_key_facts": filled(*DETAIL[:3]),
            "has_consensus": filled("consensus_points", "disagreement_points"),
        }
    )


def story_sources(
    assignments: DataFrame, articles: DataFrame, summaries: DataFrame,
    cluster_id: str | None = None,
) -> DataFrame:
    """Member articles of the shown stories with the focus text of each, in time order.

    Of several texts for one article the last counts. Unknown times come last.
    """
    shown = successful(summaries)
    if cluster_id is not None:
        shown = shown.where(F.col("cluster_id") == cluster_id)
        assignments = assignments.where(F.col("cluster_id") == cluster_id)
    entries = shown.select(
        "cluster_id", F.posexplode("source_perspectives").alias("place", "entry")
    ).select("cluster_id", "place", "entry.*")
    focus = latest(entries, ["cluster_id", "url_hash"], ["place"])
    members = join_spread(
        assignments.select("url_hash", "cluster_id"),
        shown.select("cluster_id"), ["cluster_id"], "url_hash", "left_semi",
    )
    columns = ["url_hash", "source_name", "source_provider", "title", "url", "url_to_image",
               "published_at", "category"]
    rows = members.join(articles.select(*columns), "url_hash").join(
        focus.select("cluster_id", "url_hash", F.col("focus").alias("source_summary")),
        ["cluster_id", "url_hash"], "left",
    )
    return rows.withColumn("source_label", source_label(F.col("source_name"))).orderBy(
        "cluster_id", F.asc_nulls_last("published_at"), "url_hash"
    )


def daily_page(stats: DataFrame, limit: int = 100) -> DataFrame:
    """Newest days first, most articles first."""
    _check("limit", limit, 1, 1000)
    return stats.orderBy(
        F.desc("published_date"), F.desc("article_count"), F.asc_nulls_last("source_name")
    ).limit(limit)


def topic_stats(summaries: DataFrame) -> DataFrame:
    """Successful stories per topic, also those that are no longer in the feed."""
    return (
        successful(summaries)
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("cluster_count"))
        .orderBy(F.desc("cluster_count"), "topic")
    )
