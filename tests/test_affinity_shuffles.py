"""What the personal feed shuffles: scores, and not every term of a score."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidings.plans import serving


def test_terms_are_summed_before_they_are_shuffled(spark):
    """Cards of equal words: rows that meet in the final sum stay near readers times cards."""
    cards, readers, words = 40, 30, 25
    start = datetime(2024, 1, 1)
    names = [f"w{k}" for k in range(words)]
    rows = [(f"c{k:02d}", f"s{k}", "t", "n", None, names, 1, start + timedelta(hours=k), None, None)
            for k in range(cards)]
    feed = spark.createDataFrame(
        rows, "cluster_id string, summary string, topic string, sentiment string, "
        "sentiment_score float, keywords array<string>, article_count int, enriched_at timestamp, "
        "first_published_at timestamp, image_url string")
    summaries = feed.select("cluster_id", "topic", "keywords")
    votes = spark.range(readers).select(
        F.col("id").alias("user_id"), F.explode(F.array(F.lit("c00"), F.lit("c01"))).alias("cluster_id"),
        F.lit(1).cast("short").alias("vote"))
    page = serving.affinity_feed(feed, votes, summaries, 40)
    found = page.collect()
    # Two likes: each card has twice two for the topic and two for each word, own cards half of it.
    full = 2 * 2 + 2 * words
    assert len(found) == readers * cards
    assert {r.score for r in found if r.cluster_id > "c01"} == {full}
    assert {r.score for r in found if r.cluster_id <= "c01"} == {full // 2}
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    # No join by reader and story before the sum: the only one left adds the own votes.
    assert plan.count("user_id") and plan.count("Join LeftOuter") == 1
