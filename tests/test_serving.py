"""Feed, search, ranking, liked list, detail, statistics, history."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidings.plans import history, serving
from tidings.schemas import SUMMARY_CLUSTERS

T0 = datetime(2024, 3, 1)


def summaries(spark, *rows):
    """Rows of (id, topic, keywords) or with a dict of further columns; newest last."""
    texts = "array<string>"
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], T0 + timedelta(minutes=n), *(
            (r[3] if len(r) > 3 else {}).get(name) for name in (
                "status", "summary", "why", "before", "after", "organizations", "consensus")))
         for n, r in enumerate(rows)],
        f"cluster_id string, topic string, keywords {texts}, enriched_at timestamp, "
        f"status string, s string, why string, before_state string, after_state string, "
        f"organizations {texts}, consensus {texts}")
    empty = F.array().cast(texts)
    return df.withColumns({
        "enrichment_status": F.coalesce("status", F.lit("success")),
        "summary": F.coalesce("s", F.lit("text")), "why_it_matters": F.coalesce("why", F.lit("")),
        "sentiment": F.lit("n"), "sentiment_score": F.lit(0.0).cast("float"),
        "llm_model": F.lit("m"), "raw_llm_response": F.lit(None).cast("string"),
        "article_count": F.lit(1),
        "key_facts_organizations": F.coalesce("organizations", empty),
        "key_facts_locations": empty, "key_facts_people": empty,
        "consensus_points": F.coalesce("consensus", empty), "disagreement_points": empty,
        "source_perspectives": F.array(
            *[F.struct(F.lit(k).alias("url_hash"), F.lit(f).alias("focus"))
              for k, f in (("u1", "old"), ("u9", "none"), ("u1", "new"))]),
    }).select(*SUMMARY_CLUSTERS.fieldNames())


def media(spark, *ids):
    return spark.createDataFrame([(i, T0, "img") for i in ids],
                                 "cluster_id string, first_published_at timestamp, image_url string")


def votes(spark, *rows):
    return spark.createDataFrame(
        [(u, c, v, T0 + timedelta(minutes=n)) for n, (u, c, v) in enumerate(rows)],
        "user_id long, cluster_id string, vote int, created_at timestamp")


def ids(df):
    return [r.cluster_id for r in df.collect()]


def test_media_and_cards(spark):
    assigned = spark.createDataFrame([("u1", "a"), ("u2", "a"), ("u3", "b")],
                                     "url_hash string, cluster_id string")
    articles = spark.createDataFrame(
        [("u1", T0, None), ("u2", T0 - timedelta(days=1), "z"), ("u3", None, None)],
        "url_hash string, published_at timestamp, url_to_image string")
    found = serving.story_media(assigned, articles)
    assert {tuple(r) for r in found.collect()} == {("a", T0 - timedelta(days=1), "z"),
                                                   ("b", None, None)}
    table = summaries(spark, ("a", "x", []), ("b", "x", [], {"status": "failed"}), ("gone", "x", []))
    assert ids(serving.cards(table, found)) == ["a"]
    assert {tuple(r) for r in serving.topic_stats(table).collect()} == {("x", 2)}


def test_feed_filters_and_pages(spark):
    table = summaries(
        spark, ("a", "Tech", ["Solar"]), ("b", "Tech", [], {"summary": "big SOLAR plant"}),
        ("c", "tech", ["solar"]), ("d", "Tech", ["sol_ar"]))
    feed = serving.cards(table, media(spark, "a", "b", "c", "d"))
    assert ids(serving.feed_page(feed)) == ["d", "c", "b", "a"]
    assert ids(serving.feed_page(feed, 2, 1)) == ["c", "b"]
    assert ids(serving.feed_page(feed, topic="Tech", q="solar")) == ["b", "a"]
    assert ids(serving.feed_page(feed, topic="", q="")) == ["d", "c", "b", "a"]
    assert ids(serving.feed_page(feed, q="s_l%r")) == ["d", "c", "b", "a"]
    pages, last = [], None
    while True:
        at = (F.lit(last.enriched_at), F.lit(last.cluster_id)) if last else (None, None)
        page = serving.feed_after(feed, *at, limit=3).collect()
        pages.append([r.cluster_id for r in page])
        if len(page) < 3:
            break
        last = page[-1]
    assert pages == [["d", "c", "b"], ["a"]]
    for limit, offset in ((0, 0), (101, 0), (1, -1)):
        with pytest.raises(ValueError):
            serving.feed_page(feed, limit, offset)


def rank(spark, cards, liked, limit=20, offset=0):
    """Order of the cards for one reader; cards and liked are (id, topic, keywords), newest first."""
    table = summaries(spark, *reversed(cards))
    extra = [row for row in liked if row[0] not in {c[0] for c in cards}]
    known = table.unionByName(summaries(spark, *extra)) if extra else table
    feed = serving.cards(table, media(spark, *[c[0] for c in cards]))
    mine = votes(spark, *[(1, row[0], 1) for row in liked], (1, "zz", -1))
    rows = serving.affinity_feed(feed, mine, known, limit, offset).orderBy("rank").collect()
    return [(r.cluster_id, r.score) for r in rows]


CARDS = [("a", "Sports", ["x"]), ("b", "Tech", ["chips", "ai"]), ("c", "Tech", ["x"]),
         ("d", "World", ["chips", "chips"])]


def test_ranking(spark):
    assert rank(spark, CARDS, []) == [("a", 0), ("b", 0), ("c", 0), ("d", 0)]
    liked = [("l1", "Tech", ["chips"]), ("l2", "Tech", ["ai", "chips"])]
    assert rank(spark, CARDS, liked) == [("b", 7), ("c", 4), ("d", 4), ("a", 0)]
    assert rank(spark, CARDS, liked, 2, 1) == [("c", 4), ("d", 4)]


def test_own_share_is_taken_off_once_per_occurrence(spark):
    got = dict(rank(spark, CARDS, [CARDS[3]]))
    # profile: World 1, chips 2; d itself: 0 + 2 * (2 - 1); b: chips 2
    assert got == {"a": 0, "b": 2, "c": 0, "d": 2}


def test_every_reader_is_ranked_with_own_votes(spark):
    table = summaries(spark, *CARDS)
    feed = serving.cards(table, media(spark, "a", "b", "c", "d"))
    mine = votes(spark, (1, "a", 1), (2, "d", -1), (2, "b", 1))
    rows = serving.affinity_feed(feed, mine, table).collect()
    by = {(r.user_id, r.cluster_id): r for r in rows}
    assert len(rows) == 8
    assert by[1, "a"].my_vote == 1 and by[2, "d"].my_vote == -1 and by[2, "a"].my_vote is None
    # the newest card is d; b is the reader's own and gains nothing from itself
    ranks = {c: (by[2, c].rank, by[2, c].score) for c in "abcd"}
    assert ranks == {"d": (1, 2), "c": (2, 2), "b": (3, 0), "a": (4, 0)}


def test_given_readers_are_ranked(spark):
    table = summaries(spark, *CARDS)
    feed = serving.cards(table, media(spark, "a", "b", "c", "d"))
    mine = votes(spark, (1, "a", 1), (2, "b", 1))
    some = spark.createDataFrame([(2,), (9,)], "user_id long")
    rows = serving.affinity_feed(feed, mine, table, readers=some).collect()
    order = {u: [r.cluster_id for r in sorted(rows, key=lambda r: r.rank) if r.user_id == u]
             for u in (1, 2, 9)}
    assert order == {1: [], 2: ["d", "c", "b", "a"], 9: ["d", "c", "b", "a"]}


def test_liked_page_may_be_short(spark):
    feed = serving.cards(summaries(spark, ("a", "t", []), ("c", "t", [])), media(spark, "a", "c"))
    mine = votes(spark, (1, "a", 1), (1, "gone", 1), (1, "b", -1), (1, "c", 1), (2, "a", 1))
    rows = serving.liked_page(mine, feed, 2).orderBy("user_id", "like_rank").collect()
    assert [(r.user_id, r.like_rank, r.cluster_id, r.my_vote) for r in rows] == [
        (1, 1, "c", 1), (2, 1, "a", 1)]
    assert {r.cluster_id for r in serving.user_votes(mine, 1).collect()} == {"a", "gone", "b", "c"}


def test_deep_liked_pages(spark):
    ids_ = [f"c{n:04d}" for n in range(1300)]
    feed = serving.cards(summaries(spark, *[(i, "t", []) for i in ids_]), media(spark, *ids_))
    mine = votes(spark, *[(1, i, 1) for i in ids_])
    rows = serving.liked_page(mine, feed, 100, 1150).orderBy("like_rank").collect()
    assert [r.cluster_id for r in rows] == ids_[::-1][1150:1250]


def test_detail_and_sources(spark):
    table = summaries(
        spark, ("a", "t", [], {"why": "w", "before": "b", "after": "a", "organizations": ["o"]}),
        ("b", "t", [], {"before": "b", "after": "a", "consensus": ["p"]}),
        ("c", "t", [], {"why": "w", "before": "b"}))
    detail = {r.cluster_id: r for r in
              serving.story_detail(table, media(spark, "a", "b", "c")).collect()}
    flags = ("has_analysis", "has_change", "has_key_facts", "has_consensus")
    assert [detail["a"][f] for f in flags] == [True, True, True, False]
    assert [detail["b"][f] for f in flags] == [False, False, False, True]
    assert [detail["c"][f] for f in flags] == [True, False, False, False]
    assert serving.story_detail(table, media(spark, "a"), "nope").isEmpty()
    assert ids(serving.story_detail(table, media(spark, "a", "b"), "b")) == ["b"]
    assigned = spark.createDataFrame([("u1", "a"), ("u2", "a"), ("u3", "a"), ("u4", "x")],
                                     "url_hash string, cluster_id string")
    articles = spark.createDataFrame(
        [("u1", None, T0), ("u2", "S", None), ("u3", "S", T0 - timedelta(days=1)), ("u4", "S", T0)],
        "url_hash string, source_name string, published_at timestamp")
    more = ["source_provider", "title", "url", "url_to_image", "category"]
    articles = articles.withColumns({name: F.lit("v") for name in more})
    rows = serving.story_sources(assigned, articles, table, "a").collect()
    assert [(r.url_hash, r.source_label, r.source_summary) for r in rows] == [
        ("u3", "S", None), ("u1", "Unknown source", "new"), ("u2", "S", None)]


def test_statistics_and_history(spark):
    stats = spark.createDataFrame([("2024-01-01", "a", 5), ("2024-01-02", "b", 1),
                                   ("2024-01-02", None, 1), ("2024-01-02", "a", 3)],
                                  "published_date string, source_name string, article_count long")
    got = [(r.published_date[-1], r.source_name) for r in serving.daily_page(stats, 3).collect()]
    assert got == [("2", "a"), ("2", "b"), ("2", None)]
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            serving.daily_page(stats, limit)
    with pytest.raises(ValueError):
        history.run_history(stats, 201)


def test_liked_list_is_limited_before_the_shuffle(spark):
    feed = serving.cards(summaries(spark, ("a", "t", [])), media(spark, "a"))
    text = serving.liked_page(votes(spark, (1, "a", 1)), feed, 5, 5)._jdf.queryExecution().toString()
    assert text[text.index("== Physical Plan"):].count("WindowGroupLimit") >= 2


def test_counts_beyond_32_bits(spark):
    from datetime import datetime

    from tidings.plans import history

    at = datetime(2025, 3, 9)
    event = history.close_event(spark, "r", "t", 1, at, 1, counts={"fetched": 3_000_000_000})
    assert event.first().rows_fetched == 3_000_000_000


def test_old_versions_of_a_table_are_dropped(spark):
    from tidings.sources import tables

    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    for k in range(4):
        rows = tables.publish_table(spark.range(k + 1).toDF("n"), "kept.rows_of")
        assert rows.count() == k + 1
    stored = spark.sql("SHOW TABLES IN kept LIKE 'rows_of_v*'").where("NOT isTemporary").collect()
    assert len(stored) == 2
