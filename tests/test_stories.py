"""Stories against a pairwise comparison of all articles on small random inputs."""

import random
from datetime import datetime, timedelta

import pytest

from suite import queries, views
from tidings.functions.text import STOPWORDS
from tidings.operators import similarity
from tidings.operators.similarity import Limits
from tidings.plans.stories import story_clusters

SCHEMA = "url_hash string, title string, published_at timestamp"
START = datetime(2024, 1, 1)


def tokens(title):
    word, words = "", []
    for letter in (title or "").lower() + " ":
        if letter.isascii() and letter.isalnum():
            word += letter
        elif word:
            words.append(word)
            word = ""
    return {w for w in words if len(w) > 2 and w not in STOPWORDS}


def brute_force(rows):
    """Story of every article by repeated spreading of the earliest member."""
    sets = [tokens(title) for _, title, _ in rows]
    links = [[] for _ in rows]
    for i, (_, _, ti) in enumerate(rows):
        for j in range(i):
            tj = rows[j][2]
            near = ti is None or tj is None or abs(ti - tj) <= timedelta(days=1)
            shared = len(sets[i] & sets[j])
            if near and shared and 2 * shared >= len(sets[i] | sets[j]):
                links[i].append(j)
                links[j].append(i)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][2] or datetime.min, rows[i][0]))
    story = {}
    for head in order:
        if head in story:
            continue
        open_rows = [head]
        while open_rows:
            i = open_rows.pop()
            if i not in story:
                story[i] = rows[head][0]
                open_rows.extend(links[i])
    return {rows[i][0]: cluster for i, cluster in story.items()}


def clusters(spark, rows, limits=Limits()):
    df = spark.createDataFrame(rows, SCHEMA)
    got = story_clusters(df, limits).collect()
    assert len(got) == len(rows)
    return {row.url_hash: row.cluster_id for row in got}


def random_rows(seed, n, words, days, longest):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(words)] + ["the", "of", "ai"]
    rows = []
    for i in range(n):
        title = " ".join(rng.choices(vocabulary, k=rng.randint(0, longest)))
        at = START + timedelta(seconds=rng.choice([3600, 86400, 43200, 1]) * rng.randint(0, days))
        rows.append((f"{rng.getrandbits(64):016x}", title or None, rng.choice([at] * 7 + [None])))
    return rows


@pytest.mark.parametrize(
    "seed, words, days, longest, limits",
    [
        (1, 12, 3, 4, Limits()),
        (2, 12, 3, 6, Limits(group=2, pivots=2, pieces=3)),
        (3, 30, 2, 8, Limits(group=3, pivots=1, pieces=2)),
        (4, 8, 5, 3, Limits(group=2)),
        (5, 60, 1, 9, Limits(group=4)),
    ],
)
def test_matches_pairwise_comparison(spark, seed, words, days, longest, limits):
    rows = random_rows(seed, 150, words, days, longest)
    assert clusters(spark, rows, limits) == brute_force(rows)


def test_family_of_near_copies_in_large_groups(spark):
    common = "alpha bravo charlie delta echo foxtrot golf hotel"
    rows = [(f"{i:04x}", f"{common} extra{i} other{i % 7}", START) for i in range(120)]
    rows += [(f"f{i:03x}", f"alpha bravo only{i} also{i}", START) for i in range(80)]
    limits = Limits(group=5, pivots=2, pieces=4)
    assert clusters(spark, rows, limits) == brute_force(rows)


def test_times_and_empty_titles(spark):
    title = "Old lighthouse opens its lamp room"
    rows = [
        ("a", title, START),
        ("b", title, START + timedelta(days=1)),
        ("c", title, START + timedelta(days=2, seconds=1)),
        ("d", title, START + timedelta(days=25)),
        ("e", None, START),
        ("f", "the of", START),
        ("g", "the of", START),
    ]
    assert clusters(spark, rows) == {
        "a": "a", "b": "a", "c": "c", "d": "d", "e": "e", "f": "f", "g": "g"
    }


def test_unknown_time_links_everything_and_comes_first(spark):
    rows = [
        ("x", "Ferry crews paint wooden hulls", START),
        ("y", "Ferry crews paint wooden hulls", START + timedelta(days=30)),
        ("z", "Ferry crews paint hulls", None),
    ]
    assert set(clusters(spark, rows).values()) == {"z"}


def test_single_words(spark):
    rows = [("a", "Breaking", START), ("b", "Breaking storm", START),
            ("c", "Breaking flood", START + timedelta(hours=20)),
            ("d", "Storm", START + timedelta(days=3)), ("e", "Flood", None)]
    assert clusters(spark, rows) == brute_force(rows)


def test_empty_input(spark):
    assert clusters(spark, []) == {}


def test_copies_of_one_title_are_split_over_tasks(spark):
    """With sizes scaled down, the last join splits the rows of a title with many copies."""
    from pyspark.sql import functions as F

    title = F.when(F.col("id") % 3 == 0, "one headline copied everywhere").otherwise(
        F.concat(F.lit("headline number"), F.col("id").cast("string"))
    )
    articles = spark.range(0, 60000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("url_hash"),
        title.alias("title"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("published_at"),
    )
    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in scaled}
    for name, value in scaled.items():
        spark.conf.set(name, value)
    try:
        found = story_clusters(articles)
        assert found.groupBy("cluster_id").count().agg(F.max("count")).first()[0] == 20000
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def hot_population(spark, size, rest=60):
    """One long title of ``size`` frequent words, and titles that make them frequent."""
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(size)]
    rnd = random.Random(size)
    rows = [("0000", " ".join(words), START)]
    rows += [(f"{i:04x}", " ".join(rnd.sample(words, size // 2)), START) for i in range(1, rest)]
    nodes = similarity.title_nodes(similarity.title_rows(spark.createDataFrame(rows, SCHEMA)))
    units, _ = similarity._cliques(similarity._ordered_nodes(nodes, Limits(group=8)))
    keys = similarity._hot_keys(units)
    return keys.where(f"len = {size}").count()


def test_keys_grow_with_the_tokens_of_a_title(spark):
    few, many = hot_population(spark, 160), hot_population(spark, 320)
    assert 0 < few < 2000
    assert many <= 2.2 * few


@pytest.mark.parametrize("levels", [1, 3])
def test_levels_of_split_groups(spark, monkeypatch, levels):
    """Large groups whose members are not all alike; the number of levels changes no story."""
    rnd = random.Random(1)
    words = [f"w{chr(97 + i)}{chr(98 + i)}x" for i in range(12)]
    rows = [
        (f"{i:04x}", " ".join([*rnd.sample(words, rnd.choice([2, 3, 4, 5, 6, 7])), *[f"own{i}"] * (i % 2)]),
         START + timedelta(hours=rnd.randrange(50)))
        for i in range(150)
    ]
    reached = []
    taken = similarity._next_keys
    monkeypatch.setattr(
        similarity, "_next_keys", lambda *a: reached.append(a[2]) or taken(*a)
    )
    limits = Limits(group=3, pivots=1, pieces=3, levels=levels)
    assert clusters(spark, rows, limits) == brute_force(rows)
    assert max(reached, default=0) <= levels - 1
    assert levels == 1 or reached


def test_registered_hot_query_takes_every_branch(spark):
    limits = queries.HOT_LIMITS
    rows = similarity.title_rows(views.busy_articles(spark, "/root/testdata/sf0.001"))
    nodes = similarity.title_nodes(rows)
    assert similarity._hot_tokens(nodes, limits).count() > 0
    ordered = similarity._ordered_nodes(nodes, limits)
    units, _ = similarity._cliques(ordered)
    assert units.count() > 0
    members = similarity._members(similarity._hot_keys(units))
    assert similarity._groups(members, limits).where(f"size > {limits.small}").count() > 0


def test_few_pairs_leave_a_group(spark, monkeypatch):
    """Titles that share words but too few of them are told apart where they meet."""
    rnd = random.Random(7)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]
    rows = [(f"{i:04x}", " ".join(rnd.sample(words, 20)), START) for i in range(120)]
    rows += [(f"f{i:03x}", f"{rows[i][1]} again{i}", START) for i in range(10)]
    looked_at = []
    taken = similarity._verify

    def counted(pairs, subjects):
        looked_at.append(pairs.distinct().count())
        return taken(pairs, subjects)

    monkeypatch.setattr(similarity, "_verify", counted)
    found = clusters(spark, rows)
    assert found == brute_force(rows) and len(set(found.values())) == 120
    assert 10 <= sum(looked_at) <= 100
