"""Landed files, provider mapping, inserts, layers."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidings.plans import layers
from tidings.schemas import LANDED_ITEM, LAYERS, RAW_ARTICLES
from tidings.operators import keyed
from tidings.sources import landing, tables

def now():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def first_article(n, url=None):
    return {"source": {"id": "tide-post", "name": "The Tide Post"}, "author": "M. Quill", "title": f"T{n}",
            "description": "D", "content": "C", "url": url or f"https://e.com/{n}",
            "urlToImage": "https://e.com/pier.png", "publishedAt": "2025-03-09T08:30:00Z"}


def second_article(n, url=None):
    return {"source": {"name": "quaynews.test", "url": "x"}, "title": f"G{n}", "description": "D",
            "content": "C", "url": url or f"https://g.com/{n}", "image": "https://g.com/quay.png",
            "publishedAt": "2025-03-09T08:41:00Z"}


def items(spark, *entries):
    """Entries of (provider, ordinal, article) as landed items."""
    rows = [(n, "technology", json.dumps(a), "2024-01-01", "r1", p) for p, n, a in entries]
    return spark.createDataFrame(rows, LANDED_ITEM)


def test_providers_are_mapped(spark):
    rows = landing.normalise_items(items(
        spark, ("newsapi", 0, first_article(1)), ("gnews", 0, second_article(1)),
        ("other", 0, {"title": "x", "url": "u", "urlToImage": "i", "image": "j"}),
    ))
    by = {r.source_provider: r for r in rows.collect()}
    a, g, o = by["newsapi"], by["gnews"], by["other"]
    assert (a.source_id, a.source_name, a.author) == ("tide-post", "The Tide Post", "M. Quill")
    assert a.url_to_image == "https://e.com/pier.png"
    assert a.published_at == datetime(2025, 3, 9, 8, 30)
    assert (g.source_id, g.source_name, g.author) == (None, "quaynews.test", None)
    assert g.url_to_image == "https://g.com/quay.png"
    assert (o.source_name, o.url_to_image, o.published_at, o.has_bad_time) == (None, "i", None, False)
    assert json.loads(g.raw_payload) == second_article(1)


def test_items_without_url_are_dropped_before_counting(spark):
    no_url = {**first_article(3), "url": None}
    empty = {**first_article(4), "url": ""}
    rows = landing.normalise_items(items(
        spark, ("newsapi", 0, first_article(1)), ("newsapi", 1, no_url), ("newsapi", 2, empty),
        ("newsapi", 3, first_article(1, "https://E.com/1/?utm_source=x")),
        ("gnews", 0, second_article(1, "https://e.com/1#top")), ("gnews", 1, second_article(2)),
    ))
    new = landing.insert_rows(rows, None, F.lit("r1"), now())
    assert new.columns == RAW_ARTICLES.fieldNames()
    assert {(r.url, r.source_provider) for r in new.collect()} == {
        ("https://e.com/1", "newsapi"), ("https://g.com/2", "gnews")
    }
    assert tuple(landing.insert_counts(rows, new).first()) == (4, 2, 2)
    again = landing.insert_rows(rows, new, F.lit("r2"), now())
    assert tuple(landing.insert_counts(rows, again).first()) == (4, 0, 4)


def test_landing_is_replaced_per_run_and_pruned(spark, tmp_path):
    path = str(tmp_path / "landing")
    base = spark.createDataFrame([(0, "c", "r1", "newsapi"), (1, "c", "r1", "newsapi"),
                                  (0, "c", "r1", "gnews"), (0, "c", "r2", "newsapi")],
                                 "ordinal long, category string, run_id string, provider string")
    rows = base.withColumn("dt", F.lit("2024-01-01")).withColumn(
        "article", F.struct(F.lit("https://e.com/1").alias("url"), F.lit(None).alias("title"))
    )
    landing.write_landing(rows, path)
    landing.write_landing(rows.where("run_id = 'r1' and ordinal = 0"), path)
    got = landing.read_landing(spark, path)
    assert sorted((r.run_id, r.provider, r.ordinal) for r in got.collect()) == [
        ("r1", "gnews", 0), ("r1", "newsapi", 0), ("r2", "newsapi", 0)]
    one = landing.read_landing(spark, path, "2024-01-01", "r2")
    assert json.loads(one.first().article)["url"] == "https://e.com/1"
    text = one._jdf.queryExecution().toString()
    filters = text[text.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "run_id" in filters and "dt" in filters


def test_array_files_keep_their_order(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01" / "run_id=r1"
    folder.mkdir(parents=True)
    entries = [{"provider": "newsapi", "category": "c", "article": first_article(n)}
               for n in range(5)]
    (folder / "newsapi_articles.json").write_text(json.dumps(entries))
    got = landing.read_array_files(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [json.loads(r.article)["title"] for r in got] == [f"T{n}" for n in range(5)]
    assert {(r.run_id, r.provider) for r in got} == {("r1", "newsapi")}


def test_inserted_items_are_the_inserted_rows(spark):
    rows = [(n, "c", json.dumps({"url": u, "title": f"T{n}"}), "2024-01-01", "r1", p)
            for p in ("gnews", "newsapi", "other") for n, u in enumerate(["https://e.com/1", "", "https://e.com/2"])]
    rows += [(None, None, None, None, None, None), (5, "c", "no object", "2024-01-01", "r1", "gnews"),
             (6, "c", json.dumps({"url": "https://e.com/3"}), "2024-01-01", "r1", "other")]
    items = spark.createDataFrame(rows, LANDED_ITEM)
    normal = landing.normalise_items(items)
    for known in (None, landing.insert_rows(normal.where("title = 'T0'"), None, F.lit("r0"), now())):
        want = landing.insert_rows(normal, known, F.lit("r1"), F.lit("2024-01-02").cast("timestamp"))
        got = landing.insert_items(items, known, F.lit("r1"), F.lit("2024-01-02").cast("timestamp"))
        assert got.schema.names == want.schema.names
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.count()


def test_landing_date_falls_back_to_today(spark):
    day = F.lit("2024-05-06 07:00:00").cast("timestamp")
    none = F.lit(None).cast("timestamp")
    row = spark.range(1).select(
        landing.landing_date(day).alias("given"), landing.landing_date(none).alias("absent"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("today"),
    ).first()
    assert row.given == "2024-05-06" and row.absent == row.today


def test_batches_keep_their_order(spark):
    one = landing.tag_items(spark.createDataFrame([(1,)], "a int"), "newsapi", F.lit("c"))
    two = landing.tag_items(spark.createDataFrame([(2,)], "b int"), "gnews", F.lit("c"))
    got = landing.union_batches(one, two).orderBy("batch").collect()
    assert [(r.batch, r.provider, r.a, r.b) for r in got] == [
        (0, "newsapi", 1, None), (1, "gnews", None, 2)]


RAW = [
    # key, source id, source name, title, url, published, fetched
    ("a", "cnn", "CNN", "  A ", "https://cnn.com/a", "2024-01-01 10:00:00", "2024-01-01 12:00:00"),
    ("b", None, "CNN", "B", "https://www.cnn.com/b", "2024-01-01 11:00:00", "2024-01-01 12:00:00"),
    ("c", None, None, None, "https://x.org/c", None, "2024-01-01 12:00:01"),
    ("d", None, "Unknown", "D", "https://y.org/d", "2024-01-02 11:00:00", "2024-01-01 12:00:02"),
]


def raw_table(spark, rows=RAW):
    schema = ("url_hash string, source_id string, source_name string, title string, url string, "
              "published string, fetched string")
    df = spark.createDataFrame(rows, schema)
    filled = {name: F.lit("x") for name in RAW_ARTICLES.fieldNames() if name not in df.columns}
    return df.withColumns(filled).withColumns({
        "published_at": F.col("published").cast("timestamp"),
        "fetched_at": F.col("fetched").cast("timestamp"), "created_at": F.current_timestamp(),
    }).select(*RAW_ARTICLES.fieldNames())


def test_layers(spark):
    stage = layers.stage_articles(raw_table(spark))
    by = {r.url_hash: r for r in stage.collect()}
    assert by["a"].title == "A" and by["b"].url_domain == "www.cnn.com"
    assert by["a"].is_content_truncated is False
    dim = layers.source_dimension(stage)
    assert {tuple(r) for r in dim.collect()} == {
        ("CNN", "cnn", "cnn.com"), ("Unknown", None, "x.org")}
    mart = layers.mart_articles(stage, dim)
    assert {(r.url_hash, r.source_id, r.source_name) for r in mart.collect()} == {
        ("a", "cnn", "CNN"), ("b", "cnn", "CNN"), ("c", None, None), ("d", None, "Unknown")}
    stats = {(str(r.published_date), r.source_name): r.article_count
             for r in layers.daily_stats(mart).collect()}
    assert stats == {("2024-01-01", "CNN"): 2, ("2024-01-02", "Unknown"): 1}


def test_ods_takes_strictly_newer_rows(spark):
    old = layers.stage_articles(raw_table(spark, RAW[:2]))
    assert layers.ods_articles(old, None).count() == 2
    later = [("a", None, "CNN", "A2", "u", None, "2024-01-01 12:00:01"),
             ("b", None, "CNN", "B2", "u", None, "2024-01-01 12:00:00"), RAW[2]]
    got = layers.ods_articles(layers.stage_articles(raw_table(spark, later)), old)
    assert {(r.url_hash, r.title) for r in got.collect()} == {("a", "A2"), ("b", "B"), ("c", None)}


def test_schema_evolution(spark):
    old = spark.createDataFrame([("a", "tech")], "k string, search_keyword string")
    new = spark.createDataFrame([("b", "art", "gnews")], "k string, category string, p string")
    up = tables.evolve(old, {"search_keyword": "category"}, {"p": F.lit("newsapi")})
    assert up.columns == ["k", "category", "p"]
    assert tables.evolve(up, {"search_keyword": "category"}, {"p": F.lit("z")}).first().p == "newsapi"
    got = tables.union_versions(old.withColumnRenamed("search_keyword", "category"), new)
    assert {tuple(r) for r in got.collect()} == {("a", "tech", None), ("b", "art", "gnews")}


def test_catalog(spark):
    rows = tables.catalog(spark).collect()
    assert len(rows) == sum(len(schema.fields) for schema in LAYERS.values())
    assert all(r.comment for r in rows)
    counted = tables.column_counts(raw_table(spark), "raw").collect()
    assert {r.column_name: r.nulls for r in counted}["published_at"] == 1
    assert {r.rows for r in counted} == {4}


def test_publishing(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    first = tables.publish_table(df, "default.layer_t")
    again = tables.publish_table(first.withColumn("v", F.col("v") + 1), "default.layer_t")
    assert {r.v for r in again.collect()} == {2}
    merged = tables.publish_incremental(
        df.where("k = '3'").withColumn("v", F.lit(9)), again, "k", "default.layer_t")
    assert merged.count() == 10 and merged.where("k = '3'").first().v == 9
    assert tables.stored(spark, "default.absent") is None
    assert tables.append_table(df, "default.appended_t") == 10
    assert tables.append_table(df.limit(3), "default.appended_t") == 3
    assert spark.table("default.appended_t").count() == 13
    tables.publish_view(df, "some_view")
    assert spark.table("some_view").count() == 10


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    left = tables.publish_table(df, "default.left_t", "k", 4)
    right = tables.publish_table(df, "default.right_t", "k", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right.select("k"), "k", "left_anti")
        assert joined.isEmpty()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_run_copy(spark, tmp_path):
    rows = raw_table(spark)
    runs = rows.withColumn("ingestion_run_id", F.when(F.col("url_hash") < "c", "r1").otherwise("r2"))
    path = str(tmp_path / "copy")
    counts = [tables.append_files(landing.run_rows(runs, run), path) for run in ("r1", "r9", "r2")]
    assert counts == [2, 0, 2]
    assert spark.read.parquet(path).count() == 4


def test_item_counts(spark):
    no_url = {**first_article(3), "url": None}
    empty = {**first_article(4), "url": ""}
    some = items(spark, ("newsapi", 0, first_article(1)), ("newsapi", 1, no_url),
                 ("gnews", 0, empty), ("gnews", 1, second_article(1)))
    assert landing.item_counts(some) == (4, 2)


def test_work_folder_is_required_on_a_cluster(spark, monkeypatch):
    from tidings import session

    class Remote:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError):
        session.work_dir(Remote)


def test_lineage_is_read_from_the_plans(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS traced")
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    tables.append_table(base, "traced.one")
    one = spark.table("traced.one")
    two = tables.publish_table(one.groupBy("k").count(), "traced.two")
    tables.publish_table(two.join(one, "k"), "traced.three")
    tables.publish_table(two.join(one, "k"), "traced.three")
    tables.publish_table(base, "traced.four", sources=["elsewhere.x"])
    got = {tuple(r) for r in tables.lineage(spark, ["traced"]).collect()}
    assert got == {("traced.two", "traced.one"), ("traced.three", "traced.one"),
                   ("traced.three", "traced.two"), ("traced.four", "elsewhere.x")}
    assert set(tables.published(spark, "traced")) == {f"traced.{n}" for n in ("one", "two", "three", "four")}


def test_commits_number_the_appends(spark):
    """A gap is left by an append that failed; rows of one append are told apart by their number."""
    spark.sql("CREATE DATABASE IF NOT EXISTS traced")
    rows = spark.createDataFrame([("a", n) for n in range(20)], "k string, n int").repartition(3)
    tables.append_table(rows, "traced.log", sequence=True)
    with pytest.raises(Exception, match="broken"):
        tables.append_table(rows.withColumn("n", F.raise_error(F.lit("broken")).cast("int")),
                            "traced.log", sequence=True)
    tables.append_table(rows.withColumn("n", F.col("n") + 100), "traced.log", sequence=True)
    stored = spark.table("traced.log")
    assert {r.c for r in stored.select("commit_seq.commit").toDF("c").collect()} == {1, 3}
    assert stored.select("commit_seq").distinct().count() == 40
    assert keyed.latest(stored, ["k"], ["commit_seq"]).first().n >= 100
