"""The daily job end to end on catalog tables, and its reruns."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidings import session
from tidings.plans import daily, enrichment, history, serving
from tidings.sources import landing, tables

TITLES = ["Storm floods three river villages again", "Storm floods three river villages",
          "Choir sings under water tower", None]


def land(spark, path, run_id, provider, numbers, titles=TITLES):
    rows = [(n, f"https://e.com/{n}", titles[n % len(titles)]) for n in numbers]
    df = spark.createDataFrame(rows, "ordinal long, u string, t string")
    article = F.struct(
        F.struct(F.lit("S").alias("name")).alias("source"), F.col("t").alias("title"),
        F.col("u").alias("url"), F.lit("2025-03-09T08:30:00Z").alias("publishedAt"))
    landing.write_landing(df.select(
        "ordinal", F.lit("world").alias("category"), article.alias("article"),
        F.lit("2025-03-09").alias("dt"), F.lit(run_id).alias("run_id"),
        F.lit(provider).alias("provider")), path)


def test_daily_job(spark, tmp_path):
    path = str(tmp_path / "landing")
    tables.create_namespaces(spark)
    land(spark, path, "r1", "newsapi", range(4))
    land(spark, path, "r1", "gnews", range(2, 6))
    with daily.track(spark, "r1", "ingest") as counts:
        counts.update(daily.ingest(spark, path, "r1"))
    assert (counts["fetched"], counts["new"], counts["duplicate"]) == (8, 6, 2)
    assert daily.refresh_layers(spark) == {"articles": 6, "sources": 1, "days": 1}
    checks = daily.check_layers(spark).collect()
    assert len(checks) == 12
    # one article was delivered without a title
    assert [(r.table_name, r.column_name, r.failures) for r in checks if r.failures] == [
        ("ods", "title", 1)]
    assert daily.cluster(spark)["new"] == 6
    members = daily.pending(spark)
    sizes = {r.cluster_id: r.article_count for r in enrichment.pending_clusters(members).collect()}
    assert sorted(sizes.values()) == [1, 1, 4]
    assert enrichment.prompts(members).where("line_no = 0").count() == 3

    good = json.dumps({"summary": "s", "topic": "t", "sentiment": "n"})
    answers = [(c, 1, good if size > 1 else "none", None) for c, size in sizes.items()]
    responses = spark.createDataFrame(
        answers, "cluster_id string, attempt int, raw_text string, error string")
    with pytest.raises(RuntimeError), daily.track(spark, "r1", "enrich") as counts:
        counts.update(daily.record_answers(spark, responses, "m"))
        daily.require_success(counts)
    assert (counts["fetched"], counts["new"], counts["failed"]) == (3, 1, 2)

    built = {tuple(r) for r in tables.lineage(spark).collect()}
    assert {("mart.mart_articles", "mart.dim_source"), ("mart.mart_articles", "ods.ods_articles"),
            ("mart.story_media", "mart.article_clusters"),
            ("mart.summary_clusters", "mart.mart_articles")} <= built
    assert spark.table(daily.MART).schema["title"].metadata["comment"] == "headline"

    # the same files again: nothing is added, and the summarised story is not pending
    assert daily.ingest(spark, path, "r1")["new"] == 0
    daily.refresh_layers(spark)
    daily.cluster(spark)
    assert spark.table(daily.MART).count() == 6
    assert enrichment.pending_clusters(daily.pending(spark)).count() == 2

    # a new run adds its new article to the layers
    land(spark, path, "r2", "newsapi", [5, 6])
    assert daily.ingest(spark, path, "r2")["new"] == 1
    assert spark.table(daily.RAW).where("ingestion_run_id = 'r2'").count() == 1

    cards = serving.feed_page(daily.feed(spark)).collect()
    assert [(c.summary, c.article_count) for c in cards] == [("s", 4)]

    log = {r.task_id: r for r in history.run_history(daily.run_log(spark)).collect()}
    assert log["ingest"].status == "success" and log["ingest"].rows_new == 6
    assert log["enrich"].status == "failed" and log["enrich"].rows_failed == 2
    assert "RuntimeError" in log["enrich"].error_message

    feedback = spark.createDataFrame(
        [(1, "a", 1, 1), (1, "a", 7, 2)], "user_id long, cluster_id string, vote int, event_id long"
    ).withColumn("created_at", F.current_timestamp())
    tables.append_table(feedback, daily.FEEDBACK_EVENTS)
    assert [r.vote for r in daily.current_votes(spark).collect()] == [1]


def test_known_keys_need_no_shuffle(spark, tmp_path):
    """The stored side of the insert is read by bucket; a run without index rows is found."""
    path = str(tmp_path / "landing")
    tables.create_namespaces(spark)
    for run, numbers in (("k1", range(100, 140)), ("k2", range(130, 150))):
        land(spark, path, run, "newsapi", numbers)
        daily.ingest(spark, path, run)
    known = tables.known_keys(spark, daily.RAW, daily.KEY, "ingestion_run_id", daily.KEY_BUCKETS)
    raw = spark.table(daily.RAW)
    assert known.count() == raw.count() == raw.select(daily.KEY).distinct().count()
    rows = landing.normalise_items(landing.read_landing(spark, path, None, "k2"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = landing.insert_rows(rows, known, F.lit("k3"), F.current_timestamp())
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert fresh.isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The lines of the join's second side follow those of the first, which are marked by a colon.
    lines = plan.splitlines()
    first_side = [k for k, line in enumerate(lines) if line.lstrip(" ").startswith(":")]
    index_side = "\n".join(lines[first_side[-1] + 1 :])
    assert "SelectedBucketsCount: 64" in index_side and "Exchange" not in index_side
    spark.sql(f"DROP TABLE {daily.RAW}_keys")
    assert daily.ingest(spark, path, "k2")["new"] == 0


def test_runs_leave_a_constant_number_of_tables_and_folders(spark, tmp_path):
    """A namespace has tables of its own; versions and work folders do not pile up."""
    path, work = str(tmp_path / "landing"), session.work_dir(spark)
    def names(prefix):
        found = [d for d in ("raw", "ods", "mart") if spark.catalog.databaseExists(f"{prefix}{d}")]
        return sorted(t.name for d in found for t in spark.catalog.listTables(f"{prefix}{d}") if not t.isTemporary)

    before = names("")
    sizes = []
    with tables.namespace("apart_"):
        tables.create_namespaces(spark)
        for number in range(4):
            land(spark, path, f"n{number}", "newsapi", range(number, number + 4))
            with session.scratch(spark):
                assert daily.ingest(spark, path, f"n{number}")["new"] == (1 if number else 4)
                written = daily.refresh_layers(spark)
                assert written["articles"] == 4 + number == daily.cluster(spark)["new"]
            folders = os.listdir(f"{work}/tidings") if os.path.isdir(f"{work}/tidings") else []
            sizes.append((len(names("apart_")), len(folders)))
        assert sizes[1] == sizes[2] == sizes[3]
        tables.drop_namespaces(spark)
        assert not spark.catalog.databaseExists("apart_mart")
    assert names("") == before
    with pytest.raises(ValueError):
        tables.drop_namespaces(spark)
