"""Streaming jobs give the tables of their batch forms; replays and restarts add nothing."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidings.operators.keyed import first_seen, fold_votes, latest
from tidings.plans.enrichment import checked_responses
from tidings.plans.layers import daily_stats
from tidings.schemas import LANDED_ITEM
from tidings.sources import landing
from tidings.streaming import jobs

T0 = datetime(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def stream_of(spark, df, path):
    df.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def landed(spark, provider, numbers):
    base = spark.createDataFrame([(n, f"https://e.com/{n % 6}?utm_source={provider}")
                                  for n in numbers], "ordinal long, u string")
    return base.select(
        "ordinal", F.lit("c").alias("category"),
        F.struct(F.col("u").alias("url"), F.col("ordinal").cast("string").alias("title")).alias(
            "article"),
        F.lit("2024-01-01").alias("dt"), F.lit("r1").alias("run_id"),
        F.lit(provider).alias("provider"))


def test_first_seen(spark, tmp_path):
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = landing.normalise_items(spark.createDataFrame([], LANDED_ITEM)).schema

    def run():
        stream = jobs.landing_stream(spark, path, files_per_batch=1)
        jobs.ingest_first_seen(stream, table, checkpoint).awaitTermination()
        return jobs.read_batches(spark, table, schema)

    landing.write_landing(landed(spark, "newsapi", range(4)).coalesce(1), path)
    assert run().count() == 4
    landing.write_landing(landed(spark, "gnews", range(20)).coalesce(1), path)
    got = run().drop("batch")
    everything = landing.normalise_items(landing.read_landing(spark, path))
    expected = first_seen(everything, None, "url_hash", ["batch_rank", "ordinal"])
    assert rows_of(got.select("url_hash", "url", "title")) == rows_of(
        expected.select("url_hash", "url", "title"))
    before = rows_of(run())
    # the last batch is run again after its commit record is lost
    commits = sorted((tmp_path / "check" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink()
    assert rows_of(run()) == before


def test_first_seen_state_follows_the_keys(spark, tmp_path):
    """A batch reads no earlier batch: the keys are rows of the state store."""
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for run, start in enumerate((0, 3, 3, 5)):
        rows = landed(spark, "newsapi", range(start, start + 3)).withColumn("run_id", F.lit(f"r{run}"))
        landing.write_landing(rows.coalesce(1), path)
    query = jobs.ingest_first_seen(jobs.landing_stream(spark, path, 1), table, checkpoint)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 6
    assert any("rocksdb" in name.lower() for name in state["customMetrics"])
    # Any of the files of earlier batches may be gone.
    for folder in (tmp_path / "out").iterdir():
        for file in folder.glob("*.parquet"):
            file.unlink()
    again = landed(spark, "newsapi", range(6)).withColumn("run_id", F.lit("again"))
    landing.write_landing(again.coalesce(1), path)
    jobs.ingest_first_seen(jobs.landing_stream(spark, path, 1), table, checkpoint).awaitTermination()
    schema = landing.normalise_items(spark.createDataFrame([], LANDED_ITEM)).schema
    assert jobs.read_batches(spark, table, schema).isEmpty()


def test_first_seen_takes_the_first_of_all_files_of_a_batch(spark, tmp_path):
    path, table, checkpoint = (str(tmp_path / "a folder" / n) for n in ("in", "out", "check"))
    for provider in ("gnews", "newsapi"):
        rows = landed(spark, provider, range(30)).withColumn("run_id", F.lit("2024 at 10:00"))
        # Every item twice, and some without a place or a URL.
        spoilt = rows.where("ordinal < 3").withColumn("ordinal", F.lit(None).cast("long"))
        empty = rows.withColumn("article", F.struct(F.lit("").alias("url"), F.lit("t").alias("title")))
        landing.write_landing(rows.union(rows).union(spoilt).union(empty).repartition(3), path)
    jobs.ingest_first_seen(jobs.landing_stream(spark, path), table, checkpoint).awaitTermination()
    everything = landing.normalise_items(landing.read_landing(spark, path))
    got = jobs.read_batches(spark, table, everything.schema)
    expected = first_seen(everything, None, "url_hash", ["batch_rank", "ordinal", "raw_payload"])
    kept = ["url_hash", "url", "source_provider", "ordinal"]
    assert rows_of(got.select(kept)) == rows_of(expected.select(kept))
    assert got.count() == 6


def vote_events(spark, count=90):
    rows = [(n % 3, f"c{n % 4}", [1, -1, None, 1][n // 3 % 4], T0 + timedelta(minutes=n * 7 % 60), n)
            for n in range(count)]
    return spark.createDataFrame(
        rows, "user_id long, cluster_id string, vote short, created_at timestamp, event_id long")


def test_vote_state_is_compacted(spark, tmp_path):
    """A read takes one snapshot and the deltas since; compaction, replay and crash change no vote."""
    events = vote_events(spark)
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    stream = stream_of(spark, events.repartition(7), path)
    jobs.fold_vote_stream(stream, table, checkpoint, every=3).awaitTermination()
    log = jobs.vote_log(spark, table, events.schema, 3)
    expected = rows_of(fold_votes(events))
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == expected
    manifest = log.manifest()
    assert manifest["upto"] == 5
    folders = {file.rsplit("/", 2)[-2] for file in log.read().inputFiles()}
    assert folders <= {manifest["snapshot"].split("/")[1], "batch=6"}
    # A batch that the snapshot covers is replayed; it counts once.
    events.limit(5).write.mode("overwrite").parquet(f"{table}/deltas/batch=2")
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == expected
    # A compaction that ends before its manifest leaves a snapshot that nothing reads.
    publish, calls = type(log)._publish, []

    def crash(self, new):
        calls.append(new)
        raise RuntimeError("lost")

    type(log)._publish = crash
    try:
        log.compact(6)
    except RuntimeError:
        pass
    finally:
        type(log)._publish = publish
    assert calls and log.manifest() == manifest
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == expected
    log.compact(6)
    assert log.manifest()["upto"] == 6
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == expected
    names = {manifest["snapshot"], log.manifest()["snapshot"]}
    assert {f"snapshots/{x.name}" for x in (tmp_path / "out" / "snapshots").iterdir()} == names
    log.append(events.limit(0), 7)
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == expected


def test_empty_state(spark, tmp_path):
    events = vote_events(spark)
    assert jobs.current_votes(spark, str(tmp_path / "none"), events.schema).isEmpty()


def test_a_table_without_batches_is_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert jobs.read_batches(spark, str(tmp_path / "none"), schema).columns == ["id", "batch"]
    assert jobs.read_batches(spark, str(tmp_path / "none"), schema).isEmpty()


def test_votes(spark, tmp_path):
    rows = [(n % 3, f"c{n % 4}", [1, -1, None, 1][n // 3 % 4], T0 + timedelta(minutes=n * 7 % 60), n)
            for n in range(80)]
    events = spark.createDataFrame(
        rows, "user_id long, cluster_id string, vote short, created_at timestamp, event_id long")
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    stream = stream_of(spark, events.repartition(5), path)
    jobs.fold_vote_stream(stream, table, checkpoint).awaitTermination()
    assert rows_of(jobs.current_votes(spark, table, events.schema)) == rows_of(fold_votes(events))


def test_daily_counts(spark, tmp_path):
    rows = [(T0 + timedelta(hours=n * 13 % 97), f"s{n % 3}" if n % 5 else None)
            for n in range(90)] + [(None, "s1")]
    articles = spark.createDataFrame(rows, "published_at timestamp, source_name string")
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    stream = stream_of(spark, articles.repartition(4), path)
    jobs.run_daily_counts(stream, "30 days", table, checkpoint).awaitTermination()
    counts = jobs.read_batches(spark, table, jobs.daily_counts(articles, "1 day").schema)
    current = latest(counts, ["published_date", "source_name"], ["batch"]).drop("batch")
    assert rows_of(current) == rows_of(daily_stats(articles))


def test_late_rows_are_counted_aside(spark, tmp_path):
    """Rows behind the watermark are a side table; a replayed batch changes nothing."""
    days = [[8, 9, 9, 10], [1, 2, 10], [9, 1, 20], [10, 25]]
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    counts = jobs.DayCounts(spark, table, timedelta(days=2), every=2)
    batches = [
        spark.createDataFrame([(T0 + timedelta(days=d), "s") for d in batch] + [(None, "s")],
                              "published_at timestamp, source_name string") for batch in days]
    for batch in batches:
        stream = stream_of(spark, batch.coalesce(1), path)
        counts.run(stream, checkpoint).awaitTermination()
    every = batches[0].union(batches[1]).union(batches[2]).union(batches[3])
    assert rows_of(counts.read().drop("late_count")) == rows_of(daily_stats(every))
    first = T0.date()
    late = {(r.published_date - first).days: r.article_count for r in counts.late().collect()}
    # behind 8 - 2 days are 1 and 2, then 1 again, and behind 20 - 2 days is 10
    assert late == {1: 2, 2: 1, 10: 1}
    before = rows_of(counts.read())
    counts._count(batches[3], 3)
    assert rows_of(counts.read()) == before


def test_answers(spark, tmp_path):
    good = '{"summary": "s", "topic": "t", "sentiment": "n"}'
    rows = [(f"c{n % 7}", n // 7 + 1, good if n % 4 == 0 else "bad", None) for n in range(21)]
    answers = spark.createDataFrame(
        rows, "cluster_id string, attempt int, raw_text string, error string")
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    stream = stream_of(spark, answers.repartition(3), path)
    jobs.check_response_stream(stream, table, checkpoint, every=2).awaitTermination()
    pick = ["cluster_id", "attempt", "answer.valid"]
    found = jobs.settled_responses(spark, table, answers.schema)
    assert rows_of(found.select(*pick)) == rows_of(checked_responses(answers).select(*pick))
    # Every text was parsed when it arrived.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan and "raw_text" in plan


def test_an_attempt_that_arrives_twice_has_one_answer(spark, tmp_path):
    """Of answers of one attempt the last to arrive counts, in the stream and in the batch."""
    def good(text):
        return f'{{"summary": "{text}", "topic": "t", "sentiment": "n"}}'

    rows = [("c", 1, good("first")), ("c", 1, good("second")), ("d", 2, "bad"), ("d", 2, "worse")]
    path, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "cluster_id string, attempt int, raw_text string, error string"
    for row in rows:
        stream = stream_of(spark, spark.createDataFrame([(*row, None)], schema), path)
        jobs.check_response_stream(stream, table, checkpoint).awaitTermination()
    found = jobs.settled_responses(spark, table, stream.schema).select("cluster_id", "raw_text")
    expected = [("c", good("second")), ("d", "worse")]
    assert rows_of(found) == expected
    numbered = spark.createDataFrame([(*r, None, n) for n, r in enumerate(rows)], schema + ", seq long")
    chosen = checked_responses(numbered.repartition(3), ["seq"]).select("cluster_id", "raw_text")
    assert rows_of(chosen) == expected
