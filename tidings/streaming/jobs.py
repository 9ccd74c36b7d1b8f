"""Structured Streaming jobs.

Results are append-only tables with one folder per micro-batch, or the state of a
:class:`~tidings.sources.state_log.StateLog`. A batch that is replayed after a failure overwrites
its own folder only, so replays change nothing. Batch numbers come from the checkpoint: a table
and its checkpoint belong together and start together.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidings.functions.responses import with_answer
from tidings.functions.urls import url_key
from tidings.operators.keyed import earliest, fold_votes, latest
from tidings.plans.enrichment import MAX_ATTEMPTS, settled
from tidings.schemas import LANDED_ITEM, PROVIDER_ARTICLE
from tidings.session import materialize, scratch
from tidings.sources.landing import item_keys, normalise_items
from tidings.sources.state_log import EVERY, StateLog
from tidings.sources.tables import CODEC

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch writes its changes, and whole snapshots come from time to time.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def landing_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New landed files, each read once."""
    return (
        spark.readStream.schema(LANDED_ITEM)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def _run(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folder(table: str, batch_id: int) -> str:
    return f"{table}/batch={batch_id}"


def _write(batch: DataFrame, table: str, batch_id: int) -> None:
    written = batch.write.mode("overwrite").option("compression", CODEC)
    written.parquet(_folder(table, batch_id))


def read_batches(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows of a table with one folder per batch; empty if nothing was written yet."""
    with_batch = StructType(list(schema.fields)).add("batch", "long")
    try:
        return spark.read.schema(with_batch).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_batch)


def ingest_first_seen(items: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the first article of every key over all time; ``items`` come from :func:`landing_stream`.

    The keyed state in the RocksDB state store holds where a key was first seen: batch time, provider
    rank, landed order and file. A batch asks for its own keys only and never reads the table; its
    time does not follow the number of batches before. Of the rows of a key in one batch the first by
    provider rank and landed order counts, of those of one place the smallest payload. The articles
    are no part of the state: those of new keys are read from the files of the batch once more.
    Batch times are the checkpoint's, so a replay finds the same keys; the clock of the driver must not go back.
    """
    for name, value in STATE_SETTINGS.items():
        items.sparkSession.conf.set(name, value)
    file, arrived = F.col("_metadata.file_path").alias("file"), F.current_timestamp().alias("arrived")
    keys = item_keys(items, file, "provider", arrived)
    place = F.struct("arrived", "batch_rank", "ordinal", "file", "provider")
    first = keys.groupBy("url_hash").agg(F.min(place).alias("first"))
    fresh = first.where(F.col("first.arrived") == F.current_timestamp())
    return _run(
        fresh.select("url_hash", "first.*"), checkpoint,
        lambda batch, batch_id: _insert_fresh(batch, table, batch_id), "update",
    )


def _insert_fresh(batch: DataFrame, table: str, batch_id: int) -> None:
    """Write the articles of the new keys of a batch."""
    spark = batch.sparkSession
    place = F.coalesce("ordinal", F.lit(-1).cast("long")).alias("place")
    with scratch(spark):
        fresh = materialize(batch.select("url_hash", "file", "provider", place), "fresh")
        # At most the files of one batch.
        files = [unquote(r.file) for r in fresh.select("file").distinct().collect()]
        if not files:
            return
        schema = StructType([f for f in LANDED_ITEM if f.name in ("ordinal", "category", "article")])
        landed = spark.read.schema(schema).json(files)
        url = F.from_json("article", PROVIDER_ARTICLE)["url"]
        keyed = landed.where(url != "").select(
            "*", url_key(url).alias("url_hash"), F.col("_metadata.file_path").alias("file"), place
        )
        where = ["url_hash", "file", "place"]
        rows = earliest(keyed.join(fresh, where), where, ["article", "category"])
        _write(normalise_items(rows), table, batch_id)


def daily_counts(articles: DataFrame, lateness: str) -> DataFrame:
    """Articles per publish date and outlet with bounded state.

    Rows later than ``lateness`` are left out, which the batch form never does; choose it
    larger than the longest delay that still counts, or use :class:`DayCounts`.
    """
    return (
        articles.where(F.col("published_at").isNotNull())
        .withWatermark("published_at", lateness)
        .groupBy(F.window("published_at", "1 day").alias("day"), "source_name")
        .agg(F.count(F.lit(1)).alias("article_count"))
        .select(
            F.to_date("day.start").alias("published_date"), "source_name", "article_count"
        )
    )


def run_daily_counts(
    articles: DataFrame, lateness: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Upsert the changed counts of each micro-batch; the last batch of a group counts."""
    counts = daily_counts(articles, lateness)
    return _run(counts, checkpoint, lambda batch, batch_id: _write(batch, table, batch_id), "update")


class DayCounts:
    """Articles per publish date and outlet with an ordinary lateness, and no row lost.

    The watermark of a batch is the newest publish time of all batches before it less ``lateness``.
    Rows of days that had ended by then are *late*: they go to a side log, the others to the main one.
    Both are folded by :class:`StateLog`, and a read adds them up, which gives the counts of the batch
    form whatever the order of arrival. Readers that want settled days only take :meth:`on_time`.
    """

    KEYS = ("published_date", "source_name")

    def __init__(
        self, spark: SparkSession, table: str, lateness: timedelta, every: int = EVERY
    ) -> None:
        self.spark, self.table, self.lateness = spark, table, lateness
        schema = "published_date date, source_name string, article_count long"
        stored = spark.createDataFrame([], schema).schema
        self.main, self.side = (
            StateLog(spark, f"{table}/{name}", stored, self._fold, every) for name in ("main", "late")
        )

    def _fold(self, counts: DataFrame) -> DataFrame:
        return counts.groupBy(*self.KEYS).agg(F.sum("article_count").alias("article_count"))

    def _newest(self, upto: int) -> datetime | None:
        """The newest publish time of the batches up to a number; one row was kept for each batch."""
        if upto < 0:
            return None
        return self.spark.read.schema("newest timestamp").parquet(
            f"{self.table}/newest/batch={upto}"
        ).first().newest

    def _count(self, batch: DataFrame, batch_id: int) -> None:
        before = self._newest(batch_id - 1)
        day = F.to_date("published_at").alias("published_date")
        known = batch.where(F.col("published_at").isNotNull())
        with scratch(self.spark):
            counts = materialize(
                known.groupBy(day, "source_name").agg(
                    F.count(F.lit(1)).alias("article_count"), F.max("published_at").alias("newest")
                ),
                "day-counts",
            )
            newest = F.greatest(F.max("newest"), F.lit(before).cast("timestamp")).alias("newest")
            counts.agg(newest).coalesce(1).write.mode("overwrite").parquet(
                f"{self.table}/newest/batch={batch_id}"
            )
            ended = F.date_add("published_date", 1).cast("timestamp")
            bound = F.lit(before).cast("timestamp") - F.lit(self.lateness)
            is_late = F.coalesce(ended <= bound, F.lit(False))
            self.main.append(counts.where(~is_late), batch_id)
            self.side.append(counts.where(is_late), batch_id)

    def run(self, articles: DataFrame, checkpoint: str) -> StreamingQuery:
        return _run(articles.select("published_at", "source_name"), checkpoint, self._count)

    def on_time(self) -> DataFrame:
        return self.main.read()

    def late(self) -> DataFrame:
        return self.side.read()

    def read(self) -> DataFrame:
        """``(published_date, source_name, article_count, late_count)`` of all rows."""
        late = self.late().withColumn("late_count", F.col("article_count"))
        both = self.on_time().withColumn("late_count", F.lit(0).cast("long")).unionByName(late)
        return both.groupBy(*self.KEYS).agg(
            F.sum("article_count").alias("article_count"), F.sum("late_count").alias("late_count")
        )


def append_batches(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append every row of a stream, replay-safe."""
    return _run(stream, checkpoint, lambda batch, batch_id: _write(batch, table, batch_id))


def vote_log(spark: SparkSession, table: str, schema: StructType, every: int = EVERY) -> StateLog:
    """The last event of each reader and story.

    Removals stay in the state, since they hide earlier votes that may still arrive.
    """
    def fold(rows: DataFrame) -> DataFrame:
        return latest(rows, ["user_id", "cluster_id"], ["created_at", "event_id"])

    return StateLog(spark, table, schema, fold, every)


def fold_vote_stream(
    events: DataFrame, table: str, checkpoint: str, every: int = EVERY
) -> StreamingQuery:
    """Fold the votes of each batch into the state of :func:`vote_log`."""
    log = vote_log(events.sparkSession, table, events.schema, every)
    return _run(events, checkpoint, log.append)


def current_votes(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    return fold_votes(vote_log(spark, table, schema).read())


def answer_log(spark: SparkSession, table: str, schema: StructType, every: int = EVERY) -> StateLog:
    """The answer that counts for each story, parsed.

    ``schema`` is that of the answers. Of answers of one attempt the one that arrived last counts.
    """
    parsed = with_answer(spark.createDataFrame([], schema), "raw_text")
    stored = StructType(list(parsed.schema.fields)).add("batch", "long").add("place", "long")
    return StateLog(spark, table, stored, lambda rows: settled(rows, ["batch", "place"]), every)


def check_response_stream(
    responses: DataFrame, table: str, checkpoint: str, every: int = EVERY
) -> StreamingQuery:
    """Parse every answer once, as it arrives, and keep the one that counts for each story."""
    log = answer_log(responses.sparkSession, table, responses.schema, every)

    def each(batch: DataFrame, batch_id: int) -> None:
        place = F.monotonically_increasing_id()
        numbered = batch.select("*", F.lit(batch_id).cast("long").alias("batch"), place.alias("place"))
        parsed = with_answer(numbered.where(F.col("attempt") <= MAX_ATTEMPTS), "raw_text")
        log.append(parsed, batch_id)

    return _run(responses, checkpoint, each)


def settled_responses(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The answer that counts for each story among all that have arrived; nothing is parsed."""
    return answer_log(spark, table, schema).read().drop("batch", "place")
