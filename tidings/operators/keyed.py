"""Keyed state on append-only tables.

The row of a key is chosen by ``row_number() = 1``. Spark applies such a limit in every task
before the shuffle (``WindowGroupLimit``), so a key that holds a third of all rows sends one row
per task, and unused columns are still pruned down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.operators.skew import join_spread


def _first_of_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` of each key.

    ``order`` is the version followed by the insert sequence: of equal versions the one
    inserted last is kept.
    """
    return _first_of_key(df, keys, [F.desc(name) for name in order])


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return _first_of_key(df, keys, [F.asc(name) for name in order])


def first_seen(
    batch: DataFrame, target: DataFrame | None, key: str, order: Sequence[str]
) -> DataFrame:
    """Rows of ``batch`` to append to ``target``: the first row of each key not yet in it.

    Rows already in the target stay as they are, whatever the batch holds for their key.
    """
    fresh = earliest(batch, [key], order)
    if target is None:
        return fresh
    return fresh.join(target.select(key), key, "left_anti")


def delete_insert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``existing`` with all rows of the incoming keys replaced by the incoming rows."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def above_watermark(incoming: DataFrame, existing: DataFrame, version: str) -> DataFrame:
    """Incoming rows newer than everything in ``existing``; all rows when it is empty.

    Strict: rows of the same second as the newest known row are not taken. The bound is a plain
    scalar subquery, which Spark pushes into the scan of the incoming rows.
    """
    if existing.isEmpty():
        return incoming
    newest = existing.agg(F.max(version)).scalar()
    return incoming.where(F.col(version) > newest)


def split_votes(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feedback events with an allowed vote (1, -1, or NULL for a removal), and the others."""
    allowed = F.col("vote").isNull() | F.col("vote").isin(1, -1)
    return events.where(allowed), events.where(~allowed)


def fold_votes(events: DataFrame) -> DataFrame:
    """Current votes from feedback events.

    The last event of a user and story counts, also when it repeats the same vote; a NULL vote
    removes the row. Removals are dropped after the fold, so that they hide earlier votes.
    """
    last = latest(events, ["user_id", "cluster_id"], ["created_at", "event_id"])
    return last.where(F.col("vote").isNotNull()).drop("event_id")


def toggle_votes(clicks: DataFrame) -> DataFrame:
    """Current votes from button clicks: a click on the active vote takes it back.

    Only the clicks after the last click in the other direction matter: the first of them sets
    the vote, the second removes it, and so on, so the vote stands when their number is odd.
    """
    keys = ["user_id", "cluster_id"]
    moment = F.struct("created_at", "event_id")
    ends = clicks.groupBy(*keys).agg(
        F.max_by("vote", moment).alias("vote"),
        F.max(F.when(F.col("vote") == 1, moment)).alias("last_up"),
        F.max(F.when(F.col("vote") == -1, moment)).alias("last_down"),
    )
    ends = ends.select(
        *keys,
        "vote",
        F.greatest("last_up", "last_down").alias("last"),
        # NULL when the other button was never used
        F.when(F.col("vote") == 1, F.col("last_down")).otherwise(F.col("last_up")).alias("turn"),
    )
    turns = ends.select(*keys, "turn").where(F.col("turn").isNotNull())
    moments = clicks.select(*keys, "event_id", moment.alias("moment"))
    joined = join_spread(moments, turns, keys, "event_id", "left")
    runs = (
        joined.where(F.col("turn").isNull() | (F.col("moment") > F.col("turn")))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return (
        ends.join(runs, keys)
        .where(F.col("clicks") % 2 == 1)
        .select(*keys, "vote", F.col("last.created_at").alias("created_at"))
    )


def fold_runs(events: DataFrame) -> DataFrame:
    """The run log from open and close events.

    The first open of ``(run_id, task_id, try_number)`` creates the row, the last close fills
    in its outcome; a close without an open changes nothing.
    """
    keys = ["run_id", "task_id", "try_number"]
    opening = ["dag_id", "execution_date"]
    closing = ["status", "rows_fetched", "rows_new", "rows_duplicate", "rows_failed",
               "error_message", "extra_metadata"]
    moment = F.struct("at", "event_id")
    is_open = F.col("kind") == "open"
    is_close = F.col("kind") == "close"
    folded = events.groupBy(*keys).agg(
        F.min_by(F.struct(*opening, "at"), F.when(is_open, moment)).alias("opened"),
        F.max_by(F.struct(*closing, "at"), F.when(is_close, moment)).alias("closed"),
    )
    closed = {name: F.col(f"closed.{name}") for name in closing}
    closed["status"] = F.coalesce(closed["status"], F.lit("running"))
    closed["error_message"] = F.substring(closed["error_message"], 1, 4000)
    for name in closing[1:5]:
        closed[name] = F.coalesce(closed[name], F.lit(0))
    return folded.where(F.col("opened").isNotNull()).select(
        *keys,
        *[F.col(f"opened.{name}").alias(name) for name in opening],
        F.col("opened.at").alias("started_at"),
        F.col("closed.at").alias("finished_at"),
        *[column.alias(name) for name, column in closed.items()],
    )


def remove_keys(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``table`` without the rows of the given keys, so that they are worked on again."""
    return table.join(ids.select(key), key, "left_anti")
