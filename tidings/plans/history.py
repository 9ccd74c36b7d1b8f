"""Run log and its page."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY = [
    "run_id", "dag_id", "task_id", "try_number", "status", "started_at", "finished_at",
    "rows_fetched", "rows_new", "rows_duplicate", "rows_failed", "error_message",
]

RUN_EVENT = (
    "run_id string, task_id string, try_number int, kind string, dag_id string, "
    "execution_date timestamp, at timestamp, event_id long, status string, rows_fetched long, "
    "rows_new long, rows_duplicate long, rows_failed long, error_message string, "
    "extra_metadata string"
)


def metadata_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def open_event(
    spark: SparkSession, run_id: str, task_id: str, try_number: int, dag_id: str,
    at: datetime, event_id: int, execution_date: datetime | None = None,
) -> DataFrame:
    """Event that opens a run-log row; without a logical date the start counts as one."""
    row = (run_id, task_id, try_number, "open", dag_id, execution_date or at, at, event_id,
           None, None, None, None, None, None, None)
    return spark.createDataFrame([row], RUN_EVENT)


def close_event(
    spark: SparkSession, run_id: str, task_id: str, try_number: int, at: datetime,
    event_id: int, status: str = "success", counts: dict[str, int] | None = None,
    error: str | None = None, metadata: str = "{}",
) -> DataFrame:
    """Event that closes a run-log row with its counts."""
    given = counts or {}
    numbers = [given.get(n, 0) for n in ("fetched", "new", "duplicate", "failed")]
    row = (run_id, task_id, try_number, "close", None, None, at, event_id, status, *numbers,
           error, metadata)
    return spark.createDataFrame([row], RUN_EVENT)


def run_history(log: DataFrame, limit: int = 20) -> DataFrame:
    """Newest runs first."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    return log.select(*HISTORY).orderBy(
        F.desc("started_at"), "run_id", "task_id", "try_number"
    ).limit(limit)
