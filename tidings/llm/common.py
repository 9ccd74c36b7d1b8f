"""What several of the operators need: texts, words, rows without clashing names."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Shuffle files go when the query that made them is done; what is needed later is a written table.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def whole_text(text: str | Column = "text") -> Column:
    """The text of a row; null counts as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a text without words."""
    return F.filter(F.split(text, WHITE_RUN), lambda w: w != "")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {name.lower() for name in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex[:12]}"


def reader_slots(spark: SparkSession) -> int:
    """The number of partitions that shuffles of this session use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tidings_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tidings-")) / "tidings.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, Path(root.name) / source.relative_to(root))
    context.addPyFile(str(target))
    context._tidings_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` of a function of this package.

    Texts may be long, so a batch has fewer rows than Spark's default.
    """
    spark = df.sparkSession
    ship(spark)
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    spark.conf.set(_CLEANUP, "true")

    def run(batches):
        try:
            yield from function(batches)
        finally:
            # A worker waits for its next task with what the allocator holds.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
