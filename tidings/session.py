"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)
#: The scratch folder around the current one.
_outer: ContextVar[str | None] = ContextVar("outer", default=None)

RUNTIME_SETTINGS = {
    # Times are compared and printed as UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a skewed join side is worth an extra shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "tidings", master: str | None = None, **conf) -> SparkSession:
    """A session with the runtime settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. On a cluster the setting is
    required, since executors on other machines must be able to read what one of them wrote.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidings-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the work folder; a path is never written twice."""
    return f"{work_dir(spark)}/tidings/{name}-{uuid.uuid4().hex}"


def temporary_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the scratch folder of the job, or in the work folder outside of one."""
    folder = _scratch.get()
    return f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_path(spark, name)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Collect the intermediate tables of a job in one folder and delete it at the end.

    Results that are read after the job must be written with ``keep=True``.
    """
    folder = new_path(spark, "scratch")
    around = _outer.set(_scratch.get())
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        _outer.reset(around)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, keep: bool = False, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the work folder and read it back; ``codec`` compresses its files.

    Cuts the lineage, so a lost executor costs one stage and not the whole history, and makes
    generated ids stable, because the committed files are the only copy that is read.
    """
    spark = df.sparkSession
    path = new_path(spark, name) if keep else temporary_path(spark, name)
    df.write.mode("error").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize` for the result of a job inside a job: it goes when the outer one ends.

    Without an outer job it is kept.
    """
    spark, folder = df.sparkSession, _outer.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
