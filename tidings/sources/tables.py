"""Layer tables: publishing, schema evolution, catalog."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidings.operators.keyed import delete_insert
from tidings.schemas import LAYERS

#: Properties of a table: the number of its last append, the tables it was built from, its rows.
COMMITS, SOURCES, ROWS = "tidings.commits", "tidings.sources", "tidings.rows"
#: The column that tells rows of equal versions apart.
SEQUENCE = "commit_seq"
#: Stored layers are read more often than written.
CODEC = "zstd"
_CATALOG = "spark_catalog"
_prefix: ContextVar[str] = ContextVar("prefix", default="")


@contextmanager
def namespace(prefix: str) -> Iterator[None]:
    """Within it the names of all layers start with ``prefix``: a second set of the same tables."""
    token = _prefix.set(prefix)
    try:
        yield
    finally:
        _prefix.reset(token)


def resolve(name: str) -> str:
    """The name of a table, view or database in the current namespace."""
    return f"{_prefix.get()}{name}"


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(resolve(name))


def _databases() -> list[str]:
    return [resolve(n) for n in dict.fromkeys(t.split(".")[0] for t in LAYERS if "." in t)]


def create_namespaces(spark: SparkSession) -> None:
    """One database per layer."""
    for name in _databases():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_namespaces(spark: SparkSession) -> None:
    """Drop the databases of a namespace of its own with all their tables."""
    if not _prefix.get():
        raise ValueError("only a namespace with a prefix can be dropped")
    for name in _databases():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def publish_view(df: DataFrame, name: str) -> None:
    """Publish a layer as a view of the session: computed when it is read."""
    df.createOrReplaceTempView(resolve(name))


def plan_sources(df: DataFrame) -> list[str]:
    """Names of the tables and views of the catalog that a frame reads, from its analysed plan.

    A view counts as itself and not as what it reads. Files that are read by path have no name.
    """
    found: set[str] = set()
    open_nodes = [df._jdf.queryExecution().analyzed()]
    while open_nodes:
        node = open_nodes.pop()
        kind = node.nodeName()
        if kind == "View":
            found.add(node.desc().identifier().unquotedString())
            continue
        if kind == "LogicalRelation" and node.catalogTable().isDefined():
            found.add(node.catalogTable().get().identifier().unquotedString())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return sorted(name.removeprefix(f"{_CATALOG}.") for name in found)


def _sources(df: DataFrame, given: Sequence[str] | None) -> list[str]:
    return sorted(map(resolve, given)) if given is not None else plan_sources(df)


def _note(spark: SparkSession, kind: str, name: str, facts: dict[str, str]) -> None:
    listed = ", ".join("'{}' = '{}'".format(key, value.replace("'", "\\'")) for key, value in facts.items())
    spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ({listed})")


def rows_published(spark: SparkSession, name: str) -> int:
    """Rows of the current version of a published table, counted while they were written."""
    return int(_property(spark, resolve(name), ROWS))


def _with_comments(df: DataFrame, schema: StructType | None) -> DataFrame:
    """``df`` with the comments that ``schema`` has for its columns."""
    comments = {f.name: f.metadata["comment"] for f in schema or () if "comment" in f.metadata}
    for name in comments.keys() & set(df.columns):
        df = df.withMetadata(name, {"comment": comments[name]})
    return df


def publish_table(
    df: DataFrame, name: str, key: str | None = None, buckets: int = 0,
    sources: Sequence[str] | None = None, schema: StructType | None = None,
) -> DataFrame:
    """Publish a layer as a full rebuild.

    The rows go to a new table and the view ``name`` is moved to it afterwards, so that a plan
    that reads the current version can build the next one, and readers never see half a table.
    The version before stays for plans that still read it; older ones are dropped.

    With a key and buckets the table is bucketed and sorted: upserts, anti-joins and joins on
    the key then read the stored side without a shuffle. Use one number of buckets for all
    tables of a key.

    The tables and views that the plan reads are noted as the sources of ``name``; name them where
    the plan was cut by a table in the work folder. Columns get the comments of ``schema``, by default
    of the layer of that name.
    """
    spark = df.sparkSession
    noted = _sources(df, sources)
    df = _with_comments(df, schema or LAYERS.get(name))
    name = resolve(name)
    database, _, base = name.rpartition(".")
    versions = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{base}_v*'")
    numbers = {}
    for row in versions.select("tableName").collect():
        if found := re.fullmatch(rf"{re.escape(base.lower())}_v(\d+)_[0-9a-f]{{32}}", row.tableName):
            numbers[row.tableName] = int(found.group(1))
    number = max(numbers.values(), default=0) + 1
    stored = f"{name}_v{number}_{uuid.uuid4().hex}"
    counted, written = _counted(df)
    writer = counted.write.mode("error").option("compression", CODEC)
    if key and buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(stored)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored}")
    _note(spark, "VIEW", name, {SOURCES: json.dumps(noted), ROWS: str(written.get["rows"])})
    for old, of in numbers.items():
        if of < number - 1:
            spark.sql(f"DROP TABLE IF EXISTS {f'{database}.' if database else ''}{old}")
    return spark.table(name)


def publish_incremental(
    incoming: DataFrame, existing: DataFrame | None, key: str, name: str, buckets: int = 0
) -> DataFrame:
    """Publish a layer as its current rows with the incoming keys replaced."""
    merged = incoming if existing is None else delete_insert(existing, incoming, key)
    return publish_table(merged, name, key, buckets)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a count of its rows, taken while they are written."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written


def append_files(df: DataFrame, path: str) -> int:
    """Append rows to the table at a path; returns their number."""
    counted, written = _counted(df)
    counted.write.mode("append").option("compression", CODEC).parquet(path)
    return int(written.get["rows"])


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).first()
    return found.value if found else None


def _next_commit(spark: SparkSession, name: str) -> int:
    """The number of the next append, taken before its rows are written.

    An append that fails leaves a gap. A table without the property had its first append only.
    """
    if not spark.catalog.tableExists(name):
        return 1
    number = int(_property(spark, name, COMMITS) or 1) + 1
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{COMMITS}' = '{number}')")
    return number


def append_table(
    df: DataFrame, name: str, partition: str | None = None, key: str | None = None,
    buckets: int = 0, sequence: bool = False, sources: Sequence[str] | None = None,
) -> int:
    """Append rows to an append-only table, creating it if needed; returns their number.

    With ``sequence`` every row gets ``commit_seq``, the number of the append and of the row in it. Of
    versions of equal time the one with the largest is the one inserted last, in every read. A table
    has one writer at a time. ``sources`` as for :func:`publish_table`.
    """
    spark = df.sparkSession
    schema, name = LAYERS.get(name), resolve(name)
    is_new = not spark.catalog.tableExists(name)
    noted = _sources(df, sources) if is_new else []
    if sequence:
        commit = F.lit(_next_commit(spark, name)).cast("long").alias("commit")
        place = F.monotonically_increasing_id().alias("row")
        df = df.withColumn(SEQUENCE, F.struct(commit, place))
    if is_new:
        df = _with_comments(df, schema)
    counted, written = _counted(df)
    writer = counted.write.mode("append").option("compression", CODEC)
    if partition:
        writer = writer.partitionBy(partition)
    if key and buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    if is_new:
        _note(spark, "TABLE", name, {SOURCES: json.dumps(noted)})
    return int(written.get["rows"])


def known_keys(spark: SparkSession, table: str, key: str, run: str, buckets: int) -> DataFrame | None:
    """The keys of an append-only table as an index that an anti-join reads without a shuffle.

    ``<table>_keys`` holds key and run, bucketed by the key. It is brought up to date with the runs
    that it does not have yet, and only their folders are read: a run that was appended before a
    crash is found the next time. None before the table's first build.
    """
    rows, name = stored(spark, table), f"{table}_keys"
    if rows is None:
        return None
    index, added = stored(spark, name), rows.select(key, run)
    if index is not None:
        indexed = index.select(run).distinct()
        missing = rows.select(run).distinct().join(indexed, run, "left_anti").collect()
        if not missing:
            return index
        added = added.where(F.col(run).isin([row[0] for row in missing]))
    append_table(added, name, key=key, buckets=buckets)
    return read(spark, name)


def stored(spark: SparkSession, name: str) -> DataFrame | None:
    """A table or view of the catalog, or None before its first build."""
    return read(spark, name) if spark.catalog.tableExists(resolve(name)) else None


def evolve(
    df: DataFrame, renames: dict[str, str] | None = None, defaults: dict[str, Column] | None = None
) -> DataFrame:
    """Bring rows written under an older schema to the current one.

    Columns are renamed where the old name is present; absent columns are added with their
    default. Columns that exist are left alone, so the step can be repeated.
    """
    present = {old: new for old, new in (renames or {}).items() if old in df.columns}
    df = df.withColumnsRenamed(present)
    missing = {name: value for name, value in (defaults or {}).items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def union_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two schema versions of one table; absent columns are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def catalog(spark: SparkSession, tables: dict[str, StructType] | None = None) -> DataFrame:
    """Column catalog: one row per table and column."""
    entries = [
        (table, position, field.name, field.dataType.simpleString(), field.nullable,
         field.metadata.get("comment", ""))
        for table, schema in (tables or LAYERS).items()
        for position, field in enumerate(schema.fields, start=1)
    ]
    return spark.createDataFrame(
        entries,
        "table_name string, position int, column_name string, type string, nullable boolean, "
        "comment string",
    )


def published(spark: SparkSession, database: str) -> dict[str, StructType]:
    """The published tables of a database and their schemas, without the stored versions."""
    rows = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()
    names = [r.tableName for r in rows if not re.search(r"_v\d+_[0-9a-f]{32}$", r.tableName)]
    return {f"{database}.{name}": spark.table(f"{database}.{name}").schema for name in names}


def lineage(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """``(table_name, source_name)``: which published table was built from which, as noted.

    The sources come from the plans that built the tables. One row per table and source, and both
    numbers follow the catalog and not the data.
    """
    wanted = databases or [name for name in _databases() if spark.catalog.databaseExists(name)]
    entries = [
        (table, source) for database in wanted for table in published(spark, database)
        for source in json.loads(_property(spark, table, SOURCES) or "[]")
    ]
    return spark.createDataFrame(entries, "table_name string, source_name string")


def column_counts(df: DataFrame, table: str) -> DataFrame:
    """Catalog rows of a stored table with its row and NULL counts, from one aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("nulls"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), "rows", F.inline(entries))
