"""Data tests and audits as report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_report(
    df: DataFrame, table: str, required: Sequence[str], unique: Sequence[str]
) -> DataFrame:
    """Failures of all checks of a table, from one pass over it.

    Every row gives ``(check, key)`` pairs: one for each required column that is NULL, and the value
    of each unique column that is not. Their counts tell both kinds of failures: NULLs, and values
    that occur more than once. Counting combines before the shuffle, so a value that many rows share
    is one pair a task.
    """
    checks = [(c, "not_null") for c in required] + [(c, "unique") for c in unique]

    def pair(number: int, column: str, kind: str):
        value = F.col(column)
        key = value.cast("string") if kind == "unique" else F.lit(None).cast("string")
        wanted = value.isNotNull() if kind == "unique" else value.isNull()
        return F.when(wanted, F.struct(F.lit(number).alias("check"), key.alias("key")))

    pairs = F.array_compact(F.array(*[pair(i, *check) for i, check in enumerate(checks)]))
    counts = df.select(F.inline(pairs)).groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))

    def failures(number: int, kind: str):
        here = F.col("check") == number
        found = F.count_if(here & (F.col("n") > 1)) if kind == "unique" else F.sum(F.when(here, F.col("n")))
        return F.coalesce(found, F.lit(0)).cast("long").alias(f"n{number}")

    totals = counts.agg(*[failures(i, kind) for i, (_, kind) in enumerate(checks)])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"),
                F.col(f"n{i}").alias("failures"),
            )
            for i, (c, kind) in enumerate(checks)
        ]
    )
    return totals.select(F.inline(entries)).select(
        F.lit(table).alias("table_name"), "column_name", "check_name", "failures"
    )


def quality_report(
    tables: dict[str, tuple[DataFrame, Sequence[str], Sequence[str]]],
) -> DataFrame:
    """Rows ``(table_name, column_name, check_name, failures)``.

    ``tables`` maps a name to the table, its not-null columns and its unique columns.
    """
    reports = [
        table_report(df, name, required, unique)
        for name, (df, required, unique) in tables.items() if [*required, *unique]
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def member_audit(assignments: DataFrame, summaries: DataFrame) -> DataFrame:
    """Stories whose stored article count differs from their distinct members."""
    members = assignments.groupBy("cluster_id").agg(
        F.count_distinct("url_hash").alias("members")
    )
    return (
        summaries.select("cluster_id", "article_count")
        .join(members, "cluster_id")
        .where(F.col("article_count") != F.col("members"))
    )
