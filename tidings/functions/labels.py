"""Reader-facing labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds and texts of the labels below.
_MINUTE, _HOUR, _DAY = 60, 3600, 86400


def consensus_label(article_count: Column) -> Column:
    return (
        F.when(article_count >= 5, "High consensus")
        .when(article_count >= 3, "Medium consensus")
        .otherwise("Low consensus")
    )


def age_label(at: Column, as_of: Column) -> Column:
    """Age of a time as seen at ``as_of``; from 30 days on, its date."""
    seconds = F.floor((F.unix_micros(as_of) - F.unix_micros(at)) / 1_000_000)

    def ago(unit, letter):
        return F.concat(F.floor(seconds / unit).cast("string"), F.lit(f"{letter} ago"))

    return (
        F.when(at.isNull(), None)
        .when(seconds < _MINUTE, "just now")
        .when(seconds < _HOUR, ago(_MINUTE, "m"))
        .when(seconds < _DAY, ago(_HOUR, "h"))
        .when(seconds < 30 * _DAY, ago(_DAY, "d"))
        .otherwise(F.date_format(at, "yyyy-MM-dd"))
    )


def coverage_label(article_count: Column) -> Column:
    noun = F.when(article_count == 1, "source").otherwise("sources")
    return F.concat(F.lit("Covered by "), article_count.cast("string"), F.lit(" "), noun)


def source_label(source_name: Column) -> Column:
    return F.coalesce(source_name, F.lit("Unknown source"))
