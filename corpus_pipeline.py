"""A training corpus in five stages, each one of the operators in ``tidings.llm``.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the one before kept, and returns
a DataFrame. ``run`` writes each result to the work folder and reads it as the next stage's input.
All stages but the last return the columns of ``documents``; the last one's ``position`` is the place of
a row in the mixture, since rows of a table read from files have no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import bpe, mixing, quality_rules, simhash, suffix_dedup
from tidings.llm.common import table
from tidings.session import configure, materialize, scratch


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that are linked."""
    return simhash.first_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes that they repeat from documents with smaller ids.

    A document keeps its row if nothing of its text is left.
    """
    cut = suffix_dedup.cut_repeats(docs.select("doc_id", "text", "lang", "source"))
    text = F.col("kept")
    return cut.select(
        "doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars")
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in an order that mixes the sources, in files that follow it."""
    return mixing.in_order(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its ``position`` in the mixture; ``docs`` are written files."""
    return bpe.encode(mixing.with_place(docs), bpe.vocabulary(), passed=("position",))


STAGES = [
    ("quality rules", rules),
    ("simhash near-dedup", near_copies),
    ("suffix-array dedup", repeats),
    ("source mixing", mixture),
    ("bpe encoding", tokens),
]

#: Hashed likelihood ratios, fingerprints and token ids have no form in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    last = STAGES[-1][0]
    with scratch(spark):
        for name, stage in STAGES:
            rows = stage(spark, docs, sf_dir)
            docs = materialize(rows, name.replace(" ", "-"), keep=name == last)
    return docs
