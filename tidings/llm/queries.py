"""The registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import (
    bpe, hard_negatives, mixing, packing, perplexity, prefix_trie, quality_rules, sharding, simhash,
    suffix_dedup, topk, toxicity, warc,
)
from tidings.llm.common import table
from tidings.session import configure, materialize, scratch


def op1_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return perplexity.classify(docs, table(spark, folder, "labels"))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.search(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id"
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents").select("doc_id", "source"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents").select("doc_id", "source"), ["doc_id"])


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, bpe.vocabulary(), with_ids=False)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    judged = quality_rules.quality_rules(docs.select("doc_id", "text"), labels)
    return judged.select("doc_id", *quality_rules.RULE_COLUMNS)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, folder, "labels"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.cut_repeats(docs, with_text=False)


def rebuilt_trie(rows: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations with the digest of the members that end in each."""
    nodes, ends = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.ordered_turns(rows)))
    joined = nodes.join(prefix_trie.ends_sha256(ends), ["k1", "k2"], "left")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_words").alias("saved_tokens"),
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return rebuilt_trie(rows)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.prepared(rows.withColumn("label", moved))
    return hard_negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, packing.vocabulary()))


QUERIES = [
    op1_perplexity, op2_topk, op3_simhash, op4_mixing, op5_sharding, op6_bpe, op7_quality_rules,
    op8_toxicity, op9_warc, op10_suffix_dedup, op11_prefix_trie, op12_hard_negatives, op13_packing,
]
#: Scores of all pairs; only SQL may do this.
_TOPK_SQL = """
WITH vectors AS (
  SELECT vec_id, min([floor(64 * x::DOUBLE) FOR x IN embedding]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 20
"""
_HARD_NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
near AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
    n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
  FROM near p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  WHERE p.place <= 5 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 5
"""
ORACLE: dict[str, str] = {"op2_topk": _TOPK_SQL, "op12_hard_negatives": _HARD_NEGATIVES_SQL}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Only the result stays; the tables on the way to it are deleted.
            with scratch(configure(spark)):
                return materialize(query(spark, folder), query.__name__, keep=True)

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        return run

    return {query.__name__: prepared(query) for query in QUERIES}
