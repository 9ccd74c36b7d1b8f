"""Quality rules: a hashed n-gram likelihood ratio between trusted text and the raw corpus.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials are counted
over the buckets: one of trusted documents, one of all documents. The score of a document is the
mean log ratio of its buckets, so that length does not matter. The threshold is a low quantile
of the scores of the trusted documents that pass the base rules, less a margin; every document is compared with it.

Only DataFrame functions are used. A document is judged within its own row, so nothing but bucket
counts is shuffled, and neither copies nor a hot source can load one task.

Defined results: a null text counts as empty; a text without words has the score 0 and fails the
base rules; repeated rows are judged one by one and all count; columns of the input stay as they
are and only ``RULE_COLUMNS`` are added (a clashing input column is replaced in the result). With
no trusted document the ratio is 0 for every bucket and the base rules alone decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import NOT_WHITE, free_name, whole_text, words_of
from tidings.session import materialize

BUCKETS = 10_000
#: Pseudo-count of each bucket in both multinomials.
SMOOTHING = 1.0
#: Trusted ids up to which they are broadcast; of more, the texts are shuffled by id.
BROADCAST_IDS = 4_000_000
#: The trusted documents' scores are counted in bins of this width; the threshold is a bin's edge.
BIN = 0.001
#: Share of the trusted documents that may lie below the threshold before the margin is taken off.
QUANTILE = 0.005
MARGIN = 0.025
#: Repeated windows of a text up to which they are looked up one by one.
LOOKED_UP = 64
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
RULE_COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "score", "kept",
)


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket and the least score of a kept document."""

    ratios: tuple[float, ...]
    threshold: float


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _longer(runs: Column, hashes: Column, n: int) -> Column:
    """A hash of each window of ``n`` words, from those of ``n - 1`` words and the words' own."""
    count = F.greatest(F.size(hashes) - (n - 1), F.lit(0))
    return F.zip_with(
        F.slice(runs, F.lit(1), count), F.slice(hashes, F.lit(n), count), lambda a, b: F.xxhash64(a, b)
    )


def _repeated_words(windows: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more in the text.

    The windows that repeat are looked up one by one where they are few, else by a second sort;
    the result is the same.
    """
    def twice(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda x, k: x == F.get(ordered, k + 1)))

    def by_lookup(repeated: Column) -> Column:
        marked = F.transform(
            windows, lambda h, i: F.when(F.array_contains(repeated, h), i).otherwise(-1)
        )
        return F.filter(marked, lambda i: i >= 0)

    def by_sort(_: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            def is_repeated(x: Column, k: Column) -> Column:
                before, after = F.get(p, k - 1)["h"], F.get(p, k + 1)["h"]
                same = F.coalesce(x["h"] == before, F.lit(False))
                return same | F.coalesce(x["h"] == after, F.lit(False))

            return F.transform(F.filter(p, is_repeated), lambda x: x["i"])

        return _once(pairs, starts)

    def counted(starts: Column) -> Column:
        def moved(by: int) -> Column:
            return F.transform(starts, lambda i: i + by)

        return F.size(F.array_distinct(F.concat(starts, moved(1), moved(2))))

    def starts_of(repeated: Column) -> Column:
        few = F.size(repeated) <= LOOKED_UP
        return F.when(few, by_lookup(repeated)).otherwise(by_sort(repeated))

    # A text without a repeated window, the usual case, is not sorted.
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    found = _once(
        F.sort_array(windows), lambda s: _once(twice(s), lambda d: _once(starts_of(d), counted))
    )
    return F.when(repeats, found).otherwise(0).cast("long")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _base(text: Column, words: Column, windows: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_WHITE))
    no_symbols = F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(text) - no_symbols).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeated_words(windows),
    }


def _scored(hashes: Column, pairs: Column, ratios: tuple[float, ...]) -> Column:
    # A constant of a fixed number of entries; it is folded to one array literal.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    size = F.lit(len(ratios))

    def add(s: Column, h: Column) -> Column:
        return s + F.get(table, F.pmod(h, size).cast("int"))

    total = F.aggregate(pairs, F.aggregate(hashes, F.lit(0.0), add), add)
    n = F.size(hashes)
    return F.when(n > 0, total / (n + n - 1)).otherwise(0.0)


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    """Hashes of the words and of the word pairs of each row."""
    hashed = docs.select(word_hashes(whole_text(text)).alias("h"))
    return hashed.withColumn("p", _longer(F.col("h"), F.col("h"), 2))


def _bucket_counts(docs: DataFrame, text: str, buckets: int) -> dict[int, int]:
    """Counts by bucket; at most ``buckets`` rows come back."""
    grams = _hashed(docs, text).select(F.explode(F.concat("h", "p")).alias("g"))
    counts = grams.groupBy(F.pmod("g", F.lit(buckets)).cast("int").alias("b"))
    return {r.b: r.n for r in counts.agg(F.count(F.lit(1)).alias("n")).collect()}


def trusted_documents(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> DataFrame:
    """The documents of the labelled ids with good quality, all of them.

    Up to ``BROADCAST_IDS`` ids are broadcast, and no text is shuffled then. Conflicting labels
    count as not trusted. With ``rows`` only so many ids are taken, those with the smallest hash.
    """
    agreed = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    good = agreed.agg(F.min("quality").alias("quality")).where("quality = 1")
    if rows is not None:
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Written, as its number of rows is asked for and it is read twice.
    ids = materialize(good.select("doc_id"), "trusted")
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", "left_semi")


def fit(docs: DataFrame, trusted: DataFrame, text: str = "text", buckets: int = BUCKETS) -> Model:
    """Count both multinomials and set the threshold by the trusted documents' scores."""
    raw, good = _bucket_counts(docs, text, buckets), _bucket_counts(trusted, text, buckets)
    if not good:
        return Model((0.0,) * buckets, 0.0)
    every, trust = sum(raw.values()), sum(good.values())
    ratios = tuple(
        round(
            math.log((good.get(b, 0) + SMOOTHING) / (trust + SMOOTHING * buckets))
            - math.log((raw.get(b, 0) + SMOOTHING) / (every + SMOOTHING * buckets)),
            6,
        )
        for b in range(buckets)
    )
    long_enough = _hashed(trusted, text).where(F.size("h") >= MIN_WORDS)
    scores = long_enough.select(_scored(F.col("h"), F.col("p"), ratios).alias("score"))
    bins = scores.groupBy(F.floor(F.col("score") / BIN).alias("bin")).count()
    counts = sorted((r["bin"], r["count"]) for r in bins.collect())
    allowed, seen, edge = QUANTILE * sum(n for _, n in counts), 0, 0
    for edge, n in counts:
        seen += n
        if seen > allowed:
            break
    return Model(ratios, edge * BIN - MARGIN)


def judge(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``RULE_COLUMNS``; one row per row of the input."""
    kept = [c for c in docs.columns if c.lower() not in RULE_COLUMNS]
    w, h, p, t = (free_name(docs, f"_{x}") for x in ("words", "hashes", "pairs", "triples"))
    body = whole_text(text)
    hashed = docs.withColumn(w, words_of(body))
    hashed = hashed.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    hashed = hashed.withColumn(p, _longer(F.col(h), F.col(h), 2))
    hashed = hashed.withColumn(t, _longer(F.col(p), F.col(h), 3))
    found = _base(body, F.col(w), F.col(t))
    found["score"] = _scored(F.col(h), F.col(p), model.ratios)
    # Unpacked from one row, as a filter on the verdict would else be pushed into the projections
    # above and repeat their work for each of its terms.
    packed = F.array(F.struct(*[c.alias(name) for name, c in found.items()]))
    scored = hashed.select(*kept, F.inline(packed))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    scored = scored.withColumn("base_failed", failed)
    verdict = ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold))
    return scored.withColumn("kept", verdict).select(*kept, *RULE_COLUMNS)


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Fit on the labelled documents and judge every document."""
    return judge(docs, fit(docs, trusted_documents(docs, labels), text), text)
