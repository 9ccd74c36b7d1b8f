"""Quality classifier: perplexity under modified Kneser-Ney models of trusted text.

One model reads words (``word_model``): its n-grams grow with the trusted text and are joined in shards.
A text is kept only if both models find it likely enough.

The other model reads bytes. Each byte belongs to one of ``CLASSES`` classes (letters, one class for all
capitals, digits, marks, parts of longer characters), and the model gives the probability of a class
after the ``ORDER - 1`` before it. All trusted text is counted: tasks add up their own text and send a
row for each n-gram they met. The counts are joined, in shards by context, with the sums of their contexts
and with the probabilities of the next lower order, by the interpolated formula with three discounts for
each order. The number of n-grams is bounded by the classes, not by the text, so the finished table is
broadcast, ``4 * CLASSES ** ORDER`` bytes at most.

A document's perplexity and its word perplexity must not exceed a quantile of the trusted documents of
its language, or of all languages where too few are trusted. For the quantiles each trusted document is
scored by a model of the other of two folds, which has not counted it; where that fold is empty, by the
model of all. This left-out perplexity, which every document has, must not be below a low quantile. Quantiles are taken from counts of fixed steps, so they are
exact in these steps and the same in every run.

Defined results: a null or empty text has no perplexity and is not kept; a null language is a language of
its own; with no trusted text every document with a text is kept; repeated rows each give their row;
columns named like ``SCORE_COLUMNS`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm import word_model
from tidings.llm.common import free_name, map_arrow, whole_text
from tidings.session import materialize

ORDER = 4
CLASSES = 48
#: Trusted documents' quantiles that bound the perplexity of bytes from above and below, and of words.
QUANTILE = 0.98
LEAST_QUANTILE = 0.001
WORD_QUANTILE = 0.995
#: A limit is so many times its language's quantile: no more than the quantile itself.
SLACK = 1.0
#: Trusted documents that a language needs for a quantile of its own.
LEAST_TRUSTED = 50
#: Perplexities are counted in these steps up to this many of them.
STEP = 0.01
STEPS = 100_000
MAX_LANGUAGES = 10_000
#: Trusted ids up to which they are broadcast; of more, the texts are shuffled by id.
BROADCAST_IDS = 4_000_000
SCORE_COLUMNS = (
    "perplexity", "threshold", "left_out_perplexity", "least_perplexity", "word_perplexity",
    "word_threshold", "kept",
)
_ROWS = 256


def _classes() -> np.ndarray:
    """The class of each byte; class 0 stands before and after a text."""
    own = np.full(256, 39, np.int32)  # other marks and control characters
    for k in range(26):
        own[97 + k], own[65 + k] = 1 + k, 27
    own[48:58] = 28
    for k, marks in enumerate((" \t", "\n\r", ".", ",", ";:", "'\"", "-", "!", "?", "()/[]")):
        for mark in marks:
            own[ord(mark)] = 29 + k
    own[ord("|")] = 46
    own[0x80:0xC0] = 40 + (np.arange(64) >> 4)  # continuation bytes
    own[0xC0:0xE0], own[0xE0:] = 44, 45
    return own


_CLASS = _classes()


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the n-grams that end in each byte of the texts or just after, and their counts."""
    pad = bytes(ORDER - 1)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts])
    parts = [pad + t + b"\0" for t in texts if t]
    if not parts:
        return np.zeros(0, np.int64), sizes
    raw = np.frombuffer(b"".join(parts), np.uint8)
    own = _CLASS[raw].astype(np.int64)
    # The bytes around the texts are class 0; zero bytes inside keep theirs.
    lengths = np.array([len(p) for p in parts])
    stops = np.cumsum(lengths)
    own[(stops[:, None] - lengths[:, None] + np.arange(ORDER - 1)).ravel()] = 0
    own[stops - 1] = 0
    code = np.zeros(len(own) - ORDER + 1, np.int64)
    for k in range(ORDER):
        code = code * CLASSES + own[k : k + len(code)]
    valid = np.ones(len(code), bool)
    crossing = (stops[:-1, None] - np.arange(1, ORDER)).ravel()
    valid[crossing] = False
    return code[valid], sizes


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, [(t or "").encode() for t in part.column("_body").to_pylist()]


def _folds(batch: pa.RecordBatch, key: str) -> np.ndarray:
    return batch.column(key).to_numpy() & 1


def count_grams(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``(code, n)`` of the n-grams of all texts.

    With a ``key``, the codes of the texts whose last bit of the key is set stand ``CLASSES ** ORDER``
    higher.
    """
    size = CLASSES**ORDER

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * size if key else size, np.int64)
        for part, texts in _texts(batches):
            codes, sizes = _laid_out(texts)
            if key:
                codes = codes + size * np.repeat(_folds(part, "_of"), sizes)
            codes, times = np.unique(codes, return_counts=True)
            counts[codes] += times
        met = np.flatnonzero(counts)
        for start in range(0, len(met), 65_536):
            own = met[start : start + 65_536]
            columns = [pa.array(own), pa.array(counts[own])]
            yield pa.RecordBatch.from_arrays(columns, ["code", "n"])

    own = [F.col(key).alias("_of")] if key else []
    rows = map_arrow(docs.select(whole_text().alias("_body"), *own), compute, "code long, n long")
    return rows.groupBy("code").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """The discounts of counts of one, two, and three or more."""
    n = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)])
    n1, n2, n3, n4 = (x or 0 for x in n.first())
    return word_model.discounts_of(n1, n2, n3, n4)


def probabilities(grams: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """``(code, p)`` of the n-grams met and ``(context, rest)`` of each order, lowest first.

    ``rest`` is the share of a context that goes to the lower order.
    """
    counts = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        # Lower orders count in how many ways an n-gram is continued to the left.
        shorter = F.pmod("code", F.lit(CLASSES**k)).alias("code")
        counts[k] = counts[k + 1].groupBy(shorter).agg(F.count(F.lit(1)).alias("n"))
        counts[k] = materialize(counts[k], "grams")
    found: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counts[k])
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        own = counts[k].withColumn("context", F.floor(F.col("code") / CLASSES)).withColumn("off", off)
        sums = own.groupBy("context").agg(
            F.sum("n").alias("total"), *[
                F.sum(test.cast("long")).alias(f"k{j}")
                for j, test in ((1, F.col("n") == 1), (2, F.col("n") == 2), (3, F.col("n") > 2))
            ],
        )
        rest = (F.col("k1") * d1 + F.col("k2") * d2 + F.col("k3") * d3) / F.col("total")
        contexts = materialize(sums.select("context", "total", rest.alias("rest")), "contexts")
        joined = own.join(contexts, "context")
        below: Column = F.lit(1.0 / CLASSES)
        if found:
            lower = found[-1][0].select(F.col("code").alias("suffix"), F.col("p").alias("below"))
            suffix = F.pmod("code", F.lit(CLASSES ** (k - 1)))
            joined = joined.withColumn("suffix", suffix).join(lower, "suffix")
            below = F.col("below")
        p = (F.col("n") - F.col("off")) / F.col("total") + F.col("rest") * below
        table = materialize(joined.select("code", p.alias("p")), "probabilities")
        found.append((table, contexts.select("context", "rest")))
    return found


def log_table(grams: DataFrame) -> np.ndarray:
    """The logarithm to base two of the probability of each n-gram, met or not.

    At most ``CLASSES ** ORDER`` rows come to the driver, whatever the text.
    """
    below = np.full(1, 1.0 / CLASSES)
    for k, (table, contexts) in enumerate(probabilities(grams)):
        rest = np.ones(CLASSES**k)
        own = contexts.toPandas()
        rest[own["context"].to_numpy(np.int64)] = own["rest"].to_numpy()
        if k == 0:
            dense = np.repeat(below, CLASSES) * rest[0]
        else:
            # The lower order sees the context without its first class.
            dense = rest[:, None] * np.tile(below.reshape(-1, CLASSES), (CLASSES, 1))
            dense = dense.ravel()
        own = table.toPandas()
        dense[own["code"].to_numpy(np.int64)] = own["p"].to_numpy()
        below = dense
    return np.log2(below).astype(np.float32)


def perplexities(
    docs: DataFrame, table: np.ndarray, key: str | None = None, name: str = "",
    others: tuple[np.ndarray | None, ...] = (),
) -> DataFrame:
    """``docs`` with ``perplexity``, the mean over a text's bytes and its end.

    With a ``key`` also column ``name``: the perplexity by the table in ``others`` of the text's fold.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table, *others))
    kept = [c for c in docs.columns if c.lower() not in (*SCORE_COLUMNS, "_body")]
    passed = [c for c in kept if c.lower() != "text"]
    kinds = dict(docs.dtypes)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, *halves = shared.value
        for part, texts in _texts(batches):
            codes, sizes = _laid_out(texts)
            stops = np.cumsum(sizes)

            def scored(values: np.ndarray) -> np.ndarray:
                sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))  # noqa: B023
                mean = (sums[stops] - sums[stops - sizes]) / np.maximum(sizes, 1)  # noqa: B023
                return np.round(2.0**-mean, 4)

            found = [pa.array(scored(logs[codes]), mask=sizes == 0)]
            if key:
                folds = _folds(part, key)
                left, unknown = np.zeros(len(sizes)), sizes == 0
                for fold, half in enumerate(halves):
                    here = folds == fold
                    if half is None:
                        unknown |= here
                    elif here.any():
                        left[here] = scored(half[codes])[here]
                found.append(pa.array(left, mask=unknown))
            own = [part.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*own, *found], names)

    names = [*passed, "perplexity", *([name] if key else [])]
    rows = docs.select(*passed, whole_text().alias("_body"))
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in passed] + [f"`{c}` double" for c in names[len(passed):]])
    return map_arrow(rows, compute, schema)


def thresholds(
    scores: DataFrame, quantile: float = QUANTILE, above: bool = True
) -> dict[str | None, float]:
    """The quantile of the perplexities of each language; key ``"*"`` is that of all.

    The limit is the upper end of the quantile's step, or the lower end without ``above``.
    """
    step = F.least(F.floor(F.col("perplexity") / STEP), F.lit(STEPS)).alias("step")
    steps = scores.where("perplexity IS NOT NULL").groupBy("lang", step).agg(
        F.count(F.lit(1)).alias("n")
    )
    steps = materialize(steps, "steps")
    every = steps.groupBy("step").agg(F.sum("n").alias("n")).withColumn("of", F.lit("all"))
    own = steps.select("step", "n", F.lit("one").alias("of"), "lang")
    both = own.unionByName(every.withColumn("lang", F.lit(None).cast("string")))
    order = Window.partitionBy("of", "lang").orderBy("step")
    total = F.sum("n").over(Window.partitionBy("of", "lang"))
    ranked = both.withColumn("seen", F.sum("n").over(order)).withColumn("total", total)
    reached = ranked.where(F.col("seen") >= quantile * F.col("total")).groupBy("of", "lang")
    found = reached.agg(F.min("step").alias("step"), F.max("total").alias("total"))
    rows = found.limit(MAX_LANGUAGES + 2).collect()
    if len(rows) > MAX_LANGUAGES + 1:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str | None, float] = {}
    for r in rows:
        value = round((r.step + above) * STEP * (SLACK if above else 1 / SLACK), 4)
        if r.of == "all":
            out["*"] = value
        elif r.total >= LEAST_TRUSTED:
            out[r.lang] = value
    return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the rows labelled as good, and never otherwise."""
    agreed = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    return agreed.agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def _with_limits(scored: DataFrame, limits: dict[str | None, float], otherwise: float, name: str) -> DataFrame:
    """``scored`` with the limit of each row's language."""
    everyone = limits.pop("*", otherwise)
    known = scored.sparkSession.createDataFrame(list(limits.items()), "_lang string, _limit double")
    lang = free_name(scored, "_of")
    same = F.col(lang).eqNullSafe(F.col("_lang"))
    # One row for each language, of which the number is checked by ``thresholds``.
    joined = scored.withColumn(lang, F.col("lang").cast("string")).join(F.broadcast(known), same, "left")
    limit = F.coalesce("_limit", F.lit(everyone))
    return joined.select(*scored.columns, limit.alias(name))


def _byte_scores(docs: DataFrame, good: DataFrame, key: str, left_out: str) -> DataFrame:
    """``perplexity`` by all trusted texts, and column ``left_out`` by those of the other fold."""
    size = CLASSES**ORDER
    both = materialize(count_grams(good, key), "grams")
    code = F.pmod("code", F.lit(size)).alias("code")
    table = log_table(materialize(both.groupBy(code).agg(F.sum("n").alias("n")), "grams"))
    others = []
    for fold in (0, 1):
        grams = both.where(F.floor(F.col("code") / size) == 1 - fold).select(code, "n")
        others.append(None if grams.isEmpty() else log_table(grams))
    return materialize(perplexities(docs, table, key, left_out, tuple(others)), "perplexities")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without ``text`` and with ``SCORE_COLUMNS``; one row per row of the input."""
    kept = [c for c in docs.columns if c.lower() not in (*SCORE_COLUMNS, "text")]
    trusted = materialize(trusted_ids(labels), "trusted")
    key, bits, left_out, most = (free_name(docs, c) for c in ("_key", "_bits", "_left_out", "_most"))
    keyed = docs.withColumn(key, word_model.text_key(whole_text()))
    keyed_body = [F.col(key).alias("_key"), whole_text().alias("_body")]
    if trusted.count() <= BROADCAST_IDS:
        good = keyed.join(F.broadcast(trusted), "doc_id", "left_semi").select("doc_id", "text", key)
    else:
        # Read many times, shuffled once.
        good = keyed.select("doc_id", "text", key).join(trusted.hint("merge"), "doc_id", "left_semi")
        good = materialize(good, "trusted-texts", codec="zstd")
    scored = _byte_scores(keyed, good, key, left_out)
    model = word_model.Model(good.select(keyed_body), keyed.select(keyed_body))
    words = model.bits(keyed.select(keyed_body)).toDF(key, bits)
    scored = materialize(scored.join(words, key, "left"), "scored")
    of_trusted = scored.join(trusted, "doc_id", "left_semi")
    bytewise = of_trusted.select("lang", F.coalesce(left_out, "perplexity").alias("perplexity"))
    wordwise = of_trusted.select("lang", F.col(bits).alias("perplexity"))
    joined = _with_limits(scored, thresholds(bytewise), float("inf"), "threshold")
    joined = _with_limits(joined, thresholds(bytewise, LEAST_QUANTILE, False), 0.0, "least_perplexity")
    joined = _with_limits(joined, thresholds(wordwise, WORD_QUANTILE), float("inf"), most)
    # Without a model of the words the bytes alone decide.
    # Below, like is compared with like: a trusted text is more likely to the model that counted it.
    apart = F.coalesce(left_out, "perplexity")
    fits = (F.col("perplexity") <= F.col("threshold")) & (apart >= F.col("least_perplexity"))
    fits &= F.coalesce(F.col(bits) <= F.col(most), F.lit(True))
    return joined.select(
        *kept, "perplexity", "threshold", apart.alias("left_out_perplexity"), "least_perplexity",
        F.round(F.pow(2.0, bits), 4).alias("word_perplexity"),
        F.pow(2.0, most).alias("word_threshold"), F.coalesce(fits, F.lit(False)).alias("kept"),
    )
