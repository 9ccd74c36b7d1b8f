"""Toxicity by weak supervision.

Many weak voters look at a document: a *lexicon* voter fires if the text has its word, a *pattern* voter
if one, two or three different words of the text begin with its letters. Words and beginnings are taken from labelled rows, the
most telling first. A generative label model then explains the votes by a hidden label: expectation
and maximisation estimate how often each voter fires on either label, and voters that fire together more
than the label explains are correlated and share their weight, so that ten copies of one opinion count
once. The label model's posteriors, not the labels, train a linear classifier on the votes and on the
share of words they hit, and that scores every document.

Only rows with ``crc32(doc_id) mod 5`` other than 0 are learned from, ``FIT_ROWS`` of them at most, those
with the smallest hash of their id; this bounds what the driver gets, one row of votes each. Scores use
the text alone.

Defined results: a null text counts as empty, and an empty one has the classifier's score for no vote;
repeated rows each give their row; a row without id is never learned from and is not held out;
conflicting labels count as toxic; without labels of both kinds every score is the share of toxic labels;
columns named like ``SCORE_COLUMNS`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow, whole_text
from tidings.session import materialize

FOLDS = 5
#: Labelled rows that the voters, the label model and the classifier are learned from.
FIT_ROWS = 20_000
VOTERS = 256
#: Letters of a pattern, and toxic rows that a voter must have hit.
PATTERN = (3, 4, 5, 6, 7)
#: Different words of a text up to which a pattern voter may ask for them.
LEVELS = 3
LEAST_HITS = 3
#: How surely a voter's rows differ from all rows, as a likelihood ratio, and their odds to be toxic.
LEAST_RATIO = 25.0
LEAST_ODDS = 4.0
SCORE_COLUMNS = ("held_out", "score", "predicted")
_CACHED = 300_000
_ROWS = 256
_LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> set[str]:
    """The different words of a text, lower-cased, without marks."""
    return set(_LETTERS.findall(text.lower()))


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in PATTERN if len(word) > n]


def signs_in(text: str) -> set[str]:
    """Words of a text, and beginnings with a star for each word that has it, up to ``LEVELS``."""
    words = words_in(text)
    begun = Counter(b for w in words for b in beginnings(w))
    stars = {b + "*" * k for b, n in begun.items() for k in range(1, min(n, LEVELS) + 1)}
    return words | stars


@dataclass
class Voters:
    """Fires the voters of a text."""

    signs: list[str]
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        #: The voters of each word or beginning, by the number of words that they ask for.
        self.lexicon = {s: k for k, s in enumerate(self.signs) if not s.endswith("*")}
        self.patterns: dict[str, list[tuple[int, int]]] = {}
        for k, s in enumerate(self.signs):
            if s.endswith("*"):
                self.patterns.setdefault(s.rstrip("*"), []).append((s.count("*"), k))

    def of_word(self, word: str) -> tuple[str, ...]:
        """The beginnings of a word that some voter has."""
        found = self.known.get(word)
        if found is None:
            found = tuple(b for b in beginnings(word) if b in self.patterns)
            if len(self.known) >= _CACHED:
                self.known.clear()
            if len(word) < 64:
                self.known[word] = found
        return found

    def votes(self, text: str) -> tuple[set[int], float]:
        """The voters that fire, and the share of different words that count for one."""
        words = words_in(text)
        fired = {self.lexicon[w] for w in words & self.lexicon.keys()}
        hits, begun = len(fired), Counter()
        for found in map(self.of_word, words):
            if found:
                begun.update(found)
                hits += 1
        for b, n in begun.items():
            fired.update(k for least, k in self.patterns[b] if n >= least)
        return fired, min(hits / len(words), 1.0) if words else 0.0


def fold(name: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(name).cast("string")), F.lit(FOLDS))


def fit_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``(text, toxic)`` of at most ``rows`` labelled ids outside the held-out fold."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold() != 0)
    ids = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Bounded by the limit, so that no text is moved to find the labelled ones.
    joined = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id")
    return joined.select("text", F.col("_toxic").alias("toxic"))


def _count_signs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each sign, toxic ones and all."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            toxic: Counter = Counter()
            every: Counter = Counter()
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                signs = signs_in(text)
                every.update(signs)
                if label:
                    toxic.update(signs)
            if every:
                names = list(every)
                columns = [pa.array(names), pa.array([toxic[s] for s in names], pa.int64()),
                           pa.array([every[s] for s in names], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["sign", "toxic", "n"])


def choose_voters(rows: DataFrame, toxic: int, total: int, voters: int = VOTERS) -> list[str]:
    """The most telling words and beginnings of the labelled rows."""
    counts = map_arrow(rows, _count_signs, "sign string, toxic long, n long").groupBy("sign")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    share = toxic / total
    clean = F.col("n") - F.col("toxic")
    odds = (F.col("toxic") + 0.5) / (clean + 0.5) * ((1 - share) / share)
    ratio = 2 * F.col("toxic") * F.log(F.col("toxic") / (F.col("n") * share))
    ratio += F.when(clean > 0, 2 * clean * F.log(clean / (F.col("n") * (1 - share)))).otherwise(0.0)
    told = counts.where(F.col("toxic") >= LEAST_HITS).withColumn("odds", odds)
    told = told.withColumn("ratio", ratio)
    told = told.where((F.col("odds") >= LEAST_ODDS) & (F.col("ratio") >= LEAST_RATIO))
    # A beginning that hits the same rows as a longer sign says it all; each rest counts once.
    best = told.orderBy(F.desc("ratio"), F.length("sign"), "sign").limit(len(PATTERN) * voters)
    chosen: dict[str, tuple[int, int]] = {}
    for r in best.select("sign", "toxic", "n").collect():
        hits = (r.toxic, r.n)
        body, stars = r.sign.rstrip("*"), "*" * max(1, r.sign.count("*"))
        if not any(chosen.get(b + stars) == hits for b in beginnings(body)):
            chosen[r.sign] = hits
    return list(chosen)[:voters]


def _vote_rows(signs: list[str]):
    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(signs)
        for batch in batches:
            found = [voters.votes(t) for t in batch.column(0).to_pylist()]
            fired = pa.array([sorted(f) for f, _ in found], pa.list_(pa.int32()))
            share = pa.array([s for _, s in found], pa.float64())
            columns = [batch.column(1).cast(pa.int32()), fired, share]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "fired", "share"])

    return compute


@dataclass(frozen=True)
class LabelModel:
    """How often each voter fires on either label, and the weight its correlations leave it."""

    prior: float
    fires: np.ndarray  # (2, voters): probability to fire on label 0 and label 1
    weight: np.ndarray
    marks: float  # accuracy of the given labels, which are a voter that never abstains

    def posterior(self, votes: np.ndarray, known: np.ndarray) -> np.ndarray:
        fires, quiet = np.log(self.fires), np.log1p(-self.fires)
        logit = math.log(self.prior / (1 - self.prior)) + votes @ ((fires[1] - fires[0]) * self.weight)
        logit += (1 - votes) @ ((quiet[1] - quiet[0]) * self.weight)
        logit += (2 * known - 1) * math.log(self.marks / (1 - self.marks))
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 30) -> LabelModel:
    """Accuracies by expectation and maximisation from the labels on; correlations given the label."""
    belief = known.astype(float)
    model = None
    for _ in range(rounds):
        both = np.stack([1 - belief, belief])
        mass = both.sum(axis=1, keepdims=True)
        fires = np.clip((both @ votes + 0.1) / (mass + 1.0), 1e-6, 1 - 1e-6)
        # What is left of the votes once the label has said its part.
        left = votes - (both[0][:, None] * fires[0] + both[1][:, None] * fires[1])
        spread = np.sqrt((left**2).mean(axis=0)) + 1e-9
        related = np.clip((left.T @ left) / len(votes) / np.outer(spread, spread), 0.0, 1.0)
        np.fill_diagonal(related, 0.0)
        related[related < 0.3] = 0.0
        prior = float(np.clip(belief.mean(), 1e-3, 0.5))
        marks = float(np.clip((belief * known + (1 - belief) * (1 - known)).mean(), 0.6, 0.98))
        model = LabelModel(prior, fires, 1 / (1 + related.sum(axis=1)), marks)
        found = model.posterior(votes, known)
        if np.abs(found - belief).max() < 1e-4:
            break
        belief = found
    return model


def fit_linear(features: np.ndarray, target: np.ndarray, rounds: int = 25, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the constant."""
    x = np.hstack([features, np.ones((len(features), 1))])
    own = np.full(x.shape[1], ridge)
    own[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + own * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(own)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    signs: tuple[str, ...]
    weights: tuple[float, ...]  # of the voters, of the share of hits, and the constant


def _features(fired: list[list[int]], shares: list[float], voters: int) -> np.ndarray:
    out = np.zeros((len(fired), voters + 1))
    for k, own in enumerate(fired):
        out[k, own] = 1.0
    out[:, voters] = np.sqrt(shares)
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    sample = materialize(fit_rows(docs, labels, rows), "labelled")
    toxic, total = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic = toxic or 0
    if not toxic or toxic == total:
        share = min(max(toxic / total if total else 0.0, 1e-4), 1 - 1e-4)
        return Model((), (0.0, math.log(share / (1 - share))))
    signs = choose_voters(sample, toxic, total)
    found = map_arrow(sample, _vote_rows(signs), "toxic int, fired array<int>, share double").collect()
    order = sorted(found, key=lambda r: (r.toxic, r.fired, r.share))
    features = _features([r.fired for r in order], [r.share for r in order], len(signs))
    votes = features[:, : len(signs)]
    known = np.array([r.toxic for r in order], float)
    belief = fit_label_model(votes, known).posterior(votes, known) if signs else known
    return Model(tuple(signs), tuple(fit_linear(features, belief).round(6).tolist()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text`` and with ``SCORE_COLUMNS``; one row per row of the input."""
    kept = [c for c in docs.columns if c.lower() not in (*SCORE_COLUMNS, "text", "_body")]
    kinds = dict(docs.dtypes)
    signs, weights = list(model.signs), np.array(model.weights)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(signs)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                sums = []
                for text in part.column("_body").to_pylist():
                    fired, share = voters.votes(text)
                    sums.append(weights[sorted(fired)].sum() + weights[-2] * math.sqrt(share) + weights[-1])
                found = 1 / (1 + np.exp(-np.clip(np.array(sums), -30, 30)))
                own = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found.round(6))], [*kept, "score"])

    rows = docs.select(*kept, whole_text().alias("_body"))
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + ["score double"])
    scored = map_arrow(rows, compute, schema)
    held_out = F.coalesce(fold() == 0, F.lit(False))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select(*kept, held_out.alias("held_out"), "score", predicted.alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
