"""Voters, the label model on drawn votes, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from tidings.llm import toxicity

FOLDER = "/root/testdata/sf0.01"


def test_signs_and_votes():
    assert toxicity.words_in("Ab, ab! x_9 été###") == {"ab", "x", "été"}
    assert toxicity.beginnings("abcdef") == ["abc", "abcd", "abcde"]
    assert toxicity.beginnings("abc") == []
    signs = toxicity.signs_in("abcd abce abcf abcg")
    assert {"abcd", "abc*", "abc**", "abc***"} <= signs and "abc****" not in signs
    voters = toxicity.Voters(["abcd", "abc*", "abc***", "zz"])
    assert voters.votes("ABCD, q") == ({0, 1}, 1.0)
    assert voters.votes("abce abcf abcg q") == ({1, 2}, 0.75)
    assert voters.votes("") == (set(), 0.0)


def drawn(seed=1, n=4000):
    """Votes of known accuracy: five voters on their own and six copies of one bad voter."""
    rnd = np.random.default_rng(seed)
    truth = (rnd.random(n) < 0.3).astype(float)
    own = [(rnd.random(n) < np.where(truth, 0.6, 0.02)) for _ in range(5)]
    bad = rnd.random(n) < np.where(truth, 0.25, 0.15)
    votes = np.stack([*own, *[bad] * 6], axis=1).astype(float)
    return truth, votes


def test_label_model_estimates_accuracies_and_correlations():
    truth, votes = drawn()
    known = truth.copy()
    turned = np.flatnonzero(truth == 0)[:40]
    known[np.flatnonzero((truth == 1) & (votes[:, :5].sum(axis=1) >= 3))[:200]] = 0
    model = toxicity.fit_label_model(votes, known)
    assert abs(model.fires[1][:5] - 0.6).max() < 0.1
    assert model.fires[0][:5].max() < 0.06
    assert model.weight[:5].min() > 0.9 and model.weight[5:].max() < 0.25
    # Labels that many voters contradict are overruled.
    found = model.posterior(votes, known) >= 0.5
    assert (found == truth).mean() > (known == truth).mean() + 0.03
    assert not found[turned].any() or found[turned].mean() < 0.1


def test_linear_classifier_follows_the_posterior():
    truth, votes = drawn(2)
    weights = toxicity.fit_linear(votes, truth)
    p = 1 / (1 + np.exp(-(votes @ weights[:-1] + weights[-1])))
    assert ((p >= 0.5) == truth).mean() > 0.93


def test_odd_rows(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(500)]
    rows, labels = [], []
    for k in range(300):
        bad = k % 5 == 0
        text = rnd.choices(words, k=30) + (["vileword"] if bad else [])
        rows.append((k, " ".join(text), 1, 0.5))
        labels.append((k, 1, int(bad)))
    rows += [(None, "vileword", 2, 0.1), (1000, None, 3, 0.1), (1001, "", 3, 0.1), (7, rows[7][1], 1, 0.5)]
    labels += [(None, 1, 1), (5, 1, None), (2000, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted int, score double")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, table).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].predicted == (k % 5 == 0) for k in range(300))
    assert by[None].predicted == 1 and by[None].held_out is False
    assert by[1000].predicted == by[1001].predicted == 0 and by[1000].score == by[1001].score
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert toxicity.toxicity(docs.limit(0), table).count() == 0
    plain = toxicity.toxicity(docs, table.where("toxic = 0")).collect()
    assert {r.predicted for r in plain} == {0}


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "quality",
        "CASE WHEN pmod(crc32(cast(doc_id AS string)), 5) = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_query_on_held_out_rows(spark):
    from tidings.llm.queries import op8_toxicity

    got = {r.doc_id: r for r in op8_toxicity(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(got) == docs.count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(got[i].predicted, t) for i, t in labels.items() if got[i].held_out]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(p and not t for p, t in held) <= 1
    assert sum(p and t for p, t in held) >= 0.5 * sum(t for _, t in held)
    assert np.mean([p == t for p, t in held]) > 0.9
