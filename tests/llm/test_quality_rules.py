"""The rules against a plain version of them, written with dictionaries."""

import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from tidings.llm import quality_rules as rules

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def chained(values):
    """Spark's hash of several longs: each is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def grams(words):
    own = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return own + [chained(p) for p in zip(own, own[1:])]


def base(text):
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
              for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed)


def plain(docs, trusted, buckets=rules.BUCKETS):
    """``{doc_id: (base..., score, kept)}``; ``trusted`` holds doc_ids."""
    raw, good = Counter(), Counter()
    for i, text in docs:
        own = [signed(g) % buckets for g in grams(WORDS.findall(text or ""))]
        raw.update(own)
        if i in trusted:
            good.update(own)
    n, t = sum(raw.values()), sum(good.values())
    ratio = [
        round(math.log((good[b] + 1) / (t + buckets)) - math.log((raw[b] + 1) / (n + buckets)), 6)
        if good else 0.0 for b in range(buckets)
    ]
    scores = {}
    for i, text in docs:
        own = grams(WORDS.findall(text or ""))
        scores[i] = sum(ratio[signed(g) % buckets] for g in own) / len(own) if own else 0.0
    bins = sorted(math.floor(scores[i] / rules.BIN) for i, x in docs
                  if i in trusted and len(WORDS.findall(x or "")) >= 50)
    edge = bins[min(int(rules.QUANTILE * len(bins)), len(bins) - 1)] if bins else 0
    limit = edge * rules.BIN - rules.MARGIN if good else 0.0
    out = {}
    for i, text in docs:
        own = base(text or "")
        out[i] = (*own, scores[i], not own[-1] and scores[i] >= limit)
    return out


def same(got, want):
    assert got[:6] == want[:6]
    assert got[6] == pytest.approx(want[6], abs=1e-9)
    # A score on the threshold itself may fall on either side of a rounding.
    assert got[7] == want[7]


def test_odd_texts(spark):
    texts = ["", None, " \n\t", "a", "a b", "a b c a b c", "x " * 200, "one two three\n" * 40, "é|é\n \n#",
             " ".join(f"w{k}" for k in range(60)), "\x1cq \x85 \xa0z", "p q r s " * 300 + "t",
             " ".join(f"{k % 70} {k % 70} z{k % 70}" for k in range(500))]
    rows = [(k, t, True, 7) for k, t in enumerate(texts)] + [(9, texts[9], True, 7), (None, "n n", False, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, _words long")
    model = rules.fit(df, df.where("doc_id IN (5, 9)"), buckets=50)
    got = rules.judge(df, model).collect()
    assert len(got) == len(rows) and "_words" in got[0]
    want = plain([(r[0], r[1]) for r in rows], {5, 9}, 50)
    for r in got:
        own = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == own[:6]
        assert r.score == pytest.approx(own[6], abs=1e-6)
    assert rules.judge(df.limit(0), model).count() == 0
    empty = rules.fit(df.limit(0), df.limit(0))
    assert set(empty.ratios) == {0.0}


def test_trusted_rows_are_bounded(spark):
    docs = spark.createDataFrame([(k, "t") for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(50)] + [(3, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert rules.trusted_documents(docs, labels).count() == 49
    assert rules.trusted_documents(docs, labels, 10).count() == 10


def test_every_trusted_row_counts(spark, monkeypatch):
    """More labelled rows than were once taken: each has its part in counts and threshold."""
    n = 21_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 7) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    trusted = rules.trusted_documents(docs, labels)
    assert trusted.count() == n
    # All documents are trusted, so that both multinomials are the same.
    assert set(rules.fit(docs, trusted, buckets=20).ratios) == {0.0}
    # Too many to broadcast: the same documents.
    monkeypatch.setattr(rules, "BROADCAST_IDS", 100)
    assert rules.trusted_documents(docs, labels).count() == n


def test_query_against_the_plain_rules(spark):
    from tidings.llm.queries import op7_quality_rules

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    want = plain(docs, {r.doc_id for r in labels if r.quality == 1})
    got = op7_quality_rules(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        same(tuple(r)[1:], want[r.doc_id])
