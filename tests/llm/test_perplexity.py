"""The model against the formula written out with dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest

from tidings.llm import perplexity as kn

FOLDER = "/root/testdata/sf0.001"


def classes(text):
    return [0] * (kn.ORDER - 1) + [int(kn._CLASS[b]) for b in text.encode()] + [0]


class Plain:
    """Interpolated modified Kneser-Ney, one n-gram at a time."""

    def __init__(self, texts):
        n = kn.ORDER
        self.counts = {n: Counter()}
        for text in texts:
            own = classes(text)
            for k in range(len(own) - n + 1 if text else 0):
                self.counts[n][tuple(own[k : k + n])] += 1
        for k in range(n - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.off, self.follow = {}, {}
        for k, counts in self.counts.items():
            n1, n2, n3, n4 = (sum(c == j for c in counts.values()) for j in (1, 2, 3, 4))
            if n1 and n2:
                y = n1 / (n1 + 2 * n2)
                d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
                self.off[k] = [min(max(x, 0.05), j + 0.95) for j, x in enumerate(d)]
            else:
                self.off[k] = [0.5] * 3
            self.follow[k] = defaultdict(list)
            for g, c in counts.items():
                self.follow[k][g[:-1]].append(c)

    def p(self, gram):
        if not gram:
            return 1 / kn.CLASSES
        k, below = len(gram), self.p(gram[1:])
        counts = self.follow[k].get(gram[:-1])
        if not counts:
            return below
        off = [self.off[k][min(c, 3) - 1] for c in counts]
        c = self.counts[k].get(gram, 0)
        own = c - self.off[k][min(c, 3) - 1] if c else 0.0
        return (own + sum(off) * below) / sum(counts)

    def perplexity(self, text):
        if not text:
            return None
        own = classes(text)
        grams = [tuple(own[k : k + kn.ORDER]) for k in range(len(own) - kn.ORDER + 1)]
        return 2 ** -(sum(math.log2(self.p(g)) for g in grams) / len(grams))


def texts():
    rnd = random.Random(6)
    words = ["the", "of", "and", "naïve", "Über", "end.", "x-y", "42", "日本", "a\x00b", "!!"]
    return [" ".join(rnd.choices(words, k=rnd.randint(1, 40))) for _ in range(40)]


def test_perplexity_against_the_formula(spark):
    train = texts()
    other = ["", None, "q", "THE OF!!", "### |||", "zebra \x00\x00", *texts()[:5]]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(train)], "doc_id long, text string")
    table = kn.log_table(kn.count_grams(df.unionByName(df.limit(1)).repartition(3)))
    plain = Plain([*train, train[0]])
    rows = [(k, t, 1.0, "b") for k, t in enumerate(other)]
    asked = spark.createDataFrame(rows, "doc_id long, text string, perplexity double, _body string")
    for r in kn.perplexities(asked, table).collect():
        want = plain.perplexity(other[r.doc_id])
        assert (want is None) == (r.perplexity is None)
        assert want is None or r.perplexity == pytest.approx(want, rel=1e-3)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "text string")
    table = kn.log_table(kn.count_grams(df)).astype(float)
    sums = (2.0**table).reshape(-1, kn.CLASSES).sum(axis=1)
    assert abs(sums - 1).max() < 1e-4


def test_thresholds_by_language(spark):
    rows = [("en", float(k), k) for k in range(1, 1001)] + [(None, 5.0, k) for k in range(60)]
    rows += [("de", 7.0, 1), ("en", None, 2)]
    df = spark.createDataFrame(rows, "lang string, perplexity double, doc_id long")
    got = kn.thresholds(df, 0.5)
    assert set(got) == {"en", None, "*"}
    assert got["en"] == pytest.approx(500.01 * kn.SLACK, rel=1e-4)
    assert got[None] == pytest.approx(5.01 * kn.SLACK, rel=1e-4)


def test_odd_rows(spark):
    rows = [(1, "good text here", "en", True), (1, "good text here", "en", False), (None, "x", None, True),
            (2, None, "en", True), (3, "", None, True), (4, "§§§§§§", "en", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept boolean")
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = kn.classify(df, labels).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in got) == [
        (0, False), (1, True), (1, True), (2, False), (3, False), (4, False)]
    assert kn.classify(df.limit(0), labels).count() == 0
    everything = kn.classify(df, labels.limit(0)).collect()
    assert sum(r.kept for r in everything) == 4


def test_query_keeps_trusted_documents(spark):
    from tidings.llm.queries import op1_perplexity

    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = op1_perplexity(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    plain = Plain([docs[i].text or "" for i, q in good.items() if q == 1])
    for r in got[:40]:
        assert r.perplexity == pytest.approx(plain.perplexity(docs[r.doc_id].text), rel=1e-3)
    kept = [r.kept for r in got if good.get(r.doc_id) == 1]
    assert sum(kept) >= 0.98 * len(kept)
