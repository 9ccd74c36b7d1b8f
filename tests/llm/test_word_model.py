"""The word model against the formula written out with dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidings.llm import perplexity as kn
from tidings.llm import word_model as wm

FOLDER = "/root/testdata/sf0.001"


def padded(text):
    return ["<s>"] * (wm.ORDER - 1) + wm.words(text) + ["</s>"]


class Plain:
    """Interpolated modified Kneser-Ney over words, one n-gram at a time."""

    def __init__(self, texts):
        n = wm.ORDER
        self.counts = {n: Counter()}
        for text in texts:
            own = padded(text)
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
            return 1 / (len(self.counts[1]) + 1)
        k, below = len(gram), self.p(gram[1:])
        counts = self.follow[k].get(gram[:-1])
        if not counts:
            return below
        off = [self.off[k][min(c, 3) - 1] for c in counts]
        c = self.counts[k].get(gram, 0)
        own = c - self.off[k][min(c, 3) - 1] if c else 0.0
        return (own + sum(off) * below) / sum(counts)

    def bits(self, text):
        own = padded(text)
        grams = [tuple(own[k : k + wm.ORDER]) for k in range(len(own) - wm.ORDER + 1)]
        return -sum(math.log2(self.p(g)) for g in grams) / len(grams)


def texts(count, seed):
    rnd = random.Random(seed)
    words = ["the", "of", "and", "naïve", "Über", "end.", "x-y", "42", "日本", "a\x00b", "!!"]
    return [" ".join(rnd.choices(words, k=rnd.randint(1, 40))) for _ in range(count)]


def keyed(spark, rows):
    df = spark.createDataFrame([(t,) for t in rows], "_body string")
    return df.withColumn("_key", wm.text_key(F.col("_body")))


def test_bits_against_the_formula(spark):
    train = [*texts(40, 6), texts(40, 6)[0], ""]
    asked = [*train[:8], "", "zebra", "THE OF !!", *texts(6, 9)]
    fold = {r._body: r._key & 1 for r in keyed(spark, {*train, *asked}).collect()}
    key = {r._body: r._key for r in keyed(spark, {*asked}).collect()}
    plain = {f: Plain([t for t in train if fold[t] != f]) for f in (0, 1)}
    model = wm.Model(keyed(spark, train).repartition(3))
    got = {r.key: r.bits for r in model.bits(keyed(spark, [*asked, asked[0]])).collect()}
    assert set(got) == {key[t] for t in asked if t}
    for t in asked:
        if t:
            assert got[key[t]] == pytest.approx(plain[fold[t]].bits(t), rel=1e-5)


def test_the_model_grows_with_the_trusted_text(spark):
    rnd = random.Random(3)
    few, many = (
        [" ".join("".join(rnd.choices("abcdefgh", k=7)) for _ in range(500)) for _ in range(n)] for n in (4, 40)
    )
    sizes = [wm.Model(keyed(spark, rows)).tables[wm.ORDER].count() for rows in (few, many)]
    assert sizes[1] > 9 * sizes[0]


def test_words_out_of_order_are_rejected(spark):
    """Bytes of a word salad look much like those of the text; its word n-grams do not."""
    rnd = random.Random(5)
    follow = {f"{a}{b}": [f"{x}{y}" for x, y in zip(rnd.choices("klmn", k=2), rnd.choices("aeio", k=2), strict=True)]
              for a in "klmn" for b in "aeio"}

    def sentence():
        out = ["ka"]
        for _ in range(120):
            out.append(rnd.choice(follow[out[-1]]))
        return out

    good = [sentence() for _ in range(120)]
    salad = [rnd.sample(s, len(s)) for s in (sentence() for _ in range(30))]
    rows = [(i, " ".join(s), "xx") for i, s in enumerate([*good, *salad])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(good))], "doc_id long, quality int")
    got = {r.doc_id: r for r in kn.classify(docs, labels).collect()}
    assert sum(got[i].kept for i in range(120)) >= 116
    assert not any(got[i].kept for i in range(120, 150))
    assert all(got[i].word_perplexity > got[i].word_threshold for i in range(120, 150))


def test_words_of_scripts_without_blanks():
    assert wm.words("Über 42, naïve_x 日本語! ไทย") == [
        "Über", "4", "2", ",", "naïve", "_", "x", "日", "本", "語", "!", "ไ", "ท", "ย"]


def test_labelled_bad_documents_are_rejected(spark):
    from tidings.llm.queries import op1_perplexity

    folder = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in op1_perplexity(spark, folder).collect() if r.doc_id in quality]
    bad = [r.kept for r in got if quality[r.doc_id] == 0]
    good = [r.kept for r in got if quality[r.doc_id] == 1]
    assert bad and sum(bad) <= 0.06 * len(bad)
    assert sum(good) >= 0.95 * len(good)
    assert all(r.perplexity <= r.threshold and r.left_out_perplexity >= r.least_perplexity for r in got if r.kept)


def test_limits_are_of_documents_left_out(spark):
    """Texts of words of their own: each is less likely to a model that has not counted it."""
    rnd = random.Random(8)
    rows = [(i, " ".join("".join(rnd.choices("abcdefghijklmnop", k=6)) for _ in range(30)), "xx", 1)
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = kn.classify(docs.drop("quality"), docs.select("doc_id", "quality")).collect()
    assert got[0].threshold > max(r.perplexity for r in got)
    assert kn.SLACK == 1


def test_hashed_words_are_those_of_the_pattern():
    rnd = random.Random(2)
    odd = ["", " ", "Über 42, naïve_x 日本語! ไทย", "é\u0301² ½ a\x00b ٣\u3000x", "ab", "ba", "x" * 3000]
    odd += ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(400))]
    hashes, sizes = wm.hashed_words([*odd, *texts(30, 4), ""])
    found = [wm.words(t) for t in [*odd, *texts(30, 4), ""]]
    assert sizes.tolist() == [len(w) for w in found]
    pairs = set(zip([w for own in found for w in own], hashes.tolist(), strict=True))
    assert len({w for w, _ in pairs}) == len(pairs) == len({h for _, h in pairs})


def test_passes_shards_and_pieces_do_not_change_the_bits(spark, monkeypatch):
    """Every n-gram is looked up, in passes over the shards; a heavy word is dealt over pieces."""
    train = [*texts(60, 6), texts(60, 6)[0], "the", "the the the the"]
    asked = [*train[:30], "", " ", "zebra", "THE OF !!", *texts(20, 9)]
    for name, value in {"SHARD_BYTES": 900, "BATCH_BYTES": 700, "HEAVY_SAMPLE": 1.0}.items():
        monkeypatch.setattr(wm, name, value)
    fold = {r._body: r._key & 1 for r in keyed(spark, {*train, *asked}).collect()}
    key = {r._body: r._key for r in keyed(spark, {*asked}).collect()}
    plain = {f: Plain([t for t in train if fold[t] != f]) for f in (0, 1)}
    docs = keyed(spark, asked).repartition(2)
    model = wm.Model(keyed(spark, train).repartition(3), docs)
    assert model.dealt.shards > wm.PASSES == len(model.passes) and len(model.dealt.words) and model.heavy.count()
    got = {r.key: r.bits for r in model.bits(docs).collect()}
    assert set(got) == {key[t] for t in asked if t}
    for t in asked:
        if t:
            assert got[key[t]] == pytest.approx(plain[fold[t]].bits(t), rel=1e-5)


def test_ngrams_of_a_pass_take_few_bytes(spark):
    """A row of seven numbers for each n-gram, shuffled five times, was forty times the text."""
    rnd = random.Random(4)
    known = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(2000)]
    rows = [" ".join(rnd.choices(known, k=500)) for _ in range(300)]
    dealt = wm._Dealt(10, {})
    sent = [wm._sent(wm._sized(keyed(spark, rows)).coalesce(1), dealt, k, k + 2, False) for k in range(0, 10, 2)]
    sizes = [s.selectExpr("coalesce(sum(octet_length(body)), 0) AS n").first().n for s in sent]
    assert sum(sizes) < 10 * 300 * 500 and max(sizes) < 0.3 * sum(sizes)


def test_trusted_texts_beyond_the_broadcast(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(["a", "b", "c", "dd"], k=20)), "xx", i % 3) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = docs.select("doc_id", F.col("quality").cast("int").alias("quality"))
    want = sorted(kn.classify(docs.drop("quality"), labels).collect())
    monkeypatch.setattr(kn, "BROADCAST_IDS", 3)
    assert sorted(kn.classify(docs.drop("quality"), labels).collect()) == want
