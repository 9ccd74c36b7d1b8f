"""Fingerprints against a plain form, trees and links against all pairs."""

import random

import xxhash

from tidings.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs):
    """Smallest id by fingerprint class, comparing all fingerprints."""
    values = sorted({v for _, v in pairs})
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2 and label[b] > label[a]:
                    label[b], changed = label[a], True
    first = {}
    for i, v in pairs:
        if i is not None:
            first[label[v]] = min(i, first.get(label[v], i))
    return {v: first.get(label[v]) for v in values}


def test_fingerprints():
    texts = ["", None, " \t\n", "one", "one Two", "one two three", "É a b a b a b", "x " * 70_000,
             "a\x1cb c d", "a b c  e"]
    rnd = random.Random(3)
    texts += [" ".join(rnd.choices("abcdef", k=rnd.randint(1, 30))) for _ in range(200)]
    for text in texts:
        assert simhash.fingerprint(text) == plain(text), (text or "")[:50]


def test_tree_finds_all_within_the_radius():
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    values = {c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for c in centres * 20}
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in list(values)[:100]:
        assert sorted(tree.within(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def test_links_join_what_all_pairs_join(spark):
    rnd = random.Random(8)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    values = sorted({c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for c in centres * 30})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    for shard_rows in (simhash.SHARD_ROWS, 5):
        parent = {v: v for v in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in simhash.links(df, 2, shard_rows).collect():
            parent[max(root(r.a), root(r.b))] = min(root(r.a), root(r.b))
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2:
                    sa, sb = (x - (1 << 64) if x >> 63 else x for x in (a, b))
                    assert root(sa) == root(sb)


def test_components_of_odd_rows(spark):
    texts = [None, "", " ", "a b c d", "A  b\nc d", "a b c d", "z y x", "one", "one", "two words"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "a b c d", "x"), (None, "one", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.simhash_components(df)
    expected = classes([(i, plain(t)) for i, t, _ in rows])
    want = sorted(((i, expected[plain(t)]) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == want
    left = simhash.first_of_each(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [0, 3, 6, 7, 9]
    assert simhash.simhash_components(df.limit(0)).count() == 0
    assert simhash.first_of_each(df.limit(0)).count() == 0


def test_every_text_of_a_repeated_id_counts(spark):
    """Groups are of texts: three different texts leave three rows, whatever ids they share."""
    a, b, c = ("alpha beta gamma delta", "one two three four five", "red green blue white black")
    rows = [(1, a), (2, a), (2, b), (3, b), (3, c), (3, c), (None, a), (None, "lone words here"),
            (None, "lone words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(((r.doc_id, r.text) for r in simhash.first_of_each(df).collect()), key=str)
    assert left == sorted([(1, a), (2, b), (3, c), (None, "lone words here")], key=str)


def test_query_against_all_pairs(spark):
    from tidings.llm.queries import op3_simhash

    docs = [(r.doc_id, plain(r.text)) for r in
            spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected = classes(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(spark, FOLDER).collect()}
    assert got == {i: (f"{v:016x}", expected[v]) for i, v in docs}
