"""Top-k search against the scores of all pairs."""

import math

import numpy as np
import pytest

from tidings.llm import topk

FOLDER = "/root/testdata/sf0.001"


def brute(vectors, queries, k):
    """``vectors`` maps an id to whole numbers."""
    out = []
    for q in queries:
        scores = []
        for i, v in vectors.items():
            if i != q:
                scores.append((-sum(a * b for a, b in zip(vectors[q], v)), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("kind", ["even", "skewed", "ties", "same"])
def test_shard_against_all_pairs(kind):
    rnd = np.random.default_rng(3)
    n, d, k = 900, 16, 5
    values = {
        "even": rnd.normal(0, 9, (n, d)), "skewed": rnd.normal(0, 1, (n, d)) ** 5,
        "ties": rnd.integers(-1, 2, (n, d)), "same": np.ones((n, d)),
    }[kind]
    vectors = np.floor(values).astype(np.float32)
    ids = rnd.permutation(n) * 3
    shard = topk.Shard(ids, vectors)
    found = {int(q): list(zip(i.tolist(), s.astype(int).tolist()))
             for q, i, s in shard.search(ids[:60], vectors[:60], k)}
    whole = {int(i): v.astype(int).tolist() for i, v in zip(ids, vectors)}
    for q, _, i, s in brute(whole, ids[:60].tolist(), k):
        assert (i, s) in found[q]
    assert all(len(x) == k for x in found.values()) and len(found) == 60


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []),
            (6, [0.5, -0.25]), (7, [1.0]), (8, [0.1, 0.2, 0.3]), (None, [9.0, 9.0]), (20, [0.0, 0.0]),
            (20, [5.0, 0.0]), (40, [-1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    vectors = topk.quantised(df)
    got = rows_of(topk.search(vectors, vectors.where("vec_id % 20 = 0"), 3))
    usable = {0: [0.5, -0.25], 6: [0.5, -0.25], 7: [1.0], 8: [0.1, 0.2, 0.3], 20: [0.0, 0.0],
              40: [-1.0, 1.0]}
    whole = {i: [math.floor(64 * float(np.float32(x))) for x in v] + [0] * (3 - len(v))
             for i, v in usable.items()}
    assert got == brute(whole, [0, 20, 40], 3)
    assert topk.search(vectors.limit(0), vectors.limit(0), 3).count() == 0


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vectors = topk.quantised(df)
    got = rows_of(topk.search(vectors, vectors.where("vec_id % 20 = 0"), 20))
    whole = {r.vec_id: [math.floor(64 * x) for x in r.embedding] for r in df.collect()}
    assert got == brute(whole, [i for i in whole if i % 20 == 0], 20)


@pytest.mark.parametrize("large", [2.0**30, 2.0**41, 1e30])
def test_large_components_take_part(spark, large):
    rows = [(0, [large, 1.0]), (20, [large, 0.5]), (21, [-large, 3.0]), (22, [large + 2.0**12, 2.0]), (23, [0.25, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.quantised(df)
    assert vectors.count() == 5
    got = rows_of(topk.search(vectors, vectors.where("vec_id % 20 = 0"), 3))
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    ends = [(q, r, i, min(max(s, -(2**63)), 2**63 - 1)) for q, r, i, s in brute(whole, [0, 20], 5)]
    want = []
    for q in (0, 20):
        ranked = sorted(((-s, i) for a, _, i, s in ends if a == q))[:3]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(ranked)]
    assert got == want
