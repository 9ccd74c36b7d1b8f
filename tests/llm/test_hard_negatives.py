"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest

from tidings.llm import hard_negatives
from tidings.llm.queries import ORACLE, registered

FOLDER = "/root/testdata/sf0.001"
FIELDS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(vectors, anchors, k=5):
    """``vectors`` maps an id to its label and whole numbers."""
    out = []
    for a in anchors:
        label, v = vectors[a]
        scores = {}
        for i, (other, w) in vectors.items():
            exact = sum(x * y for x, y in zip(v, w))
            scores[i] = (-min(max(exact, -(2**63)), 2**63 - 1), i, other == label)
        ranked = sorted(scores[i] for i in vectors if i != a)
        for p, i, _ in [x for x in ranked if x[2]][:k]:
            fit = [x for x in ranked if not x[2] and 80 * -p <= 100 * -x[0] <= 100 * -p]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(fit[:k])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[f] for f in FIELDS) for r in df.collect())


def given(df, scale=256):
    out = {}
    for r in df.collect():
        out[r.vec_id] = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label,
                         [math.floor(scale * x) for x in r.embedding])
    return out


def test_query_against_all_pairs_and_sql(spark):
    whole = given(spark.read.parquet(f"{FOLDER}/embeddings.parquet"))
    got = rows_of(registered()["op12_hard_negatives"](spark, FOLDER))
    assert got == brute(whole, [i for i in whole if i % 100 == 0]) and got
    duckdb = pytest.importorskip("duckdb")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    found = database.execute(f"SELECT {', '.join(FIELDS)} FROM ({ORACLE['op12_hard_negatives']})").fetchall()
    assert sorted(found) == got


def test_waves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7)
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vectors = hard_negatives.prepared(df)
    got = hard_negatives.mine(vectors, vectors.where("vec_id % 10 = 0"), first=2)
    whole = {r.vec_id: (r.label, [math.floor(256 * x) for x in r.embedding]) for r in df.collect()}
    assert rows_of(got) == brute(whole, [i for i in whole if i % 10 == 0])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 1),
            (5, [], 1), (6, [0.5, -0.25], 1), (7, [1.0], 2), (8, [0.1, 0.2, 0.3], 2), (None, [9.0, 9.0], 1),
            (9, [0.4, -0.2], None), (10, [0.5, -0.25], 2), (11, [0.45, -0.2], 2), (100, [0.0, 0.0], 2),
            (200, [2.0, 1.0], 1), (200, [3.0, 1.0], 1), (300, [-1.0, 1.0], 1),
            (400, [1e12, 3e30], 1), (401, [1e12, 2.9e30], 1), (402, [3.0, 2.5e30], 2), (403, [1e12, 1.0], 2)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, shard int")
    vectors = hard_negatives.prepared(df)
    got = rows_of(hard_negatives.mine(vectors, vectors.where("vec_id % 100 = 0")))
    dropped = {1, 2, 3, 4, 9, None}
    whole = {}
    for i, v, label in rows:
        if i not in dropped and i not in whole:
            v = [*v, 0.0, 0.0, 0.0][:3]
            whole[i] = (label, [math.floor(256 * x) for x in v])
    assert got == brute(whole, [0, 100, 200, 300, 400])
    empty = vectors.limit(0)
    assert hard_negatives.mine(empty, empty).count() == 0


@pytest.mark.parametrize("kind", ["clusters", "even", "same", "lengths", "ties"])
def test_bounds_hold_and_thin_out(kind):
    """Every vector with a score in the window is among the possible ones."""
    rnd = np.random.default_rng(4)
    n, d = 1500, 24
    centres = rnd.normal(0, 1, (12, d))
    values = {
        "clusters": centres[rnd.integers(0, 12, n)] * 300 + rnd.normal(0, 12, (n, d)),
        "even": rnd.normal(0, 60, (n, d)), "same": np.full((n, d), 7.0),
        "lengths": rnd.normal(0, 1, (n, d)) * 10.0 ** rnd.integers(0, 7, (n, 1)),
        "ties": rnd.integers(-1, 2, (n, d)) * 1.0,
    }[kind]
    vectors = np.floor(values)
    lengths = hard_negatives.lengths_of(vectors)
    directions = hard_negatives.farthest_first(vectors[:400], 12)
    angles = hard_negatives.angles_to(vectors, lengths, directions).astype(np.float32).astype(np.float64)
    shard = hard_negatives.Shard(np.arange(n), np.arange(n) % 3, vectors, lengths, angles)
    kept = 0
    for a in range(0, n, 50):
        exact = vectors[shard.ids] @ vectors[a]
        for share in (1.0, 0.9, 0.5):
            high = share * np.sort(exact)[-5]
            low = 0.8 * high if high > 0 else high
            found = shard.possible(angles[a], lengths[a], low, high)
            inside = np.flatnonzero((exact >= low) & (exact <= high))
            assert set(inside.tolist()) <= set(found.tolist())
            kept += len(found)
    if kind == "clusters":
        assert kept < 0.25 * 90 * n
