"""Mixtures: every row once, and never a block away from the target."""

import random

import pytest

from tidings.llm import mixing

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 3, "b": 3}, {"a": 7, "b": 2, None: 1},
                                    {k: k + 1 for k in range(20)}, {"x": 997, "y": 1, "z": 2}])
def test_schedule_is_never_a_block_off(shares):
    plan = mixing.schedule(shares)
    period = sum(shares.values())
    seen = dict.fromkeys(shares, 0)
    for slot, (name, block, release, deadline) in enumerate(plan):
        assert block == seen[name] and release <= slot < deadline
        seen[name] += 1
        for s, n in shares.items():
            assert abs(seen[s] - (slot + 1) * n / period) < 1
    assert seen == shares


def test_whole_shares():
    rnd = random.Random(1)
    for _ in range(50):
        weights = {k: rnd.random() ** 3 + 1e-6 for k in range(rnd.randint(1, 40))}
        shares = mixing.whole_shares(weights, 1000)
        assert sum(shares.values()) == 1000 and min(shares.values()) >= 1
    assert mixing.whole_shares({"a": 1, "b": 3}, 8) == {"a": 2, "b": 6}
    with pytest.raises(ValueError):
        mixing.whole_shares({"a": 1, "b": 0}, 8)


def brute(sizes, shares, block_rows):
    """Sources in the order in which the schedule takes rows, one after another."""
    left, order, plan = dict(sizes), [], mixing.schedule(shares)
    while any(left.values()):
        for name, *_ in plan:
            take = min(block_rows, left[name])
            order += [name] * take
            left[name] -= take
    return order


def test_order_against_one_by_one(spark):
    sizes = {"a": 57, "b": 9, "c": 1, None: 20}
    rows = [(i, s, "t", 5) for s, n in sizes.items() for i in range(n)] + [(None, "a", None, 5)] * 2
    sizes["a"] += 2
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    weights = {"a": 4, "b": 2, "c": 1, None: 1}
    for block_rows in (1, 4):
        got = mixing.mix(df, weights, period=16, block_rows=block_rows).orderBy("position").collect()
        assert [r.position for r in got] == list(range(len(rows)))
        shares = mixing.whole_shares(weights, 16)
        assert [r.source for r in got] == brute(sizes, shares, block_rows)
        assert all(r.release_slot <= r.slot < r.deadline_slot for r in got)
    plain = df.drop("slot")
    left = mixing.in_order(plain, mixing.mix(plain, weights)).collect()
    assert sorted(map(str, left)) == sorted(str(r) for r in plain.collect())
    assert mixing.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.source_sizes(df, max_sources=3)


def test_query_against_one_by_one(spark):
    from tidings.llm.queries import op4_mixing

    got = op4_mixing(spark, FOLDER).orderBy("position").collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    weights = {s: n**mixing.FLATTEN for s, n in sizes.items()}
    assert [r.position for r in got] == list(range(docs.count()))
    assert len({r.doc_id for r in got}) == len(got)
    shares = mixing.whole_shares(weights, mixing.PERIOD)
    assert [r.source for r in got] == brute(sizes, shares, mixing.BLOCK_ROWS)
