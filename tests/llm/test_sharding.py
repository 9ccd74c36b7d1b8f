"""The lookup table and placement."""

import pytest

from tidings.llm import sharding

FOLDER = "/root/testdata/sf0.001"


def brute(shards, size):
    """Turn by turn over written-out preference lists."""
    import xxhash

    lists = {}
    for name in sorted(shards):
        offset = xxhash.xxh64_intdigest(name, 1) % size
        skip = xxhash.xxh64_intdigest(name, 2) % (size - 1) + 1
        lists[name] = [(offset + k * skip) % size for k in range(size)]
    owner = {}
    while len(owner) < size:
        for name, wanted in lists.items():
            free = next((s for s in wanted if s not in owner), None)
            if free is not None:
                owner[free] = name
    return [owner[s] for s in range(size)]


def test_table():
    for shards, size in ((["a"], 7), (["b", "a", "c"], 101), ([f"s{k}" for k in range(20)], 211)):
        table = [shards[k] for k in sharding.lookup_table(shards, size)]
        assert table == brute(shards, size)
        counts = [table.count(s) for s in shards]
        assert max(counts) - min(counts) <= 1
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8), (list("abcdefgh"), 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_few_slots_move_when_a_shard_goes():
    shards = [f"s{k}" for k in range(10)]
    before = [shards[k] for k in sharding.lookup_table(shards, 1009)]
    after = [shards[:-1][k] for k in sharding.lookup_table(shards[:-1], 1009)]
    moved = sum(a != b and b != "s9" for a, b in zip(after, before))
    assert moved < 0.1 * 1009


def test_place(spark, tmp_path):
    rows = [(i % 40 if i else None, "x", i) for i in range(100)] + [(7, "y", 7)] * 30
    df = spark.createDataFrame(rows, "k long, shard string, slot long")
    placed = sharding.place(df, ["k"], ["one", "two", "three"], 101)
    got = placed.collect()
    assert len(got) == len(rows) and placed.columns == ["k", "slot", "shard"]
    assert len({(r.k, r.shard) for r in got}) == len({r[0] for r in rows})
    assert {r.slot for r in got if r.k is None} == {0}
    sharding.write_shards(placed, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(rows)
    assert sharding.place(df.limit(0), ["k"]).count() == 0


def test_query_against_the_plain_table(spark):
    from tidings.llm.queries import op5_sharding

    got = op5_sharding(spark, FOLDER).collect()
    table = sharding.lookup_table(sharding.SHARDS)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    slots = docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {sharding.TABLE_SIZE}) AS s")
    want = {r.doc_id: sharding.SHARDS[table[r.s]] for r in slots.collect()}
    assert {r.doc_id: r.shard for r in got} == want and len(got) == len(want)
