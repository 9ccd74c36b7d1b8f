"""The trie against a brute force over all prefixes."""

import hashlib
import re
import zlib

import pytest

from tidings.llm import prefix_trie
from tidings.llm.queries import registered, rebuilt_trie

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NONE = hashlib.sha256(b"").hexdigest()


def brute(rows):
    """``rows`` of (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(convs.get(base, [])[:h] + turns[h:])
    members, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children, out = {}, []
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in own) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in own)
    for node, who in members.items():
        parent = min(members[node[:-1]]) if node else None
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(who), len(node), parent, len(who), len(children.get(node, [])), leaves[node],
                    saved[node], hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
             "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = brute([tuple(r) for r in given.collect()])
    assert rows_of(registered()["op11_prefix_trie"](spark, FOLDER)) == want
    assert len(want) > 50


def cases():
    deep = [(40, t, "user", f"x {t % 3}") for t in range(25)]
    yield "copies", [(c, t, "user", f"a b {t}") for c in range(60, 80) for t in range(5)]
    yield "deep", deep + [(41, *r[1:]) for r in deep] + [(42, *r[1:]) for r in deep[:22]] + [(42, 99, "u", "end")]
    yield "odd", [
        (None, 0, "user", "lost"), (20, None, None, None), (20, 1, "user", "b"), (20, 1, "assistant", "a"),
        (20, 1, "user", "b"), (21, 0, "user", ""), (21, 1, "", "user"), (33, 0, "user", "only"),
        (-7, 0, "user", "minus"), (-7, 1, "user", "one"), (0, 0, "ab", "c"), (7, 0, "a", "bc"), (1, 5, "a", "bc\n d"),
        *((c, t, "r", f"{c % 2} t") for c in range(100, 130) for t in range(c % 5)),
    ]
    yield "long text", [(5, 0, "user", "w " * 50_000), (25, 0, "user", "w " * 50_000), (25, 1, "user", "w")]


@pytest.mark.parametrize("name, rows", list(cases()))
def test_cases_against_brute_force(spark, monkeypatch, name, rows):
    monkeypatch.setattr(prefix_trie, "STRETCH", 7)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, k1 string")
    assert rows_of(rebuilt_trie(df)) == brute(rows)


def test_small_chunks_of_ids(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(1, 400)]
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 16)
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(rebuilt_trie(df)) == brute(rows)


def test_empty_table_and_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, None, "b"), (2, 0, "user", "a")], SCHEMA)
    assert rebuilt_trie(df.limit(0)).count() == 0
    turns = prefix_trie.ordered_turns(df)
    plain = turns.select("conv_id", turns.pos.alias("depth"), "turn_sha256", "words")
    sizes = plain.groupBy("conv_id").count().withColumnRenamed("count", "len")
    nodes, _ = prefix_trie.trie(plain.join(sizes, "conv_id"))
    found = {(r.depth, r.role, r.text, r.n_convs) for r in prefix_trie.turn_texts(nodes, df).collect()}
    assert found == {(0, None, None, 2), (1, "user", "a", 2), (2, "", "b", 1)}
