"""Packing against the tokenizers library, piece by piece, and against lower bounds."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidings.llm import packing
from tidings.llm.queries import registered

FOLDER = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    own = tokenizers.Tokenizer.from_file(packing.vocabulary())
    own.no_truncation()
    own.no_padding()
    return own


def expected_pieces(library, docs, capacity):
    out = []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % capacity or capacity
        marks = [0, *range(head, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(marks, marks[1:])):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check_sequences(rows, capacity):
    """Gapless sequences of at most ``capacity``; gives their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def got_pieces(rows):
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)


def test_query_against_library(spark, library):
    rows = registered()["op13_packing"](spark, FOLDER).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got_pieces(rows) == expected_pieces(library, docs, 1024)
    used = check_sequences(rows, 1024)
    least = math.ceil(sum(r.length for r in rows) / 1024)
    assert used <= 1.01 * least + 1


def test_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "_LONG_WHITE", packing.re.compile(r"\s{20}"))
    texts = ["", None, "a", "x <|endoftext|> y", " " * 40 + "b", "İ́ 한글 \U0001f600" * 30, "word " * 900, "same", "same"]
    docs = [(k if k != 2 else None, t) for k, t in enumerate(texts)] + [(7, "other"), (7, "other")]
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, row long, bin string")
    rows = packing.pack(packing.pieces(df, packing.vocabulary(), 16), 16).collect()
    assert got_pieces(rows) == expected_pieces(library, docs, 16)
    check_sequences(rows, 16)
    empty = packing.pack(packing.pieces(df.limit(0), packing.vocabulary(), 16), 16)
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_ids_travel_along(spark, library):
    df = spark.createDataFrame([(1, "one two three " * 9), (2, "four")], "doc_id long, text string")
    rows = packing.pack(packing.pieces(df, packing.vocabulary(), 8, with_ids=True), 8).collect()
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


@pytest.mark.parametrize("kind", ["even", "large", "small", "half", "equal"])
@pytest.mark.parametrize("part", [10_000, 25])
def test_tree_of_partitions(spark, kind, part):
    """Many small partitions lose little against one; whatever goes up, every piece stays."""
    rnd = np.random.default_rng(5)
    n, capacity = 1500, 64
    lengths = {
        "even": rnd.integers(1, 64, n), "large": rnd.integers(33, 64, n), "small": rnd.integers(1, 9, n),
        "half": np.full(n, 32), "equal": np.full(n, 40),
    }[kind].astype(np.int64)
    rows = [(k, 0, 0, int(x), 0) for k, x in enumerate(lengths)]
    found = spark.createDataFrame(rows, packing._PIECE)
    got = packing.pack(found, capacity, part_pieces=part).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(k, int(x)) for k, x in enumerate(lengths)]
    used = check_sequences(got, capacity)
    whole = len(set(packing.best_fit(lengths, capacity)[0].tolist()))
    if part > n:
        assert used == whole
    assert used <= 1.06 * whole + 1
    if kind in ("half", "equal"):
        assert used == whole


def brute_best_fit(lengths, capacity):
    room, out = [], [None] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        able = [(r, b) for b, r in enumerate(room) if r >= lengths[item]]
        if able:
            least = min(r for r, _ in able)
            out[item] = least
            room[next(b for r, b in able if r == least)] -= lengths[item]
        else:
            out[item] = capacity
            room.append(capacity - lengths[item])
    return out


def test_best_fit_takes_the_least_room():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        lengths = rnd.integers(1, 33, 60)
        bins, offsets = packing.best_fit(lengths, 32)
        assert [32 - int(o) for o in offsets] == brute_best_fit(lengths.tolist(), 32)
        assert np.bincount(bins, lengths).max() <= 32
    assert len(packing.best_fit(np.zeros(0, np.int64), 32)[0]) == 0


def test_node_sends_no_more_than_a_bound():
    """One bin at most is half full or less, so a node of eight children moves eight at most."""
    rnd = np.random.default_rng(8)
    bins, _ = packing.best_fit(rnd.integers(1, 65, 999), 64)
    rows = []
    for node in range(8):
        lengths = rnd.integers(1, 65, 99)
        bins, _ = packing.best_fit(lengths, 64)
        fill = np.bincount(bins, lengths).astype(np.int64)
        assert (fill <= 32).sum() <= 1
        rows += [(0, node << 33 | k, int(u)) for k, u in enumerate(fill)]
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
    batch = pa.RecordBatch.from_arrays(columns, ["node", "bin", "used"])
    out = pa.Table.from_batches(list(packing._pack_bins(64)([batch]))).to_pylist()
    assert len(out) == len(rows) and sum(r["bin"] != r["into"] for r in out) <= 8
