"""Cut bytes against a table of all windows, and the parts of the sort on their own."""

import hashlib
import random

import numpy as np
import pytest

from tidings.llm import suffix_dedup

FOLDER = "/root/testdata/sf0.001"


def brute(docs, match=50):
    """``(n_bytes, n_removed, n_spans, kept_sha256)`` by id, by a dictionary of all windows."""
    least, out = {}, []
    ordered = sorted((d for d in docs if d[0] is not None), key=lambda d: d[0])
    for i, text in ordered:
        data = (text or "").encode()
        for s in range(len(data) - match + 1):
            least.setdefault(data[s : s + match], i)
    for i, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - match + 1 if i is not None else 0):
            if least[data[s : s + match]] < i:
                gone[s : s + match] = b"\1" * match
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        left = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str
    )


def texts():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdeé", k=rnd.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choices(words, k=n))

    passage, lead = prose(40), prose(12)
    docs = [prose(rnd.randint(0, 60)) for _ in range(60)]
    docs += [prose(rnd.randint(0, 9)) + passage[rnd.randint(0, 60) :] + prose(9) for _ in range(60)]
    docs += [lead + prose(rnd.randint(1, 30)) for _ in range(40)]
    docs += [docs[3]] * 5 + [None, "", " ", "x" * 49, "x" * 50, "x" * 51, "x" * 500, "ab" * 300, passage]
    docs += [passage * 3, "é" * 25, "\x00" * 120, "\x00" * 60 + "q"]
    rows = [(k, t) for k, t in enumerate(docs)]
    rnd.shuffle(rows)
    return rows + [(3, docs[60]), (3, docs[3]), (None, passage), (None, docs[5])]


@pytest.mark.parametrize("local,hot", [(64, 2048), (2, 3), (1000, 5)])
def test_cut_against_all_windows(spark, local, hot):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows],
                               "doc_id long, text string, spans string, n_bytes double")
    got = suffix_dedup.cut_repeats(df.repartition(3), local=local, hot_docs=hot)
    assert result(got) == brute(rows)
    assert {"spans", "kept"} <= set(got.columns)


def test_rows_of_one_id_keep_their_own_bytes(spark):
    """A second row of an id that repeats nothing loses nothing to the spans of the first."""
    rnd = random.Random(11)
    passage, other = ("".join(rnd.choices("abcdefgh ", k=n)) for n in (140, 419))
    rows = [(1, passage), (2, "head " + passage), (2, other), (3, other[:200]), (3, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(suffix_dedup.cut_repeats(df))
    assert got == brute(rows)
    assert (2, 419, 0, 0) in {r[:4] for r in got}


@pytest.mark.parametrize("place, together", [(1, 1), (7, 30)])
def test_span_rows_do_not_follow_the_partitions(spark, monkeypatch, place, together):
    """Split sources change no result; a text has a row for each source it repeats from."""
    rows = [r for r in texts() if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    few = suffix_dedup.repeated_spans(df).count()
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 600)
    assert suffix_dedup.repeated_spans(df).count() <= 1.05 * few + 5
    monkeypatch.setattr(suffix_dedup, "PLACE_ROWS", place)
    monkeypatch.setattr(suffix_dedup, "_TOGETHER", together)
    assert result(suffix_dedup.cut_repeats(df)) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.cut_repeats(df).count() == 0


def test_long_texts_in_pieces():
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 105, 300_000).astype(np.uint8).tobytes()
    old, suffix_dedup._PIECE = suffix_dedup._PIECE, 10_000
    try:
        count = 0
        for part, ends, places in suffix_dedup._text_groups([data, b"x" * 60], 50):
            first, last, _ = suffix_dedup.units(part, ends, 50)
            count += int((last - first + 1).sum())
    finally:
        suffix_dedup._PIECE = old
    assert count == len(data) - 49 + 11


def test_deep_shallow_sort_finds_equal_suffixes_in_order():
    rnd = random.Random(4)
    core = bytes(rnd.choices(b"ab", k=40))
    data = b"".join(core + bytes(rnd.choices(b"ab", k=rnd.randint(1, 14))) for _ in range(200))
    places = np.arange(len(data) - 49)
    owners = np.arange(len(places))
    found = list(suffix_dedup.equal_suffixes(data, places, owners, 50))
    want = {}
    for p in places.tolist():
        want.setdefault(data[p : p + 50], []).append(p)
    want = {k: v for k, v in want.items() if len(v) > 1}
    assert sorted(sorted(x) for x in found) == sorted(want.values())
    keys = [data[x[0] : x[0] + 50] for x in found]
    assert keys == sorted(keys)


def test_query_against_all_windows(spark):
    from tidings.llm.queries import op10_suffix_dedup

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert result(op10_suffix_dedup(spark, FOLDER)) == brute(docs)


def test_a_task_holds_one_bucket_at_a_time():
    """What two documents share in a bucket is sent on before the next bucket is read."""
    import numpy as np
    import pyarrow as pa

    from tidings.llm import suffix_dedup as dedup

    def bucket(b):
        known = np.repeat(np.arange(5, dtype=np.uint64) + np.uint64(100 * b), 2)
        docs = np.tile(np.array([1, 2]), 5)
        row = [[b], [None], [dedup._planes(known)], [dedup._planes(docs)], [b""]]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = [pa.array(x, kind) for x, kind in zip(row, kinds)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "doc", "hashes", "docs", "heavy"])

    read = []

    def batches():
        for b in range(4):
            read.append(b)
            yield bucket(b)

    out, seen = dedup._meet(100)(batches()), []
    for found in out:
        if found.num_rows:
            seen.append((len(read), sorted(set(a // 100 for a in found.column(1).to_pylist()))))
    assert [b for _, b in seen] == [[0], [1], [2], [3]]
    assert [n for n, _ in seen] == [2, 3, 4, 4]
