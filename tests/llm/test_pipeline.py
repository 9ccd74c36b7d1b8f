"""The stages one after another against plain versions of the operators."""

import hashlib
import struct

import pytest

import corpus_pipeline
from tests.llm import test_mixing, test_quality_rules, test_simhash, test_suffix_dedup
from tidings.llm import bpe, mixing

tokenizers = pytest.importorskip("tokenizers")
FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def cut(docs):
    """Texts without repeats by id, by a dictionary of all windows."""
    least, out = {}, {}
    for i, text in sorted(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 49):
            if least.setdefault(data[s : s + 50], i) < i:
                gone[s : s + 50] = b"\1" * 50
        out[i] = bytes(c for c, g in zip(data, gone) if not g).decode(errors="ignore")
    return out


def test_stages_in_their_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "rules", "near_copies", "repeats", "mixture", "tokens"]


def test_run_against_plain_operators(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    texts, source = {r.doc_id: r.text for r in rows}, {r.doc_id: r.source for r in rows}
    judged = test_quality_rules.plain(list(texts.items()), {r.doc_id for r in labels if r.quality == 1})
    kept = [(i, texts[i]) for i in texts if judged[i][-1]]
    prints = [(i, test_simhash.plain(t)) for i, t in kept]
    first = test_simhash.classes(prints)
    alone = [(i, texts[i]) for i, v in prints if first[v] == i]
    left = cut(alone)
    theirs = tokenizers.Tokenizer.from_file(bpe.vocabulary())
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(left)
    for r in got:
        ids = theirs.encode(left[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    sizes = {}
    for i in left:
        sizes[source[i]] = sizes.get(source[i], 0) + 1
    shares = mixing.whole_shares({s: n**mixing.FLATTEN for s, n in sizes.items()}, mixing.PERIOD)
    order = test_mixing.brute(sizes, shares, mixing.BLOCK_ROWS)
    assert sorted(order) == sorted(source[r.doc_id] for r in got)
    assert test_suffix_dedup.brute(alone)


def test_stages_keep_the_columns_and_stand_odd_rows(spark):
    long = " ".join(f"word{k}" for k in range(80))
    rows = [(1, long, "en", "a", 5), (2, long, "en", "a", 5), (2, long, "en", "a", 5), (None, long, None, None, None),
            (3, None, "en", "b", 0), (4, "", None, "b", 0), (5, long[::-1], "de", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, FOLDER)
            assert frame.columns == COLUMNS
        assert frame.count() >= 0
    whole = corpus_pipeline.near_copies(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in whole.collect() if r.doc_id is not None) == [1, 3, 5]
