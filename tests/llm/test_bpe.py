"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import struct
import unicodedata

import pytest

from tidings.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"
ODD = [
    "", " ", "\n\t ", "Hello, WORLD's end they'll we've I'm 'd", "naïve café Ÿ İstanbul ΣΑΣ σας ß",
    "a<|endoftext|>b <|startoftext|> <|startoftext|>x<|endoftext|", "日本語テキスト 한국어 ไทย",
    "é é<|endoftext|>́", "x\x1c\x1d\x1e\x1f\x85\xa0 　y", "a‍b­c",
    "1234567890 ½ ² Ⅷ", "!!!???...###%%%", "👍🏽👨‍👩‍👧 ok", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "\x00\x01", "ǅ ŉ ﬁ", "''s''t", "don't DON'T", "﻿bom", "ab" * 5000,
]


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(PATH)


def same(theirs, texts):
    own = bpe.codec(PATH)
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text[:80])
        assert own.decode(ids) == theirs.decode(ids, skip_special_tokens=False), repr(text[:80])


def test_odd_texts(theirs):
    same(theirs, ODD)


def test_random_texts(theirs):
    rnd = random.Random(7)
    assigned = [c for c in map(chr, range(1, 0x3000)) if unicodedata.category(c)[0] not in "CM"]
    letters = "abcdeinorst'  \n.,é日Σ1"
    same(theirs, ["".join(rnd.choices(letters, k=rnd.randint(1, 60))) for _ in range(3000)])
    same(theirs, ["".join(rnd.choices(assigned, k=40)) for _ in range(500)])


def test_each_word_ends_in_one_token_only(theirs):
    """Every prefix has a last token, and it is that of the prefix's own encoding."""
    own = bpe.codec(PATH)
    word = "internationalization"
    tokens, sizes = own.last_tokens(word)
    assert all(t >= 0 for t in tokens[1:]) and all(sizes[1:])


def test_rows(spark, theirs):
    texts = [*ODD, None, "again", "again"]
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = bpe.encode(df, PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _, _ in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        assert by[i].ids == ids and by[i].n_tokens == len(ids)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert by[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        text = theirs.decode(ids, skip_special_tokens=False)
        assert by[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query_on_all_documents(spark, theirs):
    from tidings.llm.queries import op6_bpe

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = op6_bpe(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        ids = theirs.encode(docs[r.doc_id], add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
