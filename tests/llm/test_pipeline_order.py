"""The order of the mixture reaches the result of the last stage."""

import random

import corpus_pipeline
from tests.llm import test_mixing
from tidings.llm import mixing
from tidings.session import materialize


def test_tokens_carry_the_mixture(spark):
    sizes = {"a": 900, "b": 250, "c": 60, None: 10}
    rnd = random.Random(2)
    # Long rows of one source make files of unlike sizes, which readers pack out of order.
    rows = [(i, "".join(rnd.choices("abcdefgh ", k=2000 if s == "b" else 20)), "en", s, 20)
            for s, n in sizes.items() for i in range(n)]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "130")
    try:
        written = materialize(corpus_pipeline.mixture(spark, docs, ""), "mixed")
        got = materialize(corpus_pipeline.tokens(spark, written, ""), "tokens", keep=True)
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(written.inputFiles()) > 4
    got = got.orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    shares = mixing.exact_shares({s: n**mixing.FLATTEN for s, n in sizes.items()})
    weights = mixing.slots(shares)
    left, want = dict(sizes), []
    while any(left.values()):
        name = next(weights)[0]
        taken = min(mixing.BLOCK_ROWS, left[name])
        want += [name] * taken
        left[name] -= taken
    assert [rows[r.doc_id][3] for r in got] == want
    assert sorted(map(str, want)) == sorted(map(str, test_mixing.brute(sizes, dict.fromkeys(sizes, 1), 8)))
    order = [r.position for r in mixing.mix(docs).select("position", "doc_id").orderBy("doc_id").collect()]
    assert all(order[r.doc_id] == r.position for r in got)
