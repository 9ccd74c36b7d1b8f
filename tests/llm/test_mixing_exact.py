"""Mixtures follow the weights as given, not weights rounded to a period."""

from fractions import Fraction

from tidings.llm import mixing


def worst(order, weights):
    """The largest distance, in blocks, of a source from its exact share."""
    total = sum(map(Fraction, weights.values()))
    exact = {s: Fraction(w) / total for s, w in weights.items()}
    seen, far = dict.fromkeys(weights, 0), 0
    for slot, name in enumerate(order):
        seen[name] += 1
        far = max(far, *(abs(seen[s] - (slot + 1) * w) for s, w in exact.items()))
    return far


def test_never_a_block_off_the_unrounded_weights(spark):
    sizes = {f"s{k}": 1200 + 31 * k for k in range(6)} | {"large": 9000}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    got = mixing.mix(df, block_rows=1).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert all(r.release_slot <= r.slot < r.deadline_slot for r in got)
    # Until the first source ends every slot holds a block.
    left, end = dict(sizes), 0
    for end, r in enumerate(got):
        left[r.source] -= 1
        if not left[r.source]:
            break
    assert end > 5_000 and got[end].slot == end
    weights = {s: n**mixing.FLATTEN for s, n in sizes.items()}
    assert worst([r.source for r in got[: end + 1]], weights) < 1


def test_a_small_weight_gets_its_share_only(spark):
    rows = [(i, s) for s, n in {"a": 3000, "b": 3000}.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 0.9999, "b": 0.0001}
    got = mixing.mix(df.where("source = 'a' OR doc_id < 2"), weights, block_rows=1).collect()
    assert sum(r.source == "b" and r.position < 3000 for r in got) <= 1


def test_more_sources_than_the_driver_may_ask_for(spark):
    sizes = {f"host{k}": 1 + k % 3 for k in range(mixing.MAX_SOURCES + 300)}
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "source string, doc_id long")
    got = mixing.mix(df, block_rows=1).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert {(r.source, r.doc_id) for r in got} == set(rows)
    assert mixing.mix(df.limit(0)).columns == [*df.columns, *mixing.MIX_COLUMNS]


def test_shares_are_exact():
    shares = mixing.exact_shares({"a": 0.1, "b": 3, None: 2**0.5})
    total = sum(map(Fraction, (0.1, 3, 2**0.5)))
    assert Fraction(shares["a"], sum(shares.values())) == Fraction(0.1) / total
