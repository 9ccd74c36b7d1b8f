"""Keyed state, numbering, components, spread joins, quality."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidings.operators import components, keyed, quality, skew
from tidings.operators.components import connected_components
from tidings.operators.numbering import number_within
from tidings.operators.skew import join_spread

T0 = datetime(2024, 1, 1)


def minute(n):
    return T0 + timedelta(minutes=n)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_latest_and_earliest_settle_ties_by_sequence(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0, "old"), ("a", 2, 0, "tie"), ("a", 2, 1, "new"), ("b", 1, 0, None)],
        "k string, ver int, seq int, text string",
    )
    got = keyed.latest(rows, ["k"], ["ver", "seq"])
    assert {(r.k, r.text) for r in got.collect()} == {("a", "new"), ("b", None)}
    got = keyed.earliest(rows, ["k"], ["ver", "seq"])
    assert {(r.k, r.text) for r in got.collect()} == {("a", "old"), ("b", None)}


def test_latest_is_limited_before_the_shuffle_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("ver"), F.lit("x").alias("wide")
    ).write.parquet(path)
    text = plan(keyed.latest(spark.read.parquet(path), ["k"], ["ver"]).select("k", "ver"))
    physical = text[text.index("== Physical Plan"):]
    assert physical.count("WindowGroupLimit") >= 2
    assert "wide" not in physical


def test_first_seen_keeps_known_rows_and_is_idempotent(spark):
    schema = "url_hash string, ordinal int, run string"
    batch = spark.createDataFrame([("a", 1, "r1"), ("a", 0, "r1"), ("b", 2, "r1")], schema)
    first = keyed.first_seen(batch, None, "url_hash", ["ordinal"])
    assert {(r.url_hash, r.ordinal) for r in first.collect()} == {("a", 0), ("b", 2)}
    assert keyed.first_seen(batch, first, "url_hash", ["ordinal"]).isEmpty()
    more = batch.unionByName(spark.createDataFrame([("c", 9, "r2")], schema))
    assert [r.url_hash for r in keyed.first_seen(more, first, "url_hash", ["ordinal"]).collect()
            ] == ["c"]


def test_delete_insert_and_watermark(spark):
    schema = "k string, at int, v string"
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "x")], schema)
    new = spark.createDataFrame([("a", 6, "y"), ("b", 5, "y"), ("c", 7, "y")], schema)
    fresh = keyed.above_watermark(new, old, "at")
    got = {tuple(r) for r in keyed.delete_insert(old, fresh, "k").collect()}
    assert got == {("a", 6, "y"), ("b", 5, "x"), ("c", 7, "y")}
    assert keyed.above_watermark(new, old.limit(0), "at").count() == 3


def test_votes_fold(spark):
    schema = "user_id long, cluster_id string, vote short, created_at timestamp, event_id long"
    events = spark.createDataFrame(
        [(1, "a", 1, minute(0), 0), (1, "a", -1, minute(1), 1),
         (1, "b", 1, minute(0), 2), (1, "b", None, minute(3), 3),
         (2, "a", 1, minute(0), 4), (2, "a", 1, minute(9), 5),
         (3, "a", None, minute(0), 6), (3, "a", 1, minute(0), 7)],
        schema,
    )
    got = {tuple(r) for r in keyed.fold_votes(events).collect()}
    assert got == {(1, "a", -1, minute(1)), (2, "a", 1, minute(9)), (3, "a", 1, minute(0))}
    bad = events.withColumn("vote", F.lit(0).cast("short"))
    allowed, refused = keyed.split_votes(bad)
    assert allowed.isEmpty() and refused.count() == 8


def test_toggled_votes_equal_pressing_one_by_one(spark):
    rng = random.Random(7)
    clicks, state = [], {}
    for n in range(400):
        key, vote = (rng.randint(1, 3), rng.choice("abcd")), rng.choice([1, 1, -1])
        clicks.append((*key, vote, minute(n // 2), n))
        state[key] = (None, None) if state.get(key, (None,))[0] == vote else (vote, minute(n // 2))
    df = spark.createDataFrame(
        clicks, "user_id long, cluster_id string, vote int, created_at timestamp, event_id long"
    )
    got = {(r.user_id, r.cluster_id): (r.vote, r.created_at)
           for r in keyed.toggle_votes(df).collect()}
    assert got == {key: value for key, value in state.items() if value[0]}


def test_run_log(spark):
    schema = ("run_id string, task_id string, try_number int, kind string, dag_id string, "
              "execution_date timestamp, at timestamp, event_id long, status string, "
              "rows_fetched int, rows_new int, rows_duplicate int, rows_failed int, "
              "error_message string, extra_metadata string")
    events = [
        ("r", "t", 1, "open", "d", T0, minute(0), 0) + (None,) * 7,
        ("r", "t", 1, "open", "other", T0, minute(1), 1) + (None,) * 7,
        ("r", "t", 1, "close", None, None, minute(2), 2, "failed", 5, 3, 2, 1, "e" * 5000, "{}"),
        ("r", "u", 1, "open", "d", T0, minute(0), 3) + (None,) * 7,
        ("r", "v", 1, "close", None, None, minute(0), 4, "success", 1, 1, 0, 0, None, "{}"),
    ]
    rows = {r.task_id: r for r in keyed.fold_runs(spark.createDataFrame(events, schema)).collect()}
    assert set(rows) == {"t", "u"}
    assert rows["t"].dag_id == "d" and rows["t"].status == "failed"
    assert rows["t"].started_at == minute(0) and rows["t"].finished_at == minute(2)
    assert len(rows["t"].error_message) == 4000 and rows["t"].rows_duplicate == 2
    assert rows["u"].status == "running" and rows["u"].finished_at is None
    assert rows["u"].rows_new == 0


def test_numbers_follow_the_key_in_groups_of_any_size(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "big").otherwise(F.col("id").cast("string")).alias("g"),
        F.sha2(F.col("id").cast("string"), 256).alias("k"),
    )
    rows = number_within(df, "g", "k", "n").collect()
    assert len(rows) == 3000
    big = sorted((r.k, r.n) for r in rows if r.g == "big")
    assert [n for _, n in big] == list(range(1, 2501))
    assert {r.n for r in rows if r.g != "big"} == {1}


def find_labels(edges):
    label = {x: x for edge in edges for x in edge}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, 500 + i) for i in range(1, 300)]
    loose = [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(120)]
    edges = path + hub + [(a, b) for a, b in loose if a != b]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges + [(7, 7)], "id long, other long")
    got = connected_components(df).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.label for r in got} == find_labels(edges)


def test_hubs_are_cut_and_change_nothing(spark, monkeypatch):
    hub = [(5000, i) for i in range(400)] + [(i, 9000 + i % 7) for i in range(300, 350)]
    chain = [(6000 + i, 6001 + i) for i in range(30)]
    monkeypatch.setattr(skew, "SPLIT_ROWS", 20)
    cuts = []
    taken = skew.join_spread
    monkeypatch.setattr(
        components, "join_spread", lambda *a, **k: cuts.append(k["heavy"]) or taken(*a, **k)
    )
    got = connected_components(spark.createDataFrame(hub + chain, "a long, b long")).collect()
    assert {r.id: r.label for r in got} == find_labels(hub + chain)
    assert cuts[0][5000] == 20 and len(cuts[0]) < 20


def test_an_even_graph_is_joined_as_it_is(spark):
    """No copies of the unique side where no key is heavy, and a heavy key is spread."""
    edges = spark.range(3000).select(F.col("id").alias("u"), (F.col("id") % 50).alias("v"))
    stored, counts = skew.materialize_sketched(edges, "even", ["u", "v"])
    assert stored.count() == 3000 and skew.heavy_pieces(counts["u"]) == {}
    assert set(counts["v"].values()) == {60}
    smallest = stored.groupBy("v").agg(F.min("u").alias("m"))
    assert "Generate" not in plan(join_spread(stored, smallest, ["v"], "u", heavy={}))
    spread = join_spread(stored, smallest, ["v"], "u", heavy={7: 4, 8: 2})
    assert sorted(map(tuple, spread.select("u", "v", "m").collect())) == sorted(
        map(tuple, stored.join(smallest, "v").select("u", "v", "m").collect()))
    empty, none = skew.materialize_sketched(edges.limit(0), "none", ["u"])
    assert empty.isEmpty() and none == {"u": {}}


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_spread_join_equals_plain_join(spark):
    big = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("x"))
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"))
    for how in ("inner", "left", "left_anti", "left_semi"):
        plain = sorted(map(tuple, big.join(small, "k", how).collect()), key=str)
        spread = sorted(map(tuple, join_spread(big, small, ["k"], "x", how).collect()), key=str)
        assert plain == spread


def test_quality_report_and_audit(spark):
    rows = spark.createDataFrame([("a", None), ("a", 1), (None, 2), (None, 3)], "k string, v int")
    got = {tuple(r) for r in quality.quality_report({"t": (rows, ["k", "v"], ["k", "v"])}).collect()}
    assert got == {("t", "k", "not_null", 2), ("t", "v", "not_null", 1), ("t", "k", "unique", 1),
                   ("t", "v", "unique", 0)}
    assigned = spark.createDataFrame([("u", "a"), ("w", "a"), ("x", "b")],
                                     "url_hash string, cluster_id string")
    stored = spark.createDataFrame([("a", 1), ("b", 1)], "cluster_id string, article_count int")
    assert [tuple(r) for r in quality.member_audit(assigned, stored).collect()] == [("a", 1, 2)]


def test_a_table_is_read_once_for_all_its_checks(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, "b", None), (2, None, 5), (None, "b", 5), (3, "b", 6)], "k long, t string, n int")
    rows.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.quality_report({"t": (df, ["k", "t"], ["k", "t", "n"]), "u": (df, [], ["n"])})
    assert sorted(tuple(r) for r in report.collect()) == [
        ("t", "k", "not_null", 1), ("t", "k", "unique", 1), ("t", "n", "unique", 1),
        ("t", "t", "not_null", 1), ("t", "t", "unique", 1), ("u", "n", "unique", 1)]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    empty = quality.quality_report({"t": (df.limit(0), ["k"], ["t"])})
    assert sorted(tuple(r) for r in empty.collect()) == [("t", "k", "not_null", 0), ("t", "t", "unique", 0)]
