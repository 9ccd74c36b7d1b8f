"""Pending stories, prompts, outcomes, failure gate."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidings.plans import daily, enrichment
from tidings.schemas import SUMMARY_CLUSTERS

def now():
    return F.lit("2024-04-01 00:00:00").cast("timestamp")


def key(n):
    return f"{n:064x}"


def member_table(spark, rows):
    return spark.createDataFrame(
        rows, "cluster_id string, url_hash string, title string, description string, "
        "source_name string, member_no int")


def answers(spark, *rows):
    return spark.createDataFrame(
        rows, "cluster_id string, attempt int, raw_text string, error string")


def test_pending_members(spark):
    assigned = spark.createDataFrame(
        [(key(1), "a"), (key(2), "a"), (key(3), "b"), (key(4), "c"), (key(5), "d")],
        "url_hash string, cluster_id string")
    articles = spark.createDataFrame(
        [(key(n), f"t{n}", None, "s") for n in range(1, 6)],
        "url_hash string, title string, description string, source_name string")
    at = datetime(2024, 1, 1)
    versions = spark.createDataFrame(
        [("b", "success", at), ("c", "failed", at), ("d", "failed", at),
         ("d", "success", datetime(2024, 1, 2))],
        "cluster_id string, enrichment_status string, enriched_at timestamp")
    members = enrichment.pending_members(
        assigned, articles, enrichment.current_summaries(versions))
    assert sorted((r.cluster_id, r.member_no, r.title) for r in members.collect()) == [
        ("a", 1, "t1"), ("a", 2, "t2"), ("c", 1, "t4")]
    counts = enrichment.pending_clusters(members).collect()
    assert {(r.cluster_id, r.article_count) for r in counts} == {("a", 2), ("c", 1)}


MEMBERS = [("a", key(1), "T1", "D1", "Forbes", 1), ("a", key(2), None, None, None, 2),
           ("a", key(3), "T3", None, "", 3), ("b", key(4), "T4", "D4", "X", 1)]


def joined(lines, story):
    own = sorted((r.line_no, r.text) for r in lines.collect() if r.cluster_id == story)
    assert [number for number, _ in own] == list(range(len(own)))
    return "".join(text for _, text in own)


def test_prompts(spark):
    members = member_table(spark, MEMBERS)
    got = enrichment.prompts(members, "Head {{}}\n{articles_block}\nTail")
    assert joined(got, "a") == (
        "Head {}\n1. [Forbes] T1\n   D1\n2. [unknown source] \n   \n"
        "3. [unknown source] T3\n   \nTail")
    assert joined(got, "b") == "Head {}\n1. [X] T4\n   D4\nTail"
    assert "{articles_block}" in enrichment.TEMPLATE
    assert enrichment.prompts(members.limit(0)).isEmpty()


@pytest.mark.parametrize("size", [1, 4, 5, 6, 10, 23])
def test_prompts_are_put_together(spark, size):
    rows = [("a", key(n), f"T{n}", f"D{n}", "S", n) for n in range(1, size + 1)]
    lines = enrichment.prompts(member_table(spark, rows + [("b", key(0), "T", None, None, 1)]))
    whole = {r.cluster_id: r for r in enrichment.prompt_parts(lines).collect()}
    assert set(whole) == {"a", "b"}
    for story, count in (("a", size), ("b", 1)):
        own = whole[story]
        assert (own.part, own.parts, own.article_count) == (0, 1, count)
        assert own.prompt == joined(lines, story)
    parts = enrichment.prompt_parts(lines, 5).where("cluster_id = 'a'").orderBy("part").collect()
    assert [(r.part, r.parts) for r in parts] == [(k, len(parts)) for k in range(-(-size // 5))]
    assert "".join(r.prompt for r in parts) == joined(lines, "a")


def test_stored_prompts_are_read_in_order(spark, tmp_path):
    """A story that is cut over several files is one text; others keep their own."""
    rows = [("a", key(n), f"T{n}", f"D{n}", "S", n) for n in range(1, 400)]
    lines = enrichment.prompts(member_table(spark, rows + [("b", key(0), "T", None, None, 1)]))
    path = str(tmp_path / "prompts")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        enrichment.write_prompts(lines, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = spark.read.parquet(path).where("cluster_id = 'a'").select(F.input_file_name()).distinct()
    assert files.count() > 1
    for story in ("a", "b"):
        assert "".join(enrichment.prompt_text(spark, path, story)) == joined(lines, story)
    assert list(enrichment.prompt_text(spark, path, "c")) == []


GOOD = ('{"summary": "s%s", "topic": "t", "sentiment": "n", "keywords": ["k"], '
        '"source_perspectives": [{"index": 2, "focus": "x"}, {"index": 9, "focus": "y"}, '
        '{"index": 0, "focus": "z"}, {"index": 2, "focus": "w"}]}')


def test_outcomes(spark):
    members = member_table(spark, MEMBERS + [("c", key(5), "T", "D", "S", 1),
                                             ("d", key(6), "T", "D", "S", 1),
                                             ("e", key(7), "T", "D", "S", 1)])
    responses = answers(
        spark, ("a", 1, "no", None), ("a", 2, GOOD % 2, None), ("a", 3, GOOD % 3, None),
        ("b", 1, "bad1", None), ("b", 2, "bad2", None), ("b", 4, GOOD % 4, None),
        ("c", 1, None, "x" * 3000), ("d", 1, "", None), ("zz", 1, GOOD % 1, None))
    rows = enrichment.outcomes(members, responses, F.lit("m"), now())
    assert rows.columns == SUMMARY_CLUSTERS.fieldNames()
    by = {r.cluster_id: r for r in rows.collect()}
    assert set(by) == {"a", "b", "c", "d", "e"}
    a = by["a"]
    assert (a.enrichment_status, a.summary, a.article_count, a.llm_model) == (
        "success", "s2", 3, "m")
    assert [tuple(p) for p in a.source_perspectives] == [(key(2), "x"), (key(2), "w")]
    assert a.raw_llm_response is None and a.keywords == ["k"]
    b = by["b"]
    assert (b.enrichment_status, b.summary, b.keywords, b.raw_llm_response) == (
        "failed", "", [], "bad2")
    assert len(by["c"].raw_llm_response) == 2000
    assert by["d"].raw_llm_response == by["e"].raw_llm_response == enrichment.EMPTY_ANSWER
    counts = enrichment.enrichment_counts(rows).first()
    assert tuple(counts) == (5, 1, 4, True)


@pytest.mark.parametrize("failed, total, over", [(0, 0, False), (1, 5, False), (2, 9, True)])
def test_gate_is_strict(spark, failed, total, over):
    status = ["failed"] * failed + ["success"] * (total - failed)
    rows = spark.createDataFrame([(s,) for s in status], "enrichment_status string")
    counts = enrichment.enrichment_counts(rows).first()
    assert (counts.attempted, counts.is_over_limit) == (total, over)
    values = {"is_over_limit": over, "failed": failed, "fetched": total}
    if over:
        with pytest.raises(RuntimeError):
            daily.require_success(values)
    else:
        daily.require_success(values)
