"""Archives: exact round trips, revisits, and searches against the plain table."""

import base64
import gzip
import hashlib

from tidings.llm import warc
from tidings.session import new_path

FOLDER = "/root/testdata/sf0.001"


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        own = first.get(html or "") if len(data) >= least else None
        kind = "response" if own is None or own == page else "revisit"
        sha1 = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), sha1, kind, own if kind == "revisit" else None))
    return sorted(out, key=str)


def rows_of(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


ROWS = [(5, "http://a.example.com/x", "<p>é\r\n\r\n</p>"), (3, "http://a.example.com/x", "<p>é\r\n\r\n</p>"),
        (9, None, None), (8, "", ""), (2, "not a url\r\nX: y", "z" * 100_000), (7, "http://[bad", "q"),
        (None, "http://b.example.org:81/?a=b", "q"), (None, "http://c.example", "only"),
        (5, "http://a.example.com/x", "<p>é\r\n\r\n</p>"), (11, "http://a.example.com/x", "other")]


def test_round_trip_of_odd_pages(spark):
    df = spark.createDataFrame([(*r, "c") for r in ROWS],
                               "page_id long, url string, html string, record_type string")
    assert rows_of(warc.round_trip(df)) == brute(ROWS)
    assert rows_of(warc.round_trip(df, least_bytes=5)) == brute(ROWS, 5)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_members_are_plain_gzip_and_carry_the_payload(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/archives"
    captures = warc.write_archives(df, folder)
    files = list((tmp_path / "archives").iterdir())
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC/1.1\r\n") == len(ROWS)
    found = warc.read_captures(captures, folder, with_payload=True).collect()
    whole = {r.page_id: bytes(r.payload) for r in found if r.payload is not None and r.page_id}
    assert whole[3] == ROWS[0][2].encode() and whole[2] == b"z" * 100_000


def test_keys():
    assert warc.url_key("http://m.Example.COM/a?b=c") == "com,example,m)/a?b=c"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == "urn:none"


def test_search_in_small_blocks(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    more = pages.unionByName(pages.selectExpr("page_id + 100000 AS page_id", "url", "html"))
    hot = pages.selectExpr("page_id + 500000 AS page_id", "'http://hot.example/' AS url", "html")
    folder = new_path(spark, "archives")
    index = warc.build_index(warc.write_archives(more.unionByName(hot), folder), block_lines=7)
    rows = more.unionByName(hot).select("page_id", "url").collect()
    assert len(index.first) > 20 and len(index.places(warc.url_key("http://hot.example/"))) > 5
    asked = sorted({warc.url_key(r.url) for r in rows})[::3] + ["aaa", "zzz", "com,example)/none"]
    keys = spark.createDataFrame([(k,) for k in asked] + [(None,)], "key string")
    got = sorted(r.page_id for r in warc.read_captures(index.find(keys), folder).collect())
    assert got == sorted(r.page_id for r in rows if warc.url_key(r.url) in set(asked))


def test_query_against_the_plain_table(spark):
    from tidings.llm.queries import op9_warc

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    assert rows_of(op9_warc(spark, FOLDER)) == brute(rows)
