"""WARC archives with a two-level capture index.

Each task writes an archive of its own, one gzip member a record, so that a record can be read by
its place alone. The captures are sorted by reversed-host URL key over all tasks and cut into
compressed blocks; the first key of each block makes a sparse directory. A search takes the
directory, of which ``MAX_BLOCKS`` bounds the size, finds a key's blocks by binary search, opens only
these, finds the captures in them by binary search again, and reads their byte ranges.

Pages with equal payloads are stored once: the smallest page_id is the response, the others are
revisits that refer to it. Payloads are compared by digest and length; the bytes move once, by page,
so a payload that a third of the pages share is no single task.

An archive counts only if the stored list of captures names it: what a lost executor left half
written is never read. Archives lie in the shared work folder, by any file system that pyarrow reads.

Defined results: a null html counts as empty, a null url as ``urn:none``; equal payloads shorter than
``least_bytes`` are all responses; repeated rows each make a record; a row without page_id is a
response only if no row with an id has its payload; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow, reader_slots
from tidings.session import materialize, temporary_path

DATE = "2024-01-01T00:00:00Z"
#: Bytes after which a task begins another archive, and bytes of one range read.
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 8 << 20
#: Lines of an index block, and the blocks beyond which blocks grow instead.
BLOCK_LINES = 1024
MAX_BLOCKS = 1_000_000
_LEVEL = 3
_NONE = "urn:none"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def target(url: str | None) -> str:
    """The url as one header line."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~", encoding="utf-8") if url else _NONE


def url_key(url: str | None) -> str:
    """The url with its host reversed, so that pages of one domain lie together."""
    text = target(url)
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return text
    if not host:
        return text
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One gzip member: a response, or a revisit of the page ``first``."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    is_revisit = first is not None and first != page
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{first}>")
    head = "\r\n".join(lines).encode()
    pack = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return pack.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parsed(member: bytes) -> dict:
    """What a record says; the digest of a response is computed again and must agree."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != sha1):
        raise ValueError("a payload does not agree with its digest")

    def page(name: str) -> int | None:
        number = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return {
        "page_id": page("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": size,
        "payload_digest": sha1, "record_type": kind, "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


_CAPTURES = "key string, page_id long, path string, offset long, length long"


def _columns(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    found = [pa.array(x, kind) for x, (_, kind) in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(found, [name for name, _ in schema])


def _write(folder: str):
    kinds = [("key", pa.string()), ("page_id", pa.int64()), ("path", pa.string()),
             ("offset", pa.int64()), ("length", pa.int64())]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        out, path, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page, url, html, first in zip(*(batch.column(k) for k in range(4))):
                    payload = (html.as_py() or "").encode()
                    member = record(page.as_py(), url.as_py(), payload, first.as_py())
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        path, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(path, compression=None)
                    out.write(member)
                    rows.append((url_key(url.as_py()), page.as_py(), path, at, len(member)))
                    at += len(member)
                if rows:
                    yield _columns(rows, kinds)
        finally:
            if out is not None:
                out.close()

    return compute


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each page below ``folder``; the stored list of captures."""
    html = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(html)
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.sha2(html, 256).alias("same"), size.alias("size"),
    )
    narrow = materialize(named.select("page_id", "same", "size").distinct(), "payloads")
    smallest = narrow.where(F.col("size") >= least_bytes).groupBy("same", "size").agg(
        F.min("page_id").alias("first")
    )
    # Stored, so that the join has a plain shuffle on both sides and can split a hot payload.
    smallest = materialize(smallest, "smallest")
    firsts = materialize(narrow.join(smallest, ["same", "size"], "left"), "firsts")
    other = firsts.select(F.col("page_id").alias("p"), F.col("same").alias("s"), "first")
    both = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("same") == F.col("s"))
    rows = named.join(other, both).select("page_id", "url", "html", "first")
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    return materialize(map_arrow(rows, _write(folder), _CAPTURES), "captures")


def _pack(lines_per_block: int):
    kinds = [("first_key", pa.string()), ("last_key", pa.string()), ("lines", pa.int64()),
             ("data", pa.binary())]

    def block(lines: list[tuple]) -> tuple:
        data = "\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode()
        return lines[0][0], lines[-1][0], len(lines), zlib.compress(data)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(k).to_pylist() for k in range(5)))
            while len(held) >= lines_per_block:
                yield _columns([block(held[:lines_per_block])], kinds)
                held = held[lines_per_block:]
        if held:
            yield _columns([block(held)], kinds)

    return compute


class CaptureIndex:
    """Compressed blocks of sorted captures, and the directory of their first and last keys."""

    def __init__(self, blocks: DataFrame) -> None:
        self.blocks = blocks
        rows = blocks.select("block", "first_key", "last_key").orderBy("first_key", "last_key")
        found = rows.limit(2 * MAX_BLOCKS + 1).collect()
        if len(found) > 2 * MAX_BLOCKS:
            raise ValueError("the directory is beyond its bound")
        self.numbers = [r.block for r in found]
        self.first, self.last = [r.first_key for r in found], [r.last_key for r in found]

    def places(self, key: str) -> list[int]:
        """Numbers of the blocks that may hold ``key``."""
        at = bisect_left(self.last, key)
        found = []
        while at < len(self.first) and self.first[at] <= key:
            found.append(self.numbers[at])
            at += 1
        return found

    def find(self, keys: DataFrame) -> DataFrame:
        """Captures of all of ``keys.key``."""
        spark = keys.sparkSession
        directory = spark.sparkContext.broadcast((self.numbers, self.first, self.last))

        def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = CaptureIndex.__new__(CaptureIndex)
            own.numbers, own.first, own.last = directory.value
            for batch in batches:
                rows = [(b, k) for k in batch.column(0).to_pylist() for b in own.places(k)]
                if rows:
                    yield _columns(rows, [("block", pa.int64()), ("key", pa.string())])

        wanted = keys.select("key").where("key IS NOT NULL").distinct()
        asked = map_arrow(wanted, locate, "block long, key string")
        # A block has no more keys than lines, or fewer hits than keys asked for in vain.
        lists = asked.groupBy("block").agg(F.sort_array(F.collect_list("key")).alias("keys"))
        joined = self.blocks.select("block", "data").join(lists, "block").select("data", "keys")
        return map_arrow(joined, _open_blocks, _CAPTURES)


def _open_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("key", pa.string()), ("page_id", pa.int64()), ("path", pa.string()),
             ("offset", pa.int64()), ("length", pa.int64())]
    for batch in batches:
        for data, keys in zip(batch.column(0), batch.column(1).to_pylist()):
            lines = [json.loads(x) for x in zlib.decompress(data.as_py()).decode().split("\n")]
            stored = [x[0] for x in lines]
            rows = []
            for key in keys:
                at = bisect_left(stored, key)
                while at < len(stored) and stored[at] == key:
                    rows.append(tuple(lines[at]))
                    at += 1
            if rows:
                yield _columns(rows, kinds)


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort the captures by key and cut them into blocks."""
    spark: SparkSession = captures.sparkSession
    count = captures.count()
    lines = max(block_lines, -(-count // MAX_BLOCKS))
    # The page and place spread the captures of one url over several ranges.
    order = ["key", "page_id", "path", "offset"]
    ranged = captures.repartitionByRange(reader_slots(spark), *order).sortWithinPartitions(*order)
    packed = map_arrow(
        ranged.select("key", "page_id", "path", "offset", "length"), _pack(lines),
        "first_key string, last_key string, lines long, data binary",
    )
    numbered = packed.withColumn("block", F.monotonically_increasing_id())
    return CaptureIndex(materialize(numbered, "index"))


def read_captures(captures: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records at the captures' places, read by byte range."""
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    kinds += [("payload", pa.binary())] * with_payload

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        name, source, held, begin = "", None, b"", 0
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if path != name:
                    if source is not None:
                        source.close()
                    name, source, held, begin = path, system.open_input_file(path), b"", 0
                if offset < begin or offset + length > begin + len(held):
                    # Records that follow one another come with one read.
                    begin = offset
                    held = source.read_at(max(length, READ_BYTES), offset)
                found = parsed(held[offset - begin : offset - begin + length])
                rows.append(tuple(found[c] for c, _ in kinds))
            if rows:
                yield _columns(rows, kinds)
        if source is not None:
            source.close()

    spread = captures.repartition(reader_slots(captures.sparkSession), "path")
    ordered = spread.sortWithinPartitions("path", "offset").select("path", "offset", "length")
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long" + ", payload binary" * with_payload
    )
    return map_arrow(ordered, compute, schema)


def keys_of(pages: DataFrame) -> DataFrame:
    """``key`` of each page's url."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _columns([(url_key(u),) for u in batch.column(0).to_pylist()], [("key", pa.string())])

    return map_arrow(pages.select("url").distinct(), compute, "key string").distinct()


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages, index them, look every url up, and read the records back."""
    folder = temporary_path(pages.sparkSession, "archives")
    index = build_index(write_archives(pages, folder, least_bytes))
    return read_captures(index.find(keys_of(pages)), folder)
