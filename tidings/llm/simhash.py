"""SimHash near-dedup: fingerprints within a few bits of each other, found with BK-trees.

Fingerprints, not documents, are compared: equal ones are one row with their smallest id. Two
fingerprints of 64 bits that differ in at most two have two of four 16-bit bands in common, so each
is sent to six shards, one for each pair of bands. A shard that grows beyond ``SHARD_ROWS`` is split
once more by the same rule over its other 32 bits; after that only 16 bits are free, so a shard has
65,536 members at most, whatever the input. Each shard is one BK-tree in one task: children hang
under the integer Hamming distance to their parent, and a search follows only edges within the
radius of the distance found. The trees travel by shard and are not broadcast to all tasks, as the
set of all fingerprints has no size bound. A tree's links leave the task as a forest, so a group of
copies makes as many rows as it has members. Links of all shards are joined by star contraction.

Defined results: a null or blank text has fingerprint zero and is linked like any other; repeated
rows each get their row; a row without id has a fingerprint and the smallest id of its group, and is
never the smallest itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import free_name, map_arrow, reader_slots, whole_text
from tidings.operators.components import connected_components
from tidings.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_ROWS = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: each bit is the majority of its shingles' hash bits."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, _CHUNK):
        runs = [words[start + k : start + k + _CHUNK + shingle - 1] for k in range(shingle)]
        grams = zip(*runs) if len(words) >= shingle else [words]
        hashes = [xxhash.xxh64_intdigest(b" ".join(g), SEED) for g, _ in zip(grams, range(_CHUNK))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep_row: bool = False) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the 64 bits as a signed long.

    With ``keep_row`` also ``row``, a hash of the whole text.
    """
    names = ["doc_id", "fp", *(["row"] if keep_row else [])]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            kept = [batch.column(2)] if keep_row else []
            yield pa.RecordBatch.from_arrays([batch.column(0), signed, *kept], names)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if keep_row:
        rows = rows.select("doc_id", "text", F.xxhash64(whole_text()).alias("row"))
    return map_arrow(rows, compute, ", ".join(f"{name} long" for name in names))


class BKTree:
    """A tree of integers; a child hangs under its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node, children = self.root
        while distance := (node ^ value).bit_count():
            if distance not in children:
                children[distance] = (value, {})
                return
            node, children = children[distance]

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            node, children = open_nodes.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge in range(distance - radius, distance + radius + 1):
                if edge in children:
                    open_nodes.append(children[edge])
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """``(value, root)`` of every value that is linked to another of the list and is no root."""
    tree, parent = BKTree(), {}

    def root_of(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in values:
        if value in parent:
            continue
        near = tree.within(value, radius)
        tree.add(value)
        parent[value] = value
        for other in near:
            a, b = root_of(other), root_of(value)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := root_of(x)) != x]


def _band_pairs(value: Column, bands: int, width: int) -> list[Column]:
    """A number for each pair of the lowest ``bands`` bands of ``value``, with the pair's place."""
    mask = F.lit((1 << width) - 1)
    cut = [F.shiftrightunsigned(value, width * k).bitwiseAND(mask) for k in range(bands)]
    return [
        F.lit(place << (2 * width)).cast("long").bitwiseOR(
            F.shiftleft(cut[a], width).bitwiseOR(cut[b])
        )
        for place, (a, b) in enumerate(combinations(range(bands), 2))
    ]


def _free_bits(fp: Column, shard: Column) -> Column:
    """The 32 bits of ``fp`` that the shard's pair of bands leaves open."""
    place = F.shiftrightunsigned(shard, 32)
    cases = []
    for at, pair in enumerate(combinations(range(4), 2)):
        low, high = (k for k in range(4) if k not in pair)
        band = [F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in (low, high)]
        cases.append(F.when(place == at, F.shiftleft(band[1], 16).bitwiseOR(band[0])))
    return F.coalesce(*cases)


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect all of ``distinct.fp`` within ``radius`` bits."""
    if radius > 2:
        raise ValueError("two common bands of four are certain up to two bits only")
    spark = distinct.sparkSession
    sharded = distinct.select("fp", F.explode(F.array(*_band_pairs(F.col("fp"), 4, 16))).alias("shard"))
    sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(sharded.join(sizes, "shard"), "shards")
    inner = F.array(*_band_pairs(_free_bits(F.col("fp"), F.col("shard")), 4, 8))
    part = F.when(F.col("size") > shard_rows, inner).otherwise(F.array(F.lit(-1).cast("long")))
    rows = shared.select("shard", F.explode(part).alias("part"), "fp")
    slots = reader_slots(spark)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _groups(batches):
            if pairs := forest(values, radius):
                a, b = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    dealt = rows.repartition(slots, "shard", "part").sortWithinPartitions("shard", "part", "fp")
    return map_arrow(dealt, search, "a long, b long")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[int]]:
    """The signed fingerprints of each shard, from batches sorted by shard."""
    key, values = None, []
    for batch in batches:
        shard, part, fp = (batch.column(k).to_numpy() for k in range(3))
        starts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0)) + 1
        for lo, hi in zip([0, *starts], [*starts, len(fp)]):
            if lo == hi:
                continue
            if (here := (shard[lo], part[lo])) != key:
                if len(values) > 1:
                    yield values
                key, values = here, []
            values.extend(_unsigned(fp[lo:hi]))
    if len(values) > 1:
        yield values


def _unsigned(values: np.ndarray) -> list[int]:
    # Differences of two's complement numbers have the same bits, but Python's are endless.
    return values.view(np.uint64).tolist()


def _classes(found: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """``(fp, label, component_id)`` of every fingerprint; the label names its class."""
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = connected_components(links(distinct, radius, shard_rows))
    named = distinct.join(labels.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    # Stored, so that joins with it have a plain shuffle on both sides and can split a hot value.
    return materialize(named.join(smallest, "label").select("fp", "label", "component_id"), "classes")


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row."""
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = _classes(found, radius, shard_rows)
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp: str = "fp") -> Column:
    """The fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, then the smallest text hash.

    Groups are of texts, so rows that repeat an id are judged each by its own text. Rows without id come
    last in their group and are kept only where no row has an id.
    """
    names = [free_name(docs, n) for n in ("_none", "_id", "_text")]
    # No key is null, so one shuffle serves the join and the removal of repeats.
    own_id = F.col("doc_id").cast("long")
    keys = [own_id.isNull(), F.coalesce(own_id, F.lit(0).cast("long")), F.xxhash64(whole_text())]
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(keys, names)))
    found = materialize(fingerprints(docs, shingle, keep_row=True), "fingerprints")
    classes = _classes(found, radius, SHARD_ROWS)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    firsts = found.join(classes, "fp").groupBy("label").agg(F.min(order).alias("least"))
    of = [F.col("least.none"), F.coalesce("least.doc_id", F.lit(0).cast("long")), F.col("least.row")]
    firsts = materialize(firsts.select(*(k.alias(n) for k, n in zip(of, names))), "first-rows")
    # What is left twice is one text under one id.
    return keyed.join(firsts, names, "left_semi").dropDuplicates(names).select(*docs.columns)
