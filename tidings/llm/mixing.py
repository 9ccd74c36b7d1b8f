"""Mixing sources to target weights by proportionate-fair scheduling.

Time is cut into slots and each slot holds one block of ``block_rows`` rows of one source. Block ``i``
of a source with weight ``w`` is released at slot ``floor(i / w)`` and due by slot
``ceil((i + 1) / w)``; in each slot the released block with the earliest deadline goes next. With
weights that sum to one, each source is then always less than one block away from its share.

Releases and deadlines are those of the exact weights, as fractions, over the whole input; only a caller
who gives a ``period`` gets weights rounded to whole slots of it. The schedule has a row for each block.
It is made block after block, by one task that holds a row for each source and takes time in proportion
to the slots (those of sources that have run out included). Rows are joined with it by their source and
the number of their block, so rows are never scheduled one after another.

Rows are numbered by fixed slots of a hash: counts per slot give offsets, and a window sees one
slot of one source, so that a source with a third of all rows is spread over all tasks.

Every row comes exactly once. A source that has run out leaves its slots empty, which are closed up;
the others go on in their own proportion.

Defined results: a null source is a source of its own; null ids are ordered by the other columns' hash;
repeated rows each get a place of their own; an empty table gives an empty result; columns named like
``MIX_COLUMNS`` are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import free_name, map_arrow

#: The mixture flattens the sizes of the sources by this exponent, unless weights are given.
FLATTEN = 0.5
#: A usual period for weights that a caller wants rounded.
PERIOD = 1_000
BLOCK_ROWS = 8
#: Sources whose sizes the driver may ask for; a mixture itself has no such limit.
MAX_SOURCES = 1_000
#: Bits of the hash slots that number the rows of a source.
NUMBERING_BITS = 9
_PLAN_ROWS = 16_384
MIX_COLUMNS = ("source_index", "slot", "release_slot", "deadline_slot", "position")


def whole_shares(weights: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Slots of each source in a period: at least one each, by largest remainders."""
    total = sum(weights.values())
    if not weights:
        return {}
    if min(weights.values()) <= 0 or len(weights) > period:
        raise ValueError("weights must be positive, and a period must have a slot for each source")
    free = period - len(weights)
    exact = {s: w / total * period for s, w in weights.items()}
    above = {s: max(0.0, x - 1) for s, x in exact.items()}
    scale = free / sum(above.values()) if sum(above.values()) > 0 else 0.0
    parts = {s: int(x * scale) for s, x in above.items()}
    order = sorted(weights, key=lambda s: (parts[s] - above[s] * scale, s is None, str(s)))
    left = free - sum(parts.values())
    for k in range(left):
        parts[order[k % len(order)]] += 1
    return {s: 1 + n for s, n in parts.items()}


def exact_shares(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """Whole numbers in the exact proportions of the weights."""
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*[w.denominator for w in exact.values()])
    return {s: int(w * unit) for s, w in exact.items()}


def slots(shares: Mapping[str | None, int]) -> Iterator[tuple[str | None, int, int, int]]:
    """``(source, block, release, deadline)`` of each slot without end, earliest deadline first."""
    period = sum(shares.values())
    names = sorted(shares, key=lambda s: (s is None, str(s)))
    waiting = [(0, k, 0) for k in range(len(names))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
    slot = 0
    while names:
        while waiting and waiting[0][0] <= slot:
            release, k, block = heapq.heappop(waiting)
            deadline = -(-(block + 1) * period // shares[names[k]])
            heapq.heappush(ready, (deadline, k, block, release))
        deadline, k, block, release = heapq.heappop(ready)
        yield names[k], block, release, deadline
        heapq.heappush(waiting, ((block + 1) * period // shares[names[k]], k, block + 1))
        slot += 1


def schedule(shares: Mapping[str | None, int]) -> list[tuple[str | None, int, int, int]]:
    """The slots of one period."""
    return list(islice(slots(shares), sum(shares.values())))


def source_sizes(docs: DataFrame, max_sources: int = MAX_SOURCES) -> dict[str | None, int]:
    """Rows of each source; fails beyond ``max_sources``, which bounds what the driver gets."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them first")
    return {r.s: r.n for r in found}


def _numbered(docs: DataFrame, source: str, index: str) -> DataFrame:
    """Number the rows of each source from 0 in the order of a hash of the row."""
    # The text is left out of the order: ids settle it, and rows that repeat an id are alike.
    skipped = (source, "text", "html")
    keys = [c for c, kind in docs.dtypes if c not in skipped and not kind.startswith(("map", "var"))]
    order, slot = free_name(docs, "_order"), free_name(docs, "_hash_slot")
    hashed = docs.withColumn(order, F.xxhash64(*keys) if keys else F.lit(0).cast("long"))
    hashed = hashed.withColumn(slot, F.shiftrightunsigned(order, 64 - NUMBERING_BITS).cast("int"))
    sizes = hashed.groupBy(source, slot).agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(source).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(source).alias("_s"), F.col(slot).alias("_k"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy(source, slot).orderBy(order, *keys)
    ranked = hashed.withColumn(index, F.row_number().over(within))
    same = F.col(source).eqNullSafe(F.col("_s")) & (F.col(slot) == F.col("_k"))
    # The number of sources has no bound, so Spark decides by size.
    joined = ranked.join(offsets, same)
    number = (F.col("_offset") + F.col(index) - 1).cast("long")
    return joined.withColumn(index, number).drop("_s", "_k", "_offset", order, slot)


def _plan(
    sizes: DataFrame, weights: Mapping[str | None, float] | None, period: int | None, block_rows: int
) -> DataFrame:
    """The slot of each block of ``(name, size)`` and the number of rows before it in the mixture."""
    names = ["_n", "_b", "_slot", "_release", "_deadline", "_before"]
    schema = "_n string, _b long, _slot long, _release long, _deadline long, _before long"

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: dict[str | None, int] = {}
        for batch in batches:
            left |= dict(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        own = {s: n**FLATTEN if weights is None else weights[s] for s, n in left.items()}
        if period is None:
            shares = exact_shares(own) if own else {}
        else:
            shares = whole_shares(own, max(period, 4 * len(own)))
        rows: list[tuple] = []
        before, waiting = 0, len(left)
        for slot, (name, block, release, deadline) in enumerate(slots(shares)):
            if size := left[name]:
                rows.append((name, block, slot, release, deadline, before))
                taken = min(block_rows, size)
                before += taken
                left[name] = size - taken
                waiting -= taken == size
            if len(rows) == _PLAN_ROWS or not waiting:
                columns = zip(*rows, strict=True)
                kinds = [pa.string()] + [pa.int64()] * 5
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)
                rows = []
            if not waiting:
                break

    return map_arrow(sizes.coalesce(1), compute, schema)


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    period: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs`` with ``MIX_COLUMNS``; ``position`` is the row's place in the mixture, from 0.

    ``weights`` gives the share of every source; without it shares follow the sizes of the sources,
    flattened by ``FLATTEN``. With a ``period`` they are rounded to whole slots of it.
    """
    kept = [c for c in docs.columns if c.lower() not in MIX_COLUMNS]
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    name, index = free_name(docs, "_source"), free_name(docs, "_index")
    named = docs.withColumn(name, F.col("source").cast("string"))
    counted = named.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    plan = _plan(counted, weights, period, block_rows)
    placed = _numbered(named, name, index)
    block = F.floor(F.col(index) / block_rows)
    placed = placed.join(plan, F.col(name).eqNullSafe(F.col("_n")) & (block == F.col("_b")))
    position = F.col("_before") + F.pmod(index, F.lit(block_rows))
    return placed.select(
        *kept, F.col(index).alias("source_index"), F.col("_slot").alias("slot"),
        F.col("_release").alias("release_slot"), F.col("_deadline").alias("deadline_slot"),
        position.alias("position"),
    )


def in_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``mixed`` with the columns of ``docs``, in files that follow the mixture."""
    ordered = mixed.orderBy("position")
    return ordered.select(*docs.columns)


def with_place(written: DataFrame) -> DataFrame:
    """``written`` with ``position``, the place of each row, from 0, in files that ``in_order`` filled.

    A reader packs the files by size, so the order is taken from their numbers and the rows in them.
    """
    part = F.regexp_extract("_metadata.file_path", r"part-(\d+)-[^/]*$", 1).cast("long")
    # A task that closes a file early goes on in another with the next last number.
    piece = F.regexp_extract("_metadata.file_path", r"-c(\d+)[^-/]*$", 1).cast("long")
    kept = [c for c in written.columns if c.lower() != "position"]
    part_name, piece_name, row = (free_name(written, c) for c in ("_part", "_piece", "_row"))
    rows = written.select(
        *kept, part.alias(part_name), F.coalesce(piece, F.lit(0)).alias(piece_name),
        F.col("_metadata.row_index").alias(row),
    )
    sizes = rows.groupBy(part_name, piece_name).agg(F.count(F.lit(1)).alias("size"))
    # A row for each file.
    earlier = Window.orderBy(part_name, piece_name).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(part_name).alias("_p"), F.col(piece_name).alias("_c"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = (F.col(part_name) == F.col("_p")) & (F.col(piece_name) == F.col("_c"))
    joined = rows.join(F.broadcast(offsets), same)
    return joined.select(*kept, (F.col("_offset") + F.col(row)).cast("long").alias("position"))
