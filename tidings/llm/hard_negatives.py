"""Hard negatives by angular triangle filtering.

Each vector keeps its angles to ``REFERENCES`` directions. By the triangle inequality the angle between two
vectors is at least the largest difference of their angles to a direction and at most the smallest sum
(or what the sum lacks to a full turn). The cosines of these two, times both lengths and widened by more
than rounding can do, are bounds of the score. Only vectors whose bounds overlap the wanted window of
scores are scored, in whole numbers.

* ``index`` pads the vectors, stores lengths and angles, and deals the rows over shards. The directions
  come from ``SAMPLE`` rows at most, farthest first; they steer the work and not the result.
* In a shard the rows of each nearest direction are sorted by the angle to it, so a window of scores is a
  range of rows, found by binary search; the other directions' angles thin it out further.
* ``nearest`` takes targets, windows of scores of an anchor, to the shards in blocks of anchors. Shards go
  in waves that double, and each wave knows the ``k``-th best score of those before, which lifts the
  window's floor: a wave adds some ``k`` rows a target, so rows grow with the anchors and the
  logarithm of the shards.
* ``mine`` uses it twice: the best of the same label for every anchor, then for every such positive the best
  of the other labels inside its window.

Defined results: rows with a null id, label or vector or a null or non-finite component take no part, neither do
components that are not finite times ``scale``; shorter vectors are filled up with zeros and an empty one
is all zeros; of rows that repeat an id the one with the smallest label, then components, counts; equal
scores go to the smaller id; scores beyond the range of a long are its ends; a positive with a negative
score has an empty window; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow, reader_slots
from tidings.session import materialize

SCALE = 256
REFERENCES = 16
#: Rows from which the directions are taken, at most.
SAMPLE = 1024
SHARD_ROWS = 16_384
BLOCK_ANCHORS = 256
#: Shards of the first wave.
FIRST_SHARDS = 16
#: Rows that give a first floor to a target without one.
PROBED = 64
#: More than the rounding of two angles, in radians, and of a score, as a share.
ANGLE_SLACK = 1e-5
SCORE_SLACK = 1e-9
_LEAST, _MOST = -(2**63), 2**63 - 1


def prepared(rows: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, label, v)``: components times ``scale``, rounded down, of the rows that take part."""
    exact = F.transform(F.col(vector), lambda x: x.cast("double") * scale)
    finite = F.forall(exact, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.where(F.col(key).isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull())
    # Whole numbers may be too large for a long; a double holds each of them.
    whole = F.transform(exact, lambda x: x - F.pmod(x, F.lit(1.0)))
    return valid.where(finite).select(
        F.col(key).cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v")
    )


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, also of vectors whose squares are beyond a double."""
    top = np.abs(vectors).max(axis=1, initial=0.0)
    scaled = vectors / np.where(top > 0, top, 1.0)[:, None]
    return top * np.sqrt(np.einsum("ij,ij->i", scaled, scaled))


def angles_to(vectors: np.ndarray, lengths: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of each vector to each direction; a vector of zeros is at a right angle to all."""
    unit = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
    return np.arccos(np.clip(unit @ directions.T, -1.0, 1.0))


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions of the sample's mean and then of the vectors farthest from those taken."""
    lengths = lengths_of(sample)
    unit = sample[lengths > 0] / lengths[lengths > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    mean = unit.mean(axis=0)
    size = np.linalg.norm(mean)
    taken = [mean / size if size > 1e-9 else unit[0]]
    nearest = unit @ taken[0]
    while len(taken) < count and nearest.min() < 1 - 1e-6:
        taken.append(unit[np.argmin(nearest)])
        nearest = np.maximum(nearest, unit @ taken[-1])
    return np.array(taken)


def index(vectors: DataFrame, references: int = REFERENCES, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """``(shard, vec_id, label, v, length, angles)`` of every vector, and the number of shards."""
    least = F.min(F.struct("label", "v")).alias("best")
    single = vectors.groupBy("vec_id").agg(least).select("vec_id", "best.label", "best.v")
    stored = materialize(single, "vectors")
    rows, width = stored.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    picked = stored.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    filled = np.array([[*r.v, *([0.0] * (width - len(r.v)))] for r in picked]).reshape(-1, width)
    directions = farthest_first(filled, references)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(x.values) for x in batch.column(2)]
            whole = np.zeros((len(found), width))
            for k, x in enumerate(found):
                whole[k, : len(x)] = x
            lengths = lengths_of(whole)
            angles = angles_to(whole, lengths, directions).astype(np.float32)
            columns = [batch.column(0), batch.column(1), _lists(whole), pa.array(lengths), _lists(angles)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "length", "angles"])

    schema = "vec_id long, label long, v array<double>, length double, angles array<float>"
    shards = max(1, -(-rows // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    made = map_arrow(stored.select("vec_id", "label", "v"), compute, schema).select(shard, "*")
    return materialize(made.sortWithinPartitions("shard"), "angles"), shards


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _table(lists: pa.Array, rows: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1).astype(np.float64)


class Shard:
    """Vectors by nearest direction and the angle to it."""

    def __init__(self, ids, labels, vectors, lengths, angles) -> None:
        cell = angles.argmin(axis=1)
        order = np.lexsort((angles[np.arange(len(ids)), cell], cell))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.lengths, self.angles = lengths[order], angles[order]
        cell = cell[order]
        bounds = np.searchsorted(cell, np.arange(angles.shape[1] + 1))
        self.cells = [
            (c, lo, hi, self.angles[lo:hi, c], self.lengths[lo:hi].max())
            for c, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if lo < hi
        ]
        #: Vectors that were scored, and those that a plain search would have scored.
        self.scored = self.asked = 0

    def scores(self, rows: np.ndarray, vector: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products as longs."""
        self.scored += len(rows)
        out = np.zeros(len(rows), np.int64)
        # No partial sum is larger than the product of the lengths.
        small = self.lengths[rows] * length < 2.0**52
        out[small] = (self.vectors[rows[small]] @ vector).astype(np.int64)
        if not small.all():
            whole = [int(x) for x in vector]
            for k in np.flatnonzero(~small):
                exact = sum(int(a) * b for a, b in zip(self.vectors[rows[k]], whole))
                out[k] = min(max(exact, _LEAST), _MOST)
        return out

    def possible(self, angles: np.ndarray, length: float, low: float, high: float) -> np.ndarray:
        """Rows whose bounds overlap scores from ``low`` to ``high``."""
        ranges = []
        for c, lo, hi, sorted_angles, longest in self.cells:
            reach = np.pi
            most = length * longest * (1 + SCORE_SLACK)
            if low > 0 and most < np.inf:
                if most < low:
                    continue
                reach = np.arccos(min(1.0, low / most)) + ANGLE_SLACK
            a = np.searchsorted(sorted_angles, angles[c] - reach)
            b = np.searchsorted(sorted_angles, angles[c] + reach, "right")
            ranges.append(np.arange(lo + a, lo + b))
        rows = np.concatenate(ranges) if ranges else np.zeros(0, np.int64)
        own = self.angles[rows]
        apart = np.abs(own - angles).max(axis=1, initial=0.0) - ANGLE_SLACK
        both = own + angles
        within = np.minimum(both, 2 * np.pi - both).min(axis=1, initial=np.pi) + ANGLE_SLACK
        size = self.lengths[rows] * length
        margin = size * SCORE_SLACK + 1
        upper = size * np.cos(np.clip(apart, 0, np.pi)) + margin
        lower = size * np.cos(np.clip(within, 0, np.pi)) - margin
        # Bounds that are no numbers keep their row.
        return rows[~(upper < low) & ~(lower > high)]

    def search(self, anchor: int, label: int, vector, length, angles, targets, k: int, same: bool):
        """``(target, ids, scores)``: each target's best ``k``, best first, of ``(name, low, high)``."""
        fits = self.labels == label
        fits = (fits if same else ~fits) & (self.ids != anchor)
        self.asked += int(fits.sum())
        floor, high = min(t[1] for t in targets), max(t[2] for t in targets)
        if floor == _LEAST:
            # The k best of the rows nearest by angle are a floor.
            near = np.flatnonzero(fits)
            if len(near) > PROBED:
                apart = np.abs(self.angles[near] - angles).max(axis=1)
                near = near[np.argpartition(apart, PROBED)[:PROBED]]
            if len(near) >= k:
                floor = int(np.sort(self.scores(near, vector, length))[-k])
        # The ends of a long stand for all that is beyond them.
        bounds = -np.inf if floor == _LEAST else float(floor), np.inf if high == _MOST else float(high)
        rows = self.possible(angles, length, *bounds)
        rows = rows[fits[rows]]
        found = self.scores(rows, vector, length)
        for name, low, high in targets:
            inside = np.flatnonzero((found >= max(low, floor)) & (found <= high))
            if len(inside) > k:
                kth = np.partition(found[inside], len(inside) - k)[len(inside) - k]
                inside = inside[found[inside] >= kth]
            # The complement orders longs downwards and has no overflow.
            best = inside[np.lexsort((self.ids[rows[inside]], ~found[inside]))][:k]
            if len(best):
                yield name, self.ids[rows[best]], found[best]


_ANSWER = "anchor_id long, name long, vec_id long, score long"


def _answers(k: int, same: bool):
    """Rows sorted by shard, each shard's vectors before the blocks of anchors that are put to it."""

    def built(parts: list[pa.RecordBatch]) -> Shard:
        whole = pa.Table.from_batches(parts).combine_chunks()
        column = {n: whole.column(n).combine_chunks() for n in ("vec_id", "label", "v", "length", "angles")}
        n = whole.num_rows
        ids, labels, lengths = (column[c].to_numpy() for c in ("vec_id", "label", "length"))
        return Shard(ids, labels, _table(column["v"], n), lengths, _table(column["angles"], n))

    def put(shard: Shard, block: pa.StructArray) -> pa.RecordBatch | None:
        n = len(block)
        vectors, angles = _table(block.field("v"), n), _table(block.field("angles"), n)
        lengths, targets = block.field("length").to_numpy(), block.field("targets").to_pylist()
        ids, labels = block.field("vec_id").to_pylist(), block.field("label").to_pylist()
        out: list[tuple] = []
        for a in range(n):
            wanted = [(t["name"], t["low"], t["high"]) for t in targets[a]]
            for name, who, scores in shard.search(
                ids[a], labels[a], vectors[a], lengths[a], angles[a], wanted, k, same
            ):
                out += [(ids[a], name, int(i), int(s)) for i, s in zip(who, scores)]
        if not out:
            return None
        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
        return pa.RecordBatch.from_arrays(columns, ["anchor_id", "name", "vec_id", "score"])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            places, asks = batch.column("shard").to_numpy(), batch.column("block").is_valid()
            asks = asks.to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(places) != 0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *turns], [*turns, batch.num_rows]):
                if lo == hi:
                    continue
                if places[lo] != at:
                    at, shard, held = places[lo], None, []
                part = batch.slice(lo, hi - lo)
                if not asks[lo]:
                    held.append(part)
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = built(held), []
                for row in part.column("block"):
                    found = put(shard, row.values)
                    if found is not None:
                        yield found

    return compute


def nearest(
    stored: DataFrame, shards: int, targets: DataFrame, k: int, same: bool, first: int = FIRST_SHARDS
) -> DataFrame:
    """``(anchor_id, name, rank, vec_id, score)``: the best ``k`` of each target.

    ``targets`` has ``(anchor_id, name, low, high)``; scores count from ``low`` to ``high``. Rows of the
    anchor's label are searched, or those of the others.
    """
    targets = materialize(targets, "targets")
    anchors = targets.select("anchor_id").distinct().count()
    blocks = max(1, -(-anchors // BLOCK_ANCHORS))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    asked = ["vec_id", "label", "v", "length", "angles"]
    held = stored.select("shard", *asked)
    order = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "vec_id")
    best, lo = None, 0
    while lo < shards:
        hi = min(shards, max(first, 2 * lo))
        known = targets
        if best is not None:
            full = best.groupBy("anchor_id", "name").agg(
                F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")
            ).where(F.col("n") == k)
            known = targets.join(full, ["anchor_id", "name"], "left").select(
                "anchor_id", "name", F.greatest("low", "kth").alias("low"), "high"
            )
        windows = known.groupBy(F.col("anchor_id").alias("vec_id")).agg(
            F.collect_list(F.struct("name", "low", "high")).alias("targets")
        )
        packed = stored.join(windows, "vec_id").groupBy(block.alias("_block")).agg(
            F.collect_list(F.struct(*asked, "targets")).alias("block")
        )
        every = F.explode(F.sequence(F.lit(lo), F.lit(hi - 1))).alias("shard")
        wave = held.where(F.col("shard").between(lo, hi - 1)).unionByName(
            packed.select(every, "block"), allowMissingColumns=True
        )
        slots = max(hi - lo, reader_slots(stored.sparkSession))
        dealt = wave.repartition(slots, "shard").sortWithinPartitions("shard", F.col("block").isNotNull())
        found = map_arrow(dealt, _answers(k, same), _ANSWER)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best, lo = materialize(ranked, "best"), hi
    return best.select("anchor_id", "name", "rank", "vec_id", "score")


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    first: int = FIRST_SHARDS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` as ``prepared`` makes them, ``anchors`` has the ``vec_id`` of the anchors. A negative's score is
    within these percentages of the positive's.
    """
    stored, shards = index(vectors)
    ids = stored.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi").select("vec_id")
    every = ids.select(
        F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("name"),
        F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"),
    )
    pairs = nearest(stored, shards, every, positives, True, first).select(
        "anchor_id", F.col("vec_id").alias("name"), F.col("score").alias("positive_score")
    )
    exact = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(exact * percent[0] / 100), F.floor(exact * percent[1] / 100)
    windows = pairs.select(
        "anchor_id", "name", low.cast("decimal(25,0)").alias("low"), high.cast("decimal(25,0)").alias("high")
    ).where("low <= high")
    ends = [F.lit(x).cast("decimal(25,0)") for x in (_LEAST, _MOST)]
    windows = windows.select(
        "anchor_id", "name",
        *(F.least(F.greatest(F.col(n), ends[0]), ends[1]).cast("long").alias(n) for n in ("low", "high")),
    )
    found = nearest(stored, shards, windows, negatives, False, first)
    return found.join(pairs, ["anchor_id", "name"]).select(
        "anchor_id", F.col("name").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
