"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are whole numbers. The index is cut into shards of ``SHARD_ROWS`` vectors. In a shard the
postings, one for each vector and dimension, stand in segments of descending quantised impact: segment
0 holds all components of the largest size, and so on. Queries work through the segments in that
order and add up scores; a dimension not yet met adds nothing. What a vector may still gain is at
most the length of the query times the length of its unread components (Cauchy and Schwarz).
Reading stops only on proof: when few vectors are left that can reach the k-th of the exact scores
known. These possible members are then scored exactly.

Queries travel to every shard and are worked on in blocks; a shard answers with its ``k`` best for each
query. A task holds a shard and a block at a time, and what is merged is ``k`` rows for each query and
shard.

Defined results: a vector that is null, empty, or holds a null or a non-finite component takes no part;
of rows that repeat an id the one with the smallest components counts; shorter vectors are filled up
with zeros; equal scores go to the smaller id; a query is never its own candidate; other columns are
ignored; scores beyond the range of a long are its ends, and components too large for exact sums in
doubles are scored in endless whole numbers; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow, reader_slots
from tidings.session import materialize

SCALE = 64
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
#: Segments of a shard; the bounds between them halve.
SEGMENTS = 4
#: Share of a shard's vectors that may be left over for exact scoring; more are read on.
RESCORED = 0.02


def quantised(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: components times ``SCALE``, rounded down, of the vectors that take part."""
    exact = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = (F.size(vector) > 0) & F.forall(
        exact, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf"))
    )
    # A whole number may be too large for a long; a double holds each of them.
    whole = F.transform(exact, lambda x: x * SCALE - F.pmod(x * SCALE, F.lit(1.0)))
    valid = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(usable)
    return valid.select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))


class Shard:
    """The segments of some vectors, in descending order of impact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, segments: int = SEGMENTS) -> None:
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors)
        top = float(size.max(initial=0.0))
        #: Components of a segment are larger than its bound; the last one's bound is zero.
        self.bounds = [top / 2 ** (k + 1) for k in range(segments - 1)] + [0.0]
        self.planes, self.rests = [], []
        above = np.inf
        for bound in self.bounds:
            inside = (size > bound) & (size <= above)
            self.planes.append(np.where(inside, vectors, 0.0).astype(vectors.dtype))
            rest = np.where(size <= bound, vectors, 0.0)
            self.rests.append(np.sqrt(np.einsum("ij,ij->i", rest, rest, dtype=np.float64)))
            above = bound

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        """``(query, ids, scores)`` of each query's best ``k``, best first."""
        n = len(self.ids)
        order = np.argsort(ids)
        own = order[np.minimum(np.searchsorted(ids[order], self.ids), len(ids) - 1)]
        same = np.flatnonzero(ids[own] == self.ids)
        scores = np.zeros((len(ids), n), queries.dtype)
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries, dtype=np.float64))
        open_rows = np.arange(len(ids))
        few = max(4 * k, int(RESCORED * n))
        for plane, rest in zip(self.planes, self.rests):
            scores[open_rows] += queries[open_rows] @ plane.T
            scores[own[same], same] = -np.inf
            done = []
            for row in open_rows:
                found = scores[row]
                if n <= few or not rest.any():
                    yield self._best(row, ids, queries, np.flatnonzero(found > -np.inf), k)
                    done.append(row)
                    continue
                # The k best so far, scored exactly, are a floor for the k-th score.
                ahead = np.argpartition(found, n - k)[n - k :]
                ahead = ahead[found[ahead] > -np.inf]
                if len(ahead) < k:
                    continue
                floor = (self.vectors[ahead] @ queries[row]).min()
                reach = lengths[row] * rest * (1 + 1e-6) + 1e-3
                possible = np.flatnonzero(found + reach >= floor)
                if len(possible) <= few:
                    yield self._best(row, ids, queries, possible, k)
                    done.append(row)
            open_rows = np.setdiff1d(open_rows, done)
            if not len(open_rows):
                return
        for row in open_rows:
            yield self._best(row, ids, queries, np.flatnonzero(scores[row] > -np.inf), k)

    def _best(self, row: int, ids: np.ndarray, queries: np.ndarray, possible: np.ndarray, k: int):
        exact = self.vectors[possible] @ queries[row]
        if len(exact) > k:
            # All that tie with the k-th stay until the ids decide.
            kth = np.partition(exact, len(exact) - k)[len(exact) - k]
            possible, exact = possible[exact >= kth], exact[exact >= kth]
        best = np.lexsort((self.ids[possible], -exact))[:k]
        return ids[row], self.ids[possible[best]], exact[best]


def _matrix(flat: list[np.ndarray], least: int) -> np.ndarray:
    """Vectors filled up with zeros, to ``least`` components at least."""
    width = max(least, max(len(x) for x in flat))
    out = np.zeros((len(flat), width))
    for k, x in enumerate(flat):
        out[k, : len(x)] = x
    return out


def _answer(k: int):
    """Rows sorted by shard, each shard's vectors before the queries that are put to it."""

    def answers(shard: Shard, ids: list[int], asked: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        queries = _matrix(asked, shard.vectors.shape[1])[:, : shard.vectors.shape[1]]
        largest = np.abs(queries).max() * np.abs(shard.vectors).max() * queries.shape[1]
        if largest >= 2.0**53:
            yield from exactly(shard, ids, queries)
            return
        if largest >= 2.0**24 and shard.vectors.dtype == np.float32:
            shard = Shard(shard.ids, shard.vectors.astype(np.float64))
        found = list(shard.search(np.array(ids), queries.astype(shard.vectors.dtype), k))
        if found:
            counts = [len(f[1]) for f in found]
            columns = [
                pa.array(np.repeat([f[0] for f in found], counts)),
                pa.array(np.concatenate([f[1] for f in found])),
                pa.array(np.concatenate([f[2] for f in found]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    def exactly(shard: Shard, ids: list[int], queries: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All vectors in endless whole numbers, where a double does not hold the sums."""
        stored = [[int(x) for x in v] for v in shard.vectors]
        for query, vector in zip(ids, queries):
            whole = [int(x) for x in vector]
            scores = (
                (-min(max(sum(a * b for a, b in zip(whole, v)), -(2**63)), 2**63 - 1), i)
                for i, v in zip(shard.ids.tolist(), stored) if i != query
            )
            best = heapq.nsmallest(k, scores)
            columns = [[query] * len(best), [i for _, i in best], [-s for s, _ in best]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
            )

    def built(ids: list[int], vectors: list[np.ndarray]) -> Shard:
        stored = _matrix(vectors, 1)
        exact = np.abs(stored).max() < 2.0**24
        return Shard(np.array(ids), stored.astype(np.float32 if exact else np.float64))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            places, asks, names = (batch.column(c).to_pylist() for c in range(3))
            for place, ask, name, v in zip(places, asks, names, batch.column(3)):
                if place != at or ask and shard is None or len(ids) >= BLOCK_ROWS and shard:
                    if shard and ids:
                        yield from answers(shard, ids, vectors)
                    elif ids and place == at:
                        shard = built(ids, vectors)
                    if place != at:
                        at, shard = place, None
                    ids, vectors = [], []
                if ask and shard is None:
                    continue  # a shard without vectors
                ids.append(name)
                vectors.append(np.array(v.values))
        if shard and ids:
            yield from answers(shard, ids, vectors)

    return compute


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` best of ``index`` for each query.

    Both frames have ``(vec_id, v)`` as ``quantised`` makes them.
    """
    stored, asked = (
        materialize(x.groupBy("vec_id").agg(F.min("v").alias("v")), name)
        for x, name in ((index, "vectors"), (queries, "queries"))
    )
    shards = max(1, -(-stored.count() // SHARD_ROWS))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    held = stored.select(own.alias("shard"), F.lit(False).alias("asks"), "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    sent = asked.select(every.alias("shard"), F.lit(True).alias("asks"), "vec_id", "v")
    dealt = held.unionByName(sent).repartition(max(shards, reader_slots(index.sparkSession)), "shard")
    ordered = dealt.sortWithinPartitions("shard", "asks")
    found = map_arrow(ordered, _answer(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
