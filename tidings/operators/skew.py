"""Joins whose large side may have hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidings.session import materialize

PIECES = 8
#: Rows of a key from which it is heavy, and rows of a piece of it.
SPLIT_ROWS = 100_000
#: Keys that a sketch reports at most, and keys that it follows at a time.
TOP_KEYS = 1_000
TRACKED_KEYS = 10_000


def materialize_sketched(
    df: DataFrame, name: str, columns: Sequence[str]
) -> tuple[DataFrame, dict[str, dict[int, int]]]:
    """``df`` as a table in the work folder, and the most frequent values of some columns.

    A frequent-items sketch is kept while the rows are written: no further pass, and a few thousand
    counts for each task. Every value with more than some thousandth of the rows is found.
    """
    sketch = Observation()
    counts = [
        F.expr(f"approx_top_k({c}, {TOP_KEYS}, {TRACKED_KEYS})").alias(c) for c in columns
    ]
    stored = materialize(df.observe(sketch, *counts), name)
    found = sketch.get
    return stored, {
        c: {row["item"]: row["count"] for row in found.get(c) or []} for c in columns
    }


def heavy_pieces(*counts: Mapping[int, int]) -> dict[int, int]:
    """Pieces of each key whose counts together reach ``SPLIT_ROWS``, the heaviest keys only."""
    total: dict[int, int] = {}
    for found in counts:
        for key, count in found.items():
            total[key] = total.get(key, 0) + count
    heaviest = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:TOP_KEYS]
    return {key: -(-count // SPLIT_ROWS) for key, count in heaviest if count > SPLIT_ROWS}


def join_spread(
    big: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    how: str = "inner",
    pieces: int = PIECES,
    heavy: Mapping[int, int] | None = None,
) -> DataFrame:
    """Join ``big`` to a side with one row per key, with hot keys cut into pieces.

    The unique side is usually an aggregate on the same key. Spark would then reuse its
    partitioning, and the skew join, which needs a plain shuffle on both sides, could not split
    a hot key. The piece number spreads the rows of a key over several tasks and puts a plain
    shuffle on both sides. A unique side that turns out small at run time is still broadcast.

    ``heavy`` has the pieces of each heavy key of a single key column, at most ``TOP_KEYS`` of them; only
    these are cut, and only their unique rows are copied. Without it all keys are cut alike.
    """
    if heavy is not None and not heavy:
        return big.join(unique, list(keys), how)
    split = F.lit(pieces)
    if heavy is not None:
        kind = dict(big.dtypes)[keys[0]]
        rows = [(key, count) for key, count in sorted(heavy.items())[:TOP_KEYS]]
        # At most TOP_KEYS rows.
        table = F.broadcast(big.sparkSession.createDataFrame(rows, f"{keys[0]} {kind}, _pieces int"))
        big, unique = (side.join(table, keys[0], "left") for side in (big, unique))
        split = F.coalesce("_pieces", F.lit(1))
    piece = F.pmod(F.xxhash64(spread_by), split).cast("int")
    copies = F.explode(F.sequence(F.lit(0), split - 1))
    big, unique = big.withColumn("_piece", piece), unique.withColumn("_piece", copies)
    if heavy is not None:
        big, unique = big.drop("_pieces"), unique.drop("_pieces")
    return big.join(unique, [*keys, "_piece"], how).drop("_piece")
