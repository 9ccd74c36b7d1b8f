"""Numbering the rows of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLOT_DIGITS = 3


def number_within(df: DataFrame, group: str, key: str, name: str) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by ``key``.

    ``key`` is a hex digest. Its first digits cut a group into 4096 even slots, numbered
    separately; the sizes of the slots before give the offset. So a group that holds a third
    of all rows is spread over 4096 pieces, and no window sees more than one piece or one row
    per slot.
    """
    slotted = df.withColumn("_slot", F.substring(key, 1, _SLOT_DIGITS))
    sizes = slotted.groupBy(group, "_slot").agg(F.count(F.lit(1)).alias("_size"))
    earlier = (
        Window.partitionBy(group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        group, "_slot", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy(group, "_slot").orderBy(key)
    numbered = slotted.withColumn("_number", F.row_number().over(within))
    return numbered.join(offsets, [group, "_slot"]).select(
        *df.columns, (F.col("_offset") + F.col("_number")).cast("long").alias(name)
    )
