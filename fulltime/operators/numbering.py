"""Running numbers over a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulltime.session import stored

#: Low bits of ``monotonically_increasing_id``: the row's place within its partition.
_PLACE = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "number", first: int = 0) -> DataFrame:
    """``df`` with the running number of every row in the given order, from ``first``.

    Rows are dealt out by ranges of the order and sorted within them; the table is stored with the range
    and the place in it of every row, and the rows of the ranges before (one small row a range) are added.
    Rows that tie in every column of ``order`` get different numbers in any order; nulls come first (or as
    the order's own expressions say). A range holds all rows that tie, so order by enough columns to tell
    rows apart.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stored(dealt.select("*", F.spark_partition_id().alias("_range"),
                               F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place")), "numbered")
    ranges = held.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # as many rows as shuffle partitions: always small enough to broadcast
    return held.join(F.broadcast(starts), "_range").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_place") + F.lit(first)).cast("long").alias(name))
