"""Set operations: union by name, side stacking in one scan, distinct key unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``unionByName`` over a list (columns matched by name, not position)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def stack_sides(df: DataFrame, keys: Sequence[str], columns: dict[str, tuple[str, str]],
                side_col: str | None = None) -> DataFrame:
    """Turn each (home, away) row into two rows with side-neutral columns, in one scan.

    ``columns`` maps an output name to its (home column, away column). The side is a boolean
    ``is_home`` column, or a 'home'/'away' string column named ``side_col``.
    """
    def side(is_home: bool):
        vals = [F.col(h if is_home else a).alias(n) for n, (h, a) in columns.items()]
        flag = F.lit("home" if is_home else "away").alias(side_col) if side_col else F.lit(is_home).alias("is_home")
        return F.struct(*vals, flag)

    return df.select(*keys, F.explode(F.array(side(True), side(False))).alias("_s")).select(*keys, "_s.*")


def distinct_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct union of the key columns of every frame (one shuffle, after map-side distinct)."""
    return union_by_name([f.select(*keys) for f in frames]).distinct()


def editions(df: DataFrame) -> list[tuple[int, int]]:
    """The (competition, season) pairs that a table has, in order: a short list, read from the data."""
    return sorted((r[0], r[1]) for r in df.select("competition_id", "season_id").where(
        "competition_id IS NOT NULL AND season_id IS NOT NULL").distinct().collect())
