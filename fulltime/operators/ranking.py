"""Ranking helpers that stay safe when one group holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Number of sub-groups a hot group is split into before the final top-k.
DEFAULT_SALTS = 16


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int,
    unique_key: str | Sequence[str],
    salts: int = DEFAULT_SALTS,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of every group under ``order`` (a total order: include a unique tie-break).

    Two steps: a top-k inside (group, salt) where the salt hashes the unique key, then a top-k
    over at most ``k * salts`` survivors per group. A group with a third of all rows is sorted
    by ``salts`` tasks instead of one. ``rank_col`` adds the 1-based position.
    """
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(salts))
    local = Window.partitionBy(*by, "_salt").orderBy(*order)
    final = Window.partitionBy(*by).orderBy(*order)
    out = (
        df.withColumn("_salt", salt)
        .withColumn("_rn", F.row_number().over(local))
        .filter(F.col("_rn") <= k)
        .withColumn("_rn", F.row_number().over(final))
        .filter(F.col("_rn") <= k)
        .drop("_salt")
    )
    if rank_col:
        return out.withColumnRenamed("_rn", rank_col)
    return out.drop("_rn")


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """SQL ``rank()`` (ties share a rank) inside each group; used on aggregated tables (one row per team)."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
