"""Generic column and frame helpers: safe ratios, zero fill, optional columns, role prefixes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x: str | Column, digits: int) -> Column:
    """Half-up rounding of a double that first removes floating noise (round to 9 places).

    A mean like 57.725 may come out as 57.72499999999999 or 57.72500000000001 depending on the
    summation order; rounding to 9 places first makes ``rnd(x, 2)`` give 57.73 either way.
    """
    return F.round(F.round(c(x), 9), digits)


def pct(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    """``round(num / den * 100, digits)``; null when the denominator is 0 or null."""
    return F.when(c(den) > 0, rnd(c(num) / c(den) * 100, digits))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` that is null instead of failing on a zero denominator."""
    return F.try_divide(c(num).cast("double"), c(den).cast("double"))


def zero_fill(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace nulls by 0 in the named columns only; the other columns keep their nulls."""
    present = [x for x in cols if x in df.columns]
    return df.fillna(0, subset=present) if present else df


def col_or_null(df: DataFrame, name: str, dtype: str | DataType = "string") -> Column:
    """The column when the frame has it, otherwise a typed null under the same name."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype).alias(name)


def with_optional(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add every missing column of ``spec`` (name -> type) as a typed null."""
    missing = [F.lit(None).cast(t).alias(n) for n, t in spec.items() if n not in df.columns]
    return df.select("*", *missing) if missing else df


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[x for x in cols if x in df.columns])


def drop_like(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name matches the regular expression (for example audit columns ``^_``)."""
    rx = re.compile(pattern)
    return df.drop(*[x for x in df.columns if rx.search(x)])


def as_role(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column (except ``keep``) so one dimension can be joined in two roles (home_/away_)."""
    return df.select(*[F.col(x).alias(x if x in keep else f"{prefix}{x}") for x in df.columns])


def side_diff(cols: Sequence[str], left: str = "home_", right: str = "away_", suffix: str = "_diff") -> list[Column]:
    """``home_x - away_x`` for every x, named ``x_diff``."""
    return [(F.col(f"{left}{x}") - F.col(f"{right}{x}")).alias(f"{x}{suffix}") for x in cols]


def slug(col: str | Column) -> Column:
    """Lower case, spaces to underscores (identifiers built from names)."""
    return F.regexp_replace(F.lower(F.trim(c(col))), r"\s+", "_")


def sanitise_name(name: str) -> str:
    """Column-name clean-up applied to flattened two-level headers: space, /, %, -, : to safe text."""
    out = name.strip().lower()
    for a, b in ((" ", "_"), ("/", "_per_"), ("%", "_pct"), ("-", "_"), (":", "_")):
        out = out.replace(a, b)
    return re.sub(r"_+", "_", out).strip("_")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so sums whose order depends on partitioning compare stably."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
