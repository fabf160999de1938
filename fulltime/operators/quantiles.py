"""Exact quantiles of many columns at once: radix selection over order-preserving 64-bit keys.

Every value becomes a whole number of 64 bits that orders as the values do. A pass counts the next 16 bits of the
keys that agree with what is known of each wanted rank, for all columns and ranks together, and so fixes 16 more
bits of every answer: four passes, whatever the size, the ranks and the distribution. A pass is one aggregate
of at most 2^16 counts for each column and known prefix; the driver gets one row a wanted rank. The rows are dealt
out and their keys stored before the passes, so those neither hang on the partitions that the rows come in nor work
out a key twice.
"""

from __future__ import annotations

import decimal
import struct
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fulltime.session import stored

#: Bits fixed by a pass.
BITS = 16
PASSES = 64 // BITS


def _with_key(df: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with the bits of the double ``x`` as a whole number, those of negative ones counted down: it orders as
    doubles do.

    A normal size is m * 2^e with 2^52 <= m < 2^53, found by exact products with powers of two (in two steps, as
    one factor may be out of range). Both zeros are one; NaN is the largest value, as in Spark's own order.
    """
    keep = [f"`{c}`" for c in df.columns]
    finite = "_a > 0 AND _a < double('inf')"
    return (df.selectExpr(*keep, f"abs(`{x}`) AS _a")
            .selectExpr(*keep, "_a", f"CASE WHEN {finite} THEN cast(floor(log2(_a)) AS int) END AS _e")  # may be one off next to a power of two
            .selectExpr(*keep, "_a", "CASE WHEN power(2D, _e) > _a THEN _e - 1 WHEN power(2D, _e + 1) <= _a THEN _e + 1 ELSE _e END AS _e")
            .selectExpr(*keep, "_a", "_e", "CASE WHEN _e < -1022 THEN 1074 ELSE 52 - _e END AS _shift")
            .selectExpr(*keep, "_a", "_e", f"CASE WHEN {finite} THEN cast(_a * power(2D, _shift div 2) * power(2D, _shift - _shift div 2) AS bigint) END AS _m")
            .selectExpr(*keep, f"CASE WHEN isnan(_a) THEN {2**63 - 1}L WHEN _a = 0 THEN 0L WHEN _a = double('inf') THEN {2047 << 52}L WHEN _e < -1022 THEN _m"
                               f" ELSE (_e + 1023L) * {1 << 52}L + (_m - {1 << 52}L) END AS _size")
            .selectExpr(*keep, f"CASE WHEN `{x}` < 0 THEN -_size ELSE _size END AS `{out}`"))


def _double_of(key: int) -> float:
    return float("nan") if key == 2**63 - 1 else struct.unpack("<d", struct.pack("<q", abs(key)))[0] * (1 if key >= 0 else -1)


def _number(c: str, kind: T.DataType):
    """A column as double or as whole number (SQL; one of the two, the other null), and what turns a key into its value."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"cast(`{c}` AS double)", "cast(NULL AS bigint)", _double_of
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return "cast(NULL AS double)", f"cast(cast(`{c}` AS decimal(38,18)) * {10**kind.scale}L AS bigint)", lambda k: decimal.Decimal(k).scaleb(-kind.scale)
    if isinstance(kind, T.IntegralType):
        return "cast(NULL AS double)", f"cast(`{c}` AS bigint)", int
    raise TypeError(f"no quantiles of {kind.simpleString()}")


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], object]:
    """For each column and share q the least value that ceil(q * n) of its n non-null values don't exceed; None
    for a column without values. ``df`` is read once."""
    cells = [(c, q) for c, qs in wanted.items() for q in qs]
    out: dict[tuple[str, float], object] = dict.fromkeys(cells)
    if not cells:
        return out
    place = {c: i for i, c in enumerate(wanted)}
    double, whole, back = zip(*[_number(c, df.schema[c].dataType) for c in wanted])
    cols = ", ".join(f"named_struct('c', {i}, 'd', {d}, 'w', {w})" for i, (d, w) in enumerate(zip(double, whole)))
    # a wide table of few rows may come in one task, with many values in each row
    spread = df.select(*[f"`{c}`" for c in wanted]).hint("rebalance")
    each = spread.selectExpr(f"inline(array({cols}))").where("d IS NOT NULL OR w IS NOT NULL")
    each = stored(_with_key(each, "d", "k").selectExpr("c", "coalesce(w, k) AS k"), "quantile-keys")  # once for all columns
    # wanted ranks of each column: what is known of their key so far, and the rank among the values that agree with it
    todo = [(i, place[c], 0, None, float(q)) for i, (c, q) in enumerate(cells)]
    for done in range(0, 64, BITS):
        if not todo:  # no values at all
            break
        ranks = "array(" + ", ".join("array(" + ", ".join(
            f"named_struct('cell', {cell}, 'known', {known}L, 'rank', cast({'NULL' if rank is None else rank} AS bigint), 'q', {q!r}D)"
            for cell, c, known, rank, q in todo if c == i) + ")" for i in range(len(place))) + ")"
        mine = f"filter(get({ranks}, c), r -> r.known = known)"
        known = f"shiftright(k, {64 - done})" if done else "0L"
        digit = f"shiftright(k, {64 - BITS - done})" + (f" & {(1 << BITS) - 1}" if done else "")
        # each key only looks its prefix up in constants; the ranks themselves are matched to the few counts
        asked = "array(" + ", ".join(
            "cast(array(" + ", ".join(f"{x}L" for x in sorted({t[2] for t in todo if t[1] == i})) + ") AS array<bigint>)" for i in range(len(place))) + ")"
        counts = (each.selectExpr("c", f"{known} AS known", f"{digit} AS digit").where(f"array_contains(get({asked}, c), known)")
                  .groupBy("c", "known", "digit").count())
        # 2^16 digits of a column and prefix at most
        placed = counts.selectExpr("*", "sum(count) OVER (PARTITION BY c, known) AS all",
                                   "sum(count) OVER (PARTITION BY c, known ORDER BY digit ROWS UNBOUNDED PRECEDING) AS upto")
        hit = placed.selectExpr("c", "known", "digit", "count", "all", "upto", f"inline({mine})").toDF(
            "c", "known", "digit", "count", "all", "upto", "cell", "same", "rank", "q")
        hit = hit.selectExpr("cell", "c", "known", "digit", "upto", "count", "q", "coalesce(rank, greatest(1L, ceil(q * all - 1e-9D))) AS rank")
        rows = hit.where("upto >= rank AND upto - count < rank").selectExpr(  # a row a wanted rank
            "cell", "c", "known", "digit", "rank - upto + count AS rank", "q").collect()
        todo = [(r["cell"], r["c"], (r["known"] << BITS) + r["digit"] if done else r["digit"], r["rank"], r["q"]) for r in rows]
    return out | {cells[cell]: back[c](key) for cell, c, key, _, _ in todo}
