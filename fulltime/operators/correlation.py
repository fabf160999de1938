"""Correlation matrix of many columns from mergeable co-moments, in one pass over the rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of this module run in Python workers, which need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = "part long, n long, mean array<double>, m array<double>"
#: Groups that the tasks' moments are merged in before the driver merges the groups'.
GROUPS = 64

Moments = tuple[int, np.ndarray, np.ndarray]  # rows, means, sums of products of deviations from them


def merged(a: Moments | None, b: Moments) -> Moments:
    """Moments of the rows of both."""
    if a is None or not a[0]:
        return b
    if not b[0]:
        return a
    n, d = a[0] + b[0], b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _moments(x: np.ndarray) -> Moments:
    mean = x.mean(axis=0)
    return len(x), mean, (x - mean).T @ (x - mean)


def _row(part: int, m: Moments) -> dict:
    return {"part": [part], "n": [m[0]], "mean": [m[1].tolist()], "m": [m[2].ravel().tolist()]}


def _of(n: int, mean: list[float], m: list[float]) -> Moments:
    return n, np.array(mean), np.array(m).reshape(len(mean), len(mean))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, corr, rows): Pearson correlation of every pair of columns, ``col_a`` before ``col_b`` in ``cols``.

    A row with a null or NaN in any of the columns is left out of all pairs, so the matrix is that of one set of
    rows. Null where a column doesn't vary or fewer than two rows are left. A task sends one small matrix, its
    moments about its own means; these are merged in groups, then on the driver (``GROUPS`` matrices at most).
    """
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    for i in range(len(cols)):
        x = x.where(F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}"))
    arrow = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("m", pa.list_(pa.float64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total: Moments | None = None
        for b in batches:
            if b.num_rows:
                total = merged(total, _moments(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])))
        if total is not None:
            yield pa.RecordBatch.from_pydict(_row(TaskContext.get().partitionId() % GROUPS, total), schema=arrow)

    def group(table: pa.Table) -> pa.Table:
        total: Moments | None = None
        for r in table.to_pylist():
            total = merged(total, _of(r["n"], r["mean"], r["m"]))
        return pa.Table.from_pydict(_row(table.column("part")[0].as_py(), total), schema=arrow)

    rows = x.mapInArrow(task, PARTS).groupBy("part").applyInArrow(group, PARTS).collect() if cols else []
    total: Moments | None = None
    for r in sorted(rows, key=lambda r: r["part"]):
        total = merged(total, _of(r["n"], r["mean"], r["m"]))
    n, m = (total[0], total[2]) if total else (0, np.zeros((len(cols), len(cols))))
    out = []
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            both = float(m[i, i]) ** 0.5 * float(m[j, j]) ** 0.5
            out.append((a, cols[j], max(-1.0, min(1.0, float(m[i, j]) / both)) if n > 1 and both > 0 else None, n))
    return df.sparkSession.createDataFrame(out, "col_a string, col_b string, corr double, rows long")
