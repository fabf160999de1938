"""Nearest neighbours by inner product from a forest of random-projection trees.

Equal vectors are one node (with its least ids), so a vector that stands in many rows is searched once.
Each tree halves a bounded sample of the nodes again and again: the direction is the difference of two
sample points, the border the median. Vectors get one more component that makes all norms equal, which
turns the largest inner product into the nearest direction. The trees, all of fixed size, go to every
task; every node is put in its leaf of every tree.

A query walks all trees through one priority queue: the place with the widest least margin on its way
comes first, whichever tree it is in, until the leaves it has met hold ``search`` times as many entries
as there are nodes (a node counts once in each tree). Leaves stand together in blocks of bounded size; a
block returns a query's best nodes among the leaves it asked for, scored again with a sum that does not
hang on the block. The best of all blocks are the answer.

Where vectors show no structure, as random ones don't, no index spares much: recall of 0.9 takes about
half of the rows there, and ``search`` is set for that case. Where they do, a bound on the entries looked
at (``most_rows``) keeps a query's cost the same at any size.

Defined results: rows of null id, and vectors null, empty, zero, or holding null or non-finite components
take no part, nor do vectors of another length than the most common one (ties: the shorter); rows that
repeat an id count once (the least vector); fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import map_arrow, shared_object, stored
from fulltime.operators.ranking import top_k_per_group

TREES = 4
#: Entries a leaf should have, most levels of a tree, sample points a leaf, rows a block should have.
LEAF, LEVELS, POINTS, BLOCK = 512, 12, 64, 8192


class Forest:
    """Random-projection trees over a sample of vectors, each a complete binary tree."""

    def __init__(self, sample: np.ndarray, top: float, levels: int, trees: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.levels, self.top = levels, top
        pts = self.lift(sample)
        inner = (1 << levels) - 1
        self.normal = np.zeros((trees, inner, pts.shape[1]), np.float32)
        self.border = np.zeros((trees, inner), np.float32)
        for t in range(trees):
            own = {0: np.arange(len(pts))}
            for n in range(inner):
                i = own.pop(n)
                if len(i) > 1:
                    a, b = rng.choice(i, 2, replace=False)
                    way = pts[a] - pts[b]
                else:
                    way = rng.standard_normal(pts.shape[1])
                way = (way / (np.linalg.norm(way) or 1.0)).astype(np.float32)
                along = pts[i] @ way
                self.normal[t, n], self.border[t, n] = way, np.median(along) if len(i) else 0.0
                right = along > self.border[t, n]
                own[2 * n + 1], own[2 * n + 2] = i[~right], i[right]

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Data vectors with the component that brings their norm to the greatest one."""
        x = x.astype(np.float32)
        rest = np.maximum(self.top ** 2 - (x.astype(np.float64) ** 2).sum(1), 0.0)
        return np.c_[x, np.sqrt(rest).astype(np.float32)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Signed distances from every border: vectors x trees x inner places."""
        flat = self.normal.reshape(-1, self.normal.shape[2])
        return (x @ flat.T - self.border.ravel()).reshape(len(x), *self.border.shape)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each data vector in each tree."""
        m = self.margins(self.lift(x))
        at = np.zeros(m.shape[:2], np.int64)
        row, tree = np.indices(at.shape)
        for _ in range(self.levels):
            at = 2 * at + 1 + (m[row, tree, at] > 0)
        return at - self.border.shape[1]

    def probes(self, margin: np.ndarray, size: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """Leaves a query looks into, best first, through one queue for all trees."""
        inner, out, met = self.border.shape[1], [], 0
        queue = [(-np.inf, t, 0) for t in range(len(self.border))]
        heapq.heapify(queue)
        ways = margin.tolist()
        while queue and met < enough:
            worst, t, n = heapq.heappop(queue)
            if n >= inner:
                if size[t, n - inner]:
                    out.append((t, n - inner))
                    met += size[t, n - inner]
                continue
            m = ways[t][n]
            heapq.heappush(queue, (max(worst, m), t, 2 * n + 1))
            heapq.heappush(queue, (max(worst, -m), t, 2 * n + 2))
        return out


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order wherever it stands."""
    return np.array([np.add.reduce(np.ascontiguousarray(a * q)) for a in x.astype(np.float64)])


def _usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = F.col(embedding).cast("array<float>")
    ok = (F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
          & F.exists(v, lambda c: c != 0))
    # 0.0 and -0.0 are one value
    return (rows.where(ok).select(F.col(vec_id).cast("long").alias("id"), F.transform(v, lambda c: c + F.lit(0.0).cast("float")).alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def nearest(rows: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, search: float = 1.6,
            most_rows: int | None = None, vec_id: str = "vec_id", embedding: str = "embedding", sample: int = 1 << 15) -> DataFrame:
    """The ``k`` nearest found for each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    ids = stored(_usable(rows, vec_id, embedding), "vectors")
    lengths = sorted((-r[1], r[0]) for r in ids.groupBy(F.size("v")).count().collect())
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    ids = ids.where(F.size("v") == lengths[0][1])
    least = top_k_per_group(ids, ["v"], [F.col("id")], k + 1, "id")
    nodes = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("node", F.col("ids")[0])
    nodes = stored(nodes.join(ids.where(F.pmod("id", F.lit(every)) == 0).select("v").distinct().withColumn("asks", F.lit(True)), "v", "left")
                   .select("node", "ids", F.col("asks").isNotNull().alias("asks"),
                           F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c).alias("norm2"), "v"), "nodes")
    total, top2 = nodes.agg(F.count(F.lit(1)), F.max("norm2")).first()
    levels = int(min(LEVELS, max(1, np.ceil(np.log2(total / LEAF)))))
    points = min(sample, POINTS << levels)
    fit = np.array([r[0] for r in nodes.orderBy(F.xxhash64("node"), "node").limit(points).select("v").collect()], np.float32)
    top = float(np.sqrt(top2))
    forest = Forest(fit, top, levels, trees)
    shared = shared_object(spark, forest)

    def vectors(b: pa.RecordBatch) -> np.ndarray:
        return b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                x = vectors(b)
                leaf = shared().leaves(x)
                raw = [r.tobytes() for r in x]
                for t in range(trees):
                    yield {"tree": np.full(len(x), t, np.int32), "leaf": leaf[:, t], "node": b.column("node"), "x": raw}

    placed = stored(map_arrow(nodes.select("node", "v"), place, "tree int, leaf int, node long, x binary"), "leaves")
    size = np.zeros((trees, 1 << levels), np.int64)
    for t, leaf, n in placed.groupBy("tree", "leaf").count().collect():
        size[t, leaf] = n
    enough = min(search * total, most_rows or np.inf)
    together = max(1, BLOCK * (1 << levels) // int(total))  # leaves of a block
    groups = -(-(1 << levels) // together)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                x = vectors(b)
                m = shared().margins(np.c_[x, np.zeros(len(x), np.float32)])
                for q, raw, own in zip(b.column("node").to_pylist(), x, m):
                    met: dict[int, list[int]] = {}
                    for t, leaf in shared().probes(own, size, enough):
                        met.setdefault(t * groups + leaf // together, []).append(leaf)
                    yield {"block": list(met), "query": [q] * len(met), "leaves": list(met.values()), "x": [raw.tobytes()] * len(met)}

    asked = stored(map_arrow(nodes.where("asks").select("node", "v"), ask, "block int, query long, leaves array<int>, x binary"), "probes")
    # a block with more rows than meant, or asked by more queries, is split
    most = asked.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    per_block = np.add.reduceat(size, np.arange(0, 1 << levels, together), axis=1).max()
    q_parts, n_parts = max(1, -(-int(most) // BLOCK)), max(1, -(-int(per_block) // (2 * BLOCK)))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qp", deal("query", q_parts)).withColumn("np", all_of(n_parts))
    block = (F.col("tree") * groups + F.floor(F.col("leaf") / together)).cast("int")
    right = placed.withColumn("block", block).withColumn("np", deal("node", n_parts)).withColumn("qp", all_of(q_parts))

    def meet(qs: pd.DataFrame, ns: pd.DataFrame) -> pd.DataFrame:
        query, nodes_, scores = [], [], []
        if len(qs) and len(ns):
            ns = ns.sort_values(["leaf", "node"])
            x = np.frombuffer(b"".join(ns["x"]), np.float32).reshape(len(ns), -1)
            node, leaf = ns["node"].to_numpy(), ns["leaf"].to_numpy()
            for at in range(0, len(qs), 256):
                some = qs.iloc[at:at + 256]
                q = np.frombuffer(b"".join(some["x"]), np.float32).reshape(len(some), -1)
                near = q @ x.T
                for i, (name, leaves) in enumerate(zip(some["query"], some["leaves"])):
                    own = np.flatnonzero(np.isin(leaf, leaves)) if len(leaves) < together else np.arange(len(leaf))
                    if not len(own):
                        continue
                    got, want = near[i, own], min(k + 1, len(own))
                    edge = np.partition(got, len(own) - want)[len(own) - want]
                    own = own[got >= edge - 1e-5 * top * float(np.linalg.norm(q[i]))]  # single precision picks, double precision ranks
                    score = _exact(x[own], q[i].astype(np.float64))
                    order = np.lexsort((node[own], -score))[:want]
                    query.append(name)
                    nodes_.append(node[own][order].tolist())
                    scores.append(score[order].tolist())
        return pd.DataFrame({"query": pd.Series(query, dtype="int64"), "nodes": pd.Series(nodes_, dtype=object),
                             "scores": pd.Series(scores, dtype=object)})

    keys = ["block", "np", "qp"]
    found = left.groupBy(*keys).cogroup(right.select(*keys, "leaf", "node", "x").groupBy(*keys)).applyInPandas(
        meet, "query long, nodes array<long>, scores array<double>")
    found = found.groupBy("query").agg(F.collect_list(F.struct("nodes", "scores")).alias("parts"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for q, parts in zip(b.column("query").to_pylist(), b.column("parts").to_pylist()):
                all_ = {n: s for p in parts for n, s in zip(p["nodes"], p["scores"])}
                rows = sorted((-s, n) for n, s in all_.items())[:k + 1]
                yield {"query": [q] * len(rows), "node": [n for _, n in rows], "score": [-s for s, _ in rows]}

    lists = (map_arrow(found, best, "query long, node long, score double").join(nodes.select("node", "ids"), "node").groupBy("query")
             .agg(F.collect_list(F.struct("score", "ids")).alias("found")))
    asks = ids.where(F.pmod("id", F.lit(every)) == 0).join(nodes.where("asks").select("v", "node"), "v").select("id", "node")
    met = asks.join(lists, asks.node == lists["query"]).select("id", "found")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for q, got in zip(b.column("id").to_pylist(), b.column("found").to_pylist()):
                rows = sorted((-f["score"], i) for f in got for i in f["ids"] if i != q)[:k]
                yield {"query_id": [q] * len(rows), "rank": list(range(1, len(rows) + 1)), "vec_id": [i for _, i in rows],
                       "score": [-s for s, _ in rows]}

    return map_arrow(met, rank, schema)
