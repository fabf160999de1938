"""Mixing sources to target weights, by blocks of words drawn into output shards.

The words of a source, document after document, are cut into blocks of ``block`` words; a document lies
in one block or several, and may share them with its neighbours. Each source gets a number of slots from
its target; the slots are dealt over the output shards by multinomial draws on what is still to be dealt,
so shards are mixed at random and the totals come out exactly. Slot k of a source holds block
``perm(k mod blocks)`` of pass ``k div blocks``, with a pseudorandom permutation of its own for each
source and pass; slots and blocks meet in a join on (source, block index). A source's slots never pass
``most`` times its blocks, so no document is taken more often than that.

Nothing but one row for each source (name, words) and the draws (shards x sources numbers) is on the
driver; offsets of documents are prefix sums over hashed buckets of each source, so a source that holds a
third of all rows is spread over ``BUCKETS`` groups. All draws hang on ``seed``: reruns agree.

Defined results: null text counts no words; documents without words are in no block (taken 0); null is a
source of its own, after all others; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulltime.llm.common import WORD, map_arrow, stored

#: Groups that the documents of each source are hashed to for prefix sums.
BUCKETS = 1024
BLOCK_WORDS = 64
SHARDS = 256


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words to take from each source: by weight, none above ``most`` times its size, the excess reshared."""
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def slots_of(size: int, target: float, block: int) -> tuple[int, int]:
    """Blocks of a source, and the slots that bring it nearest to its target."""
    blocks = -(-size // block)
    return blocks, round(target / size * blocks) if size else 0


def draws(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws from what is left, all dealt at the end."""
    rng, left = np.random.default_rng(seed), np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for j in range(shards):
        todo = int(left.sum()) // (shards - j)
        while todo:
            got = np.minimum(rng.multinomial(todo, left / left.sum()), left)
            out[j] += got
            left -= got
            todo -= int(got.sum())
    return out


def permuted(pos: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of ``pos`` under pseudorandom permutations of 0..n-1 that hang on ``key`` (all arrays).

    A four-round Feistel network over the next even number of bits, walked until the image is below n.
    """
    bits = np.maximum(2, np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64))
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = pos.astype(np.uint64), np.arange(len(pos))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            f = (right + k + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xC2B2AE3D27D4EB4F)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
            left, right = right, left ^ ((f >> np.uint64(32)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Mix:
    """The plan of one mix: sources with targets, and the tables of documents, slots and blocks taken."""

    def __init__(self, docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0,
                 block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 7):
        spark = docs.sparkSession
        self.docs, self.block = docs, block
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
        rows = docs.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("text_hash"),
                           F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_hash"))
        rows = stored(rows, "sizes")
        found = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()
        self.sources = sorted(((r["source"], int(r["n"])) for r in found), key=lambda r: (r[0] is None, (r[0] or "").encode()))
        sizes = [n for _, n in self.sources]
        self.targets = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
        self.plan = [slots_of(n, t, block) for n, t in zip(sizes, self.targets)]
        self.draws = draws([q for _, q in self.plan], shards, seed)
        self.seed = seed

        names = spark.createDataFrame(
            [(i, s, n, float(t)) for i, ((s, n), t) in enumerate(zip(self.sources, self.targets))],
            "src int, name string, source_size long, target double")
        rows = rows.join(names, rows.source.eqNullSafe(names.name)).drop("name")
        rows = rows.withColumn("bucket", F.pmod(F.col("text_hash"), F.lit(BUCKETS)))
        sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
        within = Window.partitionBy("src", "bucket").orderBy("doc_id", "text_hash", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
        placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
        self.placed = stored(placed.join(sums, ["src", "bucket"]).withColumn("start", F.col("base") + F.col("inner"))
                             .drop("base", "inner", "bucket", "text_hash"), "placed")

    def slots(self) -> DataFrame:
        """(shard, slot, src, block): what stands in every slot of the mix."""
        spark, seed = self.docs.sparkSession, self.seed
        count = np.array([q for _, q in self.plan], np.int64)
        blocks = np.array([b for b, _ in self.plan], np.int64)
        first = np.r_[0, np.cumsum(count)]
        upto = np.cumsum(self.draws, axis=0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for b in batches:
                at = b.column("id").to_numpy()
                src = np.searchsorted(first, at, "right") - 1
                k = at - first[src]
                shard = np.zeros(len(k), np.int32)
                for s in np.unique(src):
                    own = src == s
                    shard[own] = np.searchsorted(upto[:, s], k[own], "right")
                turn = k // blocks[src]
                key = (src * 1_000_003 + turn) * 7_368_787 + seed
                yield {"shard": shard, "slot": k, "src": src.astype(np.int32),
                       "block": permuted(k % blocks[src], blocks[src], key)}

        return map_arrow(spark.range(int(first[-1])), run, "shard int, slot long, src int, block long")

    def pieces(self) -> DataFrame:
        """(src, start, block, words, times): parts of documents by block, with the times the mix takes them."""
        times = self.slots().groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
        end, length = F.col("start") + F.col("size"), F.lit(self.block)
        first, last = F.floor(F.col("start") / length), F.floor((end - 1) / length)
        parts = self.placed.where("size > 0").select("src", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        words = F.least(end, (F.col("block") + 1) * length) - F.greatest(F.col("start"), F.col("block") * length)
        return parts.withColumn("words", words).join(times, ["src", "block"]).drop("size")

    def taken(self) -> DataFrame:
        """One row for each document: doc_id, size, source_size, target, taken."""
        got = self.pieces().groupBy("src", "start").agg(F.sum(F.col("words") * F.col("times")).alias("got"))
        some = F.when(F.col("size") > 0, F.col("start"))
        return (self.placed.withColumn("start", some).join(got, ["src", "start"], "left")
                .select("doc_id", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken")))

    def texts(self) -> DataFrame:
        """The mixed documents, columns as given: a row for each time a document is taken, whole or the parts taken so often.

        Parts end at blocks; where an ``n_chars`` column exists, it counts the new text.
        """
        cols = self.docs.columns
        part = F.struct((F.greatest(F.col("block") * self.block, F.col("start")) - F.col("start")).alias("at"), "words", "times")
        lists = self.pieces().groupBy("src", "start").agg(F.sort_array(F.collect_list(part)).alias("parts"))
        lists = (self.placed.where("size > 0").select("src", "start", "size", "doc_id", "row_hash").join(lists, ["src", "start"])
                 .select(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__hash"), "size", "parts"))
        # identical rows have one text and a list each; the text is met once
        docs = self.docs.withColumn("__id", F.col("doc_id")).withColumn("__hash", F.xxhash64(*[F.col(f"`{c}`") for c in cols])).dropDuplicates(["__id", "__hash"])
        docs = docs.select([F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(cols)] + ["__id", "__hash"])
        met = docs.join(lists, docs["__id"].eqNullSafe(lists["__id"]) & (docs["__hash"] == lists["__hash"]))
        src = met.select(*[f"d_{i}" for i in range(len(cols))], "size", "parts")
        text, chars = cols.index("text"), cols.index("n_chars") if "n_chars" in cols else -1
        word = re.compile(WORD)

        def cut(t: str, size: int, parts: list[dict], r: int) -> str:
            own = [(p["at"], p["at"] + p["words"]) for p in parts if p["times"] >= r]
            if sum(b - a for a, b in own) == size:
                return t
            starts = [0, *[m.start() for m in word.finditer(t)][1:], len(t)]
            return "".join(t[starts[a]:starts[b]] for a, b in own)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for whole in batches:
                for k in range(0, whole.num_rows, 256):
                    b = whole.slice(k, 256)
                    at, texts = [], []
                    for i, (t, size, parts) in enumerate(zip(*(b.column(c).to_pylist() for c in (f"d_{text}", "size", "parts")))):
                        for r in range(1, max(p["times"] for p in parts) + 1):
                            at.append(i)
                            texts.append(cut(t, size, parts, r))
                    out = {c: b.column(f"d_{i}").take(pa.array(at, pa.int32())) for i, c in enumerate(cols)} | {"text": texts}
                    yield out | ({"n_chars": [len(t) for t in texts]} if chars >= 0 else {})

        return map_arrow(src, run, self.docs.schema)


def mix(docs: DataFrame, weights: list[float] | None = None, **options) -> Mix:
    """A mix of (doc_id, text, source) documents; weights go to the sources in code point order, repeating."""
    return Mix(docs, weights or [5.0, 2.0, 1.0], **options)
