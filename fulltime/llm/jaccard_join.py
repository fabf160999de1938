"""N-gram Jaccard join: documents whose sets of word shingles overlap by a share or more, and their groups.

Two sets link when ``100 * intersection >= percent * union``. The join is exact; no link between
different sets is lost, and sets never meet unless they share a rare shingle:

1. ``scan``: every text becomes its sorted array of 64-bit shingle hashes, kept as an id of the whole
   set, its size and a bitmap signature of twice as many bits as shingles. Equal sets are one node
   from here on. The scan also reports shingles met again and again in one task's documents.
2. ``postings``: each node is dealt out under the first n - ceil(percent/100 * n) + 1 shingles of its
   set in a fixed order (the reported common shingles last, else by hash). Two linked sets share one of
   those. Only shingles that two nodes share stay.
3. Stars: the node with most shared shingles is the hub of those it stands under; each node is held
   against the few hubs that it shares most shingles with, which finds the body of every large group, edited
   copies around their source, in pairs that grow with the rows.
   Groups found so are held once more against the least group under a shingle, by their closest nodes.
4. Tiles: nodes under a shingle whose nodes are not all of one group yet are dealt to tiles by size band
   (a band spans 100/percent; linked sets lie in the same or the next band). In a tile pairs are made
   between different groups only.

Pairs pass three gates: the sizes; then the signatures, as ``popcount(A & ~B)`` elements of A at least
are missing from B, which bounds the overlap from above; then the intersection of the sorted arrays,
which are made again from the texts of the nodes still in play.

Defined results: words are lower-cased A-Z only; fewer words than a shingle's make one shingle; null and
empty texts have no shingles and link with nothing; repeated rows share a node; rows of null doc_id take
part but never give a group its name (null if a group has no other).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulltime.llm.common import Generations, arrow_rows, blank_split, filled, map_arrow, per_process, slices, stored
from fulltime.llm.components import components

#: Entries of each generation of a process's table of known words (speed only), shingles counted together for the report,
#: most common shingles kept (they only order a set's shingles), slots of the filter on texts read again.
KNOWN = 120_000
COUNTED = 2_000_000
COMMON = 1 << 20
SLOTS = 1 << 20
#: Hubs a node is held against in the first step; all other pairs are left to the tiles.
HUBS = 3
#: Nodes under a shingle that a join pairs up, and rows of a part of a larger one (both ways find the same).
FEW, PART = 48, 1024
#: Odd multipliers that mix a shingle's words into one key.
MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
       0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int):
        self.words = words
        self.table = Generations(KNOWN)

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        split, k = blank_split(texts, lower=True), self.words
        known = self.table.of(split.distinct.cast(pa.binary()).to_pylist(), lambda new: list(map(xxhash.xxh3_64_intdigest, new)))
        flat = np.array(known, np.uint64)[split.at] if len(known) else np.zeros(0, np.uint64)
        n = max(0, len(flat) - k + 1)
        key = np.zeros(n, np.uint64)
        for j in range(k):
            key = (key + flat[j:j + n]) * np.uint64(MIX[j % len(MIX)])
            key ^= key >> np.uint64(29)
        key *= np.uint64(MIX[-1])
        key ^= key >> np.uint64(32)
        out, at = [], 0
        for m in split.lens.tolist():
            if m >= k:
                own = np.sort(key[at:at + m - k + 1])
                out.append(own[np.r_[True, own[1:] != own[:-1]]])
            else:
                out.append(np.array([xxhash.xxh3_64_intdigest(flat[at:at + m].tobytes(), seed=1)] if m else [], np.uint64))
            at += m
        return out


def shingler_of(words: int) -> Shingler:
    """The process's shingler."""
    return per_process(f"shingles {words}", lambda: Shingler(words))


def set_id(s: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=2) - (1 << 63)


def bitmap(s: np.ndarray) -> bytes:
    """Signature: a power of two of bits, at least twice the set's size, a bit for each hash."""
    bits = 64
    while bits < 2 * len(s):
        bits *= 2
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def overlap_bound(n: int, a: np.ndarray, m: int, b: np.ndarray) -> int:
    """Most elements that sets of n and m elements with bitmaps a and b can share."""
    size = min(len(a), len(b))
    a, b = _folded(a, size), _folded(b, size)
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def scan(docs: DataFrame, words: int) -> DataFrame:
    """Rows of documents (kind 0) and of shingles common in a task (kind 1: set_id is the shingle, n how often).

    ``docs`` are (doc_id, text, tag); tag is a number carried along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler, met, held, size = shingler_of(words), set(), [], 0

        def common() -> dict:
            own = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            n = np.diff(np.r_[first, len(own)])
            s, n = own[first][n > 1], n[n > 1]
            return {"kind": np.ones(len(s), np.int32), "doc_id": [None] * len(s), "tag": [None] * len(s), "n": n.astype(np.int64),
                    "set_id": s.view(np.int64), "bits": [None] * len(s)}

        for b in slices(batches, "text", 2_000_000):
            sets = shingler.sets(filled(b.column("text")))
            ids = [set_id(s) if len(s) else None for s in sets]
            for i, s in zip(ids, sets):
                if i is not None and i not in met:
                    met.add(i)
                    held.append(s)
                    size += len(s)
            if size > COUNTED:
                yield common()
                met, held, size = set(), [], 0
            yield {"kind": np.zeros(len(sets), np.int32), "doc_id": b.column("doc_id"), "tag": b.column("tag"), "n": [len(s) for s in sets],
                   "set_id": ids, "bits": [bitmap(s) if len(s) else None for s in sets]}
        if held:
            yield common()

    return map_arrow(docs, run, "kind int, doc_id long, tag long, n long, set_id long, bits binary")


def postings(docs: DataFrame, words: int, percent: int, common: np.ndarray) -> DataFrame:
    """(shingle, set_id, n): the sets under the shingles of their prefix; ``common`` sorted as signed, rarest first by place."""
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler, met = shingler_of(words), set()
        names, place = shared.value
        for b in slices(batches, "text", 2_000_000):
            parts, ids, sizes = [], [], []
            for s in shingler.sets(filled(b.column("text"))):
                if not len(s) or (i := set_id(s)) in met:
                    continue
                met.add(i)
                n = len(s)
                need = n - -(-percent * n // 100) + 1
                if len(names):
                    v = s.view(np.int64)
                    at = np.minimum(np.searchsorted(names, v), len(names) - 1)
                    hit = names[at] == v
                    rare = s[~hit]
                    if len(rare) < need:
                        late = np.argsort(place[at[hit]])[:need - len(rare)]
                        rare = np.concatenate([rare, s[hit][late]])
                    s = rare
                parts.append(s[:need])
                ids.append(i)
                sizes.append(n)
            if parts:
                lens = [len(p) for p in parts]
                yield {"shingle": np.concatenate(parts).view(np.int64), "set_id": np.repeat(np.array(ids, np.int64), lens),
                       "n": np.repeat(np.array(sizes, np.int32), lens)}

    return map_arrow(docs.select("text"), run, "shingle long, set_id long, n int")


def _mixed(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(set_id, shingle, n, label, first) of shingles whose nodes are of several groups; first: of the least group,
    the node with the most shared shingles."""
    by = Window.partitionBy("shingle")
    named = met.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.withColumn("label", F.coalesce("label", "set_id")).withColumn("first", F.min(F.struct("label", (-F.col("ties")).alias("t"), "set_id", "n")).over(by))
    return named.withColumn("last", F.max("label").over(by)).where("first.label < last").drop("last", "ties")


def _tile_pairs(mixed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different groups under a shingle, by tiles of (shingle, size band).

    A node is at home in its band's tile, and a guest in the next one. Where few nodes meet, a join makes the
    pairs. A shingle with more than FEW nodes is worked on in cells of at most two parts of PART rows on
    average, with the signatures at hand: only pairs whose bit counts leave a link possible come out.
    """
    band = F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int")
    rows = mixed.withColumn("own", band).withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
    home = rows.withColumn("tile", F.col("own"))
    guest = rows.withColumn("tile", F.explode(F.array(F.col("own"), F.col("own") + 1)))

    few, host = guest.where(F.col("many") <= FEW), home.where(F.col("many") <= FEW)
    others = host.select("shingle", "tile", F.col("label").alias("other")).distinct()
    host = host.select("shingle", "tile", F.col("label").alias("other"), F.col("set_id").alias("set_b"), F.col("n").alias("n_b"))
    joined = (few.join(others, ["shingle", "tile"]).where("label <> other").join(host, ["shingle", "tile", "other"])
              .where(((F.col("own") < F.col("tile")) | (F.col("set_id") < F.col("set_b"))) & _sizes_fit("n", "n_b", percent))
              .select(F.least("set_id", "set_b").alias("a"), F.greatest("set_id", "set_b").alias("b")))

    # a pair comes out under the first of its large shingles only: each node brings the list of its own
    large = rows.where(F.col("many") > FEW).groupBy("set_id").agg(F.sort_array(F.collect_list("shingle")).alias("under"))
    many = guest.where(F.col("many") > FEW).join(nodes.select("set_id", "bits").join(large, "set_id"), "set_id")
    parts = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("shingle", "tile")) / PART).cast("int")
    many = many.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
    many = many.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    many = many.withColumn("lo", F.least("part", "q")).withColumn("hi", F.greatest("part", "q"))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        sets, n, label = (rows[c].to_numpy() for c in ("set_id", "n", "label"))
        at_home, part, cross = (rows["own"] == rows["tile"]).to_numpy(), rows["part"].to_numpy(), rows["lo"].iloc[0] != rows["hi"].iloc[0]
        size = min(map(len, rows["bits"]))
        bits = np.array([_folded(np.frombuffer(x, np.uint8), size) for x in rows["bits"]]).view(np.uint64)
        shingle, under = int(rows["shingle"].iloc[0]), [np.asarray(x, np.int64) for x in rows["under"]]
        a, b = [], []
        for i in np.flatnonzero(at_home):
            ok = (label != label[i]) & (~at_home | (sets < sets[i])) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
            j = np.flatnonzero(ok & (part != part[i]) if cross else ok)
            if len(j):
                most = np.minimum(n[j] - np.bitwise_count(bits[j] & ~bits[i]).sum(1, dtype=np.int64),
                                  n[i] - np.bitwise_count(bits[i] & ~bits[j]).sum(1, dtype=np.int64))
                j = j[(100 + percent) * most >= percent * (n[j].astype(np.int64) + n[i])]
            if len(j):
                theirs, lens = np.concatenate([under[k] for k in j]), np.array([len(under[k]) for k in j])
                shared = under[i][np.minimum(np.searchsorted(under[i], theirs), len(under[i]) - 1)] == theirs
                first = np.minimum.reduceat(np.where(shared, theirs, np.iinfo(np.int64).max), np.cumsum(lens) - lens)
                j = j[first == shingle]
                a.append(np.minimum(sets[j], sets[i]))
                b.append(np.maximum(sets[j], sets[i]))
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    met = many.select("shingle", "tile", "lo", "hi", "set_id", "n", "label", "own", "part", "bits", "under").groupBy("shingle", "tile", "lo", "hi")
    return joined.union(met.applyInPandas(meet, "a long, b long")).distinct()


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """A signature of fewer bytes: what stood in either half stands in the whole."""
    while len(x) > size:
        x = x[:len(x) // 2] | x[len(x) // 2:]
    return x


def _most_shared(rows: DataFrame, of: list[str], a: str, b: str) -> DataFrame:
    """(a, b): for each group ``of`` the few pairs that stand in most rows."""
    nth = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("times"), a, b))
    return (rows.groupBy(*dict.fromkeys([*of, a, b])).agg(F.count(F.lit(1)).alias("times")).withColumn("nth", nth)
            .where(F.col("nth") <= HUBS).select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())


def _sizes_fit(n: str, m: str, percent: int):
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _signature_gate(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave a link possible."""
    one = nodes.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = nodes.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for t in batches:
            keep = [percent * (n + m) <= (100 + percent) * overlap_bound(n, np.frombuffer(x, np.uint8), m, np.frombuffer(y, np.uint8))
                    for n, x, m, y in zip(*(t.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")))]
            t = t.filter(pa.array(keep, pa.bool_()))
            yield {"a": t.column("a"), "b": t.column("b")}

    return map_arrow(pairs.join(one, "a").join(two, "b"), run, "a long, b long")


def _slot(key: str):
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def _arrays(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_id, hashes) of the wanted (set_id, rep): texts are read again behind a filter of fixed size."""
    slots = wanted.select(_slot("rep").alias("s")).distinct()  # SLOTS numbers at most, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler = shingler_of(words)
        for t in slices(batches, "text", 2_000_000):
            sets = [x for x in shingler.sets(filled(t.column("text"))) if len(x)]
            yield {"set_id": [set_id(x) for x in sets], "hashes": [x.tobytes() for x in sets]}

    some = docs.withColumn("s", _slot("doc_id")).join(F.broadcast(slots), "s", "left_semi").select("text")
    found = map_arrow(some, run, "set_id long, hashes binary")
    return found.join(wanted.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The linked pairs (a, b) among candidates, stored."""
    pairs = stored(_signature_gate(pairs, nodes, percent), "pairs")
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    arrays = stored(_arrays(docs, nodes.select("set_id", "rep").join(ends, "set_id", "left_semi"), words), "arrays")
    one = arrays.select(F.col("set_id").alias("a"), F.col("hashes").alias("x"))
    two = arrays.select(F.col("set_id").alias("b"), F.col("hashes").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for t in batches:
            keep = []
            for x, y in zip(t.column("x").to_pylist(), t.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            t = t.filter(pa.array(keep, pa.bool_()))
            yield {"a": t.column("a"), "b": t.column("b")}

    return stored(map_arrow(pairs.join(one, "a").join(two, "b"), run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the least doc_id reachable by links, the row's own included.
    """
    return _grouped(docs, words, percent).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``docs``, any columns, with one document of each group: that of the least doc_id, ties by the text's hash.

    Rows of the same doc_id and text count as one document. Documents without words stay.
    """
    groups = _grouped(docs, words, percent)
    first = groups.where("set_id is not null").groupBy("label").agg(F.min(F.struct("doc_id", "tag")).alias("k")).select("k.doc_id", "k.tag")
    keep = first.union(groups.where("set_id is null").select("doc_id", "tag")).distinct()
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    tagged = docs.withColumn("__own_id", F.col("doc_id").cast("long")).withColumn("__own_tag", F.xxhash64(F.col("text").cast("string")))
    # nulls of doc_id sort before all numbers: a null is the least of its group
    met = tagged.join(keep, tagged["__own_id"].eqNullSafe(keep["__id"]) & (tagged["__own_tag"] == keep["__tag"]), "left_semi")
    return met.dropDuplicates(["__own_id", "__own_tag"]).select(*cols)


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, tag, n, set_id, label, component_id) by row; tag is the text's hash, label names the group."""
    with arrow_rows(docs.sparkSession, 500):  # rows with whole texts or two sets
        rows, nodes, labels = _linked(docs, words, percent)
    named = nodes.select("set_id", "rep").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.withColumn("label", F.coalesce("label", "set_id"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    return rows.join(named.join(least, "label").select("set_id", "label", "component_id"), "set_id", "left")


def _linked(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, tag, n, set_id), nodes (set_id, rep, n, bits), and labels (node, label) of linked nodes."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = stored(scan(docs.withColumn("tag", F.xxhash64("text")), words), "sets")
    rows = found.where("kind = 0").select("doc_id", "tag", "n", "set_id")
    common = (found.where("kind = 1").groupBy("set_id").agg(F.sum("n").alias("times")).where("times >= 8")
              .orderBy(F.desc("times"), "set_id").limit(COMMON).select("set_id").collect())
    nodes = (found.where("kind = 0 and set_id is not null").groupBy("set_id")
             .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("bits").alias("bits")))
    nodes = stored(nodes, "nodes")

    by = Window.partitionBy("shingle")
    dealt = postings(docs, words, percent, np.array([r[0] for r in common][::-1], np.int64))
    met = dealt.withColumn("first", F.min("set_id").over(by)).withColumn("last", F.max("set_id").over(by)).where("first < last")
    met = stored(met.select("shingle", "set_id", "n").distinct(), "shared")
    # the node that shares most of its shingles is the likely source of the others: the hub of those shingles
    met = stored(met.join(met.groupBy("set_id").agg(F.count(F.lit(1)).alias("ties")), "set_id"), "postings")

    # of the hubs of its shingles, a node is held against those it shares most shingles with
    stars = met.withColumn("top", F.max(F.struct("ties", "set_id", "n")).over(by)).select(
        "set_id", "n", F.col("top.set_id").alias("hub"), F.col("top.n").alias("hub_n"))
    stars = stars.where((F.col("hub") != F.col("set_id")) & _sizes_fit("n", "hub_n", percent))
    links = _verified(_most_shared(stars, ["set_id"], "hub", "set_id"), nodes, docs, words, percent)
    labels = components(links)
    # the same between groups: each against the least one under its shingles, by their closest nodes
    far = (_mixed(met, labels).where("label <> first.label").select("label", F.col("first.label").alias("other"), F.col("first.set_id").alias("hub"),
                                                                  F.col("first.n").alias("hub_n"), "set_id", "n").where(_sizes_fit("n", "hub_n", percent)))
    joined = _verified(_most_shared(far, ["label", "other"], "hub", "set_id"), nodes, docs, words, percent)
    if not joined.isEmpty():
        links = links.union(joined)
        labels = components(links)

    more = _verified(_tile_pairs(stored(_mixed(met, labels).drop("first"), "tiles"), nodes, percent), nodes, docs, words, percent)
    if not more.isEmpty():
        labels = components(links.union(more))

    return rows, nodes, labels
