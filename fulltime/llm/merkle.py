"""Merkle manifest of a table: hash trees by group over bitmap ranks, roots, proofs and their checks.

Every row is a leaf; a group's leaves stand in ascending order of their id, the groups' roots in order of the
group's name, and runs of two nodes become the hash of both until one is left (the last run may be a single
node, which is hashed alone). No table is sorted by id to find the coordinates:

1. ``bitmaps``: the ids of a group become a compressed bitmap, 64-bit words that hold an id at least, merged
   from all tasks by ``bit_or``. Directories over words (by 2^16 ids), and over those (by 2^32 and 2^48 ids)
   count rows before each; no directory node has more than 2^16 entries, however sparse the ids are.
2. ``ranked``: a leaf's coordinate is the count before its word and the popcount of the lower bits in it.
3. ``reduced``: coordinates cut into (group, block, slot) deal the nodes to slot arrays of ``SLOTS`` nodes,
   which lose 12 levels at once; the blocks' nodes are dealt again until each group has one.
4. ``paths`` go back down block by block, and each leaf gets its siblings from its block and from the path
   above it.

Hashes are lowercase hex SHA-256; those of nodes are over their digests as hex text.

Defined results: a null group is a group of its own, first; null ids come first in a group; rows of one id
stand by their leaf, equal rows are leaves of their own (they are counted once up to their coordinates); an
empty table has no rows and no root. A null value is ``-`` in a leaf, others have their length before them,
so an empty text and a null differ. Columns that aren't named take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulltime.llm.common import map_arrow, stored
from fulltime.operators.numbering import numbered

#: Nodes of a slot array and the levels it takes away.
LEVELS = 12
SLOTS = 1 << LEVELS
#: Word address of null ids, before that of every id.
NULL_AT = -(1 << 47) - 1
#: Equal rows made at once from one counted row.
COPIES = 1 << 16
BEFORE = (Window.unboundedPreceding, -1)


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of values, each ``-`` if null, else its length in UTF-8, a colon and itself."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def _running(count: str, by: list[str], order: str) -> Column:
    return F.coalesce(F.sum(count).over(Window.partitionBy(*by).orderBy(order).rowsBetween(*BEFORE)), F.lit(0))


def _addresses(df: DataFrame) -> DataFrame:
    """``df`` with the 2^16 ids its id is among (at), the word there and the bit in it."""
    low = F.coalesce(F.col("id").bitwiseAND(F.lit(0xFFFF)), F.lit(0)).cast("int")
    return df.select("*", F.coalesce(F.shiftright("id", 16), F.lit(NULL_AT)).alias("at"),
                     F.shiftright(low, 6).alias("word"), low.bitwiseAND(F.lit(63)).alias("bit"))


def bitmaps(entries: DataFrame) -> DataFrame:
    """The words of the groups' bitmaps: (g, at, word, bits, repeats, before, total).

    ``entries`` are (g, id, n). ``repeats`` lists the bits whose id has more than one row and how many more,
    ``before`` counts the group's rows of lower words, ``total`` all its rows.
    """
    ids = _addresses(entries).groupBy("g", "at", "word", "bit").agg(F.sum("n").alias("n"))
    words = stored(ids.groupBy("g", "at", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.sum("n").alias("rows"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))).alias("repeats")), "bitmaps")
    top = [F.shiftright("at", 16).alias("high"), F.shiftright("at", 32).alias("top")]
    near = words.groupBy("g", "at").agg(F.sum("rows").alias("rows")).select("*", *top)
    high = near.groupBy("g", "high", "top").agg(F.sum("rows").alias("rows"))
    tops = high.groupBy("g", "top").agg(F.sum("rows").alias("rows"))
    tops = tops.select("g", "top", _running("rows", ["g"], "top").alias("base"), F.sum("rows").over(Window.partitionBy("g")).alias("total"))
    high = high.join(tops, ["g", "top"]).select("g", "high", "total", (F.col("base") + _running("rows", ["g", "top"], "high")).alias("base"))
    near = near.join(high, ["g", "high"]).select("g", "at", "total", (F.col("base") + _running("rows", ["g", "high"], "at")).alias("base"))
    return words.join(near, ["g", "at"]).select(
        "g", "at", "word", "bits", "repeats", "total", (F.col("base") + _running("rows", ["g", "at"], "word")).alias("before"))


def ranked(entries: DataFrame) -> DataFrame:
    """``entries`` (g, id, leaf, n, ...) with the coordinate of their first leaf (pos) and the group's rows (total)."""
    words = bitmaps(entries).hint("shuffle_hash")
    found = _addresses(entries).join(words, ["g", "at", "word"])
    lower = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    more = F.expr("aggregate(repeats, 0L, (s, r) -> s + IF(r.bit < bit, r.more, 0L))")
    found = found.select(*entries.columns, "total", "at", "word", "bit", (F.col("before") + lower + more).alias("pos"),
                         F.expr("exists(repeats, r -> r.bit = bit)").alias("repeated"))
    # rows of one id, by leaf: counts by the first digits of the hash, then the few that share them
    own = ["g", "at", "word", "bit"]
    many = found.where("repeated").withColumn("digits", F.substring("leaf", 1, 4))
    digits = many.groupBy(*own, "digits").agg(F.sum("n").alias("rows")).select(
        *own, "digits", _running("rows", own, "digits").alias("base"))
    tied = many.join(digits, [*own, "digits"]).withColumn("pos", F.col("pos") + F.col("base") + _running("n", [*own, "digits"], "leaf"))
    out = [*entries.columns, "total", "pos"]
    return found.where("not repeated").select(*out).union(tied.select(*out))


def _each(entries: DataFrame) -> DataFrame:
    """A row for each of the n leaves that an entry stands for, at coordinates one after another."""
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, 16)))
    parts = entries.select("*", part.alias("part"))
    some = F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("part") * COPIES)
    each = parts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), some - 1)).alias("copy"))
    return each.withColumn("pos", F.col("pos") + F.col("part") * COPIES + F.col("copy")).drop("part", "copy", "n")


def parents(nodes: list[str]) -> list[str]:
    """The level above: hashes of runs of two, a last single node alone."""
    return [sha256("".join(nodes[i:i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]


def levels_of(nodes: list[str], total: int) -> list[list[str]]:
    """A block's levels: all of them where the block is its whole level, else those of a full slot array."""
    out = [nodes]
    while len(out) <= LEVELS and (total > SLOTS or len(out[-1]) > 1):
        out.append(parents(out[-1]))
    return out


def reduced(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Slot arrays of the nodes (g, total, pos, node, *keep): (g, total, block, nodes, *keep as lists, top), stored."""
    fields = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = "g string, total long, block long, nodes array<string>, " + "".join(f"{k} array<{fields[k]}>, " for k in keep) + "top string"

    def slots(table: pa.Table) -> pa.Table:
        n, at = table.num_rows, table.column("slot").to_pylist()
        arrays = {}
        for k in ("node", *keep):
            held = [None] * n
            for i, v in zip(at, table.column(k).to_pylist()):
                held[i] = v
            arrays[k] = held
        g, total, block = (table.column(k)[0].as_py() for k in ("g", "total", "block"))
        types = {k: pa.list_(table.schema.field(k).type) for k in keep}
        return pa.table({"g": pa.array([g], pa.string()), "total": [total], "block": [block],
                         "nodes": pa.array([arrays["node"]], pa.list_(pa.string())),
                         **{k: pa.array([arrays[k]], types[k]) for k in keep},
                         "top": levels_of(arrays["node"], total)[-1]})

    dealt = nodes.select("g", "total", F.shiftright("pos", LEVELS).alias("block"),
                         F.col("pos").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot"), "node", *keep)
    return stored(dealt.groupBy("g", "block").applyInArrow(slots, schema), "slots")


def tree(nodes: DataFrame, keep: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """All stored slot arrays, lowest first, and the tops (g, node) of the groups."""
    levels, tops = [reduced(nodes, keep)], []
    while True:
        up = levels[-1].select("g", F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"), F.col("block").alias("pos"), F.col("top").alias("node"))
        tops.append(up.where("total = 1").select("g", "node"))
        if up.where("total > 1").isEmpty():
            break
        levels.append(reduced(up.where("total > 1"), []))
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return levels, out


def siblings(levels: list[list[str]], slot: int) -> list[str]:
    """The siblings of a slot up to its block's top: L or R for their side and the hash, empty where there is none."""
    out = []
    for level in levels[:-1]:
        other = slot ^ 1
        out.append(("R" if other > slot else "L") + level[other] if other < len(level) else "")
        slot >>= 1
    return out


def folded(node: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings give."""
    for s in path:
        node = sha256((node + s[1:] if s[:1] == "R" else s[1:] + node).encode()).hexdigest()
    return node


def _with_paths(blocks: DataFrame, above: DataFrame, on: list[str], schema: str, each, names: Sequence[str]) -> DataFrame:
    """Each block joined to the path above it, and the rows that ``each(block's columns, path above)`` makes of it."""
    held = blocks.join(above, on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield each({k: batch.column(k)[i].as_py() for k in names})

    return map_arrow(held.select(*names), run, schema)


def _down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Paths (g, block, path, ...) of the blocks below, from those of the blocks themselves."""

    def each(b: dict) -> dict:
        levels, n = levels_of(b["nodes"], b["total"]), len(b["nodes"])
        return {"g": [b["g"]] * n, "block": [b["block"] * SLOTS + i for i in range(n)], "path": [siblings(levels, i) + b["path"] for i in range(n)],
                "subroot": [b["subroot"]] * n, "root": [b["root"]] * n}

    return _with_paths(blocks, above, ["g", "block"], "g string, block long, path array<string>, subroot string, root string", each,
                       ["g", "total", "block", "nodes", "path", "subroot", "root"])


def _group_paths(groups: list[DataFrame], root: str) -> DataFrame:
    """(name, path, subroot, root) of every group, from the tree of groups."""
    spark = groups[0].sparkSession
    above = spark.createDataFrame([("", 0, [])], "g string, block long, path array<string>")
    for blocks in reversed(groups[1:]):
        above = _down(blocks, above.withColumns({"subroot": F.lit(""), "root": F.lit(root)})).select("g", "block", "path")

    def each(b: dict) -> dict:
        levels, n = levels_of(b["nodes"], b["total"]), len(b["nodes"])
        return {"g": b["name"], "path": [siblings(levels, i) + b["path"] for i in range(n)], "subroot": b["nodes"], "root": [root] * n}

    return _with_paths(groups[0], above, ["g", "block"], "g string, path array<string>, subroot string, root string", each,
                       ["total", "nodes", "name", "path"])


def manifest(rows: DataFrame, with_path: bool = False) -> DataFrame:
    """Leaf, subroot, root, proof and its check of every row.

    ``rows`` are (g, id, leaf, claimed): the group's name (null: a group of its own), the id, the leaf's hash
    and a hash to prove in its place (null: the leaf itself). Returns id, leaf, subroot, root, proof_sha256
    (hash of the siblings up to the root, one after another), folded_root (from the claimed leaf and the
    siblings) and verified (that it is the root); with_path adds the siblings themselves (L or R for their
    side, then the hash; empty where a node has none).
    """
    # names of groups with the null one first, bytewise
    named = rows.select(F.when(F.col("g").isNull(), "-").otherwise(F.concat(F.lit("="), "g")).alias("g"), F.col("id").cast("long"), "leaf", "claimed")
    entries = stored(named.groupBy("g", "id", "leaf", "claimed").agg(F.count("*").alias("n")), "leaves")
    leaves = _each(ranked(entries)).withColumnRenamed("leaf", "node")
    levels, tops = tree(leaves, ["id", "claimed"])
    groups, top = tree(_roots(numbered(tops, ["g"], "pos")), ["name"])
    root = next((r["node"] for r in top.collect()), "")
    paths = _group_paths(groups, root)
    above = None
    for blocks in reversed(levels):
        ends = blocks.where(F.col("total") <= SLOTS).select("g", "block").join(paths, "g")
        above = ends if above is None else above.unionByName(ends)
        if blocks is not levels[0]:
            above = _down(blocks, above)

    def each(b: dict) -> dict:
        levels, n = levels_of(b["nodes"], b["total"]), len(b["nodes"])
        own = [siblings(levels, i) + b["path"] for i in range(n)]
        ends = [folded(c or x, p) for c, x, p in zip(b["claimed"], b["nodes"], own)]
        out = {"id": b["id"], "leaf": b["nodes"], "subroot": [b["subroot"]] * n, "root": [b["root"]] * n,
               "proof_sha256": [sha256("".join(s[1:] for s in p).encode()).hexdigest() for p in own],
               "folded_root": ends, "verified": [e == b["root"] for e in ends]}
        return out | {"path": own} if with_path else out

    return _with_paths(levels[0], above, ["g", "block"],
                       "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
                       + (", path array<string>" if with_path else ""), each,
                       ["total", "nodes", "id", "claimed", "path", "subroot", "root"])


def _roots(tops: DataFrame) -> DataFrame:
    """The groups' roots as the nodes of one tree."""
    total = tops.count()
    return tops.select(F.lit("").alias("g"), F.lit(total).cast("long").alias("total"), "pos", "node", F.col("g").alias("name"))
