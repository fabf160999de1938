import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fulltime.llm import merkle as M
from fulltime.llm.queries import op11_merkle
from tests.llm import helpers as H

ROWS = "g string, id long, leaf string, claimed string"


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def fold_up(nodes):
    """All levels of a tree over runs of two."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of (g, id, leaf, claimed)."""
    groups = defaultdict(list)
    for g, i, x, c in rows:
        groups[g].append((i is not None, i or 0, x, c))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [fold_up([x for _, _, x, _ in sorted(groups[g], key=lambda r: r[:3])]) for g in names]
    top = fold_up([t[-1][0] for t in trees])
    out = []
    for k, (g, tree) in enumerate(zip(names, trees)):
        for pos, (known, i, x, c) in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            node, proof = c or x, ""
            for levels, at in ((tree, pos), (top, k)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node, proof, at = h(node + other if at % 2 == 0 else other + node), proof + other, at // 2
            out.append((i if known else None, x, tree[-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("levels", [2, 12])
def test_equal_to_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "SLOTS", 1 << levels)
    r = random.Random(levels)
    ids = [None, None, 0, -1, -2**63, 2**63 - 1, 1 << 40, -(1 << 40), 63, 64, 65535, 65536, *range(200, 290), *[r.randrange(-2**62, 2**62) for _ in range(40)]]
    rows = [(r.choice([None, "", "-", "=", "de", "en", "en", "en", "日本"]), i, h(f"{k}"), h(f"no {k}") if k % 5 == 0 else None) for k, i in enumerate(ids)]
    rows += [("lone", 7, h("lone"), None)]
    rows += [("en", 5, h("same"), None)] * 9 + [("en", 5, h(f"other {k}"), None) for k in range(11)] + [("en", None, h("none"), None)] * 3
    got = M.manifest(H.clashing(spark.createDataFrame(rows, ROWS).repartition(5), "pos", "total", "node"))
    assert order(map(tuple, got.collect())) == order(brute(rows))


def test_paths_prove_their_leaf(spark):
    rows = [("a", i, h(f"{i}"), None) for i in range(21)] + [("b", i, h(f"b{i}"), None) for i in range(3)]
    for r in M.manifest(spark.createDataFrame(rows, ROWS), with_path=True).collect():
        assert M.folded(r["leaf"], r["path"]) == r["root"] and r["verified"]
        assert M.folded(h("x"), r["path"]) != r["root"]
        assert h("".join(s[1:] for s in r["path"])) == r["proof_sha256"]


def test_no_rows_and_one_row(spark):
    assert M.manifest(spark.createDataFrame([], ROWS)).collect() == []
    (r,) = M.manifest(spark.createDataFrame([(None, None, h("x"), None)], ROWS)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == h("x") and r["proof_sha256"] == h("") and r["verified"]


def test_many_equal_rows_are_made_in_parts(spark, monkeypatch):
    rows = spark.range(150_000).select(F.lit("g").alias("g"), F.lit(1).cast("long").alias("id"), F.lit(h("x")).alias("leaf"), F.lit(None).cast("string").alias("claimed"))
    got = M.manifest(rows).groupBy("root", "verified").count().collect()
    assert len(got) == 1 and got[0]["verified"] and got[0]["count"] == 150_000
    assert got[0]["root"] == fold_up([h("x")] * 150_000)[-1][0]


def test_leaf_text(spark, tmp_path):
    docs = H.documents(spark, H.edge_texts()).union(H.null_row(spark))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in op11_merkle(spark, str(tmp_path)).collect()}
    assert len(rows) == len(H.edge_texts()) + 1

    def value(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    for d in docs.collect():
        assert rows[d["doc_id"]]["leaf"] == h("".join(value(d[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
        assert rows[d["doc_id"]]["verified"] == (d["doc_id"] is None or d["n_chars"] is None or zlib.crc32(str(d["doc_id"]).encode()) % 7 != 0)
