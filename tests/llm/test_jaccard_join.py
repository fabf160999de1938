import random

import numpy as np

from fulltime.llm import jaccard_join as J
from tests.llm import helpers as H


def shingles(t):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in H.WORD.findall(t or "")]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    s = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 75 * (len(s[i]) + len(s[j]) - both):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(s[i]), top(i)) for i in range(len(s))}


def corpus():
    r = random.Random(9)
    texts = list(H.edge_texts()) + ["a b c d", "A B c d", "a b c d e", "E d c b a"]
    passage = H.prose(50, 60)
    for g in range(25):  # groups of near copies by few and by many edits, chains among them, and a passage shared by all
        base = H.prose(100 + g, r.randrange(20, 160)).split(" ")
        for _ in range(r.randrange(1, 7)):
            base = base if r.random() < 0.4 else list(base)
            for _ in range(r.randrange(0, 5)):
                base[r.randrange(len(base))] = f"edit{r.randrange(10 ** 6)}"
            texts.append(" ".join(base) + (" " + passage if g % 3 == 0 else ""))
    texts += [passage] * 4 + [passage + " end"] + [H.prose(7, 120).upper(), H.prose(7, 120)]
    return texts


def test_equals_brute_force(spark):
    texts = corpus()
    docs = H.clashing(H.documents(spark, texts).repartition(5), "set_id", "tag", "n", "bits")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.near_duplicates(docs).collect()}
    assert got == brute(texts)


def test_cells_of_many_parts_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "FEW", 2)
    monkeypatch.setattr(J, "PART", 3)
    monkeypatch.setattr(J, "HUBS", 1)
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.near_duplicates(H.documents(spark, texts)).collect()}
    assert got == brute(texts)


def test_large_groups_and_a_common_passage(spark):
    r, base, passage = random.Random(3), H.prose(900, 120).split(" "), H.prose(901, 55)
    texts = [" ".join(base)] * 150
    for _ in range(300):
        w = list(base)
        for _ in range(r.randrange(1, 3)):
            w[r.randrange(len(w))] = f"z{r.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    texts += [H.prose(2000 + i, 100) + " " + passage for i in range(200)]
    got = {x["doc_id"]: x["component_id"] for x in J.near_duplicates(H.documents(spark, texts)).collect()}
    assert got == {i: c for i, (_, c) in brute(texts).items()}


def test_one_of_each_group(spark):
    texts = corpus()
    docs = H.documents(spark, texts)
    docs = H.clashing(docs.union(docs.where("doc_id in (4, 30)")), "label")
    kept = sorted(r["doc_id"] for r in J.one_of_each_group(docs).collect())
    assert kept == sorted(i for i, (_, c) in brute(texts).items() if i == c)
    assert J.one_of_each_group(docs).columns == docs.columns


def test_null_ids_and_no_rows(spark):
    text = H.prose(5, 40)
    docs = spark.createDataFrame([(None, text), (8, text), (3, text + " x"), (None, None), (None, "only null")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in J.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 3), (8, 3), (3, 3), (None, None), (None, None)], key=str)
    assert J.near_duplicates(H.no_rows(spark)).count() == 0


def test_bound_is_above_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 500, rng.integers(1, 300)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        bound = J.overlap_bound(len(a), np.frombuffer(J.bitmap(a), np.uint8), len(b), np.frombuffer(J.bitmap(b), np.uint8))
        assert bound >= len(np.intersect1d(a, b))
