from collections import Counter

import numpy as np
import pytest

from fulltime.llm import source_mix as M
from tests.llm import helpers as H


def brute_targets(sizes, weights, share, most):
    want = [share * sum(sizes) * w / sum(weights) for w in weights]
    full = set()
    while over := {i for i, t in enumerate(want) if i not in full and t > most * sizes[i] + 1e-9}:
        excess = sum(want[i] - most * sizes[i] for i in over)
        full |= over
        for i in over:
            want[i] = most * sizes[i]
        free = [i for i in range(len(sizes)) if i not in full]
        for i in free:
            want[i] += excess * weights[i] / sum(weights[j] for j in free)
    return want


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 500, 3], [0, 7, 9, 100], [5], [0, 0], [3, 1000, 2, 50, 900, 1, 0]])
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert M.targets(sizes, weights, 1.5, 2) == pytest.approx(brute_targets(sizes, weights, 1.5, 2))


def test_permutations_are_one_to_one():
    for n in (1, 2, 3, 17, 64, 1000, 4097):
        for key in (0, 5, 10 ** 9):
            got = M.permuted(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(got.tolist()) == list(range(n))
    assert not np.array_equal(M.permuted(np.arange(99), np.full(99, 99), np.full(99, 1)), np.arange(99))


def test_draws_deal_all_slots():
    slots = [1000, 0, 37, 5]
    got = M.draws(slots, 16, 3)
    assert got.sum(0).tolist() == slots and got.min() >= 0 and np.ptp(got.sum(1)) <= 1


def table(spark):
    texts = [*H.edge_texts(), *[H.prose(i, 30 + 40 * (i % 7)) for i in range(120)], H.prose(3, 4000), H.prose(3, 4000)]
    return H.documents(spark, texts).union(H.null_row(spark)), texts


def test_rows_and_targets(spark):
    docs, texts = table(spark)
    rows = M.mix(H.clashing(docs, "size", "start", "src", "taken")).taken().collect()
    size = {i: len(H.WORD.findall(t or "")) for i, t in enumerate(texts)} | {None: 0}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    by = Counter()
    for i, n in size.items():
        by[source[i]] += n
    names = sorted(by, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, brute_targets([by[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)))
    taken = Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by[s]) and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(rows) == len(size)
    assert all(abs(taken[s] - want[s]) <= 2 * M.BLOCK_WORDS for s in names)
    again = M.mix(docs.repartition(5)).taken()
    assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter((r["doc_id"], r["taken"]) for r in again.collect())


def test_texts_hold_the_words_taken(spark):
    docs, texts = table(spark)
    plan = M.mix(docs)
    taken = {r["doc_id"]: r["taken"] for r in plan.taken().collect()}
    out = plan.texts()
    assert out.columns == docs.columns
    got, whole = Counter(), Counter()
    for r in out.collect():
        words = H.WORD.findall(r["text"])
        assert r["n_chars"] == len(r["text"]) and words
        assert set(words) <= set(H.WORD.findall(texts[r["doc_id"]]))
        got[r["doc_id"]] += len(words)
        whole[r["doc_id"]] += r["text"] == texts[r["doc_id"]]
    assert {i: n for i, n in taken.items() if n} == dict(got)
    assert sum(whole.values()) > 50


def test_repeated_rows_and_no_rows(spark):
    docs = H.documents(spark, [H.prose(1, 90)] * 3).selectExpr("1L AS doc_id", "text", "lang", "'s' AS source", "n_chars")
    assert sorted(r["taken"] for r in M.mix(docs).taken().collect())[-1] <= 180
    assert sum(r["taken"] for r in M.mix(docs).taken().collect()) == sum(len(H.WORD.findall(r["text"])) for r in M.mix(docs).texts().collect())
    assert M.mix(H.no_rows(spark)).taken().count() == 0 and M.mix(H.no_rows(spark)).texts().count() == 0
