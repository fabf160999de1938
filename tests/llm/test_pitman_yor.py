import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fulltime.llm import pitman_yor as Y
from tests.llm import helpers as H


def tokens(t):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in H.WORD.findall(t or "")] + ["\0"]


def corpus(spark):
    common = ["the cat sat on the mat and", "a dog ran over the hill to", "rain falls on the plain of"]
    texts = [*H.edge_texts(), *[" ".join(common[(i * j + j) % 3] + f" word{(i * 7 + j) % 11}" for j in range(8)) for i in range(150)]]
    docs = H.documents(spark, texts).union(H.null_row(spark))
    return docs.withColumn("train", F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True))), texts


def test_base_scores_and_counts(spark):
    docs, texts = corpus(spark)
    rows = {r["doc_id"]: r for r in Y.score(H.clashing(docs, "chunk", "blob", "trained"), buckets=7).collect()}
    count = Counter()
    for i, t in [*enumerate(texts), (None, None)]:
        if i is None or i % 4 != 1:
            count.update(tokens(t))
    total, kinds = sum(count.values()), len(count)
    assert len(rows) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, None)]:
        r, ws = rows[i], tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in ws))
        assert r["score"] < 0 and math.isfinite(r["score"])
    held = [r for i, r in rows.items() if i is not None and i % 4 == 1 and i > 16]
    # contexts help on texts not learned from
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {r["doc_id"]: r["score"] for r in Y.score(docs, buckets=7).collect()}
    assert all(again[i] == pytest.approx(rows[i]["score"]) for i in again)


def test_probabilities_of_a_context_add_up(spark):
    """All words of up to two letters over a small alphabet, and the rest of the spelling's mass."""
    spelling = Y.Spelling([97, 98])
    spelling.sweep(np.arange(5), np.array([4, 3, 2, 2, 1]), np.random.default_rng(0))
    assert np.allclose(spelling.prob.sum(1), 1)
    table = spelling.log_table()
    letters = [bytes([b]) for b in range(256)]
    words = [b"", *letters, *[a + b for a in letters for b in letters]]
    p = 10.0 ** spelling.of(words, table)
    cell, _, _ = spelling.cells([b""])
    first = 10.0 ** table.reshape(-1, Y.SYMBOLS)[cell[0] // Y.SYMBOLS]
    assert p[0] == pytest.approx(first[Y.END], rel=1e-5) and p.sum() < 1
    # with a discount taken and given back, a restaurant's dishes and new ones have all the mass
    model = Y.WordModel(10, 2, 10, 0.4, 3.0, spelling)
    single = model.single([b"a", b"b"], np.array([7, 3]))
    fresh = (Y.STRENGTH + 0.4 * 3) / (Y.STRENGTH + 10)
    assert 1 - fresh - 0.2 < single.sum() < 1


def test_seating_stays_in_bounds():
    rng = np.random.default_rng(1)
    count, weight = np.array([1, 2, 5, 100, 10_000]), np.array([1e-9, 0.5, 10.0, 1.0, 1e6])
    for r in (rng, None):
        t = Y.seat(count, weight, 0.5, r)
        assert (t >= 1).all() and (t <= count).all()
    mean = np.mean([Y.seat(np.array([50]), np.array([2.0]), 0.5, rng) for _ in range(2000)])
    assert mean == pytest.approx(Y.seat(np.array([50]), np.array([2.0]), 0.5, None)[0], rel=0.05)


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = H.documents(spark, ["one two", None]).withColumn("train", F.lit(False))
    rows = Y.score(docs).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert Y.score(H.no_rows(spark).withColumn("train", F.lit(True))).count() == 0


def test_scores_do_not_hang_on_the_session(spark, monkeypatch):
    monkeypatch.setattr(Y, "BUCKET_TOKENS", 2000)
    monkeypatch.setattr(Y, "CHUNK", 3000)
    docs = H.documents(spark, [H.prose(i, 60, 300) for i in range(120)]).select("doc_id", "text", (F.col("doc_id") % 7 != 2).alias("train"))
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, parts in ((4, 2), (16, 7), (211, 5)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append({r["doc_id"]: r["score"] for r in Y.score(docs.repartition(parts)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in seen[1:]:
        assert max(abs(other[d] - s) for d, s in seen[0].items()) < 1e-6
