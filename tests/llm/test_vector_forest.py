import numpy as np

from fulltime.llm import vector_forest

KIND = "vec_id long, embedding array<float>"


def brute(vectors, k, every):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], np.float32).astype(np.float64)
    out = {}
    for a, i in enumerate(ids):
        if i % every == 0:
            s = [float(np.add.reduce(np.ascontiguousarray(v * x[a]))) for v in x]
            out[i] = sorted((-s[b], j) for b, j in enumerate(ids) if j != i)[:k]
    return out


def rows_of(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_small_table_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    v = {i: rng.standard_normal(8).astype(np.float32).tolist() for i in range(60)}
    v |= {i: v[3] for i in range(60, 110)}  # one vector fifty times: ties go to the smaller id
    odd = [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0] * 7 + [float("nan")]), (280, [1.0] * 7 + [None]),
           (300, [float("inf")] + [1.0] * 7), (320, [1.0, 2.0]), (None, [1.0] * 8)]
    rows = [*v.items(), *odd, (0, v[0])]  # id 0 twice
    df = spark.createDataFrame(rows, KIND).withColumnsRenamed({}).selectExpr("*", "'x' AS rank", "'y' AS node")
    assert rows_of(vector_forest.nearest(df, search=100.0)) == brute(v, 20, 20)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [-1.0, 0.0])], KIND)
    got = rows_of(vector_forest.nearest(df))
    assert {q: [i for _, i in r] for q, r in got.items()} == {0: [20, 7], 20: [0, 7]}
    assert vector_forest.nearest(spark.createDataFrame([], KIND)).count() == 0
    assert vector_forest.nearest(spark.createDataFrame([(0, [1.0])], KIND)).count() == 0


def test_recall_of_random_vectors(spark):
    rng = np.random.default_rng(2)
    v = {i: rng.standard_normal(32).astype(np.float32).tolist() for i in range(3000)}
    got, want = rows_of(vector_forest.nearest(spark.createDataFrame(list(v.items()), KIND))), brute(v, 20, 20)
    assert got.keys() == want.keys()
    recall = np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want])
    assert recall >= 0.9
