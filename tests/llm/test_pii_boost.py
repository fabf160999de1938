import hashlib
import random
import re

import pytest

from fulltime.llm import pii_boost as P
from tests.llm import helpers as H

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    odd = [int(c) for c in digits[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 14 <= len(d) <= 19 and luhn(d),
            "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(P.KINDS) for m in re.finditer(BASE[kind], text) if good(kind, m[0]))


def texts():
    r = random.Random(8)
    out = [*H.edge_texts(), "a@b.c.d_e@f.g x@y z@.com @a.b", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 1.2.3", "12  34 4111 1111-1111 1111 4111111111111112",
           "+1 (323) 555-9830 +12 +1234567890123456 +44.20 7946 0958.", "😀 é x@y.zz 10.0.0.1 +49 (30) 1234567", "9" * 3000 + "@" + "a." * 500, "@" * 200 + "+" * 200]
    alphabet = "0123456789" * 3 + ".-+() @a"
    out += ["".join(r.choices(alphabet, k=r.randrange(5, 120))) for _ in range(1500)]
    out += ["".join(r.choices("ab._%+-@1 ", k=r.randrange(5, 60))) for _ in range(800)]
    return out


def test_base_spans_equal_brute_force(spark):
    data = texts()
    docs = H.clashing(H.documents(spark, data), "spans", "added").union(H.clashing(H.null_row(spark), "spans", "added"))
    rows = {r["doc_id"]: r for r in P.digest(docs, P.Detector(None, {})).collect()}
    for i, t in [*enumerate(data), (None, None)]:
        spans = brute(t or "")
        s = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(s.encode()).hexdigest() and rows[i]["spans"] == s, t
        assert [rows[i][f"n_{k}"] for k in P.KINDS] == [sum(x[1] == j for x in spans) for j in range(4)]


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(1)
    rows = []
    for i in range(1500):
        card = "4" + "".join(r.choices("0123456789", k=14))
        card = next(card + c for c in "0123456789" if luhn(card + c))
        bad = card[:-1] + str((int(card[-1]) + 1) % 10)
        rows.append(f"{H.prose(i, 12)} mail u{i}@host{r.randrange(9)}.example.com ip {r.randrange(256)}.1.{r.randrange(256)}.9 or 1.{300 + i}.2.3 "
                    f"card {card} no {bad} tel +1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)} on 20{r.randrange(10, 24)}-0{r.randrange(1, 9)}-1{r.randrange(9)} {i}")
    docs = H.documents(spark, rows)
    return P.fit(docs), docs


def test_model_adds_spans_and_keeps_base_ones(spark, fitted):
    detector, docs = fitted
    assert detector.score and detector.threshold["email"] <= 1
    probe = ["write to bob [at] host [dot] com today", "no data here 12 or 3.14", None]
    out = [r["spans"] for r in P.digest(H.documents(spark, probe), detector).orderBy("doc_id").collect()]
    assert out == ["email:9:32", "", ""]
    for r in P.digest(docs, detector).join(docs.select("doc_id", "text"), "doc_id").limit(200).collect():
        assert {f"{P.KINDS[k]}:{a}:{b}" for a, k, b in brute(r["text"])} <= set(r["spans"].split(","))


def test_redacted_texts_have_no_base_span(spark, fitted):
    detector, docs = fitted
    out = P.redact(H.clashing(docs, "spans", "candidates"), detector)
    assert out.columns == [*docs.columns, "spans", "candidates"]
    for r in out.limit(300).collect():
        assert not brute(r["text"]) and "[EMAIL]" in r["text"] and "[CARD]" in r["text"] and r["n_chars"] == len(r["text"])
    same = H.documents(spark, ["a  b\tc", "", None])
    assert [r["text"] for r in P.redact(same, detector).orderBy("doc_id").collect()] == ["a  b\tc", "", None]


def test_data_next_to_other_digits_is_proposed_and_found(spark):
    card = "4465758382889437"
    texts = [f"{card} {card}", f"pay 12 {card} 7 x", "+1 (826) 555-4081 190.137.223.204", "call 0171 5551234 or 01715551234", "999.10.0.0.1",
             "mail bob [at] host [dot] com. Thanks", "4111 1111 1111 1111 4111 1111 1111 1111", "é😀 " + card + " " + card]
    detector = P.Detector("1D", {k: 0.5 for k in P.KINDS})
    docs = P.with_candidates(H.documents(spark, texts))
    got = {r["doc_id"]: {(P.KINDS[c["k"]], c["b"], c["e"]) for c in r["candidates"] if c["label"] is None} for r in docs.collect()}
    assert {("card", 0, 16), ("card", 17, 33)} <= got[0] and ("card", 7, 23) in got[1] and {("card", 3, 19), ("card", 20, 36)} <= got[7]
    assert ("phone", 0, 17) in got[2] and not any(k == "phone" and e > 17 for k, _, e in got[2])
    assert {("phone", 5, 17), ("phone", 21, 32)} <= got[3] and ("ip", 4, 12) in got[4]
    assert ("email", 5, 28) in got[5] and {("card", 0, 19), ("card", 20, 39)} <= got[6]
    out = {r["doc_id"]: r["spans"].split(",") for r in P.digest(H.documents(spark, texts), detector).collect()}
    assert out[0] == ["card:0:16", "card:17:33"] and out[2] == ["phone:0:17", "ip:18:33"]
    assert [r["text"] for r in P.redact(H.documents(spark, texts[:1]), detector).collect()] == ["[CARD] [CARD]"]


def test_two_cards_in_a_run_of_the_table_are_found(spark):
    from fulltime.llm import queries
    rows = {r["doc_id"]: r["spans"] for r in queries.op5_pii(spark, "/root/testdata/sf0.01").where("doc_id in (254, 402)").collect()}
    assert all(rows[i].count("card:") == 2 for i in (254, 402))


def test_trees_as_sql_score_like_the_model():
    printed = "GBT\n  Tree 0 (weight 1.0):\n    If (feature 1 <= 2.5)\n     Predict: -1.0\n    Else (feature 1 > 2.5)\n     Predict: 0.5\n  Tree 1 (weight 0.3):\n    Predict: 0.25\n"
    assert P.trees_sql(printed) == ("1D / (1D + exp(-2D * (1.0D * (CASE WHEN c.length <= 2.5D THEN -1.0D ELSE 0.5D END) + 0.3D * (0.25D))))")


def test_all_candidates_of_all_documents_are_learned_from(spark):
    text = "ip 10.0.{}.{} or 1.{}.2.3"
    few = H.documents(spark, [text.format(i % 200, i // 200, 300 + i % 600) for i in range(600)])
    docs = few.union(few.crossJoin(spark.range(40)).select(*few.columns))  # 24,600 documents
    once, all_ = (P._labelled(d, "text").agg({"n": "sum", "k": "count"}).first() for d in (few, docs))
    assert all_["sum(n)"] == 41 * once["sum(n)"] > 40_000 and all_["count(k)"] == once["count(k)"]


def test_thresholds_equal_a_plain_pass(spark):
    r = random.Random(5)
    rows = [(k, int(r.random() < s ** 0.2), r.randrange(1, 9), s) for k in range(3) for s in (round(r.random(), 3) for _ in range(2000))]
    got = P._thresholds(spark.createDataFrame(rows, "k int, label int, n long, s double"), 0.95)
    for k in range(4):
        own = [x for x in rows if x[0] == k]
        reach = [s for s in {x[3] for x in own if x[3] >= 0.5}
                 if sum(x[1] * x[2] for x in own if x[3] >= s) >= 0.95 * sum(x[2] for x in own if x[3] >= s)]
        assert got[P.KINDS[k]] == min(reach, default=2.0)


def test_no_rows(spark):
    detector = P.fit(H.no_rows(spark))
    assert detector.score is None
    assert P.digest(H.no_rows(spark), detector).count() == 0 and P.redact(H.no_rows(spark), detector).count() == 0
