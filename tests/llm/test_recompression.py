import random
from hashlib import sha256

import numpy as np
import pytest

from fulltime.llm import recompression as R
from tests.llm import helpers as H


def brute(rows, width):
    """{(id, text): (n_words, n_removed, hash)} of (doc_id, text)."""
    split = [(d, [w.group().encode() for w in H.WORD.finditer(t or "")]) for d, t in rows]
    low = {}
    for d, ws in split:
        for i in range(len(ws) - width + 1):
            if d is not None:
                key = tuple(ws[i:i + width])
                low[key] = min(low.get(key, d), d)
    out = []
    for d, ws in split:
        gone = {j for i in range(len(ws) - width + 1) if d is not None and low[tuple(ws[i:i + width])] < d for j in range(i, i + width)}
        out.append((d, len(ws), len(gone), sha256(b" ".join(w for j, w in enumerate(ws) if j not in gone)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, docs, width):
    """Texts out of shared passages, runs, periods, own words; copies, edited copies, ids that repeat or are null."""
    r = random.Random(seed)
    word = lambda n: f"w{r.randrange(n)}"
    passages = [[word(5000) for _ in range(r.randrange(width - 3, 4 * width))] for _ in range(6)]
    passages += [["run"] * (2 * width), ["a", "b"] * width, ["x", "y", "z"] * width, [word(2) for _ in range(3 * width)]]
    rows = []
    for i in range(docs):
        ws = []
        for _ in range(r.randrange(5)):
            p = r.choice(passages)
            a = r.randrange(len(p))
            ws += r.choice([p, p[a:], p[:a], [word(5000) for _ in range(r.randrange(2 * width))], [word(3) for _ in range(r.randrange(width))]])
        if rows and r.random() < 0.3:
            ws = [w.decode() for w in (rows[r.randrange(len(rows))][1] or "").encode().split()]
            for _ in range(r.randrange(3)):
                if ws:
                    ws[r.randrange(len(ws))] = word(5000)
        text = "".join(w + r.choice([" ", " ", "\n", "\t ", " é\x85 "]) for w in ws)
        rows.append((r.choice([None, i, i, i, i, i, max(0, i - 1)]), text if r.random() > 0.03 else None))
    return rows + [(7, rows[0][1]), (10 ** 12, rows[1][1]), (-3, " ".join(passages[0]))]


@pytest.mark.parametrize("seed, width, chunk", [(1, 50, 3000), (2, 12, 200), (3, 12, 2_000_000), (4, 2, 900), (5, 30, 1)])
def test_equal_to_brute_force(spark, monkeypatch, seed, width, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = corpus(seed, 150, width)
    r = random.Random(seed)
    r.shuffle(rows)
    docs = H.clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "chunk", "name", "kind", "found")
    got = R.without_repeats(docs, width).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, width)


def test_edge_texts(spark):
    texts = H.edge_texts()
    docs = H.documents(spark, texts).union(H.null_row(spark))
    got = R.without_repeats(docs, 3).collect()
    assert sorted(map(tuple, got), key=str) == brute([*enumerate(texts), (None, None)], 3)
    assert R.without_repeats(H.no_rows(spark)).collect() == []
    assert R.without_repeats(H.null_row(spark)).collect()[0]["n_words"] == 0


def test_sure_symbols_stand_wherever_the_words_do():
    """What ``rounds`` calls sure in a window has the same low symbols in any other surroundings."""
    r = random.Random(9)
    for k in range(200):
        vocabulary = r.choice([2, 5, 1000])
        window = [f"w{r.randrange(vocabulary)}" for _ in range(40)]
        seen = []
        for _ in range(3):
            sides = [[f"w{r.randrange(vocabulary)}" for _ in range(r.randrange(20))] for _ in range(2)]
            text = " ".join(sides[0] + window + sides[1]).encode()
            words = R.Chunk(text + b"\n", [len(text)])
            at = words.windows(40)
            sure = np.array([at, at + 40])
            for n, symbols, first, _ in words.rounds(40, sure):
                if n == R.LOW:
                    break
            here, end = len(sides[0]), np.r_[first, len(words.word)][1:]
            x, y = sure[:, list(at).index(here)]
            inside = (first >= x) & (end <= y)
            seen.append(({(int(f) - here, int(s)) for f, s in zip(first[inside], symbols[inside])},
                         {(int(f) - here, int(s)) for f, s in zip(first, symbols)}))
        assert all(sure <= every for sure, _ in seen for _, every in seen)


def test_long_repeats_are_high_symbols():
    """A shared stretch much longer than a window has high symbols of its own in both texts."""
    r = random.Random(4)
    shared = [f"s{r.randrange(10 ** 6)}" for _ in range(3000)]
    names = []
    for side in "ab":
        text = " ".join([f"{side}{i}" for i in range(100)] + shared + [f"{side}{i}" for i in range(70)]).encode()
        words = R.Chunk(text + b"\n", [len(text)])
        rounds = words.rounds(50)
        for k, *_ in rounds:
            if k == R.LOW:
                break
        name, first, end = words.high(50, rounds)
        names.append({int(n): int(e - f) for n, f, e in zip(name, first, end)})
    both = names[0].keys() & names[1].keys()
    assert sum(sorted((names[0][n] for n in both), reverse=True)[:3]) > 300


def test_text_and_spans(spark):
    rows = [(1, "a b c d e"), (2, "x a b c d y"), (3, "a b c d e a b c d")]
    got = {r["doc_id"]: r for r in R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 3, with_text=True).collect()}
    assert got[1]["kept"] == "a b c d e" and got[1]["removed"] == []
    assert got[2]["kept"] == "x y" and [tuple(s) for s in got[2]["removed"]] == [(1, 5)]
    assert got[3]["kept"] == "" and [tuple(s) for s in got[3]["removed"]] == [(0, 9)]
