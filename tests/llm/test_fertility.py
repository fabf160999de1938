import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fulltime.llm import fertility
from tests.llm import helpers as H

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(lib, t):
    t = t or ""
    w, lines = H.WORD.findall(t), [x for x in t.split("\n") if H.WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    ids = lib.encode(t)
    n = max(1, len(ids))
    share = np.array(list(Counter(ids).values()) or [1]) / n
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(hit), "n_tokens": len(ids), "base_failed": len(w) < 50 or 100 * len(hit) > 50 * len(w),
            "chars_per_token": len(t) / n, "byte_share": sum(lib.is_byte(i) for i in ids) / n, "token_entropy": float(-(share * np.log2(share)).sum()) if ids else 0.0}


def test_measures_equal_brute_force(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*H.edge_texts(), *[H.prose(i, 20 + 15 * i, 60 + 40 * i) for i in range(20)], H.prose(1, 80) + "\n" + H.prose(1, 80), "a b c\na b c\n\n x#*$%&|<>\nx#", H.prose(4, 20000)]
    docs = H.clashing(H.documents(spark, texts).union(H.null_row(spark)), "script", "n_words", "kept")
    rows = {r["doc_id"]: r for r in fertility.verdict(docs, MODEL, keep=["doc_id"]).collect()}
    assert len(rows) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, None)]:
        for k, v in brute(lib, t).items():
            assert rows[i][k] == pytest.approx(v), (i, k)
        assert not (rows[i]["base_failed"] and rows[i]["kept"])


def test_bands(spark):
    words = "river stone winter garden little morning walked toward quiet house because nobody answered letters about summer light".split()
    clean = " ".join(words[(i * i * 7 + i * 3 + i // 5) % len(words)] + str(i)[-1:] * (i % 9 == 0) for i in range(160))
    noise = " ".join("".join(chr(0xE000 + (i * 37 + k) % 500) for k in range(5)) for i in range(120))
    dull = " ".join(("ha", "hm")[(i * i // 3) % 2] + "!" * (i % 3) for i in range(200))
    rows = fertility.verdict(H.documents(spark, [H.prose(2, 400), noise, dull, clean]), MODEL).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows][:3] == [True, False, False]
    assert rows[1]["byte_share"] > 0.5 and rows[0]["script"] == "latin"
    wide = {k: (0.0, 99.0, 1.0, 0.0) for k in fertility.BANDS}
    assert all(r["kept"] != r["base_failed"] for r in fertility.verdict(H.documents(spark, [noise, dull, "short"]), MODEL, bands=wide).collect())


def test_clean_labelled_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    rows = fertility.verdict(spark.read.parquet(f"{sf}/documents.parquet"), MODEL, keep=["doc_id"]).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert rows.where("quality = 1 and n_words >= 50 and not kept").count() == 0
    assert rows.where("quality = 0 and not kept").count() > 0


def test_no_rows(spark):
    assert fertility.verdict(H.no_rows(spark), MODEL).count() == 0
