import numpy as np
import pytest

from fulltime.llm import ppm_langid as L
from tests.llm import helpers as H

SAMPLES = {"de": ["der hund und die katze sind nicht mit dem auto gefahren und der mann auch nicht"] * 3 + ["das ist ein kleiner satz über die welt"],
           "en": ["the dog and the cat did not go with the car and the man did not go either"] * 3 + ["this is a short sentence about the world"],
           "fr": ["le chien et le chat ne sont pas partis avec la voiture et cet homme non plus"] * 3 + ["ceci est une phrase à propos du monde"]}


def brute_bits(model, name, text):
    """Code length by the definition, context by context."""
    w, texts = model.width, [model.symbol[np.frombuffer(t.encode(), np.uint8)].tolist() for t in SAMPLES[name]]
    counts = {}
    for t in texts:
        for k in range(4):
            for i in range(len(t) - k):
                counts.setdefault(tuple(t[i:i + k]), {}).setdefault(t[i + k], 0)
                counts[tuple(t[i:i + k])][t[i + k]] += 1
    s = [int(model.symbol[32])] * 3 + model.symbol[np.frombuffer(text.encode(), np.uint8)].tolist()
    bits = 0.0
    for i in range(3, len(s)):
        for k in range(3, -1, -1):
            c = counts.get(tuple(s[i - k:i]), {})
            n, d = sum(c.values()), len(c)
            if s[i] in c:
                bits += np.log2((n + d) / c[s[i]])
                break
            if n:
                bits += np.log2((n + d) / d)
        else:
            bits += np.log2(w)
        if s[i] == w - 1:
            bits += np.log2(257 - w)
    return bits


def test_code_lengths_equal_the_definition():
    model = L.PpmModel({k: [t.encode() for t in v] for k, v in SAMPLES.items()})
    for text in ("the cat", "über den wolken", "xyzzy QQ 123", "é", "日本"):
        got = model.bits(text.encode())
        assert got == pytest.approx([brute_bits(model, k, text) for k in model.languages], rel=1e-4)


def test_predictions_and_odd_rows(spark):
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, v in SAMPLES.items() for t in v)]
    train = spark.createDataFrame([*rows, (90, None, "en"), (91, "no language", None), (92, "", "fr")], "doc_id long, text string, lang string")
    model = L.fit(train)
    assert model.languages == ["de", "en", "fr"]
    docs = H.clashing(H.documents(spark, ["the man and the dog", "der mann und das auto", "le chat et la voiture", *H.edge_texts()]), "lang_pred", "score")
    got = {r["doc_id"]: r for r in L.predict(docs, model, keep=["doc_id", "lang", "score"]).collect()}
    assert [got[i]["lang_pred"] for i in range(3)] == ["en", "de", "fr"]
    for i, t in enumerate(H.edge_texts(), 3):
        assert (got[i]["lang_pred"] == "und") == (not any(map(str.isalpha, t or ""))), t
        assert 0 <= got[i]["score"] <= 1
    assert L.predict(H.no_rows(spark), model).count() == 0


def test_languages_of_one_script_among_many(spark):
    """Thirty languages, most in Latin letters: those in other scripts are still told apart by all their bytes."""
    other = {"ru": "все люди рождаются свободными и равными в своем достоинстве и правах", "uk": "всі люди народжуються вільними і рівними у своїй гідності та правах",
             "bg": "всички хора се раждат свободни и равни по достойнство и права", "ja": "すべての人間は生まれながらにして自由であり", "zh": "人人生而自由在尊严和权利上一律平等"}
    latin = {f"l{i:02}": H.prose(i, 400).encode() for i in range(25)}
    model = L.PpmModel({k: [t.encode()] * 3 for k, t in other.items()} | {k: [t] * 3 for k, t in latin.items()})
    probe = {"ru": "рождаются равными", "uk": "народжуються рівними", "bg": "раждат равни", "ja": "人間は自由", "zh": "生而平等"}
    for k, t in probe.items():
        assert model.languages[int(model.bits(t.encode()).argmin())] == k
    assert model.width == 256 and len(np.unique(model.symbol)) == 256


def test_long_documents_teach(spark):
    rows = [(1, SAMPLES["de"][0] * 2000, "de"), (2, SAMPLES["en"][0], "en"), (3, "é" * 40_000 + "日本" * 40_000, "xx")]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "xx"]
    assert [model.languages[int(model.bits(t.encode()).argmin())] for t in ("der hund und die katze", "the dog and the cat", "日本", "éé")] == ["de", "en", "xx", "xx"]


def test_nothing_to_learn_from(spark):
    model = L.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert L.predict(H.documents(spark, ["abc"]), model).first()["lang_pred"] == "und"


def test_held_out_accuracy(spark):
    from fulltime.llm import queries
    sf = "/root/testdata/sf0.01"
    got = queries.op7_ppm(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null").collect()
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
