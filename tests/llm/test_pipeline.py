import public_tokenizers
import sentencepiece

import corpus_pipeline
from fulltime.llm import fertility, pii_boost
from tests.llm import helpers as H
from tests.llm.test_jaccard_join import brute as groups_of
from tests.llm.test_pii_boost import brute as spans_of


def test_stages(spark):
    texts = [*H.edge_texts(), *[H.prose(i, 90) for i in range(30)], H.prose(3, 90), H.prose(3, 90) + " end",
             H.prose(60, 80) + " me@host.example.com +1 (323) 555-9830 " + H.prose(61, 20), "no " * 300]
    docs = H.clashing(H.documents(spark, texts), "kept", "spans", "label", "size")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        after[name] = docs.collect()
    model = public_tokenizers.path(corpus_pipeline.PIECES)
    good = {r["doc_id"] for r in fertility.verdict(H.documents(spark, texts), model).where("kept").collect()}
    assert {r["doc_id"] for r in after["quality"]} == good and len(good) >= 33
    kept = sorted(good)
    first = groups_of([texts[i] for i in kept])
    assert {r["doc_id"] for r in after["near_duplicates"]} == {kept[i] for i, (_, c) in first.items() if i == c}
    assert len(after["near_duplicates"]) == len(after["personal_data"]) < len(good)
    assert not any(spans_of(r["text"]) for r in after["personal_data"])
    assert all(r["n_chars"] == len(r["text"]) for r in after["mixing"])
    assert len(after["mixing"]) == len(after["sentencepiece"])
    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    want = sorted((r["doc_id"], lib.encode(r["text"], add_eos=True)) for r in after["mixing"])
    assert sorted((r["doc_id"], r["ids"]) for r in after["sentencepiece"]) == want


def test_run_over_a_folder(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns)


def test_kinds_are_those_of_the_detector():
    assert pii_boost.KINDS == ("email", "ip", "card", "phone")
