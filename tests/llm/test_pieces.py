import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from fulltime.llm import pieces
from tests.llm import helpers as H

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(MODEL)


def test_equals_library_on_random_texts(lib, coder):
    r = random.Random(4)
    texts = ["".join(r.choices("aeinrst thdor.,\n  012=-_*()<>éß▁日€😀", k=r.randrange(60))) for _ in range(4000)]
    texts += ["".join(r.choices("ab ▁=", k=r.randrange(40))) for _ in range(4000)] + [t or "" for t in H.edge_texts()]
    got = coder.encode(texts)
    want = lib.encode(texts, add_eos=True)
    assert [x.tolist() for x in got] == want
    assert coder.decode(got) == [lib.decode(x) for x in want]


@pytest.mark.parametrize("word", ["=" * 3000, "ab" * 2500, " " * 4000 + "x", "aé日" * 900])
def test_long_words_take_the_heap(lib, coder, word):
    assert coder.encode([word])[0].tolist() == lib.encode(word, add_eos=True)


def test_round_trip_rows(spark, lib):
    texts = [*H.edge_texts(), H.prose(1, 300), H.prose(1, 300)]
    docs = H.clashing(H.documents(spark, texts).union(H.null_row(spark)), "n_tokens", "ids")
    rows = {r["doc_id"]: r for r in pieces.round_trip(docs, MODEL, with_ids=True).collect()}
    assert len(rows) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, None)]:
        ids = lib.encode(t or "", add_eos=True)
        assert rows[i]["n_tokens"] == len(ids) and rows[i]["ids"] == ids
        assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert pieces.round_trip(H.no_rows(spark), MODEL).count() == 0


def test_encode_and_decode_keep_columns(spark, lib):
    docs = H.documents(spark, ["hello  world", None])
    out = pieces.decode_documents(pieces.encode_documents(docs, MODEL), MODEL).orderBy("doc_id").collect()
    assert [r["decoded"] for r in out] == ["hello  world", ""] and out[0]["lang"] == "de"
