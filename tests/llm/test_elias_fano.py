import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fulltime.llm import elias_fano as E
from fulltime.llm.common import shared_path
from tests.llm import helpers as H

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n, step", [(1, 0), (1, 9), (20, 0), (1000, 3), (3000, 900), (700, 10 ** 6)])
def test_select_and_bytes(n, step):
    r = random.Random(n)
    v = np.cumsum([r.randrange(step + 1) for _ in range(n)])
    e, end = E.EliasFano.from_bytes(b"xx" + E.EliasFano.of(v).to_bytes(), 2)
    assert e.values().tolist() == v.tolist() and end == len(E.EliasFano.of(v).to_bytes()) + 2
    assert [e.select(i) for i in range(n)] == v.tolist() == e.selects(np.arange(n)).tolist()
    some = sorted(r.sample(range(n), max(1, n // 7)))
    assert e.selects(np.array(some)).tolist() == v[some].tolist() and e.selects(np.zeros(0, np.int64)).tolist() == []
    with pytest.raises(IndexError):
        e.selects(np.array([0, n]))
    with pytest.raises(IndexError):
        e.select(n)
    if n >= 1000:  # near 2 + log2(u / n) bits each, the sample and the header aside
        assert 8 * (len(e.low) + len(e.high)) <= n * (3 + max(0, np.log2(max(1, v[-1] / n)))) + 64


def test_empty_sequence():
    e, _ = E.EliasFano.from_bytes(E.EliasFano.of(np.zeros(0, np.int64)).to_bytes(), 0)
    assert e.values().tolist() == []


def test_ids_equal_the_library():
    r, coder, lib = random.Random(3), E.WordIds(FILE), Tokenizer.from_file(FILE)
    texts = ["".join(r.choices("aeinrSTst thdor.,'\n  012=-_*()<>éßÉΣσ▁日😀\t́İ\x1c", k=r.randrange(80))) for _ in range(4000)]
    texts += [t or "" for t in H.edge_texts()] + ["<|endoftext|> a", "x<|startoftext|>.", "it's. They're, a.b, c..", "A.́ é."]
    for part in (texts, texts[::-1]):
        ids, n = coder.texts(pa.array(part, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]


def test_shards_round_trip(spark, monkeypatch):
    texts = [*H.edge_texts(), *[H.prose(i, 200) for i in range(60)]]
    docs = H.clashing(H.documents(spark, texts).union(H.null_row(spark)).repartition(3), "start", "part", "shard")
    monkeypatch.setattr(E, "SHARD_IDS", 700)
    path = shared_path(spark, "shards")
    E.write_shards(docs, FILE, 2, path)
    assert spark.read.parquet(path).count() > 5
    rows = {r["doc_id"]: r for r in E.read_shards(spark.read.parquet(path)).collect()}
    lib, at = Tokenizer.from_file(FILE), 0
    assert len(rows) == len(texts) + 1
    for i, t in [(None, None), *enumerate(texts)]:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert (rows[i]["start"], rows[i]["n_tokens"]) == (at, len(ids))
        assert rows[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_a_doc_id_that_fills_tasks(spark, monkeypatch):
    monkeypatch.setattr(E, "SHARD_IDS", 900)
    texts = [H.prose(i, 60) for i in range(80)]
    docs = spark.createDataFrame([(5 if i % 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    path = shared_path(spark, "shards")
    E.write_shards(docs, FILE, 2, path)
    assert spark.read.parquet(path).select("part").distinct().count() > 4
    rows = sorted(E.read_shards(spark.read.parquet(path)).collect(), key=lambda r: r["start"])
    lib, at = Tokenizer.from_file(FILE), 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == sorted(5 if i % 4 else i for i in range(80))
    want = [(5 if i % 4 else i, lib.encode(t, add_special_tokens=False).ids + [2]) for i, t in enumerate(texts)]
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in rows) == sorted((d, zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in want)


def test_no_rows(spark):
    path = shared_path(spark, "shards")
    E.write_shards(H.no_rows(spark), FILE, 2, path)
    assert E.read_shards(spark.read.parquet(path)).count() == 0
