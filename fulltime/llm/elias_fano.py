"""Token ids of documents in a shard format with Elias-Fano encoded document boundaries.

A shard is one binary record: a header, the document ids, the boundaries, then all ids one after
another in the narrowest of two or four bytes. Boundaries (end offsets, never falling) take
2 + log2(ids / documents) bits each: the low bits are packed, the high bits stand as ones in a bit
vector, one after as many zeros as the high part counts. Ends are read back with select, from
a sample of the positions of every 256th one and a popcount from there; no table of 64-bit offsets exists.

``write_shards`` deals documents out by range of doc_id, so shards in order of (part, seq) hold
ascending doc_ids (nulls first; rows of the same doc_id by a hash of their text). A task flushes a shard every
``SHARD_IDS`` ids, so its memory is bounded; a longer document makes a longer shard. The records are
written by Spark's own writer, so they go to any store that Spark reaches.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import Generations, Split, arrow_rows, fanout, filled, gather, map_arrow, per_process, slices

MAGIC = b"EFID"
SAMPLE = 256
SHARD_IDS = 2_000_000
#: Entries of each generation of a process's table of known chunks (speed only).
KNOWN = 500_000


class EliasFano:
    """A rising sequence of whole numbers in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"),
                   np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _lows(self, first: int, n: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(n, np.int64)
        a = first * self.low_bits
        bits = np.unpackbits(self.low[a // 8:(a + n * self.low_bits + 7) // 8], bitorder="little")
        bits = bits[a % 8:a % 8 + n * self.low_bits].reshape(n, self.low_bits)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value: popcount on from the sampled one before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.sample[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        window = self.high[byte:byte + 64].copy()
        window[0] &= 0xFF << (at % 8) & 0xFF
        while (ones := int(np.bitwise_count(window).sum())) <= left:
            left, byte = left - ones, byte + 64
            window = self.high[byte:byte + 64]
        pos = 8 * byte + int(np.flatnonzero(np.unpackbits(window, bitorder="little"))[left])
        return (pos - i << self.low_bits) + int(self._lows(i, 1)[0])

    def selects(self, at: np.ndarray) -> np.ndarray:
        """The values at rising places: the ones of each sampled stretch that has some, from its sample on."""
        at = np.asarray(at, np.int64)
        if len(at) and not 0 <= at[0] <= at[-1] < self.n:
            raise IndexError((int(at[0]), int(at[-1])))
        pos, own = np.empty(len(at), np.int64), at // SAMPLE
        for b in np.unique(own).tolist():
            mine = slice(*np.searchsorted(own, [b, b + 1]))
            start, stop = int(self.sample[b]), int(self.sample[b + 1]) if b + 1 < len(self.sample) else 8 * len(self.high)
            ones = np.flatnonzero(np.unpackbits(self.high[start // 8:(stop + 7) // 8], bitorder="little")[start % 8:])
            pos[mine] = start + ones[at[mine] - b * SAMPLE]
        lows = self._lows(int(at[0]), int(at[-1] - at[0]) + 1)[at - at[0]] if len(at) else np.zeros(0, np.int64)
        return (pos - at << self.low_bits) + lows

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return (ones - np.arange(self.n) << self.low_bits) + self._lows(0, self.n)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBIII", self.n, self.low_bits, len(self.low), len(self.high), len(self.sample))
        return head + self.low.tobytes() + self.high.tobytes() + self.sample.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<QBIII", raw, at)
        at += struct.calcsize("<QBIII")
        low, high = np.frombuffer(raw, np.uint8, a, at), np.frombuffer(raw, np.uint8, b, at + a)
        return cls(n, low_bits, low, high, np.frombuffer(raw, "<u4", c, at + a + b)), at + a + b + 4 * c


def pack_shard(doc_ids: list[int | None], lens: list[int], ids: bytes, width: int) -> bytes:
    """One shard record; ``ids`` are little-endian, ``width`` bytes each."""
    ends = EliasFano.of(np.cumsum(lens)).to_bytes()
    known = np.packbits([x is not None for x in doc_ids], bitorder="little").tobytes()
    docs = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    return b"".join([struct.pack("<4sHHQ", MAGIC, 1, width, len(doc_ids)), docs, known, ends, ids])


def read_shard(raw: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """Document ids, their end offsets and all ids of a shard record."""
    magic, version, width, n = struct.unpack_from("<4sHHQ", raw)
    if magic != MAGIC or version != 1:
        raise ValueError("not a shard of token ids")
    at = struct.calcsize("<4sHHQ")
    docs = np.frombuffer(raw, "<i8", n, at).tolist()
    at += 8 * n
    known = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at), bitorder="little")[:n].tolist()
    ends, at = EliasFano.from_bytes(raw, at + (n + 7) // 8)
    return [d if k else None for d, k in zip(docs, known)], ends, np.frombuffer(raw, f"<u{width}", -1, at)


class WordIds:
    """Ids of texts, by chunks between blanks, each distinct chunk encoded once by the library.

    The vocabulary's pre-tokenizer never joins characters across a space or line end, so the ids of a
    text are those of its chunks. A chunk of ASCII characters is taken in lower case (the vocabulary's
    own normalisation), and a point or comma after an ASCII letter by itself. A chunk of letters that
    normalisation leaves alone is one word of the library's model, and goes to that model straight;
    all others go through the library's whole chain, many at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.width = 2 if self.lib.get_vocab_size() <= 1 << 16 else 4
        self.known = Generations(KNOWN)
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + k for k, b in enumerate(rest)}

    def _encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after another, and their number by chunk."""
        plain = pc.and_(pc.string_is_ascii(chunks), pc.and_(pc.ascii_is_alpha(chunks), pc.ascii_is_lower(chunks))).to_pylist()
        texts, word = chunks.to_pylist(), self.lib.model.tokenize
        out: list = [None] * len(texts)
        odd = []
        for i, (c, p) in enumerate(zip(texts, plain)):
            if p:
                out[i] = [t.id for t in word(c)]
            elif c.isalpha() and c == c.lower() and unicodedata.is_normalized("NFC", c):
                out[i] = [t.id for t in word(c.encode().decode("latin-1").translate(self.alphabet))]
            else:
                odd.append(i)
        for k in range(0, len(odd), 20_000):  # joined by blanks, then cut by the places the ids come from
            some = [texts[i] for i in odd[k:k + 20_000]]
            got = self.lib.encode(" ".join(some), add_special_tokens=False)
            first = np.cumsum([0, *map(len, some[:-1])]) + np.arange(len(some))
            owner = np.searchsorted(first, np.array([a for a, _ in got.offsets], np.int64), "right") - 1
            cut = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(some)))].tolist()
            ids = got.ids
            for i, a, z in zip(odd[k:k + 20_000], cut, cut[1:]):
                out[i] = ids[a:z]
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.dtype(f"<u{self.width}"), int(lens.sum())), lens

    def _learn(self, new: list[str]) -> list[bytes]:
        ids, lens = self._encode(pa.array(new, pa.string()))
        raw, cut = ids.tobytes(), (self.width * np.r_[0, np.cumsum(lens)]).tolist()
        return [raw[a:z] for a, z in zip(cut, cut[1:])]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another; and their number by text.

        Distinct chunks are cut into a stem (in lower case where it is ASCII) and a point or comma after it;
        stems are what the table of known ones holds, so one entry serves all forms.
        """
        split = Split(pc.split_pattern(pc.replace_substring(texts, "\n", " "), " "))
        words = split.distinct
        tailed = pc.match_substring_regex(words, r"[A-Za-z][.,]\z")
        stems = pc.if_else(tailed, pc.utf8_slice_codeunits(words, 0, -1), words)
        stems = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        coded = pa.concat_arrays([pa.array([".", ","]), stems]).dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        values = self.known.of(coded.dictionary.to_pylist(), self._learn)
        lens = np.fromiter(map(len, values), np.int64, len(values)) // self.width
        tail = np.where(tailed.to_numpy(zero_copy_only=False), np.where(pc.ends_with(words, ".").to_numpy(zero_copy_only=False), 0, 1), -1)
        parts = np.c_[at[2:], np.where(tail >= 0, at[np.maximum(tail, 0)], -1)].ravel()
        flat, n = gather(np.frombuffer(b"".join(values), f"<u{self.width}"), lens, parts[parts >= 0])
        width = np.zeros(len(parts), np.int64)
        width[parts >= 0] = n
        ids, n = gather(flat, width.reshape(-1, 2).sum(1), split.at)
        cut = np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(split.lens)]]
        return ids, np.diff(cut)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encodes every text of (doc_id, text), an end id after each, and writes shards to ``path``.

    A null text counts as empty (the end id only). Columns of the written table: part, seq (its order),
    before (ids of the part's earlier shards), n_docs, n_ids, shard (the record).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder, part = per_process(f"words {tokenizer}", lambda: WordIds(tokenizer)), TaskContext.get().partitionId()
        doc_ids, lens, raws, held, seq, before = [], [], [], 0, 0, 0

        def flush() -> dict:
            return {"part": [part], "seq": [seq], "before": [before], "n_docs": [len(doc_ids)], "n_ids": [held],
                    "shard": [pack_shard(doc_ids, lens, b"".join(raws), coder.width)]}

        for b in slices(batches, "text", 8_000_000):
            ids, n = coder.texts(filled(b.column("text")))
            ends = np.cumsum(n + 1)  # an end id after each text
            whole = np.full(int(ends[-1]), end_id, f"<u{coder.width}")
            own = np.ones(len(whole), bool)
            own[ends - 1] = False
            whole[own] = ids
            docs_of, at = b.column("doc_id").to_pylist(), 0
            while at < len(n):  # a shard takes documents until it has its ids
                start = int(ends[at - 1]) if at else 0
                stop = min(len(n), int(np.searchsorted(ends, start + SHARD_IDS - held)) + 1)
                doc_ids += docs_of[at:stop]
                lens += (n[at:stop] + 1).tolist()
                raws.append(whole[start:ends[stop - 1]].tobytes())
                held, at = held + int(ends[stop - 1]) - start, stop
                if held >= SHARD_IDS:
                    yield flush()
                    doc_ids, lens, raws, held, seq, before = [], [], [], 0, seq + 1, before + held
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # rows of one doc_id by a hash of their text, so that a hot one is dealt to many tasks
    dealt = rows.withColumn("own", F.xxhash64("text")).repartitionByRange(fanout(docs.sparkSession), "doc_id", "own")
    dealt = dealt.sortWithinPartitions("doc_id", "own", "text").drop("own")
    with arrow_rows(docs.sparkSession, 1000):
        map_arrow(dealt, run, "part int, seq int, before long, n_docs long, n_ids long, shard binary").write.parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document of a written shard table: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it: those of earlier parts (one total for each part,
    added up on the driver), of the part's earlier shards, and of the shard before the boundary.
    """
    totals = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_ids").cast("long")).collect())
    base, at = {}, 0
    for part, n in totals:
        base[part], at = at, at + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for part, before, raw in zip(*(b.column(c).to_pylist() for c in ("part", "before", "shard"))):
                docs, ends, ids = read_shard(raw)
                wide, cut = memoryview(ids.astype("<u4").tobytes()), np.r_[0, ends.selects(np.arange(len(docs)))]
                yield {"doc_id": docs, "start": base[part] + before + cut[:-1], "n_tokens": np.diff(cut),
                       "ids_crc32": [zlib.crc32(wide[a:z]) for a, z in zip((4 * cut[:-1]).tolist(), (4 * cut[1:]).tolist())]}

    return map_arrow(shards.select("part", "before", "shard"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
