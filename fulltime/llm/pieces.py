"""Encoding and decoding with a subword model of the SentencePiece BPE kind.

A text becomes one symbol per character with the blank mark put before it and for every blank.
No piece of such a vocabulary goes on after a blank mark that follows another character, so a text
falls apart into words (blank marks, then other characters) that are encoded by themselves. All new
words of a batch are encoded together, in rounds over flat arrays: the rank of every adjacent pair,
the least rank of each word (segmented minimum), all its leftmost non-overlapping pairs of that rank
merged at once, the arrays compacted, until no word has a pair left.

Merging all pairs of a rank at once equals merging them one by one as long as the merged symbol
can't open a pair of that rank or a better one. ``PieceCoder`` finds the symbols that could
(``greedy`` False) from the vocabulary, and then merges only a word's leftmost pair in that round.
A word of more than ``LONG`` symbols goes through a heap instead, in n log n steps.

Defined results: a null text counts as empty; an empty text has the end id only; characters outside
the vocabulary become byte pieces; decoding leaves control ids out.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import Generations, Split, extended, filled, gather, map_arrow, per_process, slices

MARK = "▁"
#: Words of more symbols than this go through the heap.
LONG = 2048
#: Entries of each generation of a process's table of known words (speed only).
KNOWN = 80_000
#: Bytes of text that are worked on at a time: decoding holds some thirty bytes for each.
SLICE = 500_000
NONE = np.iinfo(np.int32).max


class PieceCoder:
    """Vocabulary arrays of one model file, with the table of words already encoded."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kinds = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        texts = [sp.id_to_piece(i) for i in range(n)]
        self.end, self.size = sp.eos_id(), n
        self.byte_id = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(texts[i][3:-1], 16)] = i
        symbols = {t: i for i, t in enumerate(texts) if not kinds[i]}
        if any(re.search(f"[^{MARK}]{MARK}", t) for t in symbols):
            raise ValueError("pieces with a blank mark after another character are not supported")
        for c in sorted({c for t in symbols for c in t} - symbols.keys()):
            symbols[c] = len(texts)  # a character that only longer pieces have
            texts.append(c)
        self.wide = len(texts)
        score = np.array([sp.get_score(i) if i < n else -np.inf for i in range(self.wide)])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        merges = {}
        self.greedy = np.ones(self.wide, bool)
        for t, i in symbols.items():
            for k in range(1, len(t)):
                a, b = symbols.get(t[:k]), symbols.get(t[k:])
                if a is not None and b is not None and i < n:
                    merges[a * self.wide + b] = i
                    for part in (a, b):
                        if self.rank[i] <= self.rank[part]:
                            self.greedy[part] = False
        self.keys = np.array(sorted(merges), np.int64)
        self.made = np.array([merges[k] for k in sorted(merges)], np.int32)
        self.merges = merges
        self.char = np.full(0x110000, -1, np.int32)
        for t, i in symbols.items():
            if len(t) == 1:
                self.char[ord(t)] = i
        raw = [b"" if sp.is_control(i) or sp.is_unknown(i) else bytes([int(t[3:-1], 16)]) if sp.is_byte(i)
               else t.replace(MARK, " ").encode() for i, t in enumerate(texts[:n])]
        self.raw, self.raw_len = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.table = Generations(KNOWN)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The symbol that each pair makes, -1 if none."""
        key = a.astype(np.int64) * self.wide + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.made[at], -1).astype(np.int32)

    def _rounds(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after the last merge, and their number by word."""
        word = np.repeat(np.arange(len(lens)), lens)
        done_sym, done_word = [], []
        made = np.full(len(sym), -1, np.int32)
        made[:-1] = np.where(word[1:] == word[:-1], self._pairs(sym[:-1], sym[1:]), -1)
        while len(sym):
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            n = np.diff(np.r_[first, len(word)])
            least = np.repeat(np.minimum.reduceat(rank, first), n)
            over = least == NONE
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                stay = ~over
                sym, word, made, rank, least = sym[stay], word[stay], made[stay], rank[stay], least[stay]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            leader = np.r_[True, word[at[1:]] != word[at[:-1]]]
            run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])  # of adjacent hits every second one merges
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[np.where(self.greedy[made[at]], nth % 2 == 0, leader)]
            sym[at] = made[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            new = np.cumsum(stay) - 1
            at = new[at]
            sym, word, made = sym[stay], word[stay], made[stay]
            near = np.zeros(len(sym), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            redo = np.flatnonzero(near)
            nxt = np.minimum(redo + 1, len(sym) - 1)
            same = (word[redo] == word[nxt]) & (nxt > redo)
            made[redo] = np.where(same, self._pairs(sym[redo], sym[nxt]), -1)
        if not done_sym:
            return sym, lens
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(lens))

    def _heap(self, sym: list[int]) -> list[int]:
        """One long word: best rank first, then leftmost, over a linked list."""
        n, left, right = len(sym), list(range(-1, len(sym) - 1)), list(range(1, len(sym) + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := right[i]) < n and (m := self.merges.get(sym[i] * self.wide + sym[j])) is not None \
                    and sym[i] >= 0 and sym[j] >= 0:
                heap.append((int(self.rank[m]), i, sym[i], sym[j])) if not heap else \
                    heapq.heappush(heap, (int(self.rank[m]), i, sym[i], sym[j]))

        alive = [True] * n
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], right[i] = self.merges[a * self.wide + b], False, right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i])
            offer(i)
        return [s for s, on in zip(sym, alive) if on]

    def _symbols(self, text: str) -> np.ndarray:
        """One symbol a character; those outside the vocabulary by their code point: -1 - code point."""
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.char[cp]
        odd = np.flatnonzero(sym < 0)
        sym[odd] = -1 - cp[odd]
        return sym

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of each word (given without the mark before it), little-endian four bytes each."""
        if any(len(w) > LONG for w in words):
            long = {w: self._bytes(np.array(self._heap(self._symbols(MARK + w).tolist()), np.int64))[0].astype("<i4").tobytes()
                    for w in words if len(w) > LONG}
            rest = iter(self.learn([w for w in words if len(w) <= LONG]))
            return [long[w] if w in long else next(rest) for w in words]
        if not words:
            return []
        sym, lens = self._rounds(self._symbols(MARK + MARK.join(words)), np.array([len(w) for w in words]) + 1)
        ids, width = self._bytes(sym.astype(np.int64))
        raw, cut = ids.astype("<i4").tobytes(), (4 * np.r_[0, np.r_[0, np.cumsum(width)][np.cumsum(lens)]]).tolist()
        return [raw[a:z] for a, z in zip(cut, cut[1:])]

    def _bytes(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, those outside the vocabulary as byte pieces; and the number of ids of each symbol."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        width = np.ones(len(sym), np.int64)
        if not len(odd):
            return sym.astype(np.int32), width
        back = {int(i): c for c, i in ((c, self.char[c]) for c in np.flatnonzero(self.char >= self.size))}
        raw = [chr(-1 - s if s < 0 else back[s]).encode() for s in sym[odd].tolist()]
        width[odd] = [len(b) for b in raw]
        ids = np.repeat(sym, width).astype(np.int32)
        slot = np.repeat(np.isin(np.arange(len(sym)), odd), width)
        ids[slot] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, width

    def _joined(self, text: str) -> str:
        """A text whose words stand between single blanks, the mark before each left out."""
        if "  " in text or MARK in text or text[:1] == " " or text[-1:] == " ":
            found = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
            return " ".join([w[1:] for w in found])
        return text

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, without end ids; and their number by text."""
        odd = pc.or_(pc.match_substring_regex(texts, f"  |{MARK}|^ | $|^ "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        if pc.any(odd).as_py():
            texts = pa.array([self._joined(t) for t in texts.to_pylist()], pa.string())
        split = Split(pc.split_pattern(texts, " "))
        values = self.table.of(split.distinct.to_pylist(), self.learn)
        lens = np.fromiter(map(len, values), np.int64, len(values)) // 4
        ids, n = gather(np.frombuffer(b"".join(values), "<i4"), lens, split.at)
        n = np.diff(np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(split.lens)]])
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        return (ids[np.repeat(~empty, n)], np.where(empty, 0, n)) if empty.any() else (ids, n)

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        ids, n = self.encode_flat(texts)
        cut = np.r_[0, np.cumsum(n)]
        ids = np.insert(ids, cut[1:], self.end)
        return np.split(ids, (cut[1:] + np.arange(1, len(n) + 1))[:-1]) if len(n) else []

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id arrays: control ids say nothing, the mark put before a text goes."""
        if not ids:
            return []
        flat = np.concatenate(ids).astype(np.int64)
        n = self.raw_len[flat]
        ends = np.cumsum(n)
        raw = self.raw[np.repeat(self.raw_at[flat] - (ends - n), n) + np.arange(int(n.sum()))].tobytes()
        cut = np.r_[0, np.r_[0, ends][np.cumsum([len(x) for x in ids])]].tolist()
        return [(raw[a + 1:b] if raw[a:a + 1] == b" " else raw[a:b]).decode("utf-8", "replace")
                for a, b in zip(cut, cut[1:])]


def piece_coder(model: str) -> PieceCoder:
    """The process's coder for a model file."""
    return per_process(f"pieces {model}", lambda: PieceCoder(model))


def encode_documents(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` (any columns) with ``ids`` array<int> of the whole text, the end id last."""
    keep = [c for c in df.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = piece_coder(model)
        for b in slices(batches, text, SLICE):
            ids = coder.encode(filled(b.column(text)))
            at = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            yield {c: b.column(c) for c in keep} | {
                "ids": pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids), pa.int32()))}

    return map_arrow(df.select(*[F.col(f"`{c}`") for c in keep]), run, extended(df, keep, "ids array<int>"))


def decode_documents(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` string, the text of the id arrays (null: empty)."""
    keep = [c for c in df.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = piece_coder(model)
        for b in batches:
            out = coder.decode([np.array(x or [], np.int64) for x in b.column(ids).to_pylist()])
            yield {c: b.column(c) for c in keep} | {"decoded": out}

    return map_arrow(df.select(*[F.col(f"`{c}`") for c in keep]), run, extended(df, keep, "decoded string"))


def round_trip(df: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Digest of encoding, then decoding every text: one row per document of (doc_id, text).

    doc_id, n_tokens (all ids, the end id too), ids_sha256 (decimal ids joined by a space),
    decoded_sha256 (the decoded text in UTF-8); the ids themselves too, if asked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = piece_coder(model)
        decimal = list(map(str, range(coder.size)))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in slices(batches, "text", SLICE):
            ids = coder.encode(filled(b.column("text")))
            yield {
                "doc_id": b.column("doc_id"), "n_tokens": [len(x) for x in ids],
                "ids_sha256": [sha(" ".join(map(decimal.__getitem__, x.tolist()))) for x in ids],
                "decoded_sha256": [sha(t) for t in coder.decode(ids)],
            } | ({"ids": pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32),
                                                  np.concatenate(ids).astype(np.int32))} if with_ids else {})

    return map_arrow(df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
