"""Long repeats between documents by recompression: word sequences that also start in an earlier document go.

A window is ``window`` consecutive words of one document. Every word covered by a window whose words also stand
in a document of a smaller id is removed; windows are judged on the input. The texts are packed into chunks
once, and Spark's rounds name things over all chunks:

1. ``symbols``: words are symbols. Runs of one symbol and then, round by round, pairs of a symbol of the left
   half of the alphabet and one of the right half become symbols (halves drawn by symbol and round). A name is a
   64-bit mix of what it stands for, so equal word sequences get the same interior symbols in every task.
   After ``LOW`` rounds, half of the symbols are joined with the one after them and reported with their text;
   rounds go on, with runs in each, and symbols of a window's length at least are reported with
   their document, up to the text as a whole.
2. A round over all names keeps low symbols of two texts or more, and the least document of high ones.
3. ``windows``: a high symbol that an earlier document has proves its windows. Which interior symbols a window
   shares with every other place where its words stand follows from the rounds (``Chunk.sure``); a window
   stays in question only if all those are kept ones. Windows in question get a 64-bit name of their words.
4. A round over these names gives each its least document; a second hash of the words verifies both matches.

Nothing is made per pair of documents; a symbol or window of a third of all documents is one row a chunk, and
Spark combines those before it shuffles and splits their join.

Defined results: null and empty texts have no words; words are told apart by their bytes; a document with fewer
words than a window loses none; documents of one id don't take words from each other; a document of null id
neither loses words nor takes any from others. Runs of a word, ties and repeated rows need no special case.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import filled, map_arrow, per_process, slices, stored

#: Bytes of text in a chunk (a longer text is a chunk of its own).
CHUNK = 500_000
#: Rounds up to the low symbols, and the longest symbol that takes part in them.
LOW, SHORT = 6, 8
#: High symbols are reported every so many rounds.
EVERY = 3

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = x ^ (x >> U(32))
    x *= _C
    x ^= x >> U(29)
    x *= _A
    x ^= x >> U(32)
    return x


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were ever needed."""

    def __init__(self, base: int):
        self.base, self.n = base, 0

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.r_[U(1), np.full(self.n - 1, b, U)])
                                  for b in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


def powers(which: int) -> Powers:
    return per_process("powers", lambda: [Powers(b) for b in _BASES])[which]


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A name for each stretch of values from starts to ends: equal for equal stretches, wherever they stand."""
    up, down = powers(which).of(len(values) + 1)
    sums = np.r_[U(0), np.cumsum(values * up[:-1])]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * _B)


def segments(parts: np.ndarray, n: int) -> np.ndarray:
    """Lengths of parts of n places that start at ``parts``."""
    return np.diff(np.r_[parts, n])


class Chunk:
    """Words of a chunk of texts, each text followed by a blank byte."""

    def __init__(self, raw: bytes, lens: list[int]):
        self.data = np.frombuffer(raw, np.uint8)
        self.solid = ~((self.data == 32) | ((self.data >= 9) & (self.data <= 13)))
        change = np.flatnonzero(np.diff(np.r_[False, self.solid]))
        self.first, self.last = change[0::2], change[1::2]  # a blank ends every text, so every word has its end
        # a byte's value: a fixed scatter of 1 to 256
        table = mix(np.arange(1, 257, dtype=U) * _A)
        self.word = stretches(np.where(self.solid, table[self.data], U(0)), self.first, self.last)
        self.offsets = np.cumsum(np.r_[0, np.asarray(lens, np.int64) + 1])
        self.cuts = np.searchsorted(self.first, self.offsets)
        self.n = np.diff(self.cuts)
        self.doc = np.repeat(np.arange(len(lens)), self.n)

    def texts(self) -> np.ndarray:
        """A name for the words of each text, in order."""
        return stretches(self.word, self.cuts[:-1], self.cuts[1:])

    def windows(self, width: int) -> np.ndarray:
        """First words of all windows."""
        at = np.arange(len(self.word))
        return at[at + width <= self.cuts[1:][self.doc]]

    def rounds(self, width: int, sure: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(round, symbols, first words, documents) after every round, until nothing changes.

        ``sure`` holds the first word and the end of every window; the low rounds narrow it down in place to the
        part whose symbols are the same wherever the window's words stand: at each end, a symbol that could
        join one outside is not sure, and a run of words that reaches the end isn't.
        """
        total = len(self.word)
        symbols, first, doc = self.word, np.arange(total), self.doc
        k = 0
        while True:
            low = k < LOW
            before = len(symbols)
            if k == 0 or not low:
                symbols, first, doc = self._runs(symbols, first, doc)
                if sure is not None and k == 0:
                    edges = np.r_[first, total]
                    sure[0] = edges[np.minimum(np.searchsorted(edges, sure[0], "right"), len(edges) - 1)]
                    sure[1] = edges[np.maximum(np.searchsorted(edges, sure[1], "left") - 1, 0)]
            takes_part = segments(first, total) <= SHORT if low else np.ones(len(symbols), bool)
            right = (mix(symbols + U((k + 1) * int(_B) % (1 << 64))) & U(1)).astype(bool)
            pair = ~right[:-1] & right[1:] & takes_part[:-1] & takes_part[1:] & (doc[:-1] == doc[1:])
            at = np.flatnonzero(pair)
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            if sure is not None and low and total:
                self._narrow(sure, np.r_[first, total], takes_part & right, takes_part & ~right, np.r_[stays, True])
            symbols = symbols.copy()
            symbols[at] = mix(mix(symbols[at] + U(2 * k + 3)) * _A ^ symbols[at + 1])
            symbols, first, doc = symbols[stays], first[stays], doc[stays]
            k += 1
            yield k, symbols, first, doc
            # 16 rounds without any pair: a share of 2^-16 of what could still join
            idle = idle + 1 if not low and len(symbols) == before else 0
            if not low and (idle >= 16 or len(symbols) <= np.count_nonzero(self.n)):
                return

    @staticmethod
    def _runs(symbols: np.ndarray, first: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of one symbol in a document as one symbol named by it and the run's length."""
        heads = np.flatnonzero(np.r_[True, (symbols[1:] != symbols[:-1]) | (doc[1:] != doc[:-1])][:len(symbols)])
        n = segments(heads, len(symbols))
        own = symbols[heads]
        return np.where(n > 1, mix(own * _B + n.astype(U)), own), first[heads], doc[heads]

    @staticmethod
    def _narrow(sure: np.ndarray, edges: np.ndarray, joins_left: np.ndarray, joins_right: np.ndarray, stays: np.ndarray) -> None:
        """Edges of the sure parts after a round of pairs; ``stays`` tells the edges that remain."""
        last = len(edges) - 1
        after = np.minimum.accumulate(np.where(stays, np.arange(last + 1), last)[::-1])[::-1]
        before = np.maximum.accumulate(np.where(stays, np.arange(last + 1), 0))
        i = np.searchsorted(edges, sure[0])
        sure[0] = np.where(np.r_[joins_left, False][i], edges[after[np.minimum(i + 1, last)]], edges[i])
        j = np.searchsorted(edges, sure[1])
        sure[1] = np.where(np.r_[False, joins_right][j], edges[before[np.maximum(j - 1, 0)]], edges[j])

    def low(self, symbols: np.ndarray, first: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(name, first word, end, document) of low symbols with the symbol after them, where that hashes higher:
        half of all, with few long stretches without one."""
        order = mix(symbols)
        at = np.flatnonzero((doc[:-1] == doc[1:]) & (order[:-1] < order[1:]))
        names = mix(mix(symbols[at] + U(1)) * _B ^ symbols[at + 1])
        return names, first[at], np.r_[first, len(self.word)][at + 2], doc[at]

    def high(self, width: int, rounds: Iterator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, first word, end) of the high symbols of the remaining rounds, and of whole texts."""
        out, met = [], np.zeros(0, np.int64)
        for k, symbols, first, _ in rounds:
            if (k - LOW) % EVERY:
                continue
            end = first + segments(first, len(self.word))
            key = first * (len(self.word) + 1) + end  # each stretch once
            new = (end - first >= width) & ~np.isin(key, met)
            met = key[end - first >= width]
            out.append((symbols[new], first[new], end[new]))
        whole = np.flatnonzero(self.n >= width)
        out.append((mix(self.texts()[whole]), self.cuts[:-1][whole], self.cuts[1:][whole]))
        return tuple(np.concatenate(x) for x in zip(*out))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def least(names: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct names and, of the first of the values, the least row by (values...) for each; then its greatest first value."""
    order = np.lexsort((*values[::-1], names))
    own = names[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
    last = np.r_[first[1:], len(own)] - 1
    return [own[first], *[v[order][first] for v in values], values[0][order][last[:len(first)]]]


def pack(docs: DataFrame) -> DataFrame:
    """Chunks of documents: (chunk, ids, lens, raw): raw holds the texts, a line end after each, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, seq = TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=3)
        held: list = []

        def chunk() -> dict:
            ids = [i for b in held for i in b.column("doc_id").to_pylist()]
            texts = [t.encode() for b in held for t in filled(b.column("text")).to_pylist()]
            return {"chunk": [(part << 32) + seq], "ids": [ids], "lens": [list(map(len, texts))],
                    "raw": [press.compress(b"".join(t + b"\n" for t in texts))]}

        size = 0
        for b in slices(batches, "text", CHUNK):
            held.append(b)
            size += b.column("text").nbytes
            if size >= CHUNK:
                yield chunk()
                held, size, seq = [], 0, seq + 1
        if held:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, run, "chunk long, ids array<long>, lens array<long>, raw binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray, Chunk]]:
    """(batch, row, ids, known ids, words) of every chunk; the id of a null one is that of no document."""
    press = zstandard.ZstdDecompressor()
    for b in batches:
        for i in range(b.num_rows):
            ids = b.column("ids")[i].as_py()
            known = np.array([x is not None for x in ids], bool)
            yield (b, i, np.array([x if x is not None else 0 for x in ids], np.int64), known,
                   Chunk(press.decompress(b.column("raw")[i].as_py()), b.column("lens")[i].as_py()))
            pa.default_memory_pool().release_unused()


NAMED = "name long, kind int, chunk long, a long, b long, top long"


def symbols(chunks: DataFrame, width: int) -> DataFrame:
    """Rows (name, kind, chunk, a, b, top), a name once a chunk.

    Kind 0 are low symbols: a and top are the least and the greatest text that has it. Kind 1 are high ones: a is the
    least document that has it, b a second name of its words there, top the greatest document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b, i, ids, known, words in _chunks(batches):
            number, texts = b.column("chunk")[i].as_py(), signed(words.texts())
            rounds = words.rounds(width)
            for k, *now in rounds:
                if k == LOW:
                    break
            name, _, _, doc = words.low(*now)
            own = known[doc]
            name, low, top = least(signed(name[own]), texts[doc[own]])
            yield {"name": name, "kind": np.zeros(len(name), np.int32), "chunk": np.full(len(name), number), "a": low,
                   "b": np.zeros(len(name), np.int64), "top": top}
            name, first, end = words.high(width, rounds)
            doc = words.doc[first]
            own = known[doc]
            check = signed(stretches(words.word, first[own], end[own], 1))
            name, low, check, top = least(signed(name[own]), ids[doc[own]], check)
            yield {"name": name, "kind": np.ones(len(name), np.int32), "chunk": np.full(len(name), number), "a": low, "b": check, "top": top}

    return map_arrow(chunks, run, NAMED)


def windows(chunks: DataFrame, width: int) -> DataFrame:
    """Rows of windows in question (kind 2, as high symbols in ``symbols``) and of stretches proved (kind 3: a and b
    are the first word and the end in the chunk). ``chunks`` also have ``found``: (name, kind, a, b) of the
    names kept, with the least document and the second name there of high ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b, i, ids, known, words in _chunks(batches):
            number = b.column("chunk")[i].as_py()
            name, kind, low, check = answers(b.column("found")[i])
            at = words.windows(width)
            at = at[known[words.doc[at]]]
            sure = np.array([at, at + width])
            rounds = words.rounds(width, sure)
            for k, *now in rounds:
                if k == LOW:
                    break
            own, first, end, _ = words.low(*now)
            missing = np.r_[0, np.cumsum(~np.isin(signed(own), name[kind == 0]))]
            lo = np.searchsorted(first, sure[0], "left")
            hi = np.maximum(np.searchsorted(end, sure[1], "right"), lo)
            asked = missing[lo] == missing[hi]
            high, first, end = words.high(width, rounds)
            proved = earlier(signed(high), ids[words.doc[first]], signed(stretches(words.word, first, end, 1)), name[kind == 1], low[kind == 1], check[kind == 1])
            proved &= known[words.doc[first]]
            first, end = union(first[proved], end[proved])
            yield {"name": np.zeros(len(first), np.int64), "kind": np.full(len(first), 3, np.int32), "chunk": np.full(len(first), number),
                   "a": first, "b": end, "top": np.zeros(len(first), np.int64)}
            # windows within a proved stretch need no proof, nor do others need them: an earlier document has them
            j = np.maximum(np.searchsorted(first, at, "right") - 1, 0)
            inside = (at >= first[j]) & (at + width <= end[j]) if len(first) else np.zeros(len(at), bool)
            at = at[asked & ~inside]
            own, low, check, top = least(signed(stretches(words.word, at, at + width)), ids[words.doc[at]], signed(stretches(words.word, at, at + width, 1)))
            yield {"name": own, "kind": np.full(len(own), 2, np.int32), "chunk": np.full(len(own), number), "a": low, "b": check, "top": top}

    return map_arrow(chunks.select("chunk", "ids", "lens", "raw", "found"), run, NAMED)


def answers(found: pa.ListScalar) -> list[np.ndarray]:
    """The columns of a list of structs, sorted by the first; empty for null."""
    if not found.is_valid:
        return [np.zeros(0, np.int64) for _ in range(4)]
    cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in found.values.flatten()]
    order = np.argsort(cols[0], kind="stable")
    return [c[order] for c in cols]


def earlier(names: np.ndarray, docs: np.ndarray, checks: np.ndarray, known: np.ndarray, low: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which names an earlier document has, as told by sorted known names, their least documents and second names there."""
    if not len(known):
        return np.zeros(len(names), bool)
    j = np.minimum(np.searchsorted(known, names), len(known) - 1)
    return (known[j] == names) & (low[j] < docs) & (there[j] == checks)


def union(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest of stretches that lie in each other or are ordered by first word, none within another."""
    order = np.lexsort((-end, first))
    first, end = first[order], end[order]
    new = np.r_[True, end[1:] > np.maximum.accumulate(end)[:-1]][:len(end)]
    return first[new], end[new]


def kept_names(named: DataFrame, where: str) -> DataFrame:
    """(chunk, found): for each chunk the names of its rows that two texts or documents have at least."""
    own = named.where(where)
    shared = own.groupBy("name", "kind").agg(F.min("a").alias("a"), F.min_by("b", "a").alias("b"), F.max("top").alias("top")).where("a < top")
    # a row a name: dealt out evenly, whatever is common
    back = own.select("name", "kind", "chunk").join(shared.drop("top").hint("shuffle_hash"), ["name", "kind"])
    return back.groupBy("chunk").agg(F.collect_list(F.struct("name", "kind", "a", "b")).alias("found"))


def without_repeats(docs: DataFrame, window: int = 50, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (hash of the kept words joined by one space) of every document;
    with_text adds the kept words themselves and the removed stretches (first word and end)."""
    chunks = stored(pack(docs), "chunks")
    named = stored(symbols(chunks, window), "symbols")
    asked = stored(windows(chunks.join(kept_names(named, "kind < 2"), "chunk", "left"), window), "windows")
    proved = asked.where("kind = 3").groupBy("chunk").agg(F.collect_list(F.struct("a", "b")).alias("proved"))
    told = chunks.join(kept_names(asked, "kind = 2"), "chunk", "left").join(proved, "chunk", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b, i, ids, known, words in _chunks(batches):
            at = words.windows(window)
            name, _, low, check = answers(b.column("found")[i])
            own, second = (signed(stretches(words.word, at, at + window, w)) for w in (0, 1))
            hit = at[earlier(own, ids[words.doc[at]], second, name, low, check) & known[words.doc[at]]]
            first, end = [hit], [hit + window]
            if (p := b.column("proved")[i]).is_valid:
                for side, col in zip((first, end), p.values.flatten()):
                    side.append(col.to_numpy(zero_copy_only=False))
            first, end = np.concatenate(first), np.concatenate(end)
            depth = np.cumsum(np.bincount(first, minlength=len(words.word) + 1) - np.bincount(end, minlength=len(words.word) + 1))[:-1]
            gone = depth > 0
            counts = np.r_[0, np.cumsum(gone)]
            # kept words with the blank after each, all blanks as spaces
            word = np.cumsum(np.bincount(words.first, minlength=len(words.data))) - 1
            shown = words.solid & ~gone[np.maximum(word, 0)] if len(gone) else words.solid
            shown[words.last[~gone]] = True
            flat = np.where(words.solid, words.data, 32).astype(np.uint8)[shown].tobytes()
            cut = np.r_[0, np.cumsum(shown)][words.offsets].tolist()
            texts = [flat[a:max(a, z - 1)] for a, z in zip(cut, cut[1:])]
            out = {"doc_id": pa.array(ids, mask=~known), "n_words": words.n, "n_removed": np.diff(counts[words.cuts]),
                   "kept_sha256": [sha256(t).hexdigest() for t in texts]}
            if with_text:
                edge = np.diff(np.r_[0, gone & True, 0].astype(np.int8))
                spans = [[] for _ in ids]
                for a, z in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    while a < z:  # a run of words gone may pass from one text to the next
                        d = int(words.doc[a])
                        stop = min(z, int(words.cuts[d + 1]))
                        spans[d].append({"first": a - int(words.cuts[d]), "end": stop - int(words.cuts[d])})
                        a = stop
                out |= {"kept": [t.decode() for t in texts], "removed": spans}
            yield out

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += ", kept string, removed array<struct<first:long,end:long>>"
    return map_arrow(told.select("chunk", "ids", "lens", "raw", "found", "proved"), run, schema)
