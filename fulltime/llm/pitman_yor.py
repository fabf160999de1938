"""Scoring texts with a hierarchical Pitman-Yor model of words in context and their spelling.

Each word is the context of a restaurant whose dishes are the words after it. All of these share a parent,
the restaurant of single words, whose own parent spells: byte contexts of three, two, one and no bytes are
restaurants too, each the parent of the longer ones that end in it, over a uniform base. A table is a
customer of the same dish one level down, a table of the word restaurant one of every context its spelling
runs through. So a word never met still has the probability of its spelling, and the probabilities of all
words in a context add up to one.

Seating follows the Chinese restaurant process and is sampled by Gibbs: in each sweep the customers of
every dish get up and sit down again, given the tables of all others and the parents' probabilities of the
sweep before (a customer opens a table with weight (strength + discount * tables) * parent probability,
and joins one with weight customers - discount * tables of the dish). After ``burn`` sweeps the predictive
probabilities of ``samples`` sweeps are averaged; they are linear in a dish's own tables, so a mean number
of tables stands for the samples there. Discounts come from the counts of ones and twos at each level.
Word contexts are sampled in the cells of a grid (by context and by dish): a cell takes the parent's and
the rest of its contexts' state from its own share of them, as in other distributed samplers.

How the corpus flows: texts are packed into chunks (compressed rows of the shared folder). A chunk sends
each distinct pair of words once to the pair's cell, with its training count; the cell adds up, seats, and
answers each chunk in its order. Words go the same way, and meet what the cells found out about each
context and dish. So a word or pair that makes up a third of all text is one entry a chunk, and nothing
but the spelling counts (a fixed number of cells) and totals reach the driver. Pairs travel under hashed
names: 28 bits of the context (contexts of one name share a restaurant), 32 bits of the dish.

Defined results: null text counts as empty; an empty text is the end token alone; a null doc_id counts as
the empty text for its fold; repeated rows are scored, and learned from, one by one; where nothing is
learned from, the model is the uniform spelling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import arrow_rows, blank_split, filled, map_arrow, shared_object, slices, stored

#: Symbols of spellings: the most frequent bytes, all others, and the end (which also stands before a word).
SYMBOLS = 40
OTHER, END = SYMBOLS - 2, SYMBOLS - 1
ORDER = 3
CELLS = SYMBOLS ** (ORDER + 1)
STRENGTH = 1.0
#: Tokens for each word bucket, and for two cells of the grid: with the tokens of the corpus they say how many there
#: are, whatever the session's settings.
BUCKET_TOKENS = 2_500_000
#: Text bytes of a chunk.
CHUNK = 3_000_000


def seat(count: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator | None) -> np.ndarray:
    """Tables of dishes with ``count`` customers; ``weight`` is that of a new table over its parent's strength.

    Customers come one by one, later in blocks of a sixteenth of those seated (a block sits at the odds it
    finds). Sampled with ``rng``; without, the expected number under the running expectation.
    """
    count = count.astype(np.float64)
    tables, seated = np.minimum(count, 1.0), np.minimum(count, 1.0)
    live = np.flatnonzero(count > seated)
    while len(live):
        s, t, c = seated[live], tables[live], count[live]
        block = np.minimum(np.maximum(1.0, np.floor(s / 16)), c - s)
        p = weight[live] / (weight[live] + np.maximum(s - discount * t, 1e-9))
        tables[live] += block * p if rng is None else rng.binomial(block.astype(np.int64), np.clip(p, 0.0, 1.0))
        seated[live] += block
        live = live[seated[live] < count[live]]
    return tables


def discount_of(count: np.ndarray) -> float:
    """From the dishes that one and two customers have."""
    one, two = int((count == 1).sum()), int((count == 2).sum())
    return float(np.clip(one / max(1, one + 2 * two), 0.05, 0.95))


class Spelling:
    """Log10 probabilities of spellings; the counts of its longest contexts come from outside."""

    def __init__(self, bytes_by_count: list[int]):
        self.symbol = np.full(256, OTHER, np.int64)
        own = bytes_by_count[:OTHER]
        self.symbol[own] = np.arange(len(own))
        self.rest = 256 - len(own)  # bytes that share a symbol
        self.sums = np.zeros((CELLS // SYMBOLS, SYMBOLS))
        self.taken = 0
        self.prob = self._uniform()

    def _uniform(self) -> np.ndarray:
        """Bytes and the end alike: the shared symbol has the weight of its bytes."""
        base = np.full(SYMBOLS, 1.0)
        base[OTHER] = self.rest
        used = np.r_[np.bincount(self.symbol, minlength=SYMBOLS)[:OTHER] > 0, self.rest > 0, True]
        base = np.where(used, base, 0.0)
        return np.tile(base / base.sum(), (CELLS // SYMBOLS, 1))

    def cells(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all symbols of all words, ends included: cell, number of its word, and whether its byte is a shared one."""
        lens = np.array([len(w) for w in words], np.int64)
        flat = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        n = lens + 1 + ORDER
        at = np.cumsum(n) - n
        sym = np.full(int(n.sum()), END, np.int64)
        place = np.repeat(at + ORDER, lens) + np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        sym[place] = flat
        last = np.repeat(at + ORDER, lens + 1) + np.arange(int((lens + 1).sum())) - np.repeat(np.cumsum(lens + 1) - lens - 1, lens + 1)
        cell = np.zeros(len(last), np.int64)
        for k in range(ORDER, -1, -1):
            cell = cell * SYMBOLS + sym[last - k]
        return cell, np.repeat(np.arange(len(words)), lens + 1), sym[last] == OTHER

    def sweep(self, cell: np.ndarray, customers: np.ndarray, rng: np.random.Generator) -> None:
        """One Gibbs sweep over all contexts, given the customers of the longest ones; then new probabilities."""
        levels, c, at = [], customers.astype(np.float64), cell
        prob = [None] * (ORDER + 1)
        below = self.prob  # of the sweep before, for the parents' probabilities
        for k in range(ORDER, -1, -1):
            size = SYMBOLS ** (k + 1)
            keep = c > 0
            at, c = at[keep], c[keep]
            d = discount_of(c)
            parent = self._level(below, k - 1).ravel()[at % (size // SYMBOLS)] if k else self._uniform()[0][at % SYMBOLS]
            context = at // SYMBOLS
            tables = np.bincount(context, np.ones(len(at)), minlength=size // SYMBOLS)
            t = seat(c, (STRENGTH + d * tables[context]) * parent, d, rng)
            levels.append((k, at, c, t, d))
            if k:
                low = size // SYMBOLS
                merged = np.bincount(at % low, t, minlength=low)
                at = np.flatnonzero(merged)
                c = merged[at]
        base = self._uniform()[0]
        for k, at, c, t, d in reversed(levels):
            size = SYMBOLS ** (k + 1)
            full, tabs = np.zeros(size), np.zeros(size)
            full[at], tabs[at] = c, t
            full, tabs = full.reshape(-1, SYMBOLS), tabs.reshape(-1, SYMBOLS)
            parent = base[None, :] if k == 0 else np.tile(prob[k - 1], (SYMBOLS, 1)) if k > 1 else np.tile(prob[0], (SYMBOLS, 1))
            total = full.sum(1, keepdims=True)
            prob[k] = (full - d * tabs + (STRENGTH + d * tabs.sum(1, keepdims=True)) * parent) / (STRENGTH + total)
        self.parts, self.prob = prob, prob[ORDER]

    def _level(self, prob: np.ndarray, k: int) -> np.ndarray:
        return self.parts[k] if getattr(self, "parts", None) else self._uniform()[:SYMBOLS ** k]

    def take(self) -> None:
        """Adds the present probabilities to the average."""
        self.sums += self.prob
        self.taken += 1

    def log_table(self) -> np.ndarray:
        """Averaged log10 probabilities by cell; the shared symbol's is that of one of its bytes."""
        p = self.sums / self.taken if self.taken else self.prob
        p = p.copy()
        if self.rest:
            p[:, OTHER] /= self.rest
        with np.errstate(divide="ignore"):
            return np.maximum(np.log10(p), -300.0).astype(np.float32).ravel()

    def of(self, words: list[bytes], table: np.ndarray) -> np.ndarray:
        """Log10 probability of each spelling."""
        cell, word, _ = self.cells(words)
        return np.bincount(word, table[cell], minlength=len(words))


class WordModel:
    """What scoring needs: totals, the averaged spelling, and expected tables by count and weight.

    tokens and types are those of the training texts; customers, discount and tables those of the
    restaurant of single words; pair_discount that of the contexts.
    """

    def __init__(self, tokens: int, types: int, customers: int, discount: float, tables: float, spelling: Spelling):
        self.tokens, self.types, self.customers, self.discount, self.tables = tokens, types, customers, discount, tables
        self.pair_discount = 0.5
        self.spelling, self.table = spelling, spelling.log_table()
        spelling.sums = spelling.prob = spelling.parts = None  # scoring needs the table only
        self.counts = np.unique(np.floor(np.logspace(0, max(1.0, np.log10(max(customers, 10))), 60)))
        self.weights = np.logspace(-12, 8, 81)
        self.expected = np.array([np.log(seat(self.counts, np.full(len(self.counts), w), discount, None)) for w in self.weights])

    def single(self, words: list[bytes], count: np.ndarray) -> np.ndarray:
        """Probability of each word without context, given its customers."""
        spelled = self.spelling.of(words, self.table)
        fresh = (STRENGTH + self.discount * self.tables) * 10.0 ** np.maximum(spelled, -290.0)
        x = np.interp(np.log(np.maximum(count, 1)), np.log(self.counts), np.arange(len(self.counts)))
        y = np.clip((np.log10(np.maximum(fresh, 1e-300)) + 12) * 4, 0, len(self.weights) - 1.001)
        i, j = np.minimum(x.astype(int), len(self.counts) - 2), y.astype(int)
        u, v = x - i, y - j
        e = self.expected
        t = np.exp((1 - v) * ((1 - u) * e[j, i] + u * e[j, i + 1]) + v * ((1 - u) * e[j + 1, i] + u * e[j + 1, i + 1]))
        t = np.where(count > 0, np.minimum(t, count), 0.0)
        return np.maximum((count - self.discount * t + fresh) / (STRENGTH + self.customers), 1e-300)

    def base(self, count: np.ndarray) -> np.ndarray:
        """Log10 of add-one word probabilities."""
        return np.log10((count + 1) / (self.tokens + self.types + 1))

    def paired(self, single: np.ndarray, count: np.ndarray, tables: np.ndarray, in_context: np.ndarray,
               context_tables: np.ndarray) -> np.ndarray:
        """Log10 probability of words after their contexts."""
        d = self.pair_discount
        return np.log10((np.maximum(count - d * tables, 0.0) + (STRENGTH + d * context_tables) * single) / (STRENGTH + in_context))


def pack(docs: DataFrame, train: str) -> DataFrame:
    """Chunks of (doc_id, text, train flag) rows, their words split once and numbered: chunk, tokens, blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        coder = zstandard.ZstdCompressor(level=1)

        def flush() -> dict:
            rows = pa.Table.from_batches(held)
            split = blank_split(filled(rows.column("text").combine_chunks()), lower=True)
            # the end token, which is the empty word, comes after the words of each text
            words = coder.compress(b"\n".join([*split.distinct.cast(pa.binary()).to_pylist(), b""]))
            row = {"doc_id": [rows.column("doc_id").to_pylist()], "train": [rows.column("train").to_pylist()], "words": [words],
                   "at": [squeeze(split.at.astype("<u4"))], "lens": [squeeze(split.lens.astype("<u4"))]}
            batch = pa.RecordBatch.from_pydict(row, schema=PACKED)
            with pa.BufferOutputStream() as sink:
                with pa.ipc.new_stream(sink, PACKED) as out:
                    out.write_batch(batch)
                return {"chunk": [(part << 32) + seq], "tokens": [len(split.at) + len(split.lens)], "blob": [sink.getvalue().to_pybytes()]}

        for b in slices(batches, "text", CHUNK):
            held.append(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in b.columns], names=b.schema.names))
            size += max(1, pa.compute.sum(pa.compute.binary_length(b.column("text"))).as_py() or 0)
            if size >= CHUNK:
                yield flush()
                seq, held, size = seq + 1, [], 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col(train).alias("train"))
    return map_arrow(rows, run, "chunk long, tokens long, blob binary")


#: Parts of a chunk's record: words joined by line ends, tokens as numbers of words, tokens of each text.
PACKED = pa.schema([("doc_id", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("words", pa.binary()), ("at", pa.binary()), ("lens", pa.binary())])


class Chunk:
    """Rows of a chunk, their words as numbers, and its distinct words in order of their first places."""

    def __init__(self, blob: bytes):
        row = pa.ipc.open_stream(blob).read_all()
        self.doc_id, self.train = (row.column(c).combine_chunks().flatten() for c in ("doc_id", "train"))
        self.words = zstandard.ZstdDecompressor().decompress(row.column("words")[0].as_py()).split(b"\n")
        self.end, lens = len(self.words) - 1, unsqueeze(row.column("lens")[0].as_py(), "<u4").astype(np.int64)
        at = unsqueeze(row.column("at")[0].as_py(), "<u4").astype(np.int64)
        if b"" in self.words[:-1]:
            self.words.pop()
            self.end = self.words.index(b"")
        self.lens = lens + 1
        self.first = np.cumsum(self.lens) - self.lens
        self.token = np.insert(at, np.cumsum(lens), self.end)
        self.learns = np.repeat(np.array(self.train.to_pylist(), np.int64), self.lens)
        self.name = np.fromiter((xxhash.xxh3_64_intdigest(w) & 0xFFFFFFFF for w in self.words), np.int64, len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, word) pairs as context * words + word, sorted, and which of them each token is."""
        before = np.r_[self.end, self.token[:-1]]
        before[self.first] = self.end
        return np.unique(before * len(self.words) + self.token, return_inverse=True)

    def keys(self, pairs: np.ndarray) -> np.ndarray:
        context, dish = self.name[pairs // len(self.words)], self.name[pairs % len(self.words)]
        return (context & CONTEXT) << 32 | dish


#: The bits of a word's 32-bit name that name its context.
CONTEXT = (1 << 28) - 1


def squeeze(x: np.ndarray) -> bytes:
    """Numbers as bytes, first bytes first, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unsqueeze(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel() if len(planes) else np.zeros(0, kind)


def _cuts(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, list[int]]:
    """A stable order by bucket, and where each bucket begins in it (and the end)."""
    order = np.argsort(bucket, kind="stable")
    return order, np.r_[0, np.cumsum(np.bincount(bucket, minlength=buckets))].tolist()


def _cell(key: np.ndarray, side: int) -> np.ndarray:
    return (key >> 32) % side * side + (key & 0xFFFFFFFF) % side


def _sum_by(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    own, at = np.unique(key, return_inverse=True)
    return [own, *[np.bincount(at, v, minlength=len(own)) for v in values]]


def seat_contexts(key: np.ndarray, count: np.ndarray, side: int, burn: int, samples: int, rng: np.random.Generator) -> np.ndarray:
    """Mean tables of the dishes of a grid cell (all counts at least one), by Gibbs."""
    tables = np.ones(len(key))
    more = np.flatnonzero(count > 1)
    if not len(more):
        return tables
    d = discount_of(count)
    context = np.unique(key >> 32, return_inverse=True)[1]
    dish = np.unique(key & 0xFFFFFFFF, return_inverse=True)[1]
    mean = np.zeros(len(more))
    for turn in range(burn + samples):
        in_context = side * np.bincount(context, tables)  # a cell holds one of ``side`` parts of its contexts' dishes
        parent = np.bincount(dish, tables)
        parent /= side * parent.sum()  # and one part of all dishes
        weight = (STRENGTH + d * in_context[context[more]]) * parent[dish[more]]
        tables[more] = seat(count[more], weight, d, rng)
        if turn >= burn:
            mean += tables[more]
    tables[more] = mean / samples
    return tables


PAIR_ROWS = "kind int, bucket int, chunk long, a binary, b binary, c binary, one long, two long"


def pair_tables(chunks: DataFrame, side: int, buckets: int, burn: int = 2, samples: int = 3, seed: int = 5) -> DataFrame:
    """Rows of three kinds: answers to chunks (0: a counts, b tables of counts above one), what each context
    (2: a names, b tables, c customers) and each dish (3: a names, b tables) has in a cell, dealt to word buckets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for number, blob in zip(b.column("chunk").to_pylist(), b.column("blob").to_pylist()):
                chunk = Chunk(blob)
                pairs, at = chunk.pairs()
                key = chunk.keys(pairs)
                count = np.bincount(at, chunk.learns, minlength=len(pairs)).astype("<u4")
                order = np.argsort(key, kind="stable")
                by, cut = _cuts(_cell(key[order], side), side * side)
                order = order[by]
                for k, (a, z) in enumerate(zip(cut, cut[1:])):
                    if a < z:
                        own = order[a:z]
                        yield {"cell": [k], "chunk": [number], "keys": [squeeze(np.diff(key[own], prepend=0))],
                               "counts": [squeeze(count[own])]}

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unsqueeze(k, "<i8")) for k in rows["keys"]]
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, np.concatenate([unsqueeze(c, "<u4") for c in rows["counts"]]), minlength=len(key)).astype(np.int64)
        cell, met = int(rows["cell"].iloc[0]), count > 0
        tables = np.zeros(len(key))
        tables[met] = seat_contexts(key[met], count[met], side, burn, samples, np.random.default_rng([seed, cell]))
        cut, out = np.cumsum([0, *map(len, keys)]).tolist(), []
        for number, a, z in zip(rows["chunk"], cut, cut[1:]):
            c, t = count[at[a:z]], tables[at[a:z]]
            out.append((0, cell, number, squeeze(c.astype("<u4")), squeeze(t[c > 1].astype("<f4")), b"", 0, 0))
        names, t, c = _sum_by(key[met] >> 32, tables[met], count[met])
        by, cut = _cuts(names % buckets, buckets)
        ones, twos = int((count == 1).sum()), int((count == 2).sum())
        for k, (a, z) in enumerate(zip(cut, cut[1:])):
            if a < z or k == 0:
                own = by[a:z]
                out.append((2, k, -1, squeeze(names[own].astype("<u4")), squeeze(t[own].astype("<f4")), squeeze(c[own].astype("<i8")),
                            ones if k == 0 else 0, twos if k == 0 else 0))
        names, t = _sum_by(key[met] & 0xFFFFFFFF, tables[met])
        by, cut = _cuts((names & CONTEXT) % buckets, buckets)
        out += [(3, k, -1, squeeze(names[by[a:z]].astype("<u4")), squeeze(t[by[a:z]].astype("<f4")), b"", 0, 0)
                for k, (a, z) in enumerate(zip(cut, cut[1:])) if a < z]
        return pd.DataFrame(out, columns=["kind", "bucket", "chunk", "a", "b", "c", "one", "two"])

    sent = map_arrow(chunks, send, "cell int, chunk long, keys binary, counts binary")
    return sent.groupBy("cell").applyInPandas(add, PAIR_ROWS)


def vocabulary(chunks: DataFrame, found: DataFrame, buckets: int) -> DataFrame:
    """Answers to chunks (kind 0: a counts, b customers as a word, c tables and customers as a context) and the
    training vocabulary (kind 1: words, counts of customers); ``found`` are the rows of ``pair_tables``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for number, blob in zip(b.column("chunk").to_pylist(), b.column("blob").to_pylist()):
                chunk = Chunk(blob)
                count = np.bincount(chunk.token, chunk.learns, minlength=len(chunk.words)).astype("<u4")
                by, cut = _cuts((chunk.name & CONTEXT) % buckets, buckets)
                for k, (a, z) in enumerate(zip(cut, cut[1:])):
                    if a < z:
                        own = by[a:z]
                        yield {"kind": [1], "bucket": [k], "chunk": [number], "a": [coder.compress(b"\n".join([chunk.words[i] for i in own]))],
                               "b": [squeeze(count[own])], "c": [b""], "one": [0], "two": [0]}

    def gather(rows: pd.DataFrame, kinds: list[str]) -> list[np.ndarray]:
        parts = [[unsqueeze(x, k) for x in rows[c]] for c, k in zip("abc", kinds)]
        return _sum_by(*[np.concatenate(p) for p in parts]) if len(rows) else [np.zeros(0)] * len(kinds)

    def look(names: np.ndarray, table: list[np.ndarray]) -> list[np.ndarray]:
        own, values = table[0], table[1:]
        if not len(own):
            return [np.zeros(len(names)) for _ in values]
        at = np.minimum(np.searchsorted(own, names), len(own) - 1)
        return [np.where(own[at] == names, v[at], 0.0) for v in values]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        pack_, unpack_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        contexts = gather(rows[rows["kind"] == 2], ["<u4", "<f4", "<i8"])
        dishes = gather(rows[rows["kind"] == 3], ["<u4", "<f4"])
        asked = rows[rows["kind"] == 1]
        split = [unpack_.decompress(w).split(b"\n") for w in asked["a"]]
        total: dict[bytes, int] = {}
        for ws, raw in zip(split, asked["b"]):
            for w, n in zip(ws, unsqueeze(raw, "<u4").tolist()):
                total[w] = total.get(w, 0) + n
        words = sorted(total)  # draws go by place, so places must not hang on the order of chunks
        place, count = {w: i for i, w in enumerate(words)}, np.array([total[w] for w in words], "<i8")
        name = np.fromiter((xxhash.xxh3_64_intdigest(w) & 0xFFFFFFFF for w in words), np.int64, len(words))
        tables, customers = look(name & CONTEXT, contexts)
        own = np.where(count > 0, np.maximum(1, np.rint(look(name, dishes)[0])), 0).astype("<i8")
        bucket, out = int(rows["bucket"].iloc[0]), []
        for number, ws in zip(asked["chunk"], split):
            at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
            out.append((0, int(number), bucket, squeeze(count[at]), squeeze(own[at]),
                        squeeze(np.c_[tables[at], customers[at]].astype("<f8").ravel()), 0, 0, 0))
        known = np.flatnonzero(count)
        if len(known):
            out.append((1, -1, bucket, pack_.compress(b"\n".join([words[i] for i in known])), pack_.compress(own[known].tobytes()), b"",
                        int(count.sum()), len(known), int(own.sum())))
        return pd.DataFrame(out, columns=["kind", "chunk", "bucket", "a", "b", "c", "tokens", "types", "customers"])

    schema = PAIR_ROWS
    sent = map_arrow(chunks, send, schema).unionByName(found.where("kind > 0"))
    return sent.groupBy("bucket").applyInPandas(
        add, "kind int, chunk long, bucket int, a binary, b binary, c binary, tokens long, types long, customers long")


def _types(row_words: bytes, row_counts: bytes) -> tuple[list[bytes], np.ndarray]:
    d = zstandard.ZstdDecompressor()
    return d.decompress(row_words).split(b"\n"), np.frombuffer(d.decompress(row_counts), "<i8")


def learn(types: DataFrame, burn: int = 2, samples: int = 3, seed: int = 5) -> WordModel:
    """The model of a training vocabulary (rows of words and counts), by Gibbs sweeps."""
    spark = types.sparkSession
    tokens, kinds, customers = (int(x or 0) for x in types.agg(F.sum("tokens"), F.sum("types"), F.sum("customers")).first())

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for w, c in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
                words, count = _types(w, c)
                n = np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=256)
                yield {"what": [*range(256), 256, 257], "n": [*n.tolist(), int((count == 1).sum()), int((count == 2).sum())]}

    seen = dict(map_arrow(types, first, "what int, n long").groupBy("what").agg(F.sum("n")).collect())
    spelling = Spelling([b for b in sorted(range(256), key=lambda b: (-seen.get(b, 0), b)) if seen.get(b, 0)])
    discount = float(np.clip(seen.get(256, 0) / max(1, seen.get(256, 0) + 2 * seen.get(257, 0)), 0.05, 0.95))
    if not kinds:
        return WordModel(0, 0, 0, discount, 0.0, spelling)
    rng, tables, taken = np.random.default_rng(seed), float(kinds), []
    for turn in range(burn + samples):
        shared = spark.sparkContext.broadcast((spelling.symbol, spelling.rest, None if turn == 0 else spelling.log_table()))
        now = tables

        def sit(batches: Iterator[pa.RecordBatch], shared=shared, now=now, turn=turn) -> Iterator[dict]:
            symbol, rest, table = shared.value
            own = Spelling([])
            own.symbol, own.rest = symbol, rest
            for b in batches:
                for w, c, bucket in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("bucket").to_pylist()):
                    words, count = _types(w, c)
                    if table is None:
                        t = np.ones(len(words))  # the first seating: one table a word
                    else:
                        weight = (STRENGTH + discount * now) * 10.0 ** np.maximum(own.of(words, table), -290.0)
                        t = seat(count, weight, discount, np.random.default_rng([seed, turn, bucket]))
                    cell, word, _ = own.cells(words)
                    n = np.bincount(cell, t[word], minlength=CELLS)
                    at = np.flatnonzero(n)
                    yield {"cell": np.r_[at, -1], "n": np.r_[n[at], t.sum()].astype(np.int64)}

        # at most CELLS + 1 rows, whatever the corpus
        got = map_arrow(types, sit, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas().sort_values("cell")
        own = got[got["cell"] >= 0]
        tables = float(got.loc[got["cell"] < 0, "n"].sum())
        spelling.sweep(own["cell"].to_numpy(), own["n"].to_numpy(), rng)
        if turn >= burn:
            spelling.take()
            taken.append(tables)
    return WordModel(tokens, kinds, customers, discount, float(np.mean(taken)), spelling)


def score(docs: DataFrame, train: str = "train", buckets: int | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, a boolean column that says what to learn from).

    doc_id, trained, n_tokens, n_known, train_tokens, base_score (add-one word counts), score (the model).
    """
    with arrow_rows(docs.sparkSession, 1000):  # rows with whole texts
        chunks = stored(pack(docs, train), "chunks")
    with arrow_rows(docs.sparkSession, 4):  # rows with a chunk each
        if buckets is None:
            buckets = max(1, -(-int(chunks.agg(F.sum("tokens")).first()[0] or 0) // BUCKET_TOKENS))
        return stored(_scored(chunks, buckets), "scores")


def _scored(chunks: DataFrame, buckets: int) -> DataFrame:
    spark = chunks.sparkSession
    side = max(1, round((2 * buckets) ** 0.5))
    pairs = stored(pair_tables(chunks, side, buckets), "pairs")
    found = stored(vocabulary(chunks, pairs, buckets), "vocabulary")
    model = learn(found.where("kind = 1").select("bucket", "a", "b", "tokens", "types", "customers"))
    ones, twos = (int(x or 0) for x in pairs.where("kind = 2").agg(F.sum("one"), F.sum("two")).first())
    model.pair_discount = float(np.clip(ones / max(1, ones + 2 * twos), 0.05, 0.95))
    shared = shared_object(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        m = shared()
        for b in batches:
            for blob, words, cells in zip(*(b.column(c).to_pylist() for c in ("blob", "words", "cells"))):
                chunk = Chunk(blob)
                n = len(chunk.words)
                count, own, context = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, 2))
                by, cut = _cuts((chunk.name & CONTEXT) % buckets, buckets)
                for a in words:
                    at = by[cut[a["bucket"]]:cut[a["bucket"] + 1]]
                    count[at], own[at] = unsqueeze(a["a"], "<i8"), unsqueeze(a["b"], "<i8")
                    context[at] = unsqueeze(a["c"], "<f8").reshape(-1, 2)
                pairs_, token_pair = chunk.pairs()
                key = chunk.keys(pairs_)
                order = np.argsort(key, kind="stable")
                by, cut = _cuts(_cell(key[order], side), side * side)
                order = order[by]
                met, tables = np.zeros(len(key)), np.zeros(len(key))
                for a in cells:
                    at = order[cut[a["bucket"]]:cut[a["bucket"] + 1]]
                    c = unsqueeze(a["a"], "<u4").astype(np.float64)
                    t = np.minimum(c, 1.0)
                    t[c > 1] = unsqueeze(a["b"], "<f4")
                    met[at], tables[at] = c, t
                single = m.single(chunk.words, own)
                u, w = pairs_ // n, pairs_ % n
                score = m.paired(single[w], met, tables, context[u, 1], context[u, 0])
                add = lambda x: np.add.reduceat(x, chunk.first)
                yield {"doc_id": chunk.doc_id, "trained": chunk.train, "n_tokens": chunk.lens,
                       "n_known": add((count > 0).astype(np.int64)[chunk.token]), "train_tokens": np.full(len(chunk.lens), m.tokens, np.int64),
                       "base_score": add(m.base(count)[chunk.token]), "score": add(score[token_pair])}

    answers = lambda rows, name: (rows.where("kind = 0").groupBy("chunk")
                                  .agg(F.collect_list(F.struct("bucket", "a", "b", *(["c"] if name == "words" else []))).alias(name)))
    met = chunks.join(answers(found, "words"), "chunk").join(answers(pairs, "cells"), "chunk")
    return map_arrow(met.select("blob", "words", "cells"), run,
                     "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
