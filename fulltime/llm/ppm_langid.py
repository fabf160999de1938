"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes long, made from labelled training texts and
then frozen. A byte costs, in its longest known context, the code length of its share there; a byte not
seen in a context costs an escape and is coded one context shorter, down to a uniform code. Escapes
follow method C: a context met n times with d different bytes escapes with probability d / (n + d).
The text gets the language whose tree codes all its bytes in the fewest bits (ties: first by name).

Statistics are frozen, so a code length is a sum: the length by contexts of up to one byte (a dense table of
65,536 rows), and what longer contexts add to it or take from it, an escape for each context met and a gain for
each byte seen in it. Those stand in sorted keys with a row of (language, value) entries each, only for what
the sample holds, whatever the number of languages.

Training takes at most ``per_language`` documents of a language, those of the least hash of doc_id; of a
document of more than ``train_bytes`` bytes, ``WINDOWS`` windows spread over it that hold no more than these
(documented bounds on the fit only; every text is scored whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import extended, map_arrow, shared_object, slices
from fulltime.operators.ranking import top_k_per_group

UNKNOWN = "und"
#: Windows that a long training document is read through.
WINDOWS = 16


def _grams(texts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of bytes as numbers, and how often each stands in the texts."""
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *[_keys(t, length) for t in texts]]), return_counts=True)


def _keys(s: np.ndarray, length: int) -> np.ndarray:
    n = max(0, len(s) - length + 1)
    key = np.zeros(n, np.uint32)
    for j in range(length):
        key = key << np.uint32(8) | s[j:n + j]
    return key


def _coded(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of the keys, their escapes, and for each key the number of its context and its own length."""
    context, at = np.unique(keys >> np.uint32(8), return_inverse=True)
    total, kinds = np.bincount(at, count, len(context)), np.bincount(at, minlength=len(context))
    return context, np.log2((total + kinds) / np.maximum(kinds, 1)), at, np.log2((total + kinds)[at] / count)


class Rows:
    """Values by (key, language): sorted keys, each with its entries."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]]):
        key = np.concatenate([np.zeros(0, np.uint32), *[p[0] for p in parts]])
        order = np.argsort(key, kind="stable")
        self.keys, n = np.unique(key, return_counts=True)
        self.first = np.r_[0, np.cumsum(n)]
        self.language = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])[order].astype(np.int32)
        width = len(parts[0]) - 1 if parts else 0
        self.values = [np.concatenate([p[k + 1] for p in parts])[order].astype(np.float32) for k in range(width)]

    def add(self, total: np.ndarray, at: np.ndarray, value: int) -> None:
        """Adds the values of the rows ``at`` (-1: none) to the languages' totals."""
        at = at[at >= 0]
        n = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(at) else at
        total += np.bincount(self.language[entry], self.values[value][entry], len(total))

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


class PpmModel:
    """Code lengths in bits of every byte after every three bytes, for each language."""

    width, symbol = 256, np.arange(256)

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        n = len(self.languages)
        self.pair = np.zeros((1 << 16, n), np.float32)  # the last of two bytes by contexts of up to one
        self.escape = np.zeros((1 << 16, n), np.float32)  # of contexts of two bytes
        three, four = [], []
        for k, name in enumerate(self.languages):
            texts = [np.frombuffer(t, np.uint8) for t in samples[name] if t]
            one = np.full(256, 8.0)
            keys, count = _grams(texts, 1)
            if len(keys):
                _, escape, _, own = _coded(keys, count)
                one += escape[0]
                one[keys] = own
            pair = np.tile(one, (256, 1))
            keys, count = _grams(texts, 2)
            context, escape, _, own = _coded(keys, count)
            pair[context] += escape[:, None]
            pair = pair.ravel()
            pair[keys] = own
            keys3, count = _grams(texts, 3)
            context, escape, at, own = _coded(keys3, count)
            self.pair[:, k], self.escape[context, k] = pair, escape
            gain = own - escape[at] - pair[keys3 & np.uint32(0xFFFF)]
            keys, count = _grams(texts, 4)
            context, escape, at, own = _coded(keys, count)
            after = np.zeros(len(keys3))  # escapes of three bytes as a context
            after[np.searchsorted(keys3, context)] = escape
            low = keys & np.uint32(0xFFFFFF)
            below = np.searchsorted(keys3, low)
            shorter = self.escape[low >> np.uint32(8), k] + pair[low & np.uint32(0xFFFF)] + gain[below]
            three.append((keys3, gain, after))
            four.append((keys, own - escape[at] - shorter))
        self.three, self.four = Rows(three), Rows(four)

    def bits(self, text: bytes, chunk: int = 1 << 18) -> np.ndarray:
        """Code length of the whole text in each language; before its first byte stand three spaces."""
        s = np.frombuffer(b"   " + text, np.uint8)
        total = np.zeros(len(self.languages))
        for a in range(0, len(s) - 3, chunk):
            x = s[a:a + chunk + 3]
            pairs, found = _keys(x, 2), self.three.find(_keys(x, 3))
            total += self.pair[pairs[2:]].sum(0, dtype=np.float64) + self.escape[pairs[1:-1]].sum(0, dtype=np.float64)
            self.three.add(total, found[1:], 0)
            self.three.add(total, found[:-1], 1)
            self.four.add(total, self.four.find(_keys(x, 4)), 0)
        return total


def fit(train: DataFrame, per_language: int = 300, train_bytes: int = 65_536) -> PpmModel:
    """The model of (doc_id, text, lang) rows; rows of null text or lang teach nothing."""
    wide = max(1, train_bytes // (4 * WINDOWS))  # a character has four bytes at most
    step = (F.length("text") - wide) / (WINDOWS - 1)
    windows = F.concat(*[F.substring("text", (F.greatest(step, F.lit(0.0)) * i).cast("int") + 1, F.lit(wide)) for i in range(WINDOWS)])
    ok = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "lang", F.when(F.octet_length("text") <= train_bytes, F.col("text")).otherwise(windows).alias("text"))
    ids = ok.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    picked = top_k_per_group(ids, ["lang"], [F.col("h"), F.col("doc_id")], per_language, "doc_id", salts=256).select("doc_id").collect()
    wanted = [r[0] for r in picked]
    rows = ok.where(F.col("doc_id").isin(wanted)).select("lang", "doc_id", "text").collect() if wanted else []
    samples: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        samples.setdefault(r["lang"], []).append(r["text"].encode())
    return PpmModel({k: v[:per_language] for k, v in samples.items()})


def predict(docs: DataFrame, model: PpmModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with lang_pred and score (posterior of equal priors, 0 to 1).

    ``und`` and 0 where the text is null or has no letter, or the model knows no language.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("__text"))
    shared = shared_object(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ppm = shared()
        for b in slices(batches, "__text"):
            names, scores = [], []
            for t in b.column("__text").to_pylist():
                if not t or not ppm.languages or not any(map(str.isalpha, t)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                bits = ppm.bits(t.encode())
                k = int(bits.argmin())
                names.append(ppm.languages[k])
                scores.append(float(1 / np.exp2(np.maximum(bits[k] - bits, -1000)).sum()))
            yield {c: b.column(c) for c in keep} | {"lang_pred": names, "score": scores}

    return map_arrow(src, run, extended(src, keep, "lang_pred string, score double"))
