"""Quality rules: how a public vocabulary breaks a text up.

A piece vocabulary fits the text it was made for: markup, shouting, symbol noise, keyboard noise or
text in a broken encoding falls into more and odder pieces, repeated text into fewer different ones.
``measure`` takes from every whole text

- chars_per_token: characters for each id,
- byte_share: ids that are raw bytes (characters outside the vocabulary), as a share of all ids,
- token_entropy: entropy in bits of the text's id distribution,

and ``verdict`` rejects a text outside the band of its main script, or one that fails the base rules
(too few words, too many repeated ones). Bands are parameters.

Defined results: a null or empty text has no words, zeros everywhere, script ``none``, and fails the
base rule on words. Rows are judged one by one, so repeated rows and null ids need no special care.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import blank_split, extended, filled, map_arrow, slices
from fulltime.llm.pieces import piece_coder

#: First and last code points of the scripts told apart. Letters of any other are ``other``.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "indic": [(0x900, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
}

#: Latin text is ``latin_marked`` from this share of its letters that are not ASCII, combining marks counted with them.
MARKED = 0.1

#: By script: least and most characters a token, most byte share, least token entropy. Scripts that the
#: vocabulary hardly covers are bytes for the most part, so only their entropy is held to a bound (the bytes
#: of one script are few, clean text of 25 to 45 words has 3.7 to 4.6 bits). Latin of many marks and
#: Cyrillic of languages the vocabulary was not made for break into pieces of little more than a letter.
BANDS = {
    "latin": (1.5, 5.0, 0.10, 5.0),
    "latin_marked": (1.0, 5.0, 0.25, 5.0),
    "greek": (0.7, 3.0, 0.30, 4.5),
    "cyrillic": (1.1, 4.5, 0.25, 5.0),
    "none": (0.5, 5.0, 0.5, 3.0),  # digits and signs, no letters
    "other": (0.2, 5.0, 1.0, 3.0),
}

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
          "chars_per_token double, byte_share double, token_entropy double, script string")
#: Odd multipliers that mix the words of a window, and the text it stands in, into one 64-bit key.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _repeated(word: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Words (by number) of each text that stand in a 3-word window found twice or more in it (64-bit window keys)."""
    out, total = np.zeros(len(lens), np.int64), len(word)
    if total < 3:
        return out
    h = word.astype(np.uint64) * MIX[3]
    h ^= h >> np.uint64(31)
    doc = np.repeat(np.arange(len(lens)), lens)
    key = (h[:-2] * MIX[0] + h[1:-1] * MIX[1] + h[2:]) * MIX[2] + doc[:-2].astype(np.uint64) * MIX[3]
    at = np.flatnonzero(doc[:-2] == doc[2:])
    key = key[at]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        hit = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
        seen = np.zeros(total, bool)
        for k in range(3):
            seen[hit + k] = True
        out += np.bincount(doc[seen], minlength=len(lens))
    return out


def _entropy(ids: np.ndarray, lens: np.ndarray, size: int) -> np.ndarray:
    key = np.repeat(np.arange(len(lens)) * size, lens) + ids
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    n, doc = np.diff(np.r_[first, len(key)]), key[first] // size
    total = np.maximum(lens, 1)
    return np.log2(total) - np.bincount(doc, n * np.log2(n), minlength=len(lens)) / total


@lru_cache(1)
def _script_table() -> tuple[np.ndarray, list[str]]:
    names = ["none", *SCRIPTS, "other", "latin_marked"]
    out = np.zeros(0x110000, np.uint8)
    letters = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c))[0] == "L"]
    out[letters] = names.index("other")
    for name in SCRIPTS:
        for a, z in SCRIPTS[name]:
            out[a:z + 1] = names.index("latin_marked" if name == "latin" and a > 0x7F else name)
    out[0x300:0x370] = names.index("latin_marked")
    out[[0xD7, 0xF7]] = 0  # signs among the Latin letters
    return out, names


def main_script(text: str) -> str:
    """The script of most letters."""
    table, names = _script_table()
    found = np.bincount(table[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=len(names))
    latin, marked = names.index("latin"), found[-1]
    found[-1] = 0
    found[latin] += marked
    if not found[1:].any():
        return names[0]
    main = 1 + int(found[1:].argmax())
    return names[-1] if main == latin and marked >= MARKED * found[latin] else names[main]


def measure(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if None) with the measures of SCHEMA for every whole text."""
    clash = {c.split()[0] for c in SCHEMA.split(", ")}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in clash]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = piece_coder(model)
        for b in slices(batches, "__text", 3_000_000):
            column = filled(b.column("__text"))
            texts, words = column.to_pylist(), blank_split(column)
            ids, n = coder.encode_flat(column)
            some, doc = np.maximum(n, 1), np.repeat(np.arange(len(n)), n)
            raw = np.zeros(coder.size, bool)
            raw[coder.byte_id] = True
            lines = [[x for x in t.split("\n") if x.strip(BLANKS)] for t in texts]
            yield {c: b.column(c) for c in keep} | {
                "n_words": words.lens,
                "word_chars": [len(t) - sum(map(t.count, BLANKS)) for t in texts],
                "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
                "n_dup_lines": [len(x) - len(set(x)) for x in lines],
                "n_repeat_words": _repeated(words.at, words.lens),
                "n_tokens": n,
                "chars_per_token": np.array([len(t) for t in texts]) / some,
                "byte_share": np.bincount(doc[raw[ids]], minlength=len(n)) / some,
                "token_entropy": _entropy(ids, n, coder.size),
                "script": [main_script(t) for t in texts],
            }

    return map_arrow(src, run, extended(src, keep, SCHEMA))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def in_band(bands: dict[str, tuple[float, float, float, float]] | None = None) -> Column:
    """True where the measures lie within the band of the text's script (``other``: any script not named)."""
    bands = bands or BANDS

    def inside(low: float, high: float, share: float, entropy: float) -> Column:
        return (F.col("chars_per_token").between(low, high) & (F.col("byte_share") <= share)
                & (F.col("token_entropy") >= entropy))

    out = None
    for name in (n for n in bands if n != "other"):
        cond = F.col("script") == name
        out = F.when(cond, inside(*bands[name])) if out is None else out.when(cond, inside(*bands[name]))
    rest = inside(*bands["other"])
    return rest if out is None else out.otherwise(rest)


def verdict(docs: DataFrame, model: str, keep: list[str] | None = None,
            bands: dict[str, tuple[float, float, float, float]] | None = None) -> DataFrame:
    """``measure`` with base_failed and kept (neither the base rules nor the bands reject the text)."""
    return (measure(docs, model, keep=keep).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & in_band(bands)))
