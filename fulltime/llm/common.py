"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types as python_types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fulltime.session import scratch_dir
from fulltime.session import stored as write_stored

#: Words are runs of other characters than these ASCII blanks (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fanout(spark: SparkSession, times: int = 1) -> int:
    """Number of shuffle partitions the session asks for, times a factor."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * times


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; ``session.drop_scratch`` deletes it."""
    return scratch_dir(spark, f"llm-{label}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    return write_stored(df, f"llm-{label}")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within this, batches to and from Python workers have ``rows`` rows at most: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_object(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """What gives ``value`` in tasks: broadcast once with its class by value, so executors need no copy of the package."""
    sent, held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get() -> Any:
        if not held:
            held.append(cloudpickle.loads(sent.value))
        return held[0]

    return get


def per_process(key: str, make: Callable[[], Any]) -> Any:
    """One object for each Python worker process, made when first asked for; the one before it goes.

    Workers outlive tasks; functions shipped by value do not. Used for vocabularies with their tables of
    words already encoded, which change no result.
    """
    module = sys.modules.setdefault("fulltime_llm_process", python_types.ModuleType("fulltime_llm_process"))
    held = getattr(module, "held", None)
    if not held or held[0] != key:
        module.held = None
        module.held = held = (key, make())
    return held[1]


class Split:
    """Words of texts as numbers: ``distinct`` words in order of their first places, ``at`` of every word, ``lens`` by text."""

    def __init__(self, lists: pa.ListArray, drop: str | None = None):
        coded = lists.flatten().dictionary_encode()
        self.distinct: pa.Array = coded.dictionary
        self.at = coded.indices.to_numpy().astype(np.int64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        if drop is not None and (gone := self.distinct.index(drop).as_py()) >= 0:
            stay = self.at != gone
            offsets = np.r_[0, np.cumsum(stay)][offsets]
            self.at = self.at[stay]
        self.lens = np.diff(offsets)


def blank_split(texts: pa.Array, lower: bool = False) -> Split:
    """Words between ASCII blanks (``WORD``), A-Z in lower case if asked; the empty string is no word."""
    return Split(pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts), "")


def filled(texts: pa.Array) -> pa.Array:
    """Strings with empty ones for nulls, from any offset of a batch."""
    return pc.fill_null(pa.concat_arrays([texts]), "")


def gather(flat: np.ndarray, lens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts ``at`` of a flat array cut into parts of ``lens``, one after another; and their lengths."""
    n = lens[at]
    first = np.cumsum(lens) - lens
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first[at] - (ends - n), n) + np.arange(total)], n


class Generations:
    """A bounded table of known words: when it is full, only words still in use live on."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def of(self, words: list, learn: Callable[[list], list]) -> list:
        """Values of distinct words; ``learn`` gives those of words not known, in order."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now
        out = list(map(self.now.get, words))
        new = [i for i, v in enumerate(out) if v is None]
        if self.before:
            old = list(map(self.before.get, [words[i] for i in new]))
            self._set(out, words, [i for i, v in zip(new, old) if v is not None], [v for v in old if v is not None])
            new = [i for i, v in zip(new, old) if v is None]
        if new:
            self._set(out, words, new, learn([words[i] for i in new]))
        return out

    def _set(self, out: list, words: list, at: list[int], values: list) -> None:
        self.now.update(zip([words[i] for i in at], values))
        for i, v in zip(at, values):
            out[i] = v


def extended(df: DataFrame, keep: list[str], more: str) -> T.StructType:
    """The schema of the columns ``keep`` of ``df``, then those of a schema string."""
    return T.StructType([*[df.schema[c] for c in keep], *T._parse_datatype_string(more).fields])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a generator of column dicts; the batches get the types of ``schema``."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type)
                 for f, c in ((f, cols[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``chars`` bytes of text each, a row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        at = held = 0
        for i, n in enumerate(sizes):
            if i > at and held + n > chars:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        yield batch.slice(at)
        pa.default_memory_pool().release_unused()
