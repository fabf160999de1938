"""Stored models: a fitted pipeline with all it needs to score raw rows, its card, and batch scoring from both.

A model is a folder of numbered versions. A version holds ``pipeline`` (written and read by MLlib's own writer:
encoders, fills and the fitted stages) and ``card`` (one row: features, metrics, what it was trained on). The
card is written last, so a version that a failed save left behind is never seen. Versions don't change.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulltime.sources.layer import Layer

CARD = ("name string, version int, kind string, features array<string>, inputs array<string>, metrics map<string,double>, "
        "trained_rows long, fingerprint string, params string")


def fingerprint(df: DataFrame, cols: Sequence[str]) -> tuple[int, str]:
    """Rows and a digest of the values of ``cols``, whatever the rows' order and partitions (repeated rows count)."""
    h = F.xxhash64(*[F.col(c) for c in cols])
    row = df.select(h.alias("a"), F.xxhash64(F.lit(1), h).alias("b")).agg(
        F.count("*"), *[F.coalesce(F.sum(F.col(c).cast("decimal(20,0)")), F.lit(0)).cast("string") for c in "ab"]).first()
    return int(row[0]), f"{int(row[1]) % 2**64:016x}{int(row[2]) % 2**64:016x}"


@dataclass
class StoredModel:
    """A version read back: its pipeline and its card."""

    pipeline: PipelineModel
    card: dict

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with what the pipeline adds; rows that lack an input are refused by name."""
        if missing := [c for c in self.card["inputs"] if c not in rows.columns]:
            raise ValueError(f"{self.card['name']} needs {missing}")
        return self.pipeline.transform(rows)


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.layer = spark, Layer(spark, root)

    def _at(self, name: str, version: int, part: str) -> str:
        return f"{name}/{version:06d}/{part}"

    def versions(self, name: str) -> list[int]:
        """Complete versions, oldest first."""
        return sorted(int(v) for v in self.layer.folders(name) if self.layer.exists(f"{name}/{v}/card/_SUCCESS"))

    def save(self, name: str, pipeline: PipelineModel, kind: str, features: Sequence[str], inputs: Sequence[str],
             metrics: Mapping[str, float], training: DataFrame, label: str = "label", params: Mapping | None = None) -> int:
        """Write a new version; its number. One writer at a time works on a name."""
        version = max([int(v) for v in self.layer.folders(name)], default=0) + 1
        pipeline.write().save(self.layer.path(self._at(name, version, "pipeline")))
        rows, digest = fingerprint(training, [*features, label])
        card = (name, version, kind, list(features), list(inputs), {k: float(v) for k, v in metrics.items()}, rows, digest,
                json.dumps(dict(params or {}), sort_keys=True))
        self.layer.overwrite(self.spark.createDataFrame([card], CARD).coalesce(1), self._at(name, version, "card"))
        return version

    def card(self, name: str, version: int) -> dict:
        return self.layer.read(self._at(name, version, "card")).first().asDict(recursive=True)

    def load(self, name: str, version: int | None = None) -> StoredModel:
        """A version, the newest if none is given."""
        known = self.versions(name)
        if not known or (version is not None and version not in known):
            raise LookupError(f"no model {name}" + (f", version {version}" if version is not None else ""))
        version = known[-1] if version is None else version
        return StoredModel(PipelineModel.load(self.layer.path(self._at(name, version, "pipeline"))), self.card(name, version))

    def cards(self, name: str) -> DataFrame:
        """The cards of all versions."""
        rows = [self.card(name, v) for v in self.versions(name)]
        return self.spark.createDataFrame([tuple(r[f.split()[0]] for f in CARD.split(", ")) for r in rows], CARD)
