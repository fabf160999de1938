"""Stored tables on Parquet: overwrite, append, dynamic partition replace, keyed upsert, export.

A table is a folder of Parquet files. A keyed table is partitioned by a hash of its keys; the partition
column is named after them (``_by64__event_id__match_id``), so the folder itself says how it is laid out.
An upsert rewrites only the partitions that its source touches, by one dynamic partition overwrite (the new
files are put in place when all are written); what was staged before is deleted afterwards. A plain
table that is upserted becomes a keyed one with all its rows. A keyed table stays keyed in appends, overwrites
(where the rows have its keys) and partition reloads. A table that can't be read is an error, never an empty
table. A null is a key value like any other: two rows of the same keys with nulls in the same places are one.

One writer at a time works on a table; readers that start after a write see all of it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

#: Partitions of a keyed table, unless its first upsert asks for another number.
PARTS = 64
KEYED = re.compile(r"^_by(\d+)__(.+)$")


def dealt_by(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    """A writer of ``df`` by these columns whose tasks hold rows of few partitions, about the session's advisory size
    of them: a partition is written by as many tasks as its size needs (not by every task), and the sort before
    the write is bounded whatever a task read."""
    if not partition_by:
        return df.write
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by]).write.partitionBy(*partition_by)


class Layer:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, name: str):
        """The file system and the path of a table's folder, for what Spark's readers and writers don't do."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, name: str) -> bool:
        """Whether the table's folder exists; any failure to find out is raised."""
        fs, where = self._fs(name)
        return fs.exists(where)

    def folders(self, name: str) -> list[str]:
        """Names of the folders in a folder; none if it doesn't exist."""
        fs, where = self._fs(name)
        return sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()) if fs.exists(where) else []

    # ------------------------------------------------------------ layout
    def _raw(self, name: str, merge_schema: bool = False) -> DataFrame:
        return self.spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(self.path(name))

    @staticmethod
    def _column(parts: int, keys: Sequence[str]) -> str:
        """Name of the partition column of a keyed table; keys that have the separator in them are written apart."""
        odd = lambda k: "__" in k or k[:1] == "_" or k[-1:] == "_" or "~" in k
        return f"_by{parts}__{'__'.join(k.replace('~', '~t').replace('_', '~u') if odd(k) else k for k in keys)}"

    @staticmethod
    def _layout(df: DataFrame) -> tuple[str, int, list[str]] | None:
        """Partition column, partitions and keys of a keyed table; None for a plain one."""
        for c in df.columns:
            if m := KEYED.match(c):
                return c, int(m[1]), [k.replace("~u", "_").replace("~t", "~") for k in m[2].split("__")]
        return None

    def _keyed(self, name: str) -> tuple[str, int, list[str]] | None:
        return self._layout(self._raw(name)) if self.exists(name) else None

    def _dealt(self, df: DataFrame, parts: int, keys: Sequence[str]) -> DataFrame:
        # keys by their text: 7 as int and as long fall in the same partition
        return df.withColumn(self._column(parts, keys), F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(parts)).cast("int"))

    # ------------------------------------------------------------ whole tables
    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        """Replaces all rows. A keyed table stays one where the rows have its keys (``partition_by`` ends that)."""
        layout = None if partition_by else self._keyed(name)
        if layout and set(layout[2]) <= set(df.columns):
            df, partition_by = self._dealt(df, layout[1], layout[2]), [layout[0]]
        dealt_by(df, partition_by).mode("overwrite").parquet(self.path(name))

    def overwrite_audited(self, df: DataFrame, name: str, cols: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
        """``overwrite``, and the rows and nulls by column that the writing job itself counted (one row, as
        ``reports.null_audit`` gives it): the data is computed and read once."""
        seen = Observation()
        aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in (df.columns if cols is None else cols)]
        self.overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows"), *aggs), name, partition_by)
        row = seen.get
        return self.spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` long" for c in row))

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        """Adds rows; new columns are seen by ``read(merge_schema=True)``. A keyed table stays one."""
        if layout := self._keyed(name):
            column, parts, keys = layout
            df, partition_by = self._dealt(df, parts, keys), [column]
        dealt_by(df, partition_by).mode("append").parquet(self.path(name))

    def replace_partitions(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
        """Idempotent reload: all rows whose ``partition_by`` values occur in ``df`` give way to those of ``df``.

        A plain table is partitioned by these columns, and only their partitions are rewritten. A keyed table
        is laid out by its keys, so all of it is written anew.
        """
        layout = self._keyed(name)
        if not layout:
            dealt_by(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
            return
        column, parts, keys = layout
        with self._staged(self._dealt(df, parts, keys), [column]) as new:
            kept = self._without(self._raw(name, merge_schema=True), new.select(*partition_by).distinct(), partition_by)
            with self._staged(kept.unionByName(new, allowMissingColumns=True), [column]) as merged:
                dealt_by(merged, [column]).mode("overwrite").parquet(self.path(name))

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        df = self._raw(name, merge_schema)
        layout = self._layout(df)
        return df.drop(layout[0]) if layout else df

    # ------------------------------------------------------------ upsert
    @contextmanager
    def _staged(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
        """``df`` written once to a place of its own, and read back: what follows doesn't compute it again. Within
        this only: the place is deleted at the end."""
        name = f"_staging/{uuid.uuid4().hex}"
        try:
            dealt_by(df, partition_by).parquet(self.path(name))
            yield self.spark.read.schema(df.schema).parquet(self.path(name))
        finally:
            fs, where = self._fs(name)
            fs.delete(where, True)

    @staticmethod
    def _without(old: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of ``old`` whose keys don't occur in ``gone``; nulls equal each other."""
        names = [f"_gone{i}" for i in range(len(keys))]
        same: Column = F.lit(True)
        for k, g in zip(keys, names):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(g))
        return old.join(gone.select(*[F.col(f"`{k}`").alias(g) for k, g in zip(keys, names)]), same, "left_anti")

    def upsert(self, source: DataFrame, name: str, keys: Sequence[str], check_unique: bool = True, parts: int = PARTS) -> None:
        """Matched keys take the source row, others are inserted; creates the table when absent.

        Source rows of the same keys are rejected (the result would hang on their order).
        """
        target = self._raw(name, merge_schema=True) if self.exists(name) else None
        layout = self._layout(target) if target is not None else None
        if layout and layout[2] != list(keys):
            raise ValueError(f"{name} is keyed by {layout[2]}, not by {list(keys)}")
        column, parts = (layout[0], layout[1]) if layout else (self._column(parts, keys), parts)
        with self._staged(self._dealt(source, parts, keys), [column]) as new:
            if check_unique and not new.groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1").isEmpty():
                raise ValueError(f"upsert source has duplicate keys {list(keys)}")
            if target is None:
                dealt_by(new, [column]).mode("overwrite").parquet(self.path(name))
                return
            if layout:
                touched = [r[0] for r in new.select(F.col(f"`{column}`")).distinct().collect()]  # ``parts`` numbers at most
                old = target.where(F.col(f"`{column}`").isin(touched))
            else:
                old = self._dealt(target, parts, keys)
            merged = self._without(old, new, keys).unionByName(new, allowMissingColumns=True)
            if layout:  # a dynamic overwrite writes new files beside the old ones, and puts them in place at the end
                dealt_by(merged, [column]).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
                return
            with self._staged(merged, [column]) as whole:
                dealt_by(whole, [column]).mode("overwrite").parquet(self.path(name))

    # ------------------------------------------------------------ catalog
    def register(self, name: str, view: str | None = None) -> str:
        """Expose a stored table to SQL as a temporary view."""
        v = view or name
        self.read(name).createOrReplaceTempView(v)
        return v

    def list(self, pattern: str) -> DataFrame:
        """Registered tables whose name matches a SQL LIKE-style pattern (``*`` or ``%`` wildcards)."""
        names = [t.name for t in self.spark.catalog.listTables(pattern=pattern.replace("%", "*"))]
        return self.spark.createDataFrame([(n,) for n in sorted(names)], "table_name string")

    # ------------------------------------------------------------ export
    def export(self, df: DataFrame, name: str, drop_pattern: str = r"^_") -> str:
        """Snappy Parquet files per serving table, audit columns dropped; as many files as the rows need."""
        rx = re.compile(drop_pattern)
        path = self.path(f"export/{name}")
        df.drop(*[c for c in df.columns if rx.search(c)]).hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(path)
        return path

    def load_export(self, name: str) -> DataFrame:
        """Read an exported table back with its load time and source name."""
        return self.spark.read.parquet(self.path(f"export/{name}")).select(
            "*", F.current_timestamp().alias("_loaded_at"), F.lit(name).alias("_source_table"))

    def table_stats(self, name: str) -> DataFrame:
        """Files, bytes and rows of a stored table, from the file metadata (one pass)."""
        per_file = self._raw(name).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        return per_file.groupBy("f").agg(F.first("s").alias("bytes"), F.count(F.lit(1)).alias("rows")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def with_audit(df: DataFrame, source: str, label: str | None = None) -> DataFrame:
    """Ingest time, source id and optional label columns (kept out of compared outputs)."""
    out = df.select("*", F.current_timestamp().alias("_ingested_at"), F.lit(source).alias("_source"))
    return out.withColumn("_label", F.lit(label)) if label is not None else out
