"""Structured Streaming jobs for live feeds: payload parsing, re-delivery dedup, windowed odds and
weather, a live scoreboard and streaming upserts into a stored table.

Sources are file streams (Kafka in production: the same code after ``readStream.format("kafka")``
and a ``CAST(value AS STRING)``). Sinks write through ``foreachBatch`` into keyed tables, of which a
batch rewrites the partitions it touches; a restarted query resumes from its checkpoint, and a batch
applied twice leaves the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from fulltime.sources.layer import Layer

#: Deliveries that a replayed history arrives in.
DELIVERIES = 3


def replay(df: DataFrame, ts: str, root: str, run: Callable[[DataFrame], DataStreamWriter], deliveries: int = DELIVERIES) -> list[dict]:
    """Feeds the rows of ``df`` to a stream in order of event time; the progress of its micro-batches.

    The history is cut into equal spans of time from its first to its last row (rows without a time come
    last), written once, and delivered span by span, with as many files each as its tasks make. ``run`` turns
    the source stream into a writer; one run takes the files in the order they came, about a span in each
    micro-batch, until all are processed (``availableNow``).
    """
    spark, staged, landing = df.sparkSession, f"{root}/staged", f"{root}/landing"
    low, high = df.agg(F.min(ts).cast("timestamp").cast("double"), F.max(ts).cast("timestamp").cast("double")).first()
    at = F.col(ts).cast("timestamp").cast("double")
    span = F.floor((at - F.lit(low or 0.0)) / F.lit(max((high or 0.0) - (low or 0.0), 1e-6)) * deliveries)
    part = F.least(F.coalesce(span, F.lit(deliveries)), F.lit(deliveries - 1)).cast("int")
    df.withColumn("_delivery", part).write.partitionBy("_delivery").parquet(staged)
    history = spark.read.schema(df.withColumn("_delivery", part).schema).parquet(staged)
    for k in range(deliveries):  # one after another: the source takes files by the time they were written
        history.where(F.col("_delivery") == k).drop("_delivery").write.mode("append").parquet(landing)
    where = spark._jvm.org.apache.hadoop.fs.Path(landing)
    files = [f for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where) if f.getPath().getName().startswith("part-")]
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max(1, -(-len(files) // deliveries))).parquet(landing)
    query = run(source).trigger(availableNow=True).start()
    query.awaitTermination()
    return [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def parse_topic(raw: DataFrame, schema: StructType, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON payload -> typed columns; rows that do not parse go to a reject output."""
    parsed = _parsed(raw, schema, value_col)
    good = parsed.filter("ok").select("p.*").drop("_corrupt_record")
    bad = parsed.filter("NOT ok").select("_raw")
    return good, bad


def _parsed(raw: DataFrame, schema: StructType, value_col: str) -> DataFrame:
    with_corrupt = StructType(schema.fields + [StructField("_corrupt_record", StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = raw.select(F.col(value_col).alias("_raw"), F.from_json(F.col(value_col), with_corrupt, opts).alias("p"))
    return parsed.withColumn("ok", F.col("p").isNotNull() & F.col("p._corrupt_record").isNull())


def parse_with_rejects(raw: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """Typed columns and ``_reject`` (the payload that did not parse, else null): one stream for one sink."""
    parsed = _parsed(raw, schema, value_col)
    return parsed.select("p.*", F.when(~F.col("ok"), F.coalesce("_raw", F.lit(""))).alias("_reject")).drop("_corrupt_record")


#: Time within which the feeds deliver an event again.
REDELIVERY = "30 minutes"


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, within: str = REDELIVERY) -> DataFrame:
    """One row per natural key (not the per-delivery id) of events that are delivered again ``within`` that time.

    State holds one entry a key, which expires that time after its row once the watermark, as far behind,
    has passed: it is bounded by the events of about twice ``within`` however long the stream runs.
    """
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))


def odds_windows(stream: DataFrame, ts: str = "ingested_at", window: str = "1 day", delay: str = "1 hour",
                 slide: str | None = None) -> DataFrame:
    """Per match and event-time window (sliding where ``slide`` is given): snapshots, newest home/draw/away
    prices, mean home price. Window bounds are wall-clock (timestamp_ntz) values, like the feed's own."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return stream.withWatermark(ts, delay).groupBy("match_id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.max_by("odd_home", ts).alias("last_odd_home"), F.max_by("odd_draw", ts).alias("last_odd_draw"),
        F.max_by("odd_away", ts).alias("last_odd_away"), F.avg("odd_home").alias("mean_odd_home"),
    ).select("match_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
             F.col("w.end").cast("timestamp_ntz").alias("window_end"), "snapshots",
             "last_odd_home", "last_odd_draw", "last_odd_away", "mean_odd_home")


def weather_windows(stream: DataFrame, ts: str = "collected_at", window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Per venue and hour: readings, mean and max wind speed."""
    return stream.withWatermark(ts, delay).groupBy("venue_id", F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("readings"), F.avg("wind_speed_kmh").alias("mean_wind_kmh"),
        F.max("wind_speed_kmh").alias("max_wind_kmh"),
    ).select("venue_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "readings", "mean_wind_kmh",
             "max_wind_kmh")


def upsert_batches(layer: Layer, name: str, keys: Sequence[str], check_unique: bool = True, parts: int = 8):
    """``foreachBatch`` function applying each micro-batch as a keyed upsert (idempotent on replay).
    ``check_unique=False`` for aggregation outputs, whose rows are unique per group key by construction."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            layer.upsert(batch, name, keys, check_unique=check_unique, parts=parts)

    return apply


def to_table(stream: DataFrame, layer: Layer, name: str, keys: Sequence[str], checkpoint: str,
             mode: str = "update", aggregated: bool = True) -> DataStreamWriter:
    """Writer of a stream into a keyed table. ``aggregated``: the stream is a grouped aggregate keyed by
    ``keys`` (no duplicate check needed)."""
    return (stream.writeStream.outputMode(mode).foreachBatch(upsert_batches(layer, name, keys, not aggregated))
            .option("checkpointLocation", checkpoint))


def to_files(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer of an append-only stream (no aggregation state) into a Parquet folder."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def run_to_table(stream: DataFrame, layer: Layer, name: str, keys: Sequence[str], checkpoint: str,
                 mode: str = "update", aggregated: bool = True) -> DataFrame:
    """Run ``stream`` over all available input (``availableNow``) into a keyed table; return it."""
    to_table(stream, layer, name, keys, checkpoint, mode, aggregated).trigger(availableNow=True).start().awaitTermination()
    return layer.read(name)


def run_append(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-only stream over all available input into a Parquet folder; return it."""
    to_files(stream, path, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)
