"""Run a monitoring operator as a Structured Streaming query over landed request-log files.

The source is a parquet folder read with ``maxFilesPerTrigger`` (several micro-batches, state carried between
them); the sink is ``foreachBatch`` writing each micro-batch's updated rows into its own ``epoch=N`` folder with
overwrite (a retried batch replaces its own output: idempotent). The final table keeps, per key, the row of the
latest epoch — the same result as the batch query. Checkpoint and sink live in the shared table folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.session import application_id, parallelism
from pricedex.sources import landing as L
from pricedex.sources import standins as S
from pricedex.streaming.monitor import HEARTBEAT_METHOD

REQUEST_LOG_SCHEMA = "ts timestamp_ntz, method string, path string, status int, latency_s double, category string"


#: How late a request may be. A parameter of every stream, fixed, whatever the span of the data.
WATERMARK = "10 minutes"

_LANDED: dict[tuple, str] = {}
_SLICE_FILES: dict[str, int] = {}


def files_per_trigger(source_path: str) -> int:
    """Files of one time slice of a landed source: a micro-batch reads one slice, so time never runs back."""
    return _SLICE_FILES.get(source_path, 3)


def _start(spark: SparkSession, writer, state_partitions: int | None):
    """Start a streaming query with an explicit number of state partitions (fixed for the life of its checkpoint;
    AQE does not resize stateful stages). The query runs on a clone of the session taken at start, so the setting
    is restored right after."""
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or parallelism(spark)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)


def _once(spark: SparkSession, name: str, sf_dir: str, land: Callable[[], str]) -> str:
    """A landed stream source is written once per application and shared by the streaming queries reading it."""
    import os

    key = (application_id(spark), name, os.path.abspath(sf_dir))
    if key not in _LANDED:
        _LANDED[key] = land()
    return _LANDED[key]


def run_update_stream(spark: SparkSession, source_path: str, build: Callable[[DataFrame], DataFrame],
                      key_cols: list[str], max_files: int | None = None, state_partitions: int | None = None) -> DataFrame:
    stream = spark.readStream.schema(REQUEST_LOG_SCHEMA).option("maxFilesPerTrigger", max_files or files_per_trigger(source_path)).parquet(source_path)
    result = build(stream)
    sink = L.fresh_path(spark, "stream_sink")
    checkpoint = L.fresh_path(spark, "stream_checkpoint")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")

    q = _start(spark, result.writeStream.outputMode("update").foreachBatch(write_batch)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True), state_partitions)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    value_cols = [c for c in result.columns if c not in key_cols]
    latest = out.groupBy(*key_cols).agg(F.max_by(F.struct(*value_cols), "epoch").alias("_v"))
    return latest.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def land_request_log_in_order(spark: SparkSession, sf_dir: str, files: int = 6) -> str:
    """Request log in ``files`` consecutive time slices, each written after the previous one (so the file source,
    which reads oldest files first, sees time advance), then one heartbeat row per service after the end."""
    return _once(spark, "request_log_in_order", sf_dir, lambda: _land_in_order(spark, sf_dir, files))


def _land_in_order(spark: SparkSession, sf_dir: str, files: int) -> str:
    path = L.fresh_path(spark, "request_log_ordered")
    log = S.request_log(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = log.agg(F.min(micros), F.max(micros)).first()  # one row: the time span
    step = (hi - lo) // files + 1
    sizes = log.groupBy(F.floor((micros - lo) / step)).count().agg(F.min("count"), F.count("*")).first()
    # Slices are written one after the other, each as the same number of files, and a micro-batch reads that many:
    # it sees a whole slice, and the next one starts after it. Small slices are one file, so that none is empty.
    parts = parallelism(spark) if sizes[1] == files and sizes[0] >= 10_000 else 1
    for i in range(files):
        slice_ = log.where((micros >= lo + i * step) & (micros < lo + (i + 1) * step))
        slice_.repartition(parts).write.mode("append").parquet(path)
    _SLICE_FILES[path] = parts
    end = F.timestamp_micros(F.lit(hi + 3600 * 10 ** 6)).cast("timestamp_ntz")
    beats = spark.range(2).select(
        end.alias("ts"), F.lit(HEARTBEAT_METHOD).alias("method"),
        F.when(F.col("id") == 0, F.lit("/api/heartbeat")).otherwise(F.lit("/api/predict")).alias("path"),
        F.lit(200).alias("status"), F.lit(0.0).alias("latency_s"), F.lit(None).cast("string").alias("category"))
    beats.coalesce(1).write.mode("append").parquet(path)
    return path


def run_append_stream(spark: SparkSession, source_path: str, build: Callable[[DataFrame], DataFrame],
                      max_files: int | None = None, state_partitions: int | None = None) -> DataFrame:
    """Append-mode query: every output row is final when emitted; the result is the union of all epochs."""
    stream = spark.readStream.schema(REQUEST_LOG_SCHEMA).option("maxFilesPerTrigger", max_files or files_per_trigger(source_path)).parquet(source_path)
    result = build(stream)
    sink = L.fresh_path(spark, "stream_sink")
    checkpoint = L.fresh_path(spark, "stream_checkpoint")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")

    q = _start(spark, result.writeStream.outputMode("append").foreachBatch(write_batch)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True), state_partitions)
    q.awaitTermination()
    return spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result.schema.fields)
                             ).parquet(sink).select(*result.columns)
