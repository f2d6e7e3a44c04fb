"""Structured Streaming versions of the run-store operators.

* ST1 ingest: a file stream of raw runs is validated per micro-batch; valid
  rows (with packed metadata) are written to the month-partitioned run
  table, rejects to a reject table (``foreachBatch``; a batch has partitions
  of its own, so a replayed one replaces itself).
* ST2 live rollup: request events -> hourly run rows with a watermark, so
  late events beyond it are dropped and closed windows are emitted once.
* ST3 live anomalies: stream-static join with a small, frozen thresholds
  table and the AN1 rule; flagged values are appended.

All jobs take a checkpoint location in the shared checkpoint folder and can
run continuously or with ``availableNow`` (drain what exists, then stop).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators import runs as RS

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _trigger(writer, available_now: bool, interval: str = "1 minute"):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def ingest_runs(spark: SparkSession, source: str, schema: T.StructType, table_dir: str, reject_dir: str,
                checkpoint: str, fmt: str = "json", available_now: bool = True, name: str = "stream"):
    """ST1: continuous ingest of run files into the run table (IO3 per micro-batch).

    A batch is stored under ``name`` and its number, so a replayed one replaces itself.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(source)

    def write_batch(batch: DataFrame, batch_id: int):
        from loadlens.sources.runstore import write_partitioned
        valid, rejects = RS.split_batch(batch)
        write_partitioned(valid, table_dir, f"{name}-{batch_id}")
        (rejects.withColumn("batch", F.lit(f"{name}-{batch_id}")).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(reject_dir))
    q = _trigger(stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint),
                 available_now).start()
    return q


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """Request events as a file stream; ``ts`` cast to ``timestamp`` for event time.

    ``path`` is a directory or a glob of files (new files are picked up).
    """
    import os
    src = path
    if path.endswith(".parquet") and "*" not in path:      # a single file: watch it as a glob
        src = path[:-len(".parquet")] + "*.parquet"
    s = (spark.readStream.schema(EVENTS_SCHEMA).option("basePath", os.path.dirname(src.rstrip("/")))
              .parquet(src))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_rollup(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """ST2: tumbling one-hour run rows; distinct users are approximate in streaming."""
    return (events.withWatermark("ts", watermark)
                  .groupBy(F.window("ts", "1 hour").alias("w"))
                  .agg(F.count("*").alias("total_requests"),
                       F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("bigint").alias("total_failures"),
                       F.avg("value").alias("avg_response_time"), F.max("value").alias("max_response_time"),
                       F.min("value").alias("min_response_time"),
                       (F.count("*") / 3600.0).alias("requests_per_sec"),
                       F.approx_count_distinct("user_id").alias("concurrent_users"))
                  .select(F.col("w.start").alias("window_start"), "*").drop("w"))


def run_to_table(df: DataFrame, out_dir: str, checkpoint: str, mode: str = "append", available_now: bool = True):
    q = _trigger(df.writeStream.format("parquet").outputMode(mode).option("path", out_dir)
                   .option("checkpointLocation", checkpoint), available_now).start()
    return q


def live_anomalies(events: DataFrame, thresholds: DataFrame, metric: str = "value") -> DataFrame:
    """ST3: events flagged by the frozen AN1 thresholds (stream-static join; Spark picks its kind by size).

    ``thresholds`` has one row per (event_type) with ``z_score_3`` and ``iqr_lower``.
    """
    j = events.join(thresholds, "event_type", "inner")
    flag = (F.col(metric) > F.col("z_score_3")) | (F.col(metric) < F.col("iqr_lower"))
    return j.where(flag).select("event_id", "ts", "event_type", F.col(metric).alias("value"),
                                (F.col(metric) > F.col("z_score_3")).alias("threshold_exceeded"))


FLAG_SCHEMA = "ts timestamp, column string, is_anomaly boolean, batch string"


def flag_batches(events: DataFrame, thresholds_dir: str, out_dir: str, checkpoint: str, metric: str = "value", available_now: bool = True):
    """ST3, first step: every event with its AN1 flag, by micro-batch (a replayed one replaces itself).

    The thresholds (parquet: event_type, z_score_3, iqr_lower) are read anew
    for each micro-batch, so a new fit takes effect without a restart.  An
    event whose type has no thresholds isn't flagged.
    """

    def write_batch(batch: DataFrame, batch_id: int):
        limits = batch.sparkSession.read.parquet(thresholds_dir).select("event_type", "z_score_3", "iqr_lower")
        flagged = batch.join(limits, "event_type", "left").select(
            "ts", F.col("event_type").alias("column"),
            F.coalesce((F.col(metric) > F.col("z_score_3")) | (F.col(metric) < F.col("iqr_lower")), F.lit(False)).alias("is_anomaly"))
        (flagged.withColumn("batch", F.lit(str(batch_id))).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_dir))
    return _trigger(events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), available_now).start()


def window_rates(flagged: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """ST3 + AN5: anomaly count and rate per event-time window and column.

    They depend on the events' times alone, not on how the stream was cut into
    batches.  A window's rate is final once the watermark (the latest event
    less the delay) has passed its end; later events for it are dropped.
    """
    return (flagged.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), "column")
            .agg(F.count_if("is_anomaly").alias("anomaly_count"), F.count("*").alias("events"))
            .select(F.col("w.start").alias("window_start"), "column", "anomaly_count", "events",
                    (F.col("anomaly_count") / F.col("events")).alias("anomaly_rate")))


def alert_windows(flagged_dir: str, out_dir: str, checkpoint: str, spark: SparkSession, window: str = "1 hour",
                  watermark: str = "1 hour", available_now: bool = True):
    """ST3 + AN5, second step: the rates of closed windows, as a stream over the flagged events."""
    flagged = spark.readStream.schema(FLAG_SCHEMA).parquet(flagged_dir).drop("batch")
    return run_to_table(window_rates(flagged, window, watermark), out_dir, checkpoint, available_now=available_now)
