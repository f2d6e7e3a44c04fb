"""Append-only log tables and their state as of a time (M11, A9-A11, W4, DR7).

A log is a parquet folder partitioned by the name of the batch that wrote it:
a batch that is written again (a repeated cycle) replaces itself, and nothing
else is ever changed.  The state of a log is an aggregate: the last record of
each key is ``max_by`` over the ordering columns, combined map-side, so a key
that holds a third of the log is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"


def append(rows: DataFrame, folder: str, batch: str) -> None:
    """Write one batch of log records; a batch of the same name is replaced."""
    (rows.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(folder))


def read(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """All records of a log, with their batch."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*fields.fields, T.StructField(BATCH, T.StringType())])).parquet(folder)


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str], as_of=None) -> DataFrame:
    """The last record of each key by ``order``; with ``as_of`` only records whose first order column is not after it."""
    keys = list(keys)
    if as_of is not None:
        log = log.where(F.col(order[0]) <= (F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of))
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest]).select(*log.columns)
