"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then start from files that survive the loss of an executor,
    and what is used twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`store` whose successor is stored, so that rounds don't pile up in the shared folder."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows (sizes the number of buckets)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def crc_mod(col, n: int):
    """crc32 of a value's decimal text, modulo ``n``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n
