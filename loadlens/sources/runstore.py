"""Run-store sinks and readers (IO1-IO12) on parquet/CSV/JSON/text files.

The run table is parquet with a fixed schema, partitioned by ``month``
(``yyyy-MM``) and ``batch``, so recency and retention prune partitions while
runs of a day (few) do not make tiny files; rows are range-partitioned on
(month, test_id) before the write, so a hot month is split over several tasks.
A batch is written as a whole: writing it again (a replayed micro-batch)
replaces it.  Retention drops whole months and rewrites only the batches of
the cutoff month that lose some of their rows; readers see it as one step.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators import runs as RS
from loadlens.operators.ordering import join_keys, running, stored
from loadlens.schema import BROWSERS, CONFIG_SCHEMA, LOAD_STATS_SCHEMA, NETWORK_CONDITIONS, RUN_SCHEMA, TEST_TYPES

PARTITION, BATCH = "month", "batch"
# Rows that one task sorts and writes.
ROWS_PER_RANGE = 200_000
# Folder of the retention runs' commit records (hidden from readers of the table), and what ends the name of a batch before theirs.
RETENTION, MARK = "_retention", "~"
STORE_SCHEMA = T.StructType([*RUN_SCHEMA.fields, T.StructField("metadata", T.StringType()), T.StructField("date", T.DateType()),
                             T.StructField(PARTITION, T.StringType()), T.StructField(BATCH, T.StringType())])


def conform(df: DataFrame, batch: str) -> DataFrame:
    """The columns of the store: missing ones are null, others live on in the metadata alone."""
    derived = {"date": F.to_date("timestamp"), PARTITION: F.date_format("timestamp", "yyyy-MM"), BATCH: F.lit(batch)}
    names = set(df.columns)
    return df.select(*[(derived[f.name] if f.name in derived else F.col(f.name) if f.name in names else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in STORE_SCHEMA])


def dealt(df: DataFrame, batch: str, metadata: bool = False) -> DataFrame:
    """The store's rows in sorted ranges of ``ROWS_PER_RANGE`` rows; what follows from a run's columns is made after the shuffle.

    ``metadata`` packs the run's fields into the metadata, a text far longer than the fields.
    """
    order = [F.date_format("timestamp", "yyyy-MM"), *[F.col(c) for c in ("test_id",) if c in df.columns]]
    rows = df.repartitionByRange(df.count() // ROWS_PER_RANGE + 1, *order)
    return conform(RS.pack_metadata(rows) if metadata else rows, batch)


def write_partitioned(df: DataFrame, table_dir: str, batch: str | None = None, metadata: bool = False) -> None:
    """Write one batch; a batch of the same name is replaced, also what a retention run has left of it."""
    if batch and MARK in batch:
        raise ValueError(f"A batch name may not hold {MARK!r}")
    (dealt(df, batch or uuid.uuid4().hex, metadata)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, BATCH).parquet(table_dir))
    for old in _glob(df.sparkSession, f"{table_dir}/{PARTITION}=*/{BATCH}={batch}{MARK}*") if batch else []:
        _delete(df.sparkSession, old)


def store_runs(df: DataFrame, table_dir: str, reject_dir: str | None = None, batch: str | None = None) -> dict:
    """IO2/IO3: validate a batch, write valid rows by month, rejects aside."""
    write_partitioned(df.where(RS.validity(df)), table_dir, batch, metadata=True)
    if reject_dir:
        RS.split_batch(df)[1].write.mode("append").parquet(reject_dir)
    return {"reject_dir": reject_dir}


def read_runs(spark: SparkSession, table_dir: str, since: str | None = None) -> DataFrame:
    """IO1: the stored run table as of the last committed retention, from month ``since`` on (filters on ``month`` prune partitions)."""
    runs = spark.read.schema(STORE_SCHEMA).parquet(table_dir)
    if since is not None:
        runs = runs.where(F.col(PARTITION) >= since)
    names, pending = _retentions(spark, table_dir)
    visible = ~F.col(BATCH).contains(MARK)
    if names:
        visible |= F.substring_index(F.col(BATCH), MARK, -1).isin(names)
    for name in pending:
        hidden = spark.read.schema(f"{PARTITION} string, {BATCH} string").json(f"{table_dir}/{RETENTION}/{name}")
        runs = runs.join(hidden, [PARTITION, BATCH], "left_anti").select(runs.columns)
    return runs.where(visible)


def recent_runs(spark: SparkSession, table_dir: str, hours: float, as_of) -> DataFrame:
    """F4 on the store: only the months since the cutoff are read."""
    cutoff = _dt.datetime.fromisoformat(str(as_of)) - _dt.timedelta(hours=float(hours))
    runs = read_runs(spark, table_dir, cutoff.strftime("%Y-%m"))
    return RS.recent_runs(runs, hours, as_of)


def newest_runs(spark: SparkSession, table_dir: str, limit: int, filters: dict | None = None) -> DataFrame:
    """F1-F3 on the store: the newest ``limit`` runs that match, from the newest months alone.

    Months are taken newest first, twice as many each time, until they hold
    enough matching runs; older months are never read.
    """
    runs = read_runs(spark, table_dir)
    months = [r[0] for r in runs.groupBy(PARTITION).agg(F.count("*")).orderBy(F.desc(PARTITION)).collect()]   # file footers only
    take = 1
    while take < len(months) and RS.filter_runs(runs.where(F.col(PARTITION) >= months[take - 1]), filters or {}).limit(limit).count() < limit:
        take *= 2
    if months:
        runs = runs.where(F.col(PARTITION) >= months[min(take, len(months)) - 1])
    return RS.get_results(runs, filters, limit=limit)


def apply_retention(spark: SparkSession, table_dir: str, days: int, as_of) -> int:
    """delete rows older than ``as_of - days``; returns the deleted count.

    Months after the cutoff month are not read.  The young rows of batches that
    lose only a part are first written as new batches that no reader sees yet;
    then one commit record makes them visible and hides the old batches, all at
    once; the hidden folders are removed last.  A run that ends before the
    commit has changed nothing, one that ends after it is finished by the next.
    """
    _finish(spark, table_dir)
    cutoff = _dt.datetime.fromisoformat(str(as_of)) - _dt.timedelta(days=int(days))
    runs = read_runs(spark, table_dir).where(F.col(PARTITION) <= cutoff.strftime("%Y-%m"))
    kept, deleted = RS.retention_split(runs, days, as_of)
    gone = (deleted.groupBy(PARTITION, BATCH).agg(F.count("*").alias("n"))
            .join(kept.groupBy(PARTITION, BATCH).agg(F.count("*").alias("left")), [PARTITION, BATCH], "left").collect())
    if not gone:
        return 0
    name = uuid.uuid4().hex
    part = [r[BATCH] for r in gone if r["left"]]
    if part:
        young = kept.where((F.col(PARTITION) == cutoff.strftime("%Y-%m")) & F.col(BATCH).isin(part))
        new = F.concat(F.substring_index(F.col(BATCH), MARK, 1), F.lit(MARK + name))
        (young.withColumn(BATCH, new).write.mode("append").partitionBy(PARTITION, BATCH).parquet(table_dir))
    _commit(spark, table_dir, name, [(r[PARTITION], r[BATCH]) for r in gone])
    _finish(spark, table_dir)
    return sum(r["n"] for r in gone)


def _commit(spark: SparkSession, table_dir: str, name: str, hidden: list[tuple]) -> None:
    """The commit record of a retention run; it counts from the moment its success mark exists."""
    spark.createDataFrame(hidden, f"{PARTITION} string, {BATCH} string").coalesce(1).write.json(f"{table_dir}/{RETENTION}/{name}")


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def _retentions(spark: SparkSession, table_dir: str) -> tuple[list[str], list[str]]:
    """Names of the committed retention runs, and of those whose old folders are not yet known to be removed."""
    names = [f.split("/")[-2] for f in _glob(spark, f"{table_dir}/{RETENTION}/*/_SUCCESS")]
    done = {f.split("/")[-2] for f in _glob(spark, f"{table_dir}/{RETENTION}/*/_DONE")}
    return names, [n for n in names if n not in done]


def _finish(spark: SparkSession, table_dir: str) -> None:
    """Remove what committed runs have hidden, and what runs that never committed have left."""
    names, pending = _retentions(spark, table_dir)
    for name in pending:
        for r in spark.read.schema(f"{PARTITION} string, {BATCH} string").json(f"{table_dir}/{RETENTION}/{name}").collect():
            _delete(spark, f"{table_dir.rstrip('/')}/{PARTITION}={r[PARTITION]}/{BATCH}={r[BATCH]}")
        mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_dir}/{RETENTION}/{name}/_DONE")
        mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark).close()
    for folder in _glob(spark, f"{table_dir}/{PARTITION}=*/{BATCH}=*{MARK}*"):
        if folder.rsplit(MARK, 1)[1] not in names:
            _delete(spark, folder)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def export_csv(df: DataFrame, path: str) -> str:
    """IO5/IO6: CSV with header, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_configs(df: DataFrame, path: str) -> str:
    """IO7: configurations as JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def load_configs(spark: SparkSession, path: str, multiline: bool = False):
    """IO7: (valid, invalid) configurations; enum domains checked as a predicate.

    ``multiline=True`` reads a file holding one JSON array of records.
    """
    df = spark.read.schema(CONFIG_SCHEMA).option("multiLine", multiline).json(path)
    ok = (F.col("test_type").isin(TEST_TYPES) & F.col("network_condition").isin(NETWORK_CONDITIONS)
          & (F.col("browser").isNull() | F.col("browser").isin(BROWSERS)))
    return df.where(ok), df.where(~F.coalesce(ok, F.lit(False)))


def pack_files(df: DataFrame, key: str, size, file_bytes: int) -> DataFrame:
    """``df`` with the number of its file in ``file``: whole runs, in the order of their ids, in files of about ``file_bytes``.

    ``size`` is the bytes a row takes.  A run's file is the file in which the
    bytes of the runs before it end, so a file holds many small runs, and a
    run larger than a file has one of its own (written in parts).
    """
    sizes = stored(df.groupBy(key).agg(F.sum(size).cast("long").alias("_bytes")), "run-sizes")
    before = running(sizes, [key], (), {"_upto": ("sum", "_bytes")})
    files = before.select(key, F.floor((F.col("_upto") - F.col("_bytes")) / F.lit(file_bytes)).cast("long").alias("file"))
    return join_keys(df, files, [key])


def write_load_stats(df: DataFrame, path: str, file_bytes: int = 8 << 20) -> DataFrame:
    """IO8: statistics rows as CSV files of about ``file_bytes`` that hold many runs each; returns the manifest (run, file)."""
    text = F.length(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])) + 1
    packed = stored(pack_files(df, "test_id", text, file_bytes), "packed-stats")
    rows = F.lit(max(1, file_bytes // 64))                      # a row has some 64 bytes at least; bounds the parts of a large run
    sizes = packed.groupBy("file").agg(F.ceil(F.count("*") / rows).cast("long").alias("_parts"))
    dealt = packed.join(sizes, "file").withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.col("_parts")))
    (dealt.repartition("file", "_part").drop("_part", "_parts").write.partitionBy("file").option("header", True).csv(path))
    return packed.select("test_id", "file").distinct()


def read_load_stats(spark: SparkSession, path: str) -> DataFrame:
    """IO8: load-generator statistics CSVs; a file holds rows of many runs, each with its run id."""
    schema = T.StructType([T.StructField("test_id", T.StringType()), *LOAD_STATS_SCHEMA.fields])
    return spark.read.schema(schema).option("header", True).csv(path)


def read_audit_reports(spark: SparkSession, path_glob: str, id_pattern: str = r"([^/]+)\.txt$") -> DataFrame:
    """IO9: one audit text report per file -> (test_id, text) -> SF1 scores."""
    df = spark.read.text(path_glob, wholetext=True)
    reports = df.select(F.regexp_extract(F.input_file_name(), id_pattern, 1).alias("test_id"),
                        F.col("value").alias("text"))
    return RS.audit_scores(reports)


# Between two reports of one text file: the record separator of ASCII.
REPORT_END = "\x1e"


def write_audit_reports(reports: DataFrame, path: str, file_bytes: int = 8 << 20) -> DataFrame:
    """IO9: text reports (test_id, text) packed into text files of about ``file_bytes``; returns the manifest (run, file).

    A report is a line with its run id, percent-encoded, and its text; a
    separator byte that no report may hold ends it.
    """
    packed = stored(pack_files(reports.select("test_id", "text"), "test_id", F.octet_length("text"), file_bytes), "packed-reports")
    record = F.concat(F.url_encode("test_id"), F.lit("\n"), F.translate("text", REPORT_END, ""))
    (packed.repartition("file").select(record.alias("value"), "file").write.partitionBy("file")
           .option("lineSep", REPORT_END).text(path))
    return packed.select("test_id", "file").distinct()


def read_audit_files(spark: SparkSession, path: str) -> DataFrame:
    """IO9: the reports of packed text files -> (test_id, scores)."""
    record = spark.read.option("lineSep", REPORT_END).text(path).select(F.split("value", "\n", 2).alias("r"))
    return RS.audit_scores(record.select(F.url_decode(F.col("r")[0]).alias("test_id"), F.coalesce(F.get("r", F.lit(1)), F.lit("")).alias("text")))


def export_report(report: DataFrame, path: str, fmt: str = "json") -> str:
    """IO10: write a (small) report frame as JSON; other formats are an error."""
    if fmt != "json":
        raise ValueError(f"Unsupported format: {fmt}")
    report.write.mode("overwrite").json(path)
    return path


def snapshot(df: DataFrame, base_path: str, now: _dt.datetime | None = None) -> str:
    """IO11: copy of the run table under a timestamped name (never overwrites)."""
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{base_path.rstrip('/')}_backup_{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path

