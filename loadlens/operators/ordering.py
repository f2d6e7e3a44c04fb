"""Order-dependent operators without a one-partition window.

A window with ``partitionBy(group).orderBy(x)`` puts a whole group in one
task; with a group holding a third of all rows that task never finishes.
Here the rows are dealt into sorted ranges instead:

1. Spark's range partitioner splits the rows on ``(group, order)`` into a
   number of ranges that follows the counted rows; the rows are written once
   to the shared folder with the number of their range, so that a lost
   executor can't move a row to another range;
2. a window per ``(range, group)`` gives the position inside the range;
3. one row per range and group holds its totals; the totals of the earlier
   ranges of the group (a window over those few rows) are joined back.

Nothing is collected, and neither the number of ranges nor of groups is
limited.  Null groups and null order keys are ordinary values (nulls first).

Public helpers: :func:`ranged`, :func:`running`, :func:`row_index`,
:func:`value_ranks`, :func:`average_rank_pct`, :func:`join_keys`.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.session import scratch_path

_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_COMBINE = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "min": F.least, "max": F.greatest}

# Rows of one range; the number of ranges follows the rows counted.
ROWS_PER_RANGE = 500_000
RANGE = "_range"
# Rows of one file of a table that a model is fitted on, and so of one task of the fit.
ROWS_PER_FILE = 250_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_rows(df: DataFrame, name: str = "fit-rows") -> DataFrame:
    """``df`` stored for the passes of a model's fit, in files of at most ``ROWS_PER_FILE`` rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def task_per_file(spark: SparkSession):
    """Scans that run inside read each file in a task of its own.

    A model's fit caches its rows as objects and a task reads a whole cached
    partition in every pass, so its rows have to be bounded, not its bytes on disk.
    """
    cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, spark.conf.get(most))
    try:
        yield
    finally:
        spark.conf.set(cost, before)


def ranged(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), num_ranges: int | None = None) -> DataFrame:
    """The stored rows with the number of their range of ``(by, order)`` in ``_range``.

    Rows that tie on the whole order are told apart by an arbitrary number, so
    that even they are spread over several ranges.
    """
    n = num_ranges or max(df.sparkSession.sparkContext.defaultParallelism, df.count() // ROWS_PER_RANGE + 1)
    split = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *by, *order, "_tie")
    return stored(split.drop("_tie").withColumn(RANGE, F.spark_partition_id()), "ranges")


def _earlier(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              extra=None) -> DataFrame:
    """Null-safe equi-join on ``keys`` keeping one copy of the keys.

    Right-side keys are renamed first so joining two frames derived from the
    same source is never ambiguous.  ``extra(right_renamed)`` may add a
    non-equi condition (written against the renamed right frame).
    """
    keys = list(keys)
    r = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for c in keys:
        e = left[c].eqNullSafe(r[f"_rk_{c}"])
        cond = e if cond is None else cond & e
    if extra is not None:
        e = extra(r)
        cond = e if cond is None else cond & e
    if cond is None:
        cond = F.lit(True)
    return left.join(r, cond, how).drop(*[f"_rk_{c}" for c in keys])


def running(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
            aggs: dict[str, tuple[str, str]] | None = None,
            num_ranges: int | None = None) -> DataFrame:
    """Running aggregates inside each ``by`` group in ``order`` order.

    ``aggs`` maps an output name to ``(fn, column)`` with fn in
    sum/min/max/count.  Ties in ``order`` are broken arbitrarily, so pass a
    unique order for a deterministic result.
    """
    aggs, by = aggs or {}, list(by)
    rows = ranged(df, order, by, num_ranges)
    source = {name: F.lit(1) if fn == "count" else F.col(c) for name, (fn, c) in aggs.items()}
    totals = rows.groupBy(RANGE, *by).agg(*[_AGG[fn](source[name]).alias(f"_t_{name}") for name, (fn, _) in aggs.items()])
    before = totals.select(RANGE, *by, *[_AGG["sum" if fn == "count" else fn](f"_t_{name}").over(_earlier(by)).alias(f"_b_{name}")
                                         for name, (fn, _) in aggs.items()])
    inside = Window.partitionBy(RANGE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({f"_in_{name}": _AGG[fn](source[name]).over(inside) for name, (fn, _) in aggs.items()})
    out = join_keys(out, before, [RANGE, *by], "left")
    for name, (fn, _) in aggs.items():
        here, prior = F.col(f"_in_{name}"), F.col(f"_b_{name}")
        out = out.withColumn(name, F.coalesce(_COMBINE[fn](prior, here), here, prior))
    return out.drop(RANGE, *[p + name for name in aggs for p in ("_in_", "_b_")])


def row_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
              name: str = "row_idx", num_ranges: int | None = None) -> DataFrame:
    """0-based position of each row inside its group in ``order`` order."""
    return (running(df, order, by, {name: ("count", "")}, num_ranges)
            .withColumn(name, (F.col(name) - 1).cast("long")))


def keys_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int], num_ranges: int | None = None) -> dict[int, tuple]:
    """The order keys at the given 0-based positions of ``df`` in ``order`` order (few positions; nulls first).

    Only the order columns are dealt into sorted ranges; the ranges' counts
    tell which of them hold a wanted position, and only those are numbered.
    """
    order = list(order)
    rows = ranged(df.select(*order), order, (), num_ranges)
    counts = rows.groupBy(RANGE).agg(F.count("*").alias("_cnt"))
    first = F.coalesce(F.sum("_cnt").over(_earlier([])), F.lit(0)).cast("long")     # a row per range
    wanted = F.array(*[F.lit(int(r)) for r in ranks]) if ranks else F.array().cast("array<long>")
    held = counts.withColumn("_first", first).withColumn("_at", F.filter(
        wanted, lambda r: (F.col("_first") <= r) & (r < F.col("_first") + F.col("_cnt")))).where(F.size("_at") > 0)
    numbered = join_keys(rows, held, [RANGE]).withColumn(
        "_pos", F.col("_first") + F.row_number().over(Window.partitionBy(RANGE).orderBy(*order)) - 1)
    return {r["_pos"]: tuple(r[c] for c in order) for r in numbered.where(F.array_contains("_at", F.col("_pos"))).collect()}


def before(order: Sequence[str], key: tuple | None):
    """Whether a row comes before ``key`` in ``order`` order (nulls first); every row does if ``key`` is None."""
    if key is None:
        return F.lit(True)
    out = F.lit(False)
    for c, v in reversed(list(zip(order, key))):
        less = F.lit(False) if v is None else F.col(c).isNull() | (F.col(c) < F.lit(v))
        out = F.coalesce(less, F.lit(False)) | (F.col(c).eqNullSafe(F.lit(v)) & out)
    return out


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (),
                num_ranges: int | None = None) -> DataFrame:
    """Distinct non-null values with their row count and cumulative count.

    Output: by..., ``value``, ``cnt``, ``cum`` (rows with value <= this one),
    ``n`` (non-null rows of the group).  Values are counted before the sort
    (map-side combine), so a hot value is a single row.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("cnt"))
    rows = ranged(counted, [value], by, num_ranges)
    inside = Window.partitionBy(RANGE, *by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = join_keys(rows.withColumn("cum", F.sum("cnt").over(inside)), range_totals(rows, by), [RANGE, *by])
    return out.withColumn("cum", F.col("cum") + F.col("_before")).drop(RANGE, "_before", "_cnt")


def range_totals(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per range and group of counted values: its count, the count before it, and the group's count ``n``."""
    by = list(by)
    totals = rows.groupBy(RANGE, *by).agg(F.sum("cnt").alias("_cnt"))
    return totals.select(RANGE, *by, "_cnt", F.coalesce(F.sum("_cnt").over(_earlier(by)), F.lit(0)).alias("_before"),
                         F.sum("_cnt").over(Window.partitionBy(*by)).cast("long").alias("n"))


def average_rank_pct(df: DataFrame, value: str, out: str, by: Sequence[str] = (),
                     num_ranges: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)``: average rank of ties / non-null count.

    NULL values get NULL.  The per-value table is joined back on the value;
    Spark picks the join by its size, and AQE splits a hot value.
    """
    by = list(by)
    vr = value_ranks(df, value, by, num_ranges)
    vr = vr.select(*by, F.col(value).alias("_v"),
                   ((F.col("cum") - F.col("cnt") + (F.col("cnt") + 1) / 2.0)
                    / F.col("n")).alias(out))
    return join_keys(df, stored(vr, "ranks"), by, "left", extra=lambda r: F.col(value) == r["_v"]).drop("_v")
