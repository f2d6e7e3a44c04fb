"""Exact linear-interpolation quantiles, distributed.

Spark's exact ``percentile`` merges a value->count map of the whole group in
one task, which does not hold for continuous metrics at scale.  Here a first
pass builds a mergeable rank sketch (KLL, a few KB) per group and column,
salted by task so that no reducer merges all of them.  The sketch brackets
every wanted rank between two values that lie a percent or two of the rows
apart.  A second pass counts exactly how many rows fall into each cell between
neighbouring bracket edges, and tells the values apart only inside the
brackets; both are combined map-side, so what is shuffled follows the number of
groups and the width of the brackets, not the rows.  Brackets that hold more
than ``OPEN_ROWS`` rows are sketched again from within before they are opened,
which makes them some fifty times smaller each time.

The result is exact, the same as numpy ``percentile`` / DuckDB
``quantile_cont``: a rank that a sketch's bracket misses (its bound holds with
high probability only) is found by sorting the values into stored ranges.

``approx=True`` switches to ``percentile_approx`` (a bounded sketch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.operators.ordering import RANGE, join_keys, range_totals, ranged, stored

#: Size parameter of a sketch; its rank error stays under ERROR of the rows (twice the usual bound).
SKETCH, ERROR = 1000, 0.006
#: Ranks that a sketch is asked for when a bracket is narrowed.
GRID = 64
#: Rows of a bracket whose values are told apart.
OPEN_ROWS = 200_000
#: Sketches of a group are merged in so many parts first.
SALTS = 64


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric ``columns`` into (by..., column, value DOUBLE)."""
    by = list(by)
    sel = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return sel.unpivot(by, list(columns), "column", "value")


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), approx: bool = False) -> dict:
    """Fitted constants {(group..., column, p): value}; bounded by groups x columns x probs."""
    if not columns:
        return {}
    lv = long_values(df, columns, by)
    return long_quantiles(lv, [*by, "column"], "value", probs, approx)


def long_quantiles(lv: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], approx: bool = False) -> dict:
    """Quantiles of ``value`` per ``keys`` group of a long table: {(keys..., p): v}.

    The groups come to the driver: for groups that are columns, or otherwise
    few.  For any number of groups use :func:`quantile_rows`.
    """
    keys, probs = list(keys), sorted({float(p) for p in probs})
    if approx:
        rows = quantile_rows(lv, keys, value, probs, approx).collect()
    else:
        lv = _values(lv, keys, value)
        rows = _by_sketch(lv, keys, probs).collect()
        if any(r["_missed"] for r in rows):
            rows = _by_ranges(lv.groupBy(*keys, "value").agg(F.count("*").alias("cnt")), keys, probs).collect()
    return {(*[r[k] for k in keys], r["p"]): r["value"] for r in rows}


def _values(lv: DataFrame, keys: list, value: str) -> DataFrame:
    return (lv.select(*keys, F.col(value).cast("double").alias("value"))
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def quantile_rows(lv: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], approx: bool = False) -> DataFrame:
    """Quantiles of ``value`` per ``keys`` group of a long table, as rows (keys..., p, value); groups without values have none."""
    keys, probs = list(keys), sorted({float(p) for p in probs})
    lv = _values(lv, keys, value)
    if approx:
        values = F.percentile_approx("value", probs, 10000)
        return lv.groupBy(*keys).agg(F.arrays_zip(F.array(*map(F.lit, probs)).alias("p"), values.alias("value")).alias("q")).select(
            *keys, F.inline("q"))
    out = stored(_by_sketch(lv, keys, probs), "quantiles")
    missed = out.where("_missed").select(*keys, "p")
    if not missed.head(1):
        return out.drop("_missed")
    rest = join_keys(lv, missed.select(*keys).distinct(), keys).groupBy(*keys, "value").agg(F.count("*").alias("cnt"))
    return out.where(~F.col("_missed")).drop("_missed").unionByName(join_keys(_by_ranges(rest, keys, probs), missed, [*keys, "p"]))


def _targets(probs: Sequence[float]):
    """The 0-based ranks below and above each probability's position among ``n`` rows, with the share of the upper one."""
    def one(p):
        at = F.lit(p) * (F.col("n") - 1)
        return F.struct(F.lit(p).alias("p"), F.floor(at).cast("long").alias("low"), F.ceil(at).cast("long").alias("high"),
                        (at - F.floor(at)).alias("share"))
    return F.array(*[one(p) for p in probs])


def _sketches(rows: DataFrame, keys: list, ranks: Sequence[float]) -> DataFrame:
    """Per group its number of rows ``n`` and the values ``q`` at ``ranks``; a part per task salt is merged first."""
    salted = rows.withColumn("_salt", F.spark_partition_id() % SALTS)
    parts = salted.groupBy(*keys, "_salt").agg(F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("s"))
    merged = parts.groupBy(*keys).agg(F.kll_merge_agg_double("s", F.lit(SKETCH)).alias("s"))
    return merged.select(*keys, F.kll_sketch_get_n_double("s").alias("n"),
                         F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(float(r)) for r in ranks])).alias("q"))


def _cell(edges: int):
    """Number of the cell between the sorted ``edges`` (at most so many): 2i lies below edge i, 2i + 1 is edge i itself."""
    v, out = F.col("value"), F.lit(0)
    for i in range(edges):
        edge = F.get("edges", F.lit(i))
        out += F.coalesce((edge < v).cast("int"), F.lit(0)) + F.coalesce((edge <= v).cast("int"), F.lit(0))
    return out


def _inside(spans: int):
    """Whether the value lies strictly within one of the ``spans`` (so many)."""
    v, out = F.col("value"), F.lit(False)
    for i in range(spans):
        span = F.get("spans", F.lit(i))
        out |= F.coalesce((span["low"] < v) & (v < span["high"]), F.lit(False))
    return out


def _brackets(fractions, n_ranks: int):
    """Positions in ``q`` of the ranks around each fraction, the sketch's error apart."""
    low = F.greatest(F.floor((fractions - ERROR) * n_ranks), F.lit(0)).cast("int")
    high = F.least(F.ceil((fractions + ERROR) * n_ranks), F.lit(n_ranks)).cast("int")
    return F.struct(F.element_at("q", low + 1).alias("low"), F.element_at("q", high + 1).alias("high"))


def _by_sketch(lv: DataFrame, keys: list, probs: list[float]) -> DataFrame:
    ranks = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-ERROR, ERROR)})
    place = {r: i + 1 for i, r in enumerate(ranks)}
    spans = F.array(*[F.struct(F.element_at("q", place[max(p - ERROR, 0.0)]).alias("low"),
                               F.element_at("q", place[min(p + ERROR, 1.0)]).alias("high")) for p in probs])
    state = _sketches(lv, keys, ranks).select(*keys, "n", spans.alias("spans"))
    state = stored(_with_edges(state.withColumn("edges", F.array().cast("array<double>"))), "quantile-brackets")
    edges = 2 * len(probs)
    widest = (state.agg(F.max("n")).first()[0] or 0) * 2 * ERROR
    while widest > OPEN_ROWS:
        state = stored(_narrowed(lv, state, keys, probs, edges), "quantile-brackets")
        edges += 2 * len(probs)
        widest = widest * 2 * (ERROR + 1 / GRID)
    rows = join_keys(lv, state.select(*keys, "spans", "edges"), keys)
    cells = rows.select(*keys, _cell(edges).alias("cell"), F.when(_inside(len(probs)), F.col("value")).alias("v"))
    return _picked(cells.groupBy(*keys, "cell", "v").agg(F.count("*").alias("cnt")), state, keys, probs)


def _with_edges(state: DataFrame) -> DataFrame:
    """The bracket ends as sorted edges; edges of earlier rounds stay."""
    ends = F.flatten(F.transform("spans", lambda s: F.array(s["low"], s["high"])))
    return state.withColumn("edges", F.array_sort(F.array_distinct(F.concat("edges", ends))))


def _narrowed(lv: DataFrame, state: DataFrame, keys: list, probs: list[float], edges: int) -> DataFrame:
    """Brackets inside the cells that hold the wanted ranks, from sketches of those cells alone."""
    rows = join_keys(lv, state.select(*keys, "spans", "edges"), keys).withColumn("cell", _cell(edges))
    counts = rows.groupBy(*keys, "cell").agg(F.count("*").alias("cnt"))
    grid = [i / GRID for i in range(GRID + 1)]
    sketched = _sketches(rows.where(_inside(len(probs))), [*keys, "cell"], grid).withColumnRenamed("n", "_n")
    upto = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = join_keys(counts, sketched, [*keys, "cell"], "left").withColumn("cum", F.sum("cnt").over(upto))  # a row per edge and gap
    wanted = state.select(*keys, F.explode(_targets(probs)).alias("t")).select(*keys, "t.p", "t.low")
    first = F.col("cum") - F.col("cnt")
    held = join_keys(wanted, cells, keys).where((first <= F.col("low")) & (F.col("low") < F.col("cum")))
    edge = F.struct(*[F.element_at("edges", F.floor(F.col("cell") / 2).cast("int") + 1).alias(e) for e in ("low", "high")])
    open_ = F.when(F.col("q").isNotNull(), _brackets((F.col("low") - first) / F.col("cnt"), GRID))
    found = join_keys(held, state.select(*keys, "edges"), keys).select(
        *keys, F.when(F.col("cell") % 2 == 1, edge).otherwise(open_).alias("s")).where("s is not null")
    new = found.groupBy(*keys).agg(F.collect_list("s").alias("spans"))                      # one per probability
    return _with_edges(join_keys(state.select(*keys, "n", "edges"), new, keys))


def _picked(counted: DataFrame, state: DataFrame, keys: list, probs: list[float]) -> DataFrame:
    """The values at the wanted ranks, interpolated; ``_missed`` where a rank lies outside every opened bracket."""
    upto = Window.partitionBy(*keys).orderBy("cell", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = counted.withColumn("cum", F.sum("cnt").over(upto))            # per group its edges, gaps, and values of open brackets
    both = join_keys(ordered, state, keys).withColumn("v", F.when(
        F.col("cell") % 2 == 1, F.get("edges", F.floor(F.col("cell") / 2).cast("int"))).otherwise(F.col("v")))
    first = F.col("cum") - F.col("cnt")

    def at(rank):
        return F.min(F.when((first <= F.col(f"t.{rank}")) & (F.col(f"t.{rank}") < F.col("cum")), F.col("v")))
    ends = (both.select(*keys, "cnt", "cum", "v", F.explode(_targets(probs)).alias("t")).groupBy(*keys, "t.p", "t.share")
            .agg(at("low").alias("a"), at("high").alias("b")))
    return ends.select(*keys, "p", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"),
                       (F.col("a").isNull() | F.col("b").isNull()).alias("_missed"))


def _by_ranges(counted: DataFrame, keys: list, probs: Sequence[float], num_ranges: int | None = None) -> DataFrame:
    """The same from distinct values dealt into stored ranges; only the ranges that hold a wanted rank are ranked."""
    rows = ranged(counted, ["value"], keys, num_ranges)
    first, last = F.col("_before"), F.col("_before") + F.col("_cnt") - 1
    totals = range_totals(rows, keys)
    wanted = totals.select(*keys, "n").distinct().select(*keys, F.explode(_targets(probs)).alias("t")).select(*keys, "t.*")

    def within(a, b, rank):
        return (a <= F.col(rank)) & (F.col(rank) <= b)
    near = F.exists(_targets(probs), lambda t: ((first <= t["low"]) & (t["low"] <= last)) | ((first <= t["high"]) & (t["high"] <= last)))
    inside = Window.partitionBy(RANGE, *keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (join_keys(rows, totals.where(near).drop("n"), [RANGE, *keys])
              .withColumn("cum", F.sum("cnt").over(inside) + F.col("_before")).select(*keys, "value", "cnt", "cum"))
    low, high = F.col("cum") - F.col("cnt"), F.col("cum") - 1
    hits = join_keys(wanted, ranked, keys).where(within(low, high, "low") | within(low, high, "high"))
    ends = hits.groupBy(*keys, "p", "share").agg(F.min(F.when(within(low, high, "low"), F.col("value"))).alias("a"),
                                                 F.min(F.when(within(low, high, "high"), F.col("value"))).alias("b"))
    return ends.select(*keys, "p", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Quantiles of each column as rows (by..., column, p, value), for any number of groups."""
    return quantile_rows(long_values(df, columns, by), [*by, "column"], "value", probs, approx)


def quantile_row(df: DataFrame, column: str, probs: Sequence[float], approx: bool = False) -> dict:
    """Fitted constants: {p: value} for one column."""
    tab = quantile_table(df, [column], probs, approx=approx)
    return {float(p): tab.get((column, float(p))) for p in probs}
