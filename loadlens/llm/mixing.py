"""Operator 9: mixing sources to target weights by Pfair scheduling (DataFrame functions only).

The rows of a source are put in a hashed order and cut into blocks.  A source's
target at a slot follows from its unrounded weight over the whole mix; when a
source is used up the others go on in their ratio, so no row is dropped or
repeated.  The mix is cut into slices of about ``cycle`` slots and wherever
sources with two blocks of a slice are used up.  At the end of every slice each source has had its target
rounded down or up, the largest remainders up, and what is rounded is carried
over, so the mix doesn't drift from the weights however long it is.  In a slice
of Q slots a source with m of them has weight m / Q; its k-th block is released
at floor(k Q / m) and due at ceil((k + 1) Q / m), and of the released blocks the
one that is due first gets the next slot.  All deadlines are met, so a source
is within a block of its target at the ends of slices, within two blocks in
a slice, and within two and a half where smaller sources are used up in it.

The driver walks the slices once with one number per source; the slots of the
slices are planned in parallel, a row for each block.

A null source is a source of its own.  Rows that repeat a doc_id keep a place
each.  Where weights are given, a source without a positive one gets a single
block beside each ``cycle`` of the others.  No rows give an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadlens.llm.tables import store

#: Rows per block, and about how many blocks a slice of the plan has.
BLOCK, CYCLE = 8, 200
#: Columns that the mix adds; a document's columns of these names are replaced.
RESULT = ("mix_block", "mix_slot", "mix_place")
#: Rows for a bucket of the hashed order.
BUCKET_ROWS = 1000
#: Slices planned by a task.
SLICES = 8


def _quotas(sizes: DataFrame, weights: Mapping[str, float] | None, cycle: int) -> DataFrame:
    """Blocks of each source in a cycle: ``share`` as the weights have it, and ``quota``, the whole blocks next to it.

    Without given weights the target is the square root of the source's size.
    """
    if weights:
        pairs = F.create_map(*[F.lit(x) for p in weights.items() for x in (p[0], float(p[1]))])
        w = F.greatest(F.coalesce(F.when(F.col("s").isNotNull(), F.element_at(pairs, F.coalesce("s", F.lit("")))), F.lit(0.0)), F.lit(0.0))
    else:
        w = F.sqrt(F.col("blocks").cast("double"))
    sizes = sizes.withColumn("w", w)
    total = sizes.agg(F.sum("w")).first()[0] or 1.0
    return (sizes.withColumn("share", F.when(F.col("w") > 0, F.col("w") / total * cycle).otherwise(F.lit(1.0)))
            .withColumn("quota", F.greatest(F.lit(1), F.round("share")).cast("long")).drop("w"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their place within the source, and the rows of each source.

    A source is numbered in buckets of the hashed order, so that one with a
    third of all rows is spread over many tasks.
    """
    buckets = max(1, docs.count() // BUCKET_ROWS)
    keyed = docs.withColumn("mix_hash", F.xxhash64(F.lit(9), "doc_id")).withColumn(
        "mix_bucket", F.pmod(F.shiftrightunsigned("mix_hash", 20), F.lit(buckets)))
    counts = store(keyed.groupBy(F.col("source").alias("s"), F.col("mix_bucket").alias("b")).agg(F.count("*").alias("n")), "mix-counts")
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = store(counts.select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "mix-starts")
    inner = Window.partitionBy("source", "mix_bucket").orderBy("mix_hash", "doc_id")
    placed = (keyed.withColumn("mix_row", F.row_number().over(inner) - 1)
              .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("mix_bucket") == F.col("b")))
              .withColumn("mix_row", F.col("mix_row") + F.col("start"))
              .drop("s", "b", "start", "mix_hash", "mix_bucket"))
    return placed, counts.groupBy("s").agg(F.sum("n").alias("rows"))


def _first_due() -> Column:
    """The order of a plan's slots: indexes into ``who``, each the released block that is due first."""
    def step(state, t):
        due = F.transform("who", lambda x, i: F.when(
            (state["done"][i] < x["m"]) & (F.floor(state["done"][i] * F.col("slots") / x["m"]) < t),
            F.struct(F.ceil((state["done"][i] + 1) * F.col("slots") / x["m"]).alias("due"), i.alias("i"))))
        pick = F.array_min(due)["i"]
        return F.struct(
            F.transform(state["done"], lambda n, j: n + F.when(j == pick, F.lit(1)).otherwise(F.lit(0)).cast("long")).alias("done"),
            F.concat(state["order"], F.array(pick)).alias("order"))

    start = F.struct(F.transform("who", lambda x: F.lit(0).cast("long")).alias("done"),
                     F.expr("cast(array() as array<int>)").alias("order"))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), "slots"), start, step, lambda state: state["order"])


def _slices(blocks: np.ndarray, quota: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slots at which the slices begin and end, and the blocks that each source has had by then."""
    end = blocks / quota                                         # in cycles, if no source were ever used up
    order = np.argsort(end, kind="stable")
    x = np.append(0.0, end[order])
    rest = np.append(np.cumsum(quota[order][::-1])[::-1], 0.0)    # of the sources that each end leaves, itself among them
    t = np.append(0, np.cumsum(blocks[order])) + x * rest        # slots passed when each source is used up
    t = np.maximum.accumulate(np.minimum(t, blocks.sum()))
    total, step = int(blocks.sum()), max(1, round(float(quota.sum())))
    cuts, ended = [], 0.0
    for slot, q, live in zip(t[1:].tolist(), quota[order].tolist(), rest.tolist()):
        ended += q / live * step                                 # blocks a slice would have had of the sources used up
        if ended >= 2:
            cuts.append(round(slot))
            ended = 0.0
    at = np.unique(np.concatenate([np.arange(0, total, step), np.array(cuts, np.int64), [total]]))
    had = [np.zeros(len(blocks), np.int64)]
    for slot in at[1:].tolist():
        target = np.minimum(blocks, quota * np.interp(slot, t, x))
        if slot == total:
            target = blocks.astype(float)
        now = np.maximum(np.floor(target + 1e-9).astype(np.int64), had[-1])
        more = slot - int(now.sum())
        if more > 0:
            left = np.where(now < blocks, target - now, -np.inf)
            now[np.argsort(-left, kind="stable")[:more]] += 1
        had.append(now)
    return at, had


def plans(sources: DataFrame) -> DataFrame:
    """``(s, first, k, at, slot0, slots, block)``: in slice ``first`` the k-th block of a source has slot ``at`` of it.

    ``sources`` holds s, blocks and quota, which needn't be whole; slot0 is the slot at which the slice begins and
    ``block`` the block's number within its source.
    """
    spark = sources.sparkSession
    schema = "first long, slot0 long, slots long, i long, m long, had long"
    every = sources.select("s", F.col("blocks").cast("long"), F.col("quota").cast("double")).orderBy(F.xxhash64(F.lit(1), "s"), "s").collect()
    parts = [np.zeros((6, 0), np.int64)]
    if every:
        _, had = _slices(np.array([r.blocks for r in every], np.int64), np.array([r.quota for r in every]))
        for j, (a, b) in enumerate(zip(had, had[1:])):
            i = np.flatnonzero(b > a)
            if len(i):
                parts.append(np.stack([np.full(len(i), v) for v in (j, a.sum(), (b - a).sum())] + [i, (b - a)[i], a[i]]))
    table = pa.table(list(np.concatenate(parts, axis=1)), names=["first", "slot0", "slots", "i", "m", "had"])
    names = spark.createDataFrame([(i, r.s) for i, r in enumerate(every)], f"i long, s {sources.schema['s'].dataType.simpleString()}")
    # a given number of partitions, as slices are few bytes but long work
    per = (spark.createDataFrame(table, schema).join(F.broadcast(names), "i").repartition(len(parts) // SLICES + 1, "first")
           .groupBy("first", "slot0", "slots").agg(F.array_sort(F.collect_list(F.struct("i", "m", "had", "s"))).alias("who")))
    slots = (per.withColumn("order", _first_due())
             .select("first", "slot0", "slots", "who", F.posexplode("order").alias("at", "j"))
             .select("first", "slot0", "slots", F.col("at").cast("long").alias("at"),
                     F.col("who")[F.col("j")]["s"].alias("s"), F.col("who")[F.col("j")]["had"].alias("had")))
    nth = Window.partitionBy("first", "s").orderBy("at")
    return (slots.withColumn("k", (F.row_number().over(nth) - 1).cast("long"))
            .withColumn("block", F.col("had") + F.col("k")).drop("had"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, cycle: int = CYCLE) -> DataFrame:
    """Every row of ``docs`` with ``mix_block`` (block within its source), ``mix_slot`` (the block's place in the
    mix) and ``mix_place`` (the row's place in the block); ordered by slot and place, the rows are the mix."""
    # the documents' own columns travel as one, so that none can clash with the names used here
    packed = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_document"))
    placed, sizes = _numbered(packed)
    sizes = sizes.withColumn("blocks", F.ceil(F.col("rows") / F.lit(block)).cast("long"))
    sources = store(_quotas(sizes, weights, cycle), "mix-sources")
    plan = store(plans(sources.select("s", "blocks", F.col("share").alias("quota")))
                 .select("s", "block", (F.col("slot0") + F.col("at")).alias("mix_slot")), "mix-plan")
    rows = (placed.withColumn("mix_block", F.floor(F.col("mix_row") / block).cast("long"))
            .withColumn("mix_place", (F.col("mix_row") % block).cast("int")))
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("mix_block") == F.col("block")))
            .select(*[F.col("mix_document")[c].alias(c) for c in docs.columns if c not in RESULT], *RESULT))
