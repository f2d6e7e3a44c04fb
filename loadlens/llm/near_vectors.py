"""Operator 4: embedding near-duplicates by int8 tile products with rigorous error bounds.

Unit vectors are quantised to int8 with one scale each, and the length of each
vector's quantisation error is kept.  For vectors x, y with errors e, f the
exact cosine lies within ``|e| (1 + |f|) + |f| (1 + |e|) + |e| |f|`` of the
scaled int8 product.  A tile is the product of two blocks; pairs surely above
or below the threshold are settled by the bound and only those in between are
computed again in double precision from the original components.

Equal vectors form one class, which takes part once.  A tile returns link
counts per vector and a spanning star per connected group, never all its
pairs, so a large group of copies costs no more rows than other vectors.

A null vector, one with null, NaN or infinite components, and one of length 0
link with nothing, and so do vectors of different dimension; so does a row
with a null vec_id (its component_id is null, kept is false).  Rows that share a vec_id count as one node of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.graph import components
from loadlens.llm.tables import store

THRESHOLD = 0.9
#: Vectors per block (one block of 64 dimensions takes 1.5 MB), and rows of a block multiplied at once.
BLOCK, STEP = 4096, 512
#: Covers the rounding of float32 scaling and of the double sums.
ROUNDING = 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, and length of the quantisation error of each unit vector."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * q) ** 2).sum(axis=1))
    return q, scale, error


def tile(x: np.ndarray, y: np.ndarray, qx, qy) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of the two blocks whose cosine is at least the threshold."""
    (a, sa, ea), (b, sb, eb) = qx, qy
    right, worst = np.ascontiguousarray(b.astype(np.float32).T), eb.max()
    found_i, found_j = [], []
    for at in range(0, len(a), STEP):
        part = slice(at, at + STEP)
        product = a[part].astype(np.float32) @ right            # exact: whole numbers below 2 ** 24
        product *= sb.astype(np.float32)
        e = ea[part]
        low = (THRESHOLD - e * (1 + worst) - worst * (1 + e) - e * worst - ROUNDING) / sa[part]
        i, j = np.nonzero(product >= low[:, None].astype(np.float32))
        if not len(i):
            continue
        value = product[i, j].astype(np.float64) * sa[part][i]
        bound = e[i] * (1 + eb[j]) + eb[j] * (1 + e[i]) + e[i] * eb[j] + ROUNDING
        ok = value - bound >= THRESHOLD
        open_ = np.flatnonzero(~ok & (value + bound >= THRESHOLD))
        for k in range(0, len(open_), 100_000):
            o = open_[k:k + 100_000]
            ok[o] = np.einsum("ij,ij->i", x[at + i[o]], y[j[o]]) >= THRESHOLD
        found_i.append(at + i[ok])
        found_j.append(j[ok])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(found_i) if found_i else empty), (np.concatenate(found_j) if found_j else empty)


def stars(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least node reachable from each of ``n`` nodes by the given links."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _usable(v: DataFrame) -> DataFrame:
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return v.withColumn("usable", F.coalesce(F.col("vec_id").isNotNull() & (F.size(x) > 0) & ~bad
                                             & F.exists(x, lambda e: e != 0), F.lit(False)))


def _blocks(classes: DataFrame) -> DataFrame:
    """One row per block of classes of a dimension: ids, copies and vectors packed; with the number of its dimension's blocks."""
    sizes = classes.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = classes.join(store(sizes, "vector-blocks"), "dim").withColumn("block", F.pmod(F.xxhash64(F.lit(4), "id"), F.col("blocks")).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        x = np.stack([np.asarray(v, np.float64) for v in t["embedding"].to_pylist()])
        ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
        return pa.table({"dim": t["dim"][:1], "blocks": t["blocks"][:1], "block": t["block"][:1],
                         "ids": pa.array([ids.tobytes()]), "copies": pa.array([copies.tobytes()]), "x": pa.array([x.tobytes()], pa.binary())})

    return dealt.groupBy("dim", "block").applyInArrow(pack, "dim int, blocks int, block int, ids binary, copies binary, x binary")


def _links(blocks: DataFrame) -> DataFrame:
    """``(id, n, low)``: partial link counts of a class, and the least class it is connected to in a tile."""
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (blocks.withColumn("other", partner)
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")))

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["block"])
        side = []
        for r in rows:
            ids = np.frombuffer(r["ids"], np.int64)
            x = unit(np.frombuffer(r["x"], np.float64).reshape(len(ids), -1))
            side.append((ids, np.frombuffer(r["copies"], np.int64), x, quantise(x)))
        (ids, copies, x, qx), (ids2, copies2, y, qy) = side[0], side[-1]
        i, j = tile(x, y, qx, qy)
        if len(side) == 1:
            apart = i != j
            i, j = i[apart], j[apart]
            n = np.bincount(i, copies[j], len(ids))
            label = stars(i, j, len(ids))
            every = ids
        else:
            n = np.concatenate([np.bincount(i, copies2[j], len(ids)), np.bincount(j, copies[i], len(ids2))])
            label = stars(i, len(ids) + j, len(ids) + len(ids2))
            every = np.concatenate([ids, ids2])
        some = np.flatnonzero(n > 0)
        return pa.table({"id": pa.array(every[some]), "n": pa.array(n[some].astype(np.int64)), "low": pa.array(every[label[some]])})

    return pairs.groupBy("dim", "p", "q").applyInArrow(run, "id long, n long, low long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = _usable(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")))
    v = v.withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(1), "embedding"))
    good = v.where("usable")
    classes = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"),
                                           F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    classes = store(classes, "vector-classes")
    links = store(_links(store(_blocks(classes), "vector-tiles")), "vector-links")
    count = links.groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    found = (classes.select("k1", "k2", "id", "copies").join(count, "id", "left").join(comp, "id", "left")
             .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    found = store(found, "vector-found")
    linked = good.select("vec_id", "k1", "k2").join(found, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = v.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
