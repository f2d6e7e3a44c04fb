"""Operator 7: n-gram Jaccard join by a size-aware heavy-light scheme.

Documents are sets of distinct 5-word shingles; two link when the Jaccard
similarity of their sets is at least 0.75.  Identical sets form one class and
take part once.  The elements of a set are ordered with the shingles that very
many documents share last, then by hash.  A pair that links shares

* light (small) sets: a 2-subset among the first ``n - need + 2`` elements, so
  all 2-subsets of that prefix are enumerated as keys;
* heavy (large) sets: one of the first ``n - need + 1`` elements, whose
  inverted lists are scanned,

with ``need = ceil(0.75 n)``, the least overlap with any partner.  The boundary
between light and heavy is the size at which the enumeration costs more rows
than the scans.  Sets up to 4/3 of the boundary emit both kinds of key, so
pairs across it meet.

Members of a key's list are not paired with each other at once.  First each
member is compared with the list's hub, the set that has the key earliest in
its order (the one with the fewest elements of its own), if the two share a
fair part of their keys; the links found merge most lists into components.
Then the pairs of a list that lie in different components are taken, by the
prefix filter for their own two sizes: with an overlap of at least t, the first
``n - t + l`` elements of either set have l of them in common, so a key counts
for a pair only at such places, and l keys are asked for.  What is left is
compared.  Comparisons use the full sets, so components are exact and no link
between different components is lost.

Nulls and empty texts have no shingles and link with nothing; documents with
fewer than five words have one shingle, of all their words; rows that repeat a
doc_id count as documents with that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadlens.llm import texts as T
from loadlens.llm.graph import components
from loadlens.llm.tables import store

WORDS = 5
#: Similarity as a fraction of whole numbers: 100 * common >= 75 * union.
SHARE = (75, 100)
#: So many shingles, those most often repeated within slices, are ordered last (8 MB; the order changes cost, not results).
FREQUENT = 1_000_000
#: Shared keys that a pair of scanned sets needs in its own prefixes, where these are long enough.
KEYS = 2
#: Rows that a scanned inverted list costs for each row that it is emitted with (cost of the boundary).
SCAN_COST = 5.0
#: Share of the smaller set's size that a member has to share in keys with the hub to be compared first.
FAIR = 0.05
#: Bits of the filter that picks wanted documents before their sets are built (2 MB, whatever the number of documents).
FILTER_BITS = 1 << 24
#: Bytes of a shingle hash that the compared sets keep (48 bits).
KEPT = 6
_U = np.uint64


def _need(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of size ``n`` with any linked partner."""
    return -(-n * SHARE[0] // SHARE[1])


def _sets(batch_table) -> list[np.ndarray]:
    return T.shingle_sets(*T.utf8(batch_table["text"]), WORDS)


def _set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set from all its elements."""
    one = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], _U)
    two = np.array([np.add.reduce(T.mix(s + _U(7))) if len(s) else 0 for s in sets], _U)
    return T.mix(one + _U(1)).view(np.int64), T.mix(two + _U(2)).view(np.int64)


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document its set's size and name; and the shingles repeated within a slice, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(batches, limit=4 << 20):
            sets = _sets(t)
            sid, sid2 = _set_ids(sets)
            n = t.num_rows
            _, first = np.unique(sid, return_index=True)       # copies in a slice count once
            shingle, count = np.unique(np.concatenate([sets[i] for i in first]), return_counts=True)
            hot = count >= 2
            k = int(hot.sum())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([t["doc_id"].combine_chunks().cast(pa.int64()), pa.nulls(k, pa.int64())]),
                pa.array(np.concatenate([[len(s) for s in sets], count[hot]]).astype(np.int64)),
                pa.array(np.concatenate([sid, shingle[hot].view(np.int64)])),
                pa.array(np.concatenate([sid2, np.zeros(k, np.int64)])),
                pa.array([True] * n + [False] * k),
            ], names=["doc_id", "n", "sid", "sid2", "is_doc"])

    both = store(docs.select(F.col("doc_id").cast("long"), "text")
                 .mapInArrow(run, "doc_id long, n long, sid long, sid2 long, is_doc boolean"), "shingle-sets")
    return (both.where("is_doc").drop("is_doc"),
            both.where("not is_doc").groupBy(F.col("sid").alias("shingle")).agg(F.sum("n").alias("n")))


def frequent(counts: DataFrame) -> np.ndarray:
    """The ``FREQUENT`` shingles with the greatest counts."""
    rows = counts.where("n > 2").orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toArrow()
    return np.sort(rows["shingle"].to_numpy().view(_U))


def boundary(sizes: DataFrame) -> int:
    """Largest set size that is cheaper to enumerate in 2-subsets than to scan, from the sizes of all sets."""
    counts = {r.n: r.c for r in sizes.where("n between 1 and 200").groupBy("n").agg(F.count("*").alias("c")).collect()}
    best, at, total = 0.0, 0, 0.0
    for n in range(1, 201):
        p = n - int(_need(np.int64(n))) + 2
        total += counts.get(n, 0) * (p * (p - 1) / 2 - (p - 1) * SCAN_COST)
        if total < best:
            best, at = total, n
    return at


def keys(docs: DataFrame, hot: np.ndarray, light: int) -> DataFrame:
    """``(key, sid, shape)``: the 2-subsets of light sets and the prefix elements of heavy ones.

    ``shape`` packs the set's size, the element's place in its order, and
    whether it is an element to scan.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for t in T.slices(batches):
            sets = _sets(t)
            sid, _ = _set_ids(sets)
            _, first = np.unique(sid, return_index=True)
            out_key, out_sid, out_shape = [], [], []
            for i in first.tolist():
                s = sets[i]
                n = len(s)
                if not n:
                    continue
                need = int(_need(np.int64(n)))
                if len(late):
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    last = late[at] == s
                    s = np.concatenate([s[~last], s[last]]) if last.any() else s
                made = []
                if n > light:
                    made.append(s[:n - need + 1])
                if n <= light * SHARE[1] // SHARE[0] + 1:
                    p = s[:n - need + 2]
                    if len(p) < 2:                              # a single shingle is its own key
                        made.append(T.mix(p + _U(3)))
                    else:
                        x, y = np.triu_indices(len(p), 1)
                        low, high = np.minimum(p[x], p[y]), np.maximum(p[x], p[y])
                        made.append(T.mix(T.mix(low + _U(5)) ^ high))
                scan = len(made[0]) if n > light else 0
                made = np.concatenate(made)
                at = np.arange(len(made))
                out_shape.append((n << 32) + np.where(at < scan, 2 * at + 1, 0))
                out_key.append(made)
                out_sid.append(np.full(len(made), sid[i]))
            if out_key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_key).view(np.int64)),
                                                  pa.array(np.concatenate(out_sid)), pa.array(np.concatenate(out_shape))],
                                                 names=["key", "sid", "shape"])

    return docs.select("text").mapInArrow(run, "key long, sid long, shape long")


def _compatible(a: str = "na", b: str = "nb"):
    """Sizes that allow the similarity at all."""
    return (F.least(a, b) * SHARE[1]) >= (F.greatest(a, b) * SHARE[0])


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that link, checked on the full sets."""
    first, second = SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            va, vb = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
            ok = []
            for x, y in zip(va, vb):
                x, y = _unpack(x), _unpack(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(second * common >= first * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("sid").alias("a"), F.col("v").alias("va"))
    right = sets.select(F.col("sid").alias("b"), F.col("v").alias("vb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _pack(s: np.ndarray) -> bytes:
    return s.view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    wide = np.zeros((len(b) // KEPT, 8), np.uint8)
    wide[:, :KEPT] = np.frombuffer(b, np.uint8).reshape(-1, KEPT)
    return wide.view(_U).ravel()


def _wanted_sets(docs: DataFrame, classes: DataFrame, sids: DataFrame, name: str) -> DataFrame:
    """``(sid, v)``: the packed sets of the wanted sids, each from one document.

    A filter of fixed size picks the documents to read sets from, so texts
    aren't shuffled; those it picks in vain are joined out.
    """
    wanted = store(sids.distinct().join(classes, "sid").select("sid", "doc_id"), name + "-ids")
    bit = F.xxhash64("doc_id").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).collect())   # at most FILTER_BITS / 32 rows
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words:
        table[r.word] = r.bits
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            yield batch.filter(pa.array((shared.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(picked(batches)):
            sets = _sets(t)
            sid, _ = _set_ids(sets)
            yield pa.RecordBatch.from_arrays([pa.array(sid), pa.array([_pack(s) for s in sets], pa.binary())], names=["sid", "v"])

    found = docs.where("doc_id is not null").select("text", F.col("doc_id").cast("long")).select("text", bit.alias("bit")).mapInArrow(run, "sid long, v binary")
    return store(found.join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid"]), name)


def set_components(docs: DataFrame, described: DataFrame, counts: DataFrame) -> DataFrame:
    """``(sid, component)`` for every set that links with another; the component is the least sid in it."""
    classes = store(described.where("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("doc_id")), "classes")
    light = boundary(classes)
    by_key = Window.partitionBy("key")
    n = F.shiftright("shape", 32)
    place = F.shiftright(F.col("shape").bitwiseAND(F.lit((1 << 32) - 1)), 1)
    scan = F.col("shape").bitwiseAND(F.lit(1)) == 1
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one shuffle serves the grouping of copies and the lists
    lists = keys(docs, frequent(counts), light).repartition(parts, "key").groupBy("key", "sid").agg(F.first("shape").alias("shape"))
    lists = store(lists.withColumn("low", F.min("sid").over(by_key)).withColumn("high", F.max("sid").over(by_key))
                  .withColumn("hub", F.min(F.struct(place.alias("place"), "sid", n.alias("n"))).over(by_key)).where("low < high")
                  .select("key", "sid", n.alias("n"), place.alias("place"), scan.alias("scan"), F.col("hub.sid").alias("hub"), F.col("hub.n").alias("nh")), "lists")

    # every member with the hubs of its lists
    star = (lists.where(F.col("sid") != F.col("hub")).where(_compatible("n", "nh"))
            .groupBy(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b"))
            .agg(F.count("*").alias("c"), F.min(F.least("n", "nh")).alias("n")).where(F.col("c") >= F.col("n") * FAIR))
    star = store(star, "hub-pairs")
    sets = _wanted_sets(docs, classes, star.select(F.explode(F.array("a", "b")).alias("sid")), "sets-1")
    merged = store(components(_common(star, sets)), "components-1")

    # pairs of a list that are still apart
    tagged = store(lists.join(merged.withColumnRenamed("id", "sid"), "sid", "left")
                   .withColumn("component", F.coalesce("component", "sid")), "tagged")
    several = tagged.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    apart = store(tagged.join(several.select("key"), "key", "left_semi"), "apart")
    left = apart.select("key", F.col("sid").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"), "scan")
    right = apart.select("key", F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    t = F.ceil((F.col("na") + F.col("nb")) * SHARE[0] / sum(SHARE))     # least overlap of a linked pair of these sizes
    need = F.greatest(*[F.ceil(F.col(x) * SHARE[0] / SHARE[1]) for x in ("na", "nb")])
    asked = 1 + F.least(F.lit(KEYS - 1), t - need)                      # prefixes reach n - need, so l is at most t - need + 1
    here = F.when(F.col("scan"), (F.least("na", "nb") > light) & (F.col("pa") < F.col("na") - t + asked)
                  & (F.col("pb") < F.col("nb") - t + asked)).otherwise(F.least("na", "nb") <= light)
    rest = (left.join(right, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _compatible() & here)
            .groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count("*").alias("c"))
            .where((F.least("na", "nb") <= light) | (F.col("c") >= asked)))
    rest = store(rest, "apart-pairs")
    sets = _wanted_sets(docs, classes, rest.select(F.explode(F.array("a", "b")).alias("sid")), "sets-2")
    late = store(_common(rest, sets), "links-2")
    every = late.union(merged.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return components(every).withColumnRenamed("id", "sid")


def shingle_join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    described, counts = describe(docs)
    linked = store(set_components(docs, described, counts), "set-components")
    named = described.join(linked, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = store(named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return (store(named, "named").join(least, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but the one with the least id of each component."""
    joined = shingle_join(docs)
    gone = joined.where("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
