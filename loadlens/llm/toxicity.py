"""Operator 8: toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained in numpy
from confirmed toxic texts and unlabelled texts with the non-negative
positive-unlabelled risk

    R(f) = pi * R_p^+(f) + max(0, R_u^-(f) - pi * R_p^-(f)),

where pi is the share of toxic rows among the labelled training rows.  The
training sample is bounded by documented parameters; every document is scored
in one pass over its whole text.

Nulls: a null or empty text has no features, so its score is the bias alone; a
null label, or a label of a missing document, is ignored; repeated label rows
of one document count as toxic if any is.  Without toxic training rows the
score is the prior (0 when there are no labels at all).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loadlens.llm import texts as T
from loadlens.llm.tables import crc_mod, store

#: Bits of a feature index; the weights are 2 ** BITS floats (1 MB).
BITS = 18
#: Word beginnings that count as features, in bytes; 0 is the whole word.
PIECES = (0, 4, 5, 6, 7)
#: Bound of the training sample (rows with the least hash of their id).
MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
_U = np.uint64


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Distinct feature indexes of each text: letters and digits of words, whole and cut short."""
    plain = np.where(_WORD[data], data, np.uint8(0x20))
    start, end, rows = T.words(plain, off)
    rolling = T.RollingHash(plain, lower=True)
    columns = []
    for k, size in enumerate(PIECES):
        stop = end if not size else np.minimum(end, start + size)
        h = T.mix(rolling.ranges(start, stop) + _U(k + 1)) >> _U(64 - BITS)
        columns.append(np.where((size == 0) | (end - start >= size), h.astype(np.int64), -1))
    table = np.stack(columns, axis=1) if len(start) else np.zeros((0, len(PIECES)), np.int64)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        f = np.unique(table[a:b])
        out.append(f[1:] if len(f) and f[0] < 0 else f)
    return out


#: Bytes that belong to a word here: ASCII letters, digits and all non-ASCII bytes.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def sample(docs: DataFrame, labels: DataFrame, positives: int = MAX_POSITIVE, unlabelled: int = MAX_UNLABELLED):
    """Bounded training sample (toxic flag and features) and the toxic share of the labelled training rows.

    Labels come only from documents whose crc32(id) mod 5 is not 0; the
    unlabelled rows are any documents without such a label.
    """
    known = (labels.where("toxic is not null").where(crc_mod("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = store(known, "toxic-labels")
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    order = F.xxhash64("doc_id", F.lit(8))
    pos = ids.join(known.where("toxic = 1"), "doc_id", "left_semi").orderBy(order).limit(positives)
    rest = ids.join(known, "doc_id", "left_anti").orderBy(order).limit(unlabelled)
    chosen = pos.withColumn("toxic", F.lit(1)).union(rest.withColumn("toxic", F.lit(0)))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(batches):
            f = features(*T.utf8(t["text"]))
            yield pa.RecordBatch.from_arrays(
                [t["toxic"].combine_chunks().cast(pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in f], pa.binary())],
                names=["toxic", "f"])

    picked = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
              .mapInArrow(extract, "toxic int, f binary"))
    rows = picked.collect()  # at most MAX_POSITIVE + MAX_UNLABELLED ids
    return ([np.frombuffer(r.f, np.int32) for r in rows if r.toxic], [np.frombuffer(r.f, np.int32) for r in rows if not r.toxic],
            toxic / n if n else 0.0)


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[off[1:]] - total[off[:-1]]


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, steps: int = 1000, rate: float = 0.05,
        decay: float = 1.0) -> Model:
    """Full-batch non-negative PU learning with the sigmoid loss and Adam steps, from a log-ratio start.

    Only features that are clearly more frequent among the positive texts than
    among the unlabelled ones (and occur in three of the former) get a weight.
    """
    w = np.zeros(1 << BITS)
    p = min(max(prior, 1e-6), 0.5)
    if not pos or not unl:
        return Model(w.astype(np.float32), float(np.log(p / (1 - p))))
    cp, cu = _rows_with(pos), _rows_with(unl)
    expected = cu * (len(pos) / len(unl))
    keep = np.flatnonzero((cp >= 3) & (cp - expected > 3 * np.sqrt(expected + 0.5)) & (cp > 2 * expected))
    place = np.full(len(w), -1)
    place[keep] = np.arange(len(keep))
    (pf, po), (uf, uo) = _chosen(pos, place), _chosen(unl, place)
    share_p, share_u = (cp[keep] + 0.5) / (len(pos) + 1), (cu[keep] + 0.5) / (len(unl) + 1)
    v = np.log(share_p / share_u) / len(PIECES)
    bias = np.log(p / (1 - p))
    first = np.zeros(len(v) + 1)
    second = np.zeros(len(v) + 1)
    for t in range(1, steps + 1):
        sp, su = _sigmoid(_sums(v[pf], po) + bias), _sigmoid(_sums(v[uf], uo) + bias)
        dp = -p * sp * (1 - sp) / len(pos)                      # derivative of pi * R_p^+
        du = np.zeros(len(unl))
        if su.mean() - p * sp.mean() > 0:                       # max(0, .) has a slope only above 0
            dp, du = dp * 2, su * (1 - su) / len(unl)
        g = np.zeros(len(v) + 1)
        g[:-1] = np.bincount(pf, np.repeat(dp, np.diff(po)), len(v)) + np.bincount(uf, np.repeat(du, np.diff(uo)), len(v))
        g[:-1] += decay * p * v / len(v)
        g[-1] = dp.sum() + du.sum()
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        step = rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        v = np.maximum(v - step[:-1], 0)                        # a chosen feature never speaks against the class
        bias -= step[-1]
    w[keep] = v
    return Model(w.astype(np.float32), float(bias))


def _rows_with(rows: list[np.ndarray]) -> np.ndarray:
    """In how many rows each feature occurs (a row's features are distinct)."""
    n = np.zeros(1 << BITS, np.int64)
    for f in rows:
        n[f] += 1
    return n


def _chosen(rows: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept features of each row, end to end, and the rows' offsets."""
    kept = [at[at >= 0] for at in (place[f] for f in rows)]
    return np.concatenate(kept), np.cumsum([0] + [len(k) for k in kept])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns and the score, as ``name``, for every row; one pass, no shuffle."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # 2 ** BITS floats
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value.astype(np.float64)
        for t in T.slices(batches):
            z = np.array([w[f].sum() for f in features(*T.utf8(t["text"]))]) + bias
            yield pa.RecordBatch.from_arrays([t[c].combine_chunks() for c in keep] + [pa.array(_sigmoid(z))], names=[*keep, name])

    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = StructType([source.schema[c] for c in keep] + [StructField(name, DoubleType())])
    return source.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under 0.5."""
    name = "_" + max([*docs.columns, "score"], key=len)         # no column of the documents has it
    return score(docs, fit(*sample(docs, labels)), tuple(docs.columns), name).where(F.col(name) < 0.5).select(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted."""
    model = fit(*sample(docs, labels))
    return score(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
