"""Operator 5: whole-document scores of a gated recurrent language model.

1. Texts are cut into words and stored as slices: numbers into a dictionary of
   word hashes per slice, an end after each text.
2. The dictionaries meet in buckets by hash, where the words of the training
   documents are counted over the whole corpus; each slice gets its counts back.
3. The most frequent words (``SHORTLIST``) feed the recurrent model, which all
   tasks train on their slices from one common start, each over all its training
   documents; the results are averaged by the tokens seen.
4. Every document is scored as a whole, its state carried across windows.  A
   word outside the shortlist has the model's probability of "another word"
   times its share of the counts of those, so every word has a probability.

Documents with crc32(doc_id as text) mod 7 = 2 are held out from all counts and
training.  A null text is an empty one (its only token is the end); a null
doc_id is not held out; repeated rows count as often as they occur; an empty
table gives no rows.  Words are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import texts as T
from loadlens.llm.recurrent import Recurrent
from loadlens.llm.tables import crc_mod, store

#: Words that the recurrent model knows one by one (and one id for all others).
SHORTLIST = 2047
#: Slices whose texts are scored side by side, so that a long text takes others along.
TOGETHER = 8
SLICE = 4 << 20
#: Parameter sets that are averaged, and word lists that are merged, in one step.
FAN = 16
_U = np.uint64
END = int(T.mix(np.array([0xE4D], _U))[0])
STORED = "slice long, ids binary, held binary, sizes binary, tokens binary, words binary, counts binary"


def _slices(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for t in T.slices(batches, limit=SLICE):
            h, rows = T.word_hashes(*T.utf8(t["text"]))
            n = t.num_rows
            held = t["held_out"].to_numpy()
            place = np.arange(len(h)) + np.repeat(np.arange(n), np.diff(rows))
            keys = np.full(len(h) + n, END, _U)
            keys[place] = h
            off = rows + np.arange(n + 1)
            words, token = np.unique(keys, return_inverse=True)
            counts = np.bincount(token, np.repeat(~held, np.diff(off)), len(words)).astype(np.int64)
            ids = t["doc_id"].combine_chunks()
            yield pa.RecordBatch.from_pylist([{
                "slice": number, "ids": _ids(ids), "held": held.astype(np.uint8).tobytes(),
                "sizes": T.planes(np.diff(off), 4), "tokens": T.planes(token, 4), "words": words.tobytes(), "counts": T.planes(counts, 4)}],
                schema=pa.schema([("slice", pa.int64()), *((c, pa.binary()) for c in ("ids", "held", "sizes", "tokens", "words", "counts"))]))
            number += 1

    return store(docs.mapInArrow(run, STORED), "lm-slices")


def _ids(ids: pa.Array) -> bytes:
    """Ids with a leading flag byte each, so that null survives."""
    flag = np.asarray(ids.is_valid()).astype(np.uint8)
    return flag.tobytes() + np.asarray(ids.fill_null(0), np.int64).tobytes()


def _id_array(b: bytes) -> pa.Array:
    n = len(b) // 9
    flag = np.frombuffer(b, np.uint8, n)
    return pa.array(np.frombuffer(b[n:], np.int64), mask=flag == 0)


COUNTED = "slice long, bucket int, totals binary, n long, v long, top binary, top_n binary"


def _count(slices: DataFrame, buckets: int) -> DataFrame:
    """Corpus counts of each slice's words by bucket, and each bucket's sums and most frequent words (slice -1)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, counts in zip(*(batch.column(c).to_pylist() for c in ("slice", "words", "counts"))):
                words, counts = np.frombuffer(words, _U), T.unplanes(counts, 4)
                bucket = ((words >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)   # rises with the word
                edge = np.searchsorted(bucket, np.arange(buckets + 1))
                some = np.flatnonzero(edge[1:] > edge[:-1]).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * len(some), pa.int64()), pa.array(some, pa.int32()),
                    pa.array([words[edge[k]:edge[k + 1]].tobytes() for k in some], pa.binary()),
                    pa.array([T.planes(counts[edge[k]:edge[k + 1]], 4) for k in some], pa.binary())], names=["slice", "bucket", "words", "counts"])

    def add(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(w, _U) for w in t["words"].to_pylist()]
        words, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(place, np.concatenate([T.unplanes(c, 4) for c in t["counts"].to_pylist()]), len(words)).astype(np.int64)
        edge = np.cumsum([0] + [len(p) for p in parts])
        replies = [T.planes(total[place[a:b]], 5) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        best = _most(words, total)
        k = t.num_rows
        return pa.table({
            "slice": pa.array(t["slice"].to_pylist() + [-1], pa.int64()), "bucket": pa.array(t["bucket"].to_pylist() + [t["bucket"][0].as_py()], pa.int32()),
            "totals": pa.array(replies + [None], pa.binary()), "n": pa.array([0] * k + [int(total.sum())]), "v": pa.array([0] * k + [int((total > 0).sum())]),
            "top": pa.array([None] * k + [words[best].tobytes()], pa.binary()),
            "top_n": pa.array([None] * k + [total[best].tobytes()], pa.binary())})

    dealt = slices.select("slice", "words", "counts").mapInArrow(deal, "slice long, bucket int, words binary, counts binary")
    return store(dealt.groupBy("bucket").applyInArrow(add, COUNTED), "lm-counts")


def _most(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the SHORTLIST most frequent words; ties by hash."""
    best = np.lexsort((words, -counts))[:SHORTLIST]
    return best[counts[best] > 0]


def _merge(tops) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of several lists of (different) words and counts."""
    words = np.concatenate([np.frombuffer(t["top"], _U) for t in tops] or [np.zeros(0, _U)])
    counts = np.concatenate([np.frombuffer(t["top_n"], np.int64) for t in tops] or [np.zeros(0, np.int64)])
    best = _most(words, counts)
    return words[best], counts[best]


def _shortlist(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of the corpus and their counts: a tree of merges, FAN buckets at a time."""
    def merge(t: pa.Table) -> pa.Table:
        words, counts = _merge(t.to_pylist())
        return pa.table({"bucket": t["bucket"][:1], "top": pa.array([words.tobytes()], pa.binary()), "top_n": pa.array([counts.tobytes()], pa.binary())})

    tops, width = counted.where("slice < 0").select("bucket", "top", "top_n"), 1
    while tops.count() > FAN:
        width *= FAN
        tops = store(tops.groupBy(F.floor(F.col("bucket") / width).alias("g")).applyInArrow(merge, "bucket int, top binary, top_n binary"), "lm-shortlist")
    return _merge([r.asDict() for r in tops.collect()])


def _resolve(slices: DataFrame, counted: DataFrame, n: int, v: int, keys: np.ndarray, key_counts: np.ndarray) -> DataFrame:
    """Slices with model word ids, and each document's base score, known tokens and share of the other words."""
    order = np.argsort(keys)
    shared = slices.sparkSession.sparkContext.broadcast((keys[order], order + 1))   # SHORTLIST words
    base, rest = np.log10(n + v + 1), np.log10(n + v + 1 - int((key_counts + 1).sum()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                words, token = np.frombuffer(row["words"], _U), T.unplanes(row["tokens"], 4)
                total = np.concatenate([T.unplanes(x["totals"], 5) for x in sorted(row["replies"], key=lambda x: x["bucket"])])
                at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
                word = np.where(known[at] == words, ids[at], 0) if len(known) else np.zeros(len(words), np.int64)
                log = np.log10(total + 1.0)
                off = np.concatenate([[0], np.cumsum(T.unplanes(row["sizes"], 4))])
                sums = lambda x: np.add.reduceat(x[token], off[:-1])  # noqa: E731  every text has its end
                yield pa.RecordBatch.from_pylist([{
                    "ids": row["ids"], "held": row["held"], "sizes": row["sizes"], "tokens": word[token].astype(np.uint16).tobytes(),
                    "base": sums(log - base).tobytes(), "known": sums((total > 0).astype(np.int64)).tobytes(),
                    "other": sums(np.where(word == 0, log - rest, 0.0)).tobytes()}],
                    schema=pa.schema([(c, pa.binary()) for c in ("ids", "held", "sizes", "tokens", "base", "known", "other")]))

    replies = counted.where("slice >= 0").groupBy("slice").agg(F.collect_list(F.struct("bucket", "totals")).alias("replies"))
    joined = slices.select("slice", "ids", "held", "sizes", "tokens", "words").join(replies, "slice")
    return store(joined.mapInArrow(run, "ids binary, held binary, sizes binary, tokens binary, base binary, known binary, other binary"), "lm-resolved")


def _training(row: dict) -> np.ndarray:
    """The tokens of a slice's training documents, end to end."""
    size = T.unplanes(row["sizes"], 4)
    return np.frombuffer(row["tokens"], np.uint16)[np.repeat(np.frombuffer(row["held"], np.uint8) == 0, size)]


def _fit(resolved: DataFrame, words: int, counts: np.ndarray, end: int) -> np.ndarray:
    """Parameters after every task trained on its slices, averaged by tokens."""
    sc = resolved.sparkSession.sparkContext
    model = Recurrent(words)
    model.prime(counts)
    first = resolved.select("sizes", "held", "tokens").limit(1).collect()           # one slice: a common start
    model.train((_training(r.asDict()) for r in first), end)
    shared = sc.broadcast(model.flat())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Recurrent(words).load(shared.value)
        seen = own.train((_training(row) for batch in batches for row in batch.to_pylist()), end, rate=0.03)
        if seen:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "seen": seen, "p": (own.flat() * np.float64(seen)).tobytes()}],
                                             schema=pa.schema([("part", pa.int64()), ("seen", pa.int64()), ("p", pa.binary())]))

    def add(t: pa.Table) -> pa.Table:
        p = np.sum([np.frombuffer(x, np.float64) for x in t["p"].to_pylist()], axis=0)
        return pa.table({"part": t["part"][:1], "seen": pa.array([sum(t["seen"].to_pylist())]), "p": pa.array([p.tobytes()], pa.binary())})

    schema = "part long, seen long, p binary"
    parts = store(resolved.select("sizes", "held", "tokens").mapInArrow(run, schema), "lm-parameters")
    width = 1
    while parts.count() > FAN:                                  # a tree of sums, FAN sets at a time
        width *= FAN
        parts = store(parts.groupBy(F.floor(F.col("part") / width).alias("g")).applyInArrow(add, schema), "lm-parameters")
    rows = parts.collect()
    if not rows:
        return model.flat()
    return (np.sum([np.frombuffer(r.p, np.float64) for r in rows], axis=0) / sum(r.seen for r in rows)).astype(np.float32)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    slices = _slices(d)
    counted = _count(slices, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    short, short_n = _shortlist(counted)
    resolved = _resolve(slices, counted, n, v, short, short_n)
    words = len(short) + 1
    end = next((k + 1 for k in np.flatnonzero(short == _U(END)).tolist()), 0)
    counts = np.append(n - short_n.sum(), short_n).astype(np.float64)
    shared = spark.sparkContext.broadcast(_fit(resolved, words, counts, end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Recurrent(words).load(shared.value)
        for batch in batches:
            rows = batch.to_pylist()
            for at in range(0, len(rows), TOGETHER):
                some = rows[at:at + TOGETHER]
                sizes = [T.unplanes(row["sizes"], 4) for row in some]
                token = np.concatenate([np.frombuffer(row["tokens"], np.uint16) for row in some]).astype(np.int64)
                scores = model.score(token, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), end) / np.log(10)
                for row, size, score in zip(some, sizes, np.split(scores, np.cumsum([len(x) for x in sizes])[:-1])):
                    yield pa.RecordBatch.from_arrays([
                        _id_array(row["ids"]), pa.array(np.frombuffer(row["held"], np.uint8) == 1), pa.array(size),
                        pa.array(np.frombuffer(row["known"], np.int64)), pa.array(np.full(len(size), n, np.int64)),
                        pa.array(np.frombuffer(row["base"], np.float64)), pa.array(score + np.frombuffer(row["other"], np.float64))],
                        names=[c.split()[0] for c in RESULT.split(", ")])

    return resolved.mapInArrow(run, RESULT)
