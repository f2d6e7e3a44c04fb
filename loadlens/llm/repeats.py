"""Operator 3: exact removal of repeated 50-byte strings by sorted suffixes.

A byte is removed when a 50-byte string that covers it also starts in a
document with a smaller doc_id.  All strings of a document are judged, not
only those at word starts:

1. A string's anchor is its least hashed 20-byte gram.  Neighbouring strings
   mostly share one, so a text falls into short regions of strings with one
   anchor, and equal strings always lie in regions with equal anchors.
2. Sieve: regions meet in buckets by anchor as packed (anchor, region) hashes.
   A region that a smaller document holds as a whole is removed at once.  If
   an anchor occurs in several documents with different regions, one
   occurrence of each such region is compared string by string.
3. Those regions' suffixes are dealt by Spark's sampled range splitters on the
   leading bytes (the anchor), sorted locally by multikey quicksort, eight
   bytes a key, and neighbours are compared.  Equal leading bytes never
   straddle a splitter, so no string has to be compared across a boundary.
4. An anchor with very many different regions (the end of a line that a third
   of the documents share) isn't left to one bucket: its strings go through a
   sieve of their own, each dealt by itself, as packed hashes of 96 bits and
   more; of the equal strings a task holds, only the least doc_id's is dealt.
   A task that holds very many regions of an anchor tells the anchor's bucket
   of them by one entry.

Nulls: a null text is an empty one; a document with a null doc_id neither
loses bytes nor makes others lose them.  Rows with equal doc_id never remove
each other's bytes.  Texts under 50 bytes stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import texts as T
from loadlens.llm.tables import store, text_bytes

SPAN, GRAM = 50, 20
#: Text bytes that a task works on at once.
SLICE = 1 << 20
#: Text bytes for a bucket of the sieve.
BUCKET_BYTES = 4 << 20
#: Regions or strings that a task packs at once.
HELD = 1 << 18
#: Strings dealt singly for a bucket of their sieve.
BUCKET_STRINGS = 1 << 16
#: Different regions of one anchor beyond which its strings are dealt singly.
HEAVY = 256
#: Regions that a sorting step takes on (some 15 strings each).
ROWS = 10_000
WHOLE, LIGHT, SINGLE = 1, 2, 3
_U = np.uint64


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:span - width], x[width - span:]) if span < width else x


def _grams(rolling: T.RollingHash) -> np.ndarray:
    """Hash of the gram at every place."""
    sums = rolling.sums
    g = (sums[GRAM:] - sums[:-GRAM]) * T.powers(len(sums))[1][:len(sums) - GRAM]
    g ^= g >> _U(32)
    g *= _U(0xD6E8FEB86659FD93)
    g ^= g >> _U(29)
    return g


def regions(data: np.ndarray, off: np.ndarray):
    """First and last string start, anchor hash and region hash of each region, and its text's number."""
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none.astype(_U), none.astype(_U), none
    rolling = T.RollingHash(data)
    low = _window_min(_grams(rolling), SPAN - GRAM + 1)
    ok = np.zeros(len(low), bool)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        ok[a:max(a, b - SPAN + 1)] = True                       # strings that end within their text
    change = low[1:] != low[:-1]
    begins, ends = ok.copy(), ok.copy()
    begins[1:] &= change | ~ok[:-1]
    ends[:-1] &= change | ~ok[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    return first, last, low[first], rolling.ranges(first, last + SPAN), np.searchsorted(off, first, "right") - 1


def _delta(x: np.ndarray) -> bytes:
    return T.planes(np.diff(x, prepend=0), 8)


def _undelta(b: bytes) -> np.ndarray:
    return np.cumsum(T.unplanes(b, 8))


REPLY = "doc_id long, th int, marks binary"
SIEVE = "bucket int, whole boolean, doc_id long, th int, marks binary, h binary, r binary, doc binary, ths binary, at binary, size binary"


def _unmark(marks: bytes) -> np.ndarray:
    return np.frombuffer(marks, np.uint32).reshape(-1, 3).astype(np.int64)


def _by_doc(ids, th, at, size, code):
    """doc_id, th and marks, packed (first string start, number of strings, code), of each document among aligned arrays."""
    order = np.lexsort((at, th, ids))
    ids, th = ids[order], th[order]
    marks = np.stack([at[order], size[order], code[order]], axis=1).astype(np.uint32)
    edge = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]))) if len(ids) else np.zeros(0, int)
    stop = np.append(edge[1:], len(ids))
    return ids[edge], th[edge], [marks[a:b].tobytes() for a, b in zip(edge.tolist(), stop.tolist())]


def _reply(ids, th, at) -> pa.RecordBatch:
    """Replies that remove the strings at the given places."""
    d, s, m = _by_doc(ids, th, at, np.ones(len(at), np.int64), np.full(len(at), WHOLE))
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s.astype(np.int32)), pa.array(m, pa.binary())],
                                      names=["doc_id", "th", "marks"])


def _packed(entries: Iterator[tuple], buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    """Entries by bucket, packed; those that a smaller document among the ones held at once has too are answered at once.

    So are those of a first hash that has very many second ones; its bucket gets one entry of no strings as a sign.
    An entry is a doc_id, th, first string start, number of strings, evenly spread hash (a bucket keeps its lower half)
    and second hash (``width`` bytes are kept).
    """

    def pack(ids, th, at, size, h, r) -> pa.RecordBatch:
        order = np.lexsort((ids, r, h))
        new_h = np.append(True, h[order[1:]] != h[order[:-1]])
        new = new_h | np.append(True, r[order[1:]] != r[order[:-1]])
        least = ids[order][new][np.cumsum(new) - 1]
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_h))[np.cumsum(new_h) - 1]
        code = np.zeros(len(order), np.int64)
        code[order] = np.where(ids[order] > least, WHOLE, np.where(kinds > HEAVY, SINGLE, 0))
        told = code > 0
        d, s, m = _by_doc(ids[told], th[told], at[told], size[told], code[told])
        sign = order[new_h & (kinds > HEAVY)]
        size = size.copy()
        size[sign] = 0
        told[sign] = False
        h, r, ids, th, at, size = (x[~told] for x in (h, r, ids, th, at, size))
        bucket = ((h >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")               # text order within a bucket, so ids and places are close
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        some = np.flatnonzero(edge[1:] > edge[:-1])
        cols: list[list] = [[] for _ in range(6)]
        for k in some.tolist():
            o = order[edge[k]:edge[k + 1]]
            for c, x in zip(cols, (T.planes(h[o].view(np.int64), 4), T.planes(r[o].view(np.int64), width), _delta(ids[o]),
                                   _delta(th[o]), T.planes(at[o], 4), T.planes(size[o], 4))):
                c.append(x)
        k = len(d)
        blank = [None] * k
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.abs(s) % buckets, some]).astype(np.int32)),
            pa.array([True] * k + [False] * len(some)),
            pa.array(np.concatenate([d, np.zeros(len(some), np.int64)])), pa.array(np.concatenate([s, np.zeros(len(some), np.int64)]).astype(np.int32)),
            pa.array(m + [None] * len(some), pa.binary()),
            *(pa.array(blank + c, pa.binary()) for c in cols)], names=[c.split()[0] for c in SIEVE.split(", ")])

    held: list[tuple] = []
    for entry in entries:
        held.append(entry)
        if sum(len(e[0]) for e in held) >= HELD:
            yield pack(*map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield pack(*map(np.concatenate, zip(*held)))


def _sieve(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed regions by bucket, and answers to those that a smaller document of the same task holds."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for t in T.slices(batches, limit=SLICE):
            data, off = T.utf8(t["text"])
            first, last, h, r, doc = regions(data, off)
            if len(first):                                      # an anchor's hash is a least one, so it isn't evenly spread
                yield (t["doc_id"].to_numpy()[doc], t["th"].to_numpy().astype(np.int64)[doc], first - off[doc], last - first + 1, T.mix(h), r)

    return docs.mapInArrow(lambda batches: _packed(entries(batches), buckets, 5), SIEVE)


def _answer(t: pa.Table) -> pa.Table:
    """One bucket of the sieve: what each document learns about its regions there."""
    whole = t.filter(t["whole"])
    t = t.filter(pc.invert(t["whole"]))
    out = whole.select(["doc_id", "th", "marks"]).cast(pa.schema([("doc_id", pa.int64()), ("th", pa.int32()), ("marks", pa.binary())]))
    if not t.num_rows:
        return out
    def column(name, read, kind):
        return np.concatenate([read(x.as_py()).astype(kind) for x in t[name]])

    h = column("h", lambda x: T.unplanes(x, 4), np.uint32)
    width = len(t["r"][0].as_py()) * 4 // len(t["h"][0].as_py())
    r = column("r", lambda x: T.unplanes(x, width), np.int64)
    ids = column("doc", _undelta, np.int64)
    size = column("size", lambda x: T.unplanes(x, 4), np.uint32)
    order = np.lexsort((ids, r, h))
    hs, rs, ds, sign = h[order], r[order], ids[order], size[order] == 0
    del h, r, ids
    new_h = np.append(True, hs[1:] != hs[:-1])
    new_r = new_h | np.append(True, rs[1:] != rs[:-1])
    begin = np.flatnonzero(new_h)
    group = np.cumsum(new_h) - 1
    several = (np.minimum.reduceat(ds, begin) != np.maximum.reduceat(ds, begin))[group]
    kinds = np.add.reduceat(new_r.astype(np.int64), begin)[group]
    least = ds[np.flatnonzero(new_r)][np.cumsum(new_r) - 1]
    code = np.zeros(len(order), np.int64)
    code[several & (ds > least)] = WHOLE
    signed = np.logical_or.reduceat(sign, begin)[group]
    open_ = (ds == least) & (several & (kinds > 1) | signed)
    code[open_] = np.where(signed[open_] | (kinds[open_] > HEAVY), SINGLE, LIGHT)
    told = (code > 0) & ~sign
    order, code = order[told], code[told]
    th = column("ths", _undelta, np.int32)[order].astype(np.int64)
    at = column("at", lambda x: T.unplanes(x, 4), np.uint32)[order].astype(np.int64)
    d, s, m = _by_doc(ds[told], th, at, size[order].astype(np.int64), code)
    return pa.concat_tables([out, pa.table({"doc_id": pa.array(d), "th": pa.array(s.astype(np.int32)), "marks": pa.array(m, pa.binary())})])


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of big-endian words, and whether each row in it differs from the one before.

    A word at a time: only rows that tie on all words so far are sorted on.
    """
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for k in range(1, words.shape[1]):
        run = np.cumsum(new)
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(tied):
            break
        rows, run = order[tied], run[tied]
        key = words[rows, k]
        o = np.lexsort((key, run))
        order[tied], key, run = rows[o], key[o], run[o]
        new[tied[1:]] |= (run[1:] == run[:-1]) & (key[1:] != key[:-1])
    return order, new


def _strings(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The strings at ``start`` as rows of seven big-endian words."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    rows = sliding_window_view(padded, 56)[start].copy()
    rows[:, SPAN:] = 0
    return rows.view(">u8").astype(_U)


def _open(t: pa.Table, code: int):
    """Bytes of the slice's texts, and text number, place there, absolute place and number of strings of the marks with a code."""
    data, off = T.utf8(t["text"])
    marks = [_unmark(m) for m in t["marks"].to_pylist()]
    row = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
    m = np.concatenate(marks)
    keep = m[:, 2] == code
    row, at, size = row[keep], m[keep, 0], m[keep, 1]
    return data, row, at, off[row] + at, size


def _each(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, .. of each row, end to end."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])


def _light(touched: DataFrame, buckets: int) -> DataFrame:
    """Strings of open regions that also start in a smaller document, as replies."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(batches, limit=SLICE):
            data, row, at, place, size = _open(t, LIGHT)
            if not len(row):
                continue
            last = place + size - 1                             # all strings of a region have its anchor, so its last one does
            anchor = last + sliding_window_view(_grams(T.RollingHash(data)), SPAN - GRAM + 1)[last].argmin(axis=1)
            yield pa.RecordBatch.from_arrays([
                _binary(sliding_window_view(data, GRAM)[anchor], np.full(len(row), GRAM)), t["doc_id"].combine_chunks().take(pa.array(row)),
                t["th"].combine_chunks().take(pa.array(row)), pa.array(at), _binary(data[_each(place, size + SPAN - 1)], size + SPAN - 1)],
                names=["gram", "doc_id", "th", "at", "part"])

    def compare(t: pa.Table) -> pa.RecordBatch:
        data, off = _bytes(t["part"])
        n = np.diff(off) - SPAN + 1
        row = np.repeat(np.arange(len(n)), n)
        place = _each(off[:-1], n)
        ids = t["doc_id"].to_numpy()[row]
        order, new = multikey_order(_strings(data, place))
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        gone = order[ids[order] > least]
        at = t["at"].to_numpy()[row[gone]] + place[gone] - off[row[gone]]
        return _reply(ids[gone], t["th"].to_numpy()[row[gone]].astype(np.int64), at)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                held.append(batch.slice(k, ROWS))
                t = pa.Table.from_batches(held)
                # whole anchors go; the last one waits for its further rows
                waits = pc.index(t["gram"], t["gram"][-1]).as_py()
                if waits and t.num_rows > ROWS:
                    yield compare(t.slice(0, waits))
                    t = t.slice(waits)
                held = t.to_batches()
        if held:
            yield compare(pa.Table.from_batches(held))

    cuts = touched.select("doc_id", "th", "text", "marks").mapInArrow(cut, "gram binary, doc_id long, th int, at long, part binary")
    return cuts.repartitionByRange(buckets, "gram").sortWithinPartitions("gram").mapInArrow(sort, REPLY)


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks().cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def _single_strings(touched: DataFrame) -> int:
    """Number of strings that are to be dealt singly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _unmark(b"".join(batch.column("marks").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([int(m[m[:, 2] == SINGLE, 1].sum())], pa.int64())], names=["n"])

    return touched.select("marks").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _single(touched: DataFrame) -> DataFrame:
    """The same for anchors with very many regions: string by string."""
    buckets = _single_strings(touched) // BUCKET_STRINGS + 1

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for t in T.slices(batches, limit=SLICE):
            data, row, at, place, size = _open(t, SINGLE)
            if len(row):
                rolling, each, place = T.RollingHash(data), np.repeat(row, size), _each(place, size)
                half = place + SPAN // 2
                a, b = rolling.ranges(place, half), rolling.ranges(half, place + SPAN)
                yield (t["doc_id"].to_numpy()[each], t["th"].to_numpy().astype(np.int64)[each], _each(at, size), np.ones(len(each), np.int64),
                       T.mix(a + T.mix(b)), T.mix(b + T.mix(a)))

    sieve = touched.select("doc_id", "th", "text", "marks").mapInArrow(lambda batches: _packed(entries(batches), buckets, 8), SIEVE)
    return sieve.groupBy("bucket").applyInArrow(_answer, REPLY)


def removed_bytes(size: int, marks: np.ndarray) -> np.ndarray:
    """Mask of the bytes covered by strings (start, number of starts, code)."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, marks[:, 0], 1)
    np.add.at(step, marks[:, 0] + marks[:, 1] - 1 + SPAN, -1)
    return np.cumsum(step)[:size] > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, marks, more in zip(*(batch.column(c).to_pylist() for c in ("text", "marks", "more"))):
            data = np.frombuffer(text.encode(), np.uint8)
            m = _unmark(b"".join([marks, *(more or [])]))
            gone = removed_bytes(len(data), m[m[:, 2] == WHOLE])
            kept = data[~gone].tobytes()
            spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
            rows.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]),
                                          *(pa.array(c, pa.string()) for c in cols[3:])], names=[c.split()[0] for c in RESULT.split(", ")])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept_text (null where nothing was removed)."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.hash("text"))
    sieve = _sieve(d.where("doc_id is not null"), buckets)
    answers = sieve.groupBy("bucket").applyInArrow(_answer, REPLY)
    answers = answers.groupBy("doc_id", "th").agg(F.collect_list("marks").alias("marks"))

    # texts whose strings are in question, and the finished rows of the others
    state = store(d.join(answers, ["doc_id", "th"], "left").select(
        "doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(F.col("marks").isNull(), F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        F.when(F.col("marks").isNotNull(), F.col("text")).alias("text"),
        "marks"), "repeats-state")
    plain = state.where("text is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                               F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"))
    touched = state.where("text is not null").select("doc_id", "th", "text", F.aggregate("marks", F.expr("X''"), lambda a, x: F.concat(a, x)).alias("marks"))
    more = _light(touched, buckets).union(_single(touched)).groupBy("doc_id", "th").agg(F.collect_list("marks").alias("more"))
    return touched.join(more, ["doc_id", "th"], "left").select("doc_id", "text", "marks", "more").mapInArrow(_clean, RESULT).union(plain)
