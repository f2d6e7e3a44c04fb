"""Operator 10: benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

Test items are cut into segments of at most 64 words.  Every 3-word gram of a
segment is a seed, so a copy is led to by any three neighbouring words that it
keeps; choosing seeds by their counts would lose an edited copy when the grams
it lacks are the rarer ones, as beside an exact copy.  Seeds
found in a document fix windows of its text around the segment's place there.
The segment's words that a window holds are a bound of its score, so windows
that hold too few go unaligned; a local alignment of words (match +1, mismatch
and gap -1) scores the others.  A document matches an item when an alignment
scores 0.4 of the segment's words and at least 8 (or all words of a shorter
segment).

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered and ASCII punctuation at
their ends taken off.  Items of under five words are no evidence and match
nothing.  Null or empty texts match nothing; an item that occurs twice matches
under both ids; repeated document rows give one row per doc_id and item_id; an
empty benchmark gives an empty result.  The benchmark is worked off in blocks of a fixed
number of segments, and only a block is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from loadlens.llm import texts as T
from loadlens.llm.tables import store

GRAM = 3
SEGMENT = 64
#: Segments per broadcast block: at most BLOCK * SEGMENT word hashes of 8 bytes (5 MB).
BLOCK = 10_000
#: Words that a copy may be longer or shifted by on either side of its segment's place.
SLACK = 16
MIN_WORDS = 5
MIN_SHARE, MIN_SCORE = 0.4, 8
_U = np.uint64
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def word_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bare words of each text, and the texts' offsets in them."""
    data, off = T.utf8(column)
    start, end, _ = T.words(data, off)
    # strip punctuation: first and last byte of each word that isn't punctuation
    solid = np.flatnonzero(~_PUNCT[data] & ~T._SPACE[data])
    if not len(solid):
        return np.zeros(0, _U), np.zeros(len(off), np.int64)
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    real = a < b
    start, end = solid[a[real]], solid[b[real] - 1] + 1
    return T.RollingHash(data, lower=True).ranges(start, end), np.searchsorted(start, off)


def segments(bench: DataFrame) -> DataFrame:
    """``(item_id, words)``: word hashes of each segment of every usable item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(batches):
            h, rows = word_rows(t["text"])
            ids, found = [], []
            for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                if b - a < MIN_WORDS:
                    continue
                parts = -(-(b - a) // SEGMENT)                  # near-equal parts, none too short
                for c in np.array_split(h[a:b], parts):
                    ids.append(t["item_id"][i].as_py())
                    found.append(c.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["item_id", "words"])

    return (bench.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
            .mapInArrow(run, "item_id long, words binary"))


def _grams(words: np.ndarray) -> np.ndarray:
    return T.runs(words, GRAM)


def _doc_grams(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams that lie within one text, and the word position where each starts."""
    g = _grams(h)
    doc = np.searchsorted(rows, np.arange(len(g)), "right") - 1
    inside = np.arange(len(g)) + GRAM <= rows[doc + 1]
    return g[inside], np.flatnonzero(inside)


def _member(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x, at


def held(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """How many words of each row of ``items`` the same row of ``windows`` holds anywhere: no alignment scores more."""
    n = np.zeros(len(items), np.int64)
    for i in range(items.shape[1]):
        n += (windows == items[:, i:i + 1]).any(axis=1)
    return n


def align(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of each row of ``items`` with the same row of ``windows``.

    Rows are word hashes padded with 0 (items) and 1 (windows), which match
    nothing.  A row of the score matrix is one vector step; gaps along it come
    from a running maximum.
    """
    n, w = windows.shape
    slope = np.arange(w, dtype=np.int32)
    above = np.zeros((n, w), np.int32)
    best = np.zeros(n, np.int32)
    for i in range(items.shape[1]):
        here = np.where(windows == items[:, i:i + 1], 1, -1).astype(np.int32)
        here[:, 1:] += above[:, :-1]
        np.maximum(here, above - 1, out=here)
        np.maximum(here, 0, out=here)
        above = np.maximum.accumulate(here + slope, axis=1) - slope
        np.maximum(best, above.max(axis=1), out=best)
    return best


class Block:
    """A bounded block of segments with the seeds that lead to them."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.size = np.array([len(w) for w in words])
        self.need = np.maximum(MIN_SHARE * self.size, np.minimum(MIN_SCORE, self.size))
        grams = [_grams(w) for w in words]
        seg, pos = (np.concatenate(x) for x in zip(*[(np.full(len(g), i), np.arange(len(g))) for i, g in enumerate(grams)]))
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.seg, self.pos, g = seg[order], pos[order], g[order]
        self.keys, self.first = np.unique(g, return_index=True)
        self.last = np.append(self.first[1:], len(g))

    def matches(self, h: np.ndarray, rows: np.ndarray):
        """Text, segment and score of every alignment in a slice that counts as a copy."""
        g, at = _doc_grams(h, rows)
        hit, k = _member(self.keys, g)
        at, k = at[hit], k[hit]
        many = self.last[k] - self.first[k]
        entry = np.repeat(self.first[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        doc = np.searchsorted(rows, at, "right") - 1
        seg, shift = self.seg[entry], at - self.pos[entry]
        order = np.lexsort((shift, seg, doc))
        doc, seg, shift = doc[order], seg[order], shift[order]
        if not len(doc):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        # seeds of one text and segment whose shifts lie in the same band of SLACK words share a window
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (seg[1:] != seg[:-1]) | (shift[1:] // SLACK != shift[:-1] // SLACK)
        doc, seg, shift = doc[new], seg[new], shift[new]
        score = np.zeros(len(doc))
        for a in range(0, len(doc), 2048):
            part = slice(a, a + 2048)
            score[part] = self._scores(h, rows, doc[part], seg[part], shift[part])
        ok = score >= self.need[seg]
        return doc[ok], seg[ok], (score / self.size[seg])[ok]

    def _scores(self, h, rows, doc, seg, shift):
        wide = SEGMENT + 3 * SLACK
        items = np.zeros((len(seg), SEGMENT), _U)
        for i, s in enumerate(seg.tolist()):
            items[i, :len(self.words[s])] = self.words[s]
        start = (shift // SLACK) * SLACK - SLACK
        col = start[:, None] + np.arange(wide)
        inside = (col >= rows[doc][:, None]) & (col < rows[doc + 1][:, None])
        windows = np.where(inside, h[np.clip(col, 0, len(h) - 1)], _U(1))
        score = np.zeros(len(seg))
        open_ = np.flatnonzero(held(items, windows) >= self.need[seg])
        score[open_] = align(items[open_], windows[open_])
        return score


def contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``(doc_id, item_id, score)`` for each document that holds a copy of an item; score is the aligned share."""
    spark = docs.sparkSession
    parts = store(segments(bench).withColumn("part", F.monotonically_increasing_id()), "segments")
    parts = parts.orderBy("part")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, score double"
    found = spark.createDataFrame([], ty.StructType.fromDDL(schema))
    low = -1
    while block := parts.where(F.col("part") > low).limit(BLOCK).collect():
        low = block[-1].part
        b = Block(np.array([r.item_id for r in block]), [np.frombuffer(r.words, _U) for r in block])
        shared = spark.sparkContext.broadcast(b)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for t in T.slices(batches):
                h, rows = word_rows(t["text"])
                doc, seg, score = block.matches(h, rows)
                yield pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks().take(pa.array(doc)), pa.array(block.ids[seg]),
                                                  pa.array(score)], names=["doc_id", "item_id", "score"])

        found = found.union(texts.mapInArrow(run, schema))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that hold no copy of a benchmark item."""
    bad = store(contaminated(docs, bench).where("doc_id is not null").select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
