"""Operator 12: text quality by a sparse ensemble of rules.

1. Statistics of every whole text (shares of capitals, symbols and repeated
   words, word and line counts, ...) become columns, in one pass over its bytes.
2. Small trees are grown in numpy, by boosting, on the statistics of a bounded
   sample of labelled rows; every path from a root to a node is a rule, a
   conjunction of bounds on statistics.
3. A lasso logistic regression over all rules keeps few of them; its penalty
   is chosen on a fold of the sample that the fit doesn't see.
4. The kept rules are compiled into one Spark column expression over the
   statistics; scoring is one pass without a shuffle.

Only labels of documents whose crc32(id) mod 5 is not 0 are learnt; the
label, lang, source and doc_id are no inputs of a score.  The sample holds the
``MAX_LABELLED`` rows with the least hash of their id, or all if there are
fewer.

Nulls: a null text counts as empty, and an empty one has all statistics 0; a
null label, or a label of a missing document, is ignored; of repeated label
rows of a document the higher counts.  A document that is repeated is scored
each time alike.  Without labels of both kinds every score is the share of
good rows (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loadlens.llm import texts as T
from loadlens.llm.tables import crc_mod, store

#: Bound of the training sample.
MAX_LABELLED = 12_000
#: Trees, their depth, the share of rows each sees, the step of boosting, and the least rows of a node.
TREES, DEPTH, SHARE, RATE, LEAST = 40, 3, 0.5, 0.3, 10
#: Thresholds tried per statistic, and the lasso penalties tried, as shares of the least one that drops every rule.
BINS, PENALTIES = 32, (0.1, 0.03, 0.01, 0.003, 0.001)
#: From this score on a document counts as good.
KEEP = 0.3

#: Statistics of a text, in the order of :func:`statistics`.
NAMES = ("chars", "words", "lines", "chars_a_word", "longest_word", "capitals", "digits", "symbols", "stops", "capital_words", "plain_words",
         "marked_words", "bare_symbols", "distinct_words", "commonest_word", "repeated_words", "words_a_line", "distinct_lines")

_BYTE = np.arange(256)
_CAPITAL = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
#: ASCII letters and all bytes of other characters.
_LETTER = _CAPITAL | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_STOP = (_BYTE == 44) | (_BYTE == 46)
_SYMBOL = (_BYTE > 32) & ~_LETTER & ~_DIGIT & ~_STOP & (_BYTE != 127)
_FIRST = (_BYTE & 0xC0) != 0x80


def _share(part, whole):
    return part / np.maximum(whole, 1)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of :data:`NAMES` for each text of UTF-8 ``data``; all 0 for an empty text."""
    start, end, rows = T.words(data, off)
    n_words = np.diff(rows)

    def running(flags):
        return np.concatenate([[0], np.cumsum(flags)])

    def per_text(mask):
        total = running(mask[data])
        return total[off[1:]] - total[off[:-1]]

    def per_word(flags):
        total = running(flags)
        return total[rows[1:]] - total[rows[:-1]]

    chars = per_text(_FIRST)
    letters, marks = running(_LETTER[data]), running((_LETTER | _DIGIT)[data])
    size, in_word = end - start, letters[end] - letters[start]
    stopped = _STOP[data[end - 1]] if len(end) else np.zeros(0, bool)
    marked = (size > 1) & _SYMBOL[data[end - 1]] & _SYMBOL[data[np.maximum(end - 2, 0)]] if len(end) else np.zeros(0, bool)
    rolling = T.RollingHash(data, lower=True)
    word = rolling.ranges(start, end)
    first = np.zeros(len(word) + 1, bool)
    first[rows] = True
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & ~first[1:-1]
    longest, distinct, commonest = np.zeros(len(chars)), np.zeros(len(chars)), np.zeros(len(chars))
    for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        if b > a:
            counts = np.unique(word[a:b], return_counts=True)[1]
            longest[i], distinct[i], commonest[i] = size[a:b].max(), len(counts), counts.max()
    line_end = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], line_end + 1, off[-1:]]))
    edges = edges[edges < len(data)]                            # a line begins at a text's start and behind each line end
    stop = np.append(edges[1:], len(data))[:len(edges)]
    stop = np.where(data[np.maximum(stop - 1, 0)] == 10, stop - 1, stop) if len(stop) else stop
    line, at = rolling.ranges(edges, np.maximum(stop, edges)), np.searchsorted(edges, off)
    lines = np.diff(at)
    distinct_lines = np.array([len(np.unique(line[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.float64)
    columns = (chars, n_words, lines, _share(chars, n_words), longest, _share(per_text(_CAPITAL), chars), _share(per_text(_DIGIT), chars),
               _share(per_text(_SYMBOL), chars), _share(per_text(_STOP), chars),
               _share(per_word(_CAPITAL[data[start]]), n_words), _share(per_word((in_word == size) | (stopped & (in_word == size - 1))), n_words),
               _share(per_word(marked), n_words), _share(per_word(marks[end] == marks[start]), n_words), _share(distinct, n_words),
               _share(commonest, n_words), _share(per_word(again), n_words), _share(n_words, lines), _share(distinct_lines, lines))
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and one column ``stat_<name>`` per statistic, for every row; one pass over whole texts."""
    source = docs.select(*keep, "text")
    schema = StructType([source.schema[c] for c in keep] + [StructField(f"stat_{n}", DoubleType()) for n in NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in T.slices(batches):
            values = statistics(*T.utf8(t["text"]))
            yield pa.RecordBatch.from_arrays([t[c].combine_chunks() for c in keep] + [pa.array(v) for v in values.T], names=schema.names)

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Bounds ``low < statistic <= high`` that all have to hold, and what the rule adds to the score's logit."""
    bounds: tuple[tuple[str, float, float], ...]
    weight: float

    def column(self) -> Column:
        holds = F.lit(True)
        for name, low, high in self.bounds:
            if low > -np.inf:
                holds &= F.col(f"stat_{name}") > low
            if high < np.inf:
                holds &= F.col(f"stat_{name}") <= high
        return F.when(holds, F.lit(float(self.weight))).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """The score, 0 to 1, over columns of :func:`with_statistics`."""
        logit = F.lit(float(self.bias))
        for rule in self.rules:
            logit += rule.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the training rows, in the order of their ids."""
    known = (labels.where("doc_id is not null and quality is not null").where(crc_mod("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("_quality")))
    ids = docs.select("doc_id").distinct()
    order = [F.xxhash64("doc_id", F.lit(12)), F.col("doc_id")]
    chosen = store(known.join(ids, "doc_id", "left_semi").orderBy(*order).limit(most), "quality-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``most`` ids
    table = with_statistics(rows, ["doc_id", "_quality"]).groupBy("doc_id").agg(
        F.min(F.struct("_quality", *[f"stat_{n}" for n in NAMES])).alias("r"))  # of repeated ids one row
    found = sorted((r.doc_id, *r.r) for r in table.collect())                   # numbers only, no texts
    values = np.array([r[2:] for r in found], np.float64).reshape(len(found), len(NAMES))
    return values, np.array([r[1] for r in found], np.float64)


def _thresholds(x: np.ndarray) -> list[np.ndarray]:
    """Values between which a statistic may be cut: midpoints of neighbouring quantiles."""
    out = []
    for column in x.T:
        v = np.unique(column)
        if len(v) > BINS:
            v = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1), method="nearest"))
        out.append((v[1:] + v[:-1]) / 2)
    return out


def _tree(bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, rows: np.ndarray, path: tuple, paths: list, step: np.ndarray) -> None:
    """Grow one node; ``paths`` gets each node's bounds ``(statistic, sign, cut number)``, ``step`` the leaf values."""
    if path:
        paths.append(path)
    g = gradient[rows]
    best, split = 1e-9, None
    if len(path) < DEPTH and len(rows) >= 2 * LEAST:
        total, n = g.sum(), len(rows)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            size = np.cumsum(np.bincount(bins[rows, f], minlength=len(c) + 1))[:-1]
            part = np.cumsum(np.bincount(bins[rows, f], g, len(c) + 1))[:-1]
            ok = (size >= LEAST) & (n - size >= LEAST)
            gain = np.where(ok, part ** 2 / np.maximum(size, 1) + (total - part) ** 2 / np.maximum(n - size, 1) - total ** 2 / n, 0)
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (f, k)
    if split is None:
        step[rows] = g.mean()
        return
    f, k = split
    low = bins[rows, f] <= k
    _tree(bins, cuts, gradient, rows[low], (*path, (f, -1, k)), paths, step)
    _tree(bins, cuts, gradient, rows[~low], (*path, (f, 1, k)), paths, step)


def _bounds(path: tuple) -> tuple:
    """A path as the least and greatest bin of each of its statistics, so that equal conjunctions are equal."""
    box: dict = {}
    for f, sign, k in path:
        low, high = box.get(f, (-1, 1 << 30))
        box[f] = (max(low, k), high) if sign > 0 else (low, min(high, k))
    return tuple(sorted((f, *b) for f, b in box.items()))


def grow_rules(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray]) -> tuple[list[tuple], np.ndarray]:
    """The distinct paths of boosted trees, and which rows each holds for."""
    bins = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    rng, z, paths = np.random.default_rng(12), np.full(len(y), np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(TREES):
        residual = y - _sigmoid(z)
        rows = np.sort(rng.permutation(len(y))[:max(1, int(SHARE * len(y)))])
        grown: list = []
        _tree(bins, cuts, residual, rows, (), grown, np.zeros(len(y)))
        paths += grown
        leaves = [p for p in grown if not any(q[:len(p)] == p and len(q) > len(p) for q in grown)]
        for p in leaves:                                        # the leaf's Newton step, for rows in and out of the tree's share
            hold = _holds(bins, _bounds(p))
            used = rows[hold[rows]]
            weight = (lambda s: (s * (1 - s)).sum())(_sigmoid(z[used]))
            z[hold] += np.clip(RATE * residual[used].sum() / max(weight, 1e-3), -2, 2)
    rules = list(dict.fromkeys(_bounds(p) for p in paths))
    table = np.stack([_holds(bins, r) for r in rules], axis=1) if rules else np.zeros((len(y), 0), bool)
    _, first = np.unique(table, axis=1, return_index=True)      # of rules that hold for the same rows the first
    first = np.sort(first)
    return [rules[i] for i in first], table[:, first]


def _holds(bins: np.ndarray, rule: tuple) -> np.ndarray:
    out = np.ones(len(bins), bool)
    for f, low, high in rule:
        out &= (bins[:, f] > low) & (bins[:, f] <= high)
    return out


def lasso(table: np.ndarray, y: np.ndarray, penalty: float, w: np.ndarray, bias: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic weights under ``penalty * sum |w|`` by accelerated proximal gradient steps; the bias is free."""
    n, k = table.shape
    rate = 4 * n / max(np.linalg.norm(table, 2) ** 2 + n, 1e-9)
    v, b, t = w.copy(), bias, 1.0
    for _ in range(steps):
        g = _sigmoid(table @ v + b) - y
        new = v - rate * (table.T @ g) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = b - rate * g.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        if np.abs(new - w).max(initial=0) + abs(new_bias - bias) < 1e-6:
            return new, new_bias
        w, bias, t = new, new_bias, t_new
    return w, bias


def _loss(table, y, w, bias) -> float:
    p = np.clip(_sigmoid(table @ w + bias), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Rules from trees, weighted by the lasso."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        return Model(float(np.log(p / (1 - p))), ())
    cuts = _thresholds(x)
    rules, table = grow_rules(x, y, cuts)
    if not rules:
        return Model(float(np.log(y.mean() / (1 - y.mean()))), ())
    scale = np.sqrt(np.maximum(table.mean(axis=0) * (1 - table.mean(axis=0)), 1 / len(y)))
    scaled = (table / scale).astype(np.float64)                 # rules of any support pay alike
    top = np.abs(scaled.T @ (y - y.mean())).max() / len(y)
    apart = np.arange(len(y)) % 4 == 0                          # rows are in the order of their ids
    w, bias, best = np.zeros(len(rules)), float(np.log(y.mean() / (1 - y.mean()))), (np.inf, PENALTIES[0])
    if apart.all() or not 0 < y[~apart].mean() < 1:
        apart = np.zeros(len(y), bool)
    for share in PENALTIES:
        w, bias = lasso(scaled[~apart], y[~apart], share * top, w, bias)
        seen = apart if apart.any() else ~apart
        best = min(best, (_loss(scaled[seen], y[seen], w, bias), share))
    w, bias = lasso(scaled, y, best[1] * top, w, bias)
    kept = np.flatnonzero(w)
    return Model(float(bias), tuple(
        Rule(tuple((NAMES[f], float(cuts[f][low]) if low >= 0 else -np.inf, float(cuts[f][high]) if high < len(cuts[f]) else np.inf)
                   for f, low, high in rules[i]), float(w[i] / scale[i])) for i in kept))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; one projection."""
    return with_statistics(docs, ["doc_id"]).select("doc_id", model.column().alias("score"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted."""
    return score(docs, fit(*sample(docs, labels))).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= KEEP).cast("int").alias("predicted"))
