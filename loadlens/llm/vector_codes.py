"""Operator 11: vector code compression by exact whole-number k-means per part, with norm-of-sum bounds.

Every component x becomes the integer ``floor(4096 * x)``; vectors are cut
into 8 equal parts, and each part position has a codebook of 16 entries, which
starts as that part of the 16 smallest vec_ids.  Six rounds assign every part
to its nearest entry and replace the entries by the floored means of their
parts; then every part is assigned once more.

A round seldom compares a part with all entries.  For each part it keeps the
distance to its own entry and the distance to the second nearest one, each
with the round in which it was measured (its stamp).  All codebooks so far are
kept too, so an entry's true displacement since a bound's stamp is the norm of
the summed moves, ``|c(now) - c(stamp)|``, never more than the sum of the
moves' norms.  The own distance grows by the own entry's displacement at most,
the others shrink by the largest displacement of another entry; a part whose
bounds stay apart keeps its code.  Else the own distance is measured anew, and
only if the bounds still meet are all entries compared, exactly, in integers,
with ties to the lower index.

Vectors travel in blocks, one row each, from one round's stored table to the
next; nothing is shuffled but sums: a round returns what its changed parts
take from their old entry and give to the new one.

Rows whose vector is null or holds a null, NaN or infinite component are
dropped.  A vector shorter than the longest one counts as filled up with
zeros, and so does a dimension that 8 doesn't divide; an empty vector is all
zeros.  Of repeated rows of one vec_id the least vector starts an entry, all of
them are coded; a null vec_id is coded but starts no entry; with fewer than
16 vec_ids the codebooks have fewer entries, without any there is no row.
Integers of any size are handled exactly; an error over the largest long is
reported as the largest long.  Equal labels are added up, nulls together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadlens.llm import exact as X
from loadlens.llm.tables import discard, store
from loadlens.operators.ordering import join_keys

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of one block (a row of the stored table).
BLOCK_VALUES = 1 << 18
#: Covers the rounding of square roots and of their sums in double precision.
SLACK = 1e-9
_MAX = (1 << 63) - 1
_STATE = "code binary, near_at binary, next_at binary, near binary, next binary"
_SUMS = "sums array<struct<part:int,entry:int,pos:int,shift:int,value:bigint>>"


def encode(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the least width that holds them: its type letter and the bytes (beyond 64 bits: text)."""
    if x.dtype == object:
        return "O", ",".join(map(str, x.ravel().tolist())).encode()
    most = X.largest(x)
    kind = "h" if most < 1 << 15 else "i" if most < 1 << 31 else "q"
    return kind, x.astype(kind).tobytes()


def decode(kind: str, data: bytes, rows: int, dim: int, width: int) -> np.ndarray:
    """The block's integers, ``width`` components wide (filled up with zeros)."""
    if kind == "O":
        x = np.empty(rows * dim, object)
        x[:] = [int(v) for v in data.split(b",")]
    else:
        x = np.frombuffer(data, kind).astype(np.int64)
    out = np.zeros((rows, width), x.dtype)
    out[:, :dim] = x.reshape(rows, dim)
    return out


def _least(ids: pa.Array, x: np.ndarray) -> tuple[list, list]:
    """The smallest vec_ids of a block, each with its least vector."""
    first: dict = {}
    known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), bool)
    order = np.asarray(ids.fill_null(0))
    small = np.unique(order[known])[:ENTRIES]
    for row in np.flatnonzero(known & np.isin(order, small)).tolist():
        v = x[row].tolist()
        first[int(order[row])] = min(first.get(int(order[row]), v), v)
    return list(first), list(first.values())


def blocks(vectors: DataFrame) -> DataFrame:
    """One row per block of vectors of one dimension, with the block's smallest vec_ids and their vectors."""
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>"))
    schema = StructType.fromDDL(f"dim long, kind string, ids array<long>, labels array<{rows.schema['label'].dataType.simpleString()}>, "
                                "x binary, least_ids array<long>, least array<array<double>>")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if not t.num_rows:
                continue
            keep, off, values = X.finite_rows(t.column("embedding"))
            size = np.diff(off)
            for dim in np.unique(size[keep]).tolist():
                chosen, step = np.flatnonzero(keep & (size == dim)), max(1, BLOCK_VALUES // max(dim, 1))
                for at in range(0, len(chosen), step):
                    some = chosen[at:at + step]
                    x = values[off[some][:, None] + np.arange(dim)]
                    ids, labels = t.column("vec_id").take(some), t.column("label").take(some)
                    kind, data = encode(X.floors(x, SCALE))
                    least_ids, least = _least(ids, x)
                    n = pa.array([0, len(some)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int64()), pa.array([kind]), pa.ListArray.from_arrays(n, ids), pa.ListArray.from_arrays(n, labels),
                         pa.array([data], pa.binary()), pa.array([least_ids], pa.list_(pa.int64())),
                         pa.array([least], pa.list_(pa.list_(pa.float64())))], names=schema.names)

    return rows.mapInArrow(pack, schema)


def first_codebook(packed: DataFrame) -> tuple[list, int]:
    """Part by part the entries that the smallest vec_ids start, and the components of a part."""
    width = -(-(packed.agg(F.max("dim")).first()[0] or 0) // PARTS)
    least = (packed.select(F.explode(F.arrays_zip("least_ids", "least")).alias("f"))
             .groupBy(F.col("f.least_ids").alias("vec_id")).agg(F.min("f.least").alias("x")).orderBy("vec_id").limit(ENTRIES))
    entries = []
    for r in least.collect():
        whole = X.floors(np.array(r["x"], np.float64), SCALE).tolist()
        entries.append([int(v) for v in whole] + [0] * (PARTS * width - len(whole)))
    return [[e[p * width:(p + 1) * width] for e in entries] for p in range(PARTS)], width


class Codebooks:
    """The codebooks of all rounds so far as arrays, and the entries' true displacements."""

    def __init__(self, history: list, width: int, most: int):
        """``most``: the largest absolute component of the vectors they are compared with."""
        flat = [v for part in history[-1] for e in part for v in e]
        most = max([most, *map(abs, flat)])
        #: Whether all sums of squares stay below 2 ** 62.
        self.plain = 4 * most * most * max(width, 1) < 1 << 62
        dtype = np.int64 if self.plain else object
        self.now = [np.array(part, dtype).reshape(len(part), width) for part in history[-1]]
        self.round = len(history) - 1
        if self.plain:
            before = np.array(history, np.float64)              # rounds, parts, entries, components
            self.moved = np.sqrt(((before - before[-1:]) ** 2).sum(axis=3)) * (1 + SLACK)
            #: Largest displacement of another entry, by round, part and own entry.
            self.others = np.zeros_like(self.moved)
            for j in range(self.moved.shape[2]):
                rest = np.delete(self.moved, j, axis=2)
                self.others[:, :, j] = rest.max(axis=2) if rest.shape[2] else 0


class State:
    """Codes of a block's parts, and the two bounds of each with their stamps."""

    def __init__(self, rows: int, row: dict | None = None):
        def read(name, dtype):
            return np.frombuffer(row[name], dtype).reshape(rows, PARTS).copy() if row else np.zeros((rows, PARTS), dtype)
        self.fresh = row is None
        self.code, self.near_at, self.next_at = (read(c, np.uint8) for c in ("code", "near_at", "next_at"))
        self.near, self.next = (read(c, np.float32) for c in ("near", "next"))
        #: How many parts were compared with their own entry, and with all.
        self.own = self.all = 0

    def columns(self) -> list[bytes]:
        return [a.tobytes() for a in (self.code, self.near_at, self.next_at, self.near, self.next)]


def _up(x):
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x):
    return np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(0))


def assign(x: np.ndarray, s: State, books: Codebooks) -> None:
    """Bring the codes of a block up to the newest codebook."""
    width = x.shape[1] // PARTS
    for p in range(PARTS):
        part, now, code = x[:, p * width:(p + 1) * width], books.now[p], s.code[:, p]
        rows = np.arange(len(x))
        if not s.fresh and books.plain:
            lower = s.next[:, p] - books.others[s.next_at[:, p], p, code]
            upper = s.near[:, p] + books.moved[s.near_at[:, p], p, code]
            rows = np.flatnonzero(upper * (1 + SLACK) >= lower)
            s.own += len(rows)
            near = _up(np.sqrt(((part[rows] - now[code[rows]]) ** 2).sum(axis=1)))
            s.near[rows, p], s.near_at[rows, p] = near, books.round
            rows = rows[near * (1 + SLACK) >= lower[rows]]
        s.all += len(rows)
        for at in range(0, len(rows), 4096):                    # bounds the table of differences
            some = rows[at:at + 4096]
            d = ((part[some][:, None, :] - now) ** 2).sum(axis=2)
            s.code[some, p] = best = np.argmin(d, axis=1)       # the first of equal ones
            if books.plain:
                here = np.arange(len(some))
                s.near[some, p] = _up(np.sqrt(d[here, best]))
                if len(now) > 1:
                    d[here, best] = _MAX
                    s.next[some, p] = _down(np.sqrt(d.min(axis=1)))
                else:
                    s.next[some, p] = np.inf
                s.near_at[some, p] = s.next_at[some, p] = books.round
    s.fresh = False


def _changes(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, entries: int) -> list[tuple]:
    """``(part, entry, pos, shift, value)``: what the changed parts add to and take from the entries' sums (pos -1: their number)."""
    width, out = x.shape[1] // PARTS, []
    for p in range(PARTS):
        total = np.zeros((entries, width + 1), x.dtype)
        moved = np.arange(len(x)) if old is None else np.flatnonzero(old[:, p] != new[:, p])
        part = np.concatenate([x[moved, p * width:(p + 1) * width], np.ones((len(moved), 1), x.dtype)], axis=1)
        np.add.at(total, new[moved, p], part)
        if old is not None:
            np.subtract.at(total, old[moved, p], part)
        for j, pos in zip(*np.nonzero(total)):
            out += [(p, int(j), int(pos) if pos < width else -1, *limb) for limb in X.limbs(int(total[j, pos]))]
    return out


def _round(table: DataFrame, history: list, width: int) -> DataFrame:
    """The blocks with their state after one more assignment, and the changes of the entries' sums."""
    kept = ["dim", "kind", "ids", "labels", "x"]
    schema = StructType([*(table.schema[c] for c in kept), *StructType.fromDDL(f"{_STATE}, {_SUMS}")])
    state = StructType.fromDDL(_STATE).names
    started, entries = state[0] in table.columns, len(history[0][0])
    kind = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("pos", pa.int32()), ("shift", pa.int32()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for k in range(t.num_rows):
                row = t.slice(k, 1)
                x, books = _open(row, history, width)
                s = State(len(x), {c: row.column(c)[0].as_py() for c in state} if started else None)
                old = s.code.copy() if started else None
                assign(x, s, books)
                names = ("part", "entry", "pos", "shift", "value")
                sums = [dict(zip(names, change)) for change in _changes(x, old, s.code, entries)]
                yield pa.RecordBatch.from_arrays(
                    [row.column(c) for c in kept] + [pa.array([b], pa.binary()) for b in s.columns()] + [pa.array([sums], kind)],
                    names=schema.names)

    return table.select(*kept, *(state if started else [])).mapInArrow(run, schema)


def _open(row: pa.RecordBatch, history: list, width: int) -> tuple[np.ndarray, Codebooks]:
    dim, n = row.column("dim")[0].as_py(), len(row.column("ids")[0])
    x = decode(row.column("kind")[0].as_py(), row.column("x")[0].as_py(), n, dim, PARTS * width)
    books = Codebooks(history, width, X.largest(x))
    return (x if books.plain else x.astype(object)), books


def _coded(table: DataFrame, history: list, width: int) -> DataFrame:
    """``(vec_id, label, code, error)`` by the last codebook, one row per vector."""
    label = table.schema["labels"].dataType.elementType.simpleString()
    schema = StructType.fromDDL(f"vec_id long, label {label}, code string, error long")
    state = StructType.fromDDL(_STATE).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for k in range(t.num_rows):
                row = t.slice(k, 1)
                x, books = _open(row, history, width)
                s = State(len(x), {c: row.column(c)[0].as_py() for c in state})
                assign(x, s, books)
                own = np.concatenate([books.now[p][s.code[:, p]] for p in range(PARTS)], axis=1)
                error = ((x.astype(object) - own) ** 2).sum(axis=1) if not books.plain or X.largest(x) >= 1 << 28 else ((x - own) ** 2).sum(axis=1)
                text = s.code.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [row.column("ids").flatten(), row.column("labels").flatten(),
                     pa.array([text[2 * PARTS * i:2 * PARTS * (i + 1)] for i in range(len(x))], pa.string()),
                     pa.array([min(int(e), _MAX) for e in error.tolist()], pa.int64())], names=schema.names)

    return table.select("dim", "kind", "ids", "labels", "x", *state).mapInArrow(run, schema)


def compress(vectors: DataFrame) -> DataFrame:
    """One row per coded vector: vec_id, code, error, label_error, codebooks_sha256."""
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    table = store(blocks(vectors), "code-blocks")
    book, width = first_codebook(table)
    if not book[0]:
        return vectors.sparkSession.createDataFrame([], out)
    history = [book]
    sums: dict = {}
    for _ in range(ROUNDS):
        last, table = table, store(_round(table, history, width), "code-round")
        discard(last)
        changes = (table.select(F.explode("sums").alias("s")).groupBy("s.part", "s.entry", "s.pos", "s.shift")
                   .agg(F.sum("s.value").alias("value")))
        for key, v in X.total(changes.collect()).items():      # a row per part, entry, component and limb
            sums[key] = sums.get(key, 0) + v
        history.append([[[sums.get((p, j, i), 0) // n for i in range(width)] if (n := sums.get((p, j, -1), 0)) else entry
                         for j, entry in enumerate(part)] for p, part in enumerate(history[-1])])
    coded = store(_coded(table, history, width), "codes")
    discard(table)
    text = ",".join(str(v) for part in history[-1] for entry in part for v in entry)
    by_label = coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return (join_keys(coded, by_label, ["label"])
            .select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")))


def _sql() -> str:
    """DuckDB SQL of :func:`compress` for vectors of one dimension and unique ids."""
    steps = [f"""kept AS (SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, floor({SCALE} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, pos, x FROM parts JOIN firsts USING (vec_id))"""]
    nearest = """codes{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM
  (SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d FROM parts p JOIN book{r} b USING (part, pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""
    for r in range(ROUNDS):
        steps += [nearest.format(r=r), f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN
  (SELECT part, entry, pos, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
   FROM parts JOIN codes{r} USING (vec_id, part) GROUP BY part, entry, pos) m USING (part, entry, pos))"""]
    steps += [nearest.format(r=ROUNDS), f"""coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM codes{ROUNDS} GROUP BY vec_id)"""]
    return ("WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)""")


SQL = _sql()
