import hashlib
import math

import duckdb
import numpy as np
import pytest

from loadlens.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def brute(rows):
    """All parts against all entries in every round, with Python's integers."""
    kept = [(i, [math.floor(V.SCALE * v) if abs(v) < 2 ** 52 else int(v) * V.SCALE for v in e], lab) for i, e, lab in rows
            if e is not None and all(v is not None and math.isfinite(v) for v in e)]
    dim = max(len(x) for _, x, _ in kept)
    width = -(-dim // 8)
    kept = [(i, x + [0] * (8 * width - len(x)), lab) for i, x, lab in kept]
    first = {}
    for i, x, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, x), x)
    starts = [first[i] for i in sorted(first)[:16]]
    books = [[s[p * width:(p + 1) * width] for s in starts] for p in range(8)]

    def nearest(x, p):
        d = [sum((a - b) ** 2 for a, b in zip(x[p * width:(p + 1) * width], e)) for e in books[p]]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)
    for _ in range(6):
        new = []
        for p in range(8):
            got = {}
            for _, x, _ in kept:
                got.setdefault(nearest(x, p)[0], []).append(x[p * width:(p + 1) * width])
            new.append([[sum(c) // len(got[j]) for c in zip(*got[j])] if j in got else e for j, e in enumerate(books[p])])
        books = new
    out, by = [], {}
    for i, x, lab in kept:
        got = [nearest(x, p) for p in range(8)]
        out.append((i, "".join(f"{j:02x}" for j, _ in got), min(sum(d for _, d in got), 2 ** 63 - 1), lab))
        by[lab] = by.get(lab, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()
    return sorted(((i, c, d, min(by[lab], 2 ** 63 - 1), sha) for i, c, d, lab in out), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, e, lab, "x") for i, e, lab in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, V.compress(df).collect()), key=str)


@pytest.mark.parametrize("block", [1 << 18, 200])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK_VALUES", block)
    r = np.random.default_rng(3)
    x = r.standard_normal((120, 16)) * r.uniform(0.1, 3, (120, 1))
    x[40:70] = x[40]                                            # copies
    rows = [(int(i * 7 % 241), v.tolist(), int(k)) for i, v, k in zip(range(120), x, r.integers(0, 3, 120))]
    rows += [(500, rows[3][1], None), (501, rows[4][1], None)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    """Nulls, NaN, short and empty vectors, repeated and null ids, huge components."""
    rows = [(1, [1.0] * 9, 1), (2, None, 1), (3, [1.0, None], 1), (4, [float("nan")] * 9, 1), (5, [float("-inf")], 1), (6, [], None),
            (7, [-2.5, 3.25], None), (7, [-2.5, 3.0], 2), (None, [0.1] * 9, 2), (8, [1e30] * 9, 3), (9, [-1e300] + [0.0] * 8, 3)]
    assert run(spark, rows) == brute(rows)
    few = [(5, [0.5, 0.25], 1)]
    assert run(spark, few) == brute(few)
    assert run(spark, [(None, [1.0], 1), (3, None, 1)]) == []
    assert V.compress(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = V.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(V.SQL).fetchall())


def _lloyd(x, books):
    width = x.shape[1] // 8
    return np.stack([((x[:, None, p * width:(p + 1) * width] - books[p]) ** 2).sum(axis=2).argmin(axis=1) for p in range(8)], axis=1)


def test_bounds_spare_comparisons_and_net_moves_are_tighter():
    """Codes equal plain assignment in every round, with few exact rescans; an entry's net move is at most its summed moves."""
    r = np.random.default_rng(5)
    centres = r.integers(-4000, 4000, (16, 32))
    x = (centres[r.integers(0, 16, 3000)] + r.integers(-900, 900, (3000, 32))).astype(np.int64)
    history = [[[x[j, p * 4:(p + 1) * 4].tolist() for j in range(16)] for p in range(8)]]
    s, scans = V.State(len(x)), []
    for _ in range(7):
        books = V.Codebooks(history, 4, V.X.largest(x))
        before = s.all
        V.assign(x, s, books)
        scans.append(s.all - before)
        code = s.code
        assert (code == _lloyd(x, books.now)).all()
        new = [[[int(v) for v in x[code[:, p] == j, p * 4:(p + 1) * 4].sum(axis=0) // max(1, (code[:, p] == j).sum())]
                if (code[:, p] == j).any() else history[-1][p][j] for j in range(16)] for p in range(8)]
        history.append(new)
    assert scans[0] == 8 * len(x) and sum(scans[1:]) < 0.5 * 6 * scans[0] and scans[-1] < 0.3 * scans[0]
    h = np.array(history, float)
    steps = np.sqrt(((h[1:] - h[:-1]) ** 2).sum(axis=3))
    net = V.Codebooks(history, 4, 4000).moved
    drift = np.cumsum(steps[::-1], axis=0)[::-1]
    assert (net[:-1] <= drift * (1 + 1e-8)).all() and (net[:-1] < 0.95 * drift).any()
