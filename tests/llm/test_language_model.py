import collections
import math
import re
import zlib

import numpy as np

from loadlens.llm import language_model as L
from loadlens.llm.recurrent import Recurrent, class_of


def words(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_counts_and_base_scores_equal_brute_force(docs):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(i % 40))) for i in range(80)] + [(200, None), (None, "w1 W1 new"), (3, "w0 w0")]
    got = L.score_documents(docs(rows)).collect()
    c = collections.Counter()
    for i, t in rows:
        if not held(i):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6))
                   for i, t in rows), key=str)
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)


def test_held_out_documents_score_above_the_unigram_base(spark, sf):
    got = L.score_documents(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out").toPandas()
    assert len(got) > 10 and got.score.sum() > got.base_score.sum()


def test_empty_table_and_only_held_out(docs):
    assert L.score_documents(docs([])).count() == 0
    only = next(i for i in range(100) if held(i))
    (r,) = L.score_documents(docs([(only, "a b")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_probabilities_sum_to_one_and_state_is_carried():
    m = Recurrent(100)
    m.prime(np.arange(100, 0, -1).astype(float))
    h = np.random.default_rng(1).standard_normal((1, 16)).astype(np.float32)
    assert abs(np.exp(m.log_prob(np.repeat(h, 100, axis=0), np.arange(100))).sum() - 1) < 1e-5
    assert class_of(np.array([0, 1, 32, 33])).tolist() == [0, 1, 1, 2]
    tokens = np.random.default_rng(2).integers(0, 100, 90)
    state, total, last = np.zeros((1, 16), np.float32), 0.0, 7
    for t in tokens:
        state, _ = m.step(np.array([last]), state)
        total += m.log_prob(state, np.array([t]))[0]
        last = t
    both = m.score(np.concatenate([tokens, tokens[:5]]), np.array([0, 90, 95]), 7)
    assert abs(both[0] - total) < 1e-3


def test_gradient_matches_finite_differences():
    m = Recurrent(40, seed=3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    g = np.random.default_rng(0)
    before, target = g.integers(0, 40, (4, 3)), g.integers(0, 40, (4, 3))
    _, grad, _ = m.gradient(before, target, np.zeros((3, 16)), 5)
    for k in ("E", "U", "C", "W", "c", "w"):
        flat = m.p[k].reshape(-1)
        at = int(np.argmax(np.abs(grad[k].reshape(-1))))
        keep, step = flat[at], 1e-3
        losses = []
        for s in (step, -step):
            flat[at] = keep + s
            losses.append(m.gradient(before, target, np.zeros((3, 16)), 5)[0])
        flat[at] = keep
        assert abs((losses[0] - losses[1]) / (2 * step) - grad[k].reshape(-1)[at]) < 2e-3
