import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from loadlens.llm import repeats as R


def brute(rows):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, d in data:
        if i is not None:
            for k in range(len(d) - 49):
                s = d[k:k + 50]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        if i is not None:
            for k in range(len(d) - 49):
                if first[d[k:k + 50]] < i:
                    gone[k:k + 50] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((i, len(d), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()) if len(d) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=50):
    rnd = random.Random(seed)
    letters = "abcdeé \n"
    text = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passages = [text(k) for k in (30, 49, 50, 51, 70, 120, 300)]
    line = text(60)
    rows = []
    for i in range(n):
        t = text(rnd.choice([0, 10, 60, 200]))
        for _ in range(rnd.randrange(4)):
            t += rnd.choice(passages) + text(rnd.choice([0, 1, 5, 40]))
        rows.append((i, t + (line + text(30) if i % 3 == 0 else "")))
    rows += [(n + 1, "a" * 400), (n + 2, "b" + "a" * 300 + "c"), (n + 3, rows[4][1]), (n + 4, ("xy" * 40 + "z") * 5)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("heavy", [0, 3, 256])
def test_equals_brute_force(docs, monkeypatch, heavy):
    monkeypatch.setattr(R, "HEAVY", heavy)                      # 0: all open anchors are dealt string by string
    monkeypatch.setattr(R, "ROWS", 20)
    rows = corpus(heavy) + [(None, "n" * 80), (900, None), (901, ""), (902, "n" * 80)]
    got = sorted((tuple(r)[:5] for r in R.remove_repeats(docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_equal_ids_do_not_remove_each_other(docs):
    t = "".join(chr(97 + i * i % 26) for i in range(90))
    got = sorted(tuple(r)[:3] for r in R.remove_repeats(docs([(1, t), (1, t), (2, "z" + t)])).collect())
    assert got == [(1, 90, 0), (1, 90, 0), (2, 91, 90)]
    assert R.remove_repeats(docs([])).count() == 0


def test_multikey_order_sorts_rows_of_words():
    rnd = np.random.default_rng(0)
    words = rnd.integers(0, 3, (500, 5)).astype(np.uint64)
    order, new = R.multikey_order(words)
    rows = [tuple(r) for r in words[order].tolist()]
    assert rows == sorted(rows)
    assert new.tolist() == [True] + [a != b for a, b in zip(rows, rows[1:])]


def test_kept_text_holds_the_rest(docs):
    shared = "shared passage that is long enough to be removed from the later one"
    rows = [(1, shared), (2, "before " + shared + " after")]
    got = {r.doc_id: r.kept_text for r in R.remove_repeats(docs(rows)).collect()}
    assert got == {1: None, 2: "before  after"} or got[2] == "before  after"


def passages(n, seed=5):
    """Documents of random letters that share a line whose surroundings differ everywhere."""
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice("abcdefgh ") for _ in range(k))
    line = text(64)
    return [(i, text(rnd.randrange(60)) + line + text(rnd.randrange(60, 120))) for i in rnd.sample(range(10 * n), n)]


@pytest.mark.parametrize("parts", [1, 40])
def test_strings_dealt_singly_equal_brute_force(docs, parts):
    rows = passages(700) + [(9000 + i, t) for i, t in corpus(1)] + [(9900, "x" * 70), (9901, "x" * 70)]
    d = docs(rows).repartition(parts).sortWithinPartitions("doc_id")
    got = sorted((tuple(r)[:5] for r in R.remove_repeats(d).collect()), key=str)
    assert got == brute(rows)


def packed(rows, buckets, monkeypatch, held):
    """The sieve's rows and a bucket's answers, without Spark."""
    monkeypatch.setattr(R, "HELD", held)

    class Docs:
        def mapInArrow(self, run, schema):
            t = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "th": pa.array([0] * len(rows), pa.int32()),
                          "text": pa.array([t for _, t in rows])})
            return pa.Table.from_batches(run(iter(t.to_batches(max_chunksize=100))))

    return R._sieve(Docs(), buckets)


def test_buckets_of_the_sieve_are_even(monkeypatch):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("abcdefgh") for _ in range(2000))) for i in range(200)]
    t = packed(rows, 50, monkeypatch, 1 << 18)
    size = np.zeros(50)
    for b, at in zip(t["bucket"].to_pylist(), t["at"].to_pylist()):
        size[b] += len(at or b"") // 4
    assert size.sum() > 10_000 and size.max() < 2 * size.mean()       # a third of all regions in the first one before


def test_an_anchor_with_very_many_regions_sends_one_sign(monkeypatch):
    rows = passages(700)
    t = packed(rows, 1, monkeypatch, 1 << 18)
    sizes = np.concatenate([np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel() for x in t["size"].drop_null().to_pylist()])
    assert 1 <= (sizes == 0).sum() <= 60
    told = np.concatenate([R._unmark(m) for m in R._answer(t)["marks"].to_pylist()])
    assert (told[:, 1] > 0).all() and (told[:, 2] == R.SINGLE).sum() > 700
