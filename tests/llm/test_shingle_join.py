import random
import re

import pytest

from loadlens.llm import shingle_join as J


def shingles(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def brute(rows):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text))
    flat = [(i, s) for i, ss in sets.items() for s in ss]
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, s) in enumerate(flat):
        for j, o in flat[:k]:
            if s and o and 100 * len(s & o) >= 75 * len(s | o):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sorted((i, len(shingles(t)), find(i)) for i, t in rows)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocab = ["w%d" % k for k in range(40)]
    common = " ".join(rnd.choice(vocab) for _ in range(20))
    rows = []
    for k in range(n):
        size = rnd.choice([1, 3, 5, 6, 9, 12, 20, 35, 60, 120])
        words = [rnd.choice(vocab) for _ in range(size)]
        rows.append([f"{' '.join(words)} {common}" if k % 3 == 0 else " ".join(words)])
        for _ in range(rnd.randrange(4)):                       # near copies around the threshold
            w = rows[-1][0].split()
            for _ in range(rnd.randrange(1 + len(w) // 12)):
                w[rnd.randrange(len(w))] = "new%d" % rnd.randrange(9)
            rows.append([" ".join(w) if rnd.random() < 0.7 else " ".join(w[:max(1, len(w) * 4 // 5)])])
    order = list(range(len(rows)))
    rnd.shuffle(order)
    return [(i, r[0]) for i, r in zip(order, rows)]


@pytest.mark.parametrize("light", [None, 0, 200])
def test_equals_brute_force_for_any_boundary(docs, monkeypatch, light):
    rows = corpus(1) + [(9000, None), (9001, ""), (9002, " \n "), (9003, "ONE two"), (9004, "one TWO"), (9005, "one")]
    if light is not None:
        monkeypatch.setattr(J, "boundary", lambda sizes: light)
    got = sorted(map(tuple, J.shingle_join(docs(rows)).collect()))
    assert got == brute(rows)


def test_threshold_is_inclusive(docs):
    a = [f"a{i}" for i in range(18)]                            # 14 shingles; 12 of 16 shared with b
    b = a[:16] + ["x", "y"]
    assert len(shingles(" ".join(a)) & shingles(" ".join(b))) * 100 == 75 * len(shingles(" ".join(a)) | shingles(" ".join(b)))
    got = sorted(map(tuple, J.shingle_join(docs([(1, " ".join(a)), (2, " ".join(b))])).collect()))
    assert got == [(1, 14, 1), (2, 14, 1)]


def test_repeated_rows_and_empty_table(docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (4, "q")]
    assert sorted(map(tuple, J.shingle_join(docs(rows)).collect())) == [(3, 2, 3), (4, 1, 4), (5, 2, 3), (5, 2, 3)]
    assert J.shingle_join(docs([])).count() == 0
    assert sorted(r.doc_id for r in J.keep_one(docs(rows)).collect()) == [3, 4]


def test_long_texts(docs):
    long = " ".join("w%d" % (i * i % 9973) for i in range(30000))
    got = sorted(map(tuple, J.shingle_join(docs([(1, long), (2, long + " tail")])).collect()))
    assert [r[2] for r in got] == [1, 1]
