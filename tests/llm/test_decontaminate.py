import random

import numpy as np

from loadlens.llm import decontaminate as D


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 1.0) for i, t in rows], "item_id long, text string, score double")


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_the_plain_recurrence():
    g = np.random.default_rng(1)
    items = g.integers(10, 16, (30, 12)).astype(np.uint64)
    windows = g.integers(10, 16, (30, 25)).astype(np.uint64)
    assert D.align(items, windows).tolist() == [plain_align(a, b) for a, b in zip(items.tolist(), windows.tolist())]


def test_exact_and_edited_copies_are_found_and_clean_texts_left(spark, docs):
    rnd = random.Random(2)
    vocab = [a + b for a in "th er on re an in ti".split() for b in "ha es ou ea st ly ble nd".split()]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, say(rnd.randrange(15, 60))) for k in range(30)] + [(30, say(300)), (31, "too short"), (32, None), (33, "")]
    items.append((34, items[0][1]))
    rows, want = [], set()
    for i in range(150):
        text = say(rnd.randrange(0, 300))
        if i % 3 == 0:
            k = rnd.randrange(31)
            copy = items[k][1].split()
            for _ in range(len(copy) // 8 if i % 2 else 0):     # one word in eight replaced
                copy[rnd.randrange(len(copy))] = "changed"
            text = f"{text} {' '.join(copy).upper()}. {say(20)}"
            want |= {(i, k)} | ({(i, 34)} if k == 0 else set())
        rows.append((i, text))
    rows += [(900, None), (901, "")]
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(docs(rows), bench(spark, items)).collect()}
    assert set(got) == want
    kept = D.drop_contaminated(docs(rows), bench(spark, items))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want} and kept.columns == docs(rows).columns


def test_blocks_change_nothing(spark, docs, monkeypatch):
    rnd = random.Random(7)
    items = [(k, " ".join(f"v{rnd.randrange(50)}" for _ in range(20))) for k in range(9)]
    rows = [(k, "start here " + t + " end") for k, t in items] + [(50, "nothing of it")]
    want = {(k, k) for k, _ in items}
    for size in (2, 100):
        monkeypatch.setattr(D, "BLOCK", size)
        assert {(r.doc_id, r.item_id) for r in D.contaminated(docs(rows), bench(spark, items)).collect()} == want


def test_passage_in_every_document_and_empty_tables(spark, docs):
    item = " ".join(f"q{k}" for k in range(30))
    rows = [(i, f"a{i} b{i} {item} c{i}") for i in range(40)]
    got = D.contaminated(docs(rows), bench(spark, [(1, item)])).collect()
    assert len(got) == 40 and all(r.score == 1 for r in got)
    assert D.contaminated(docs(rows), bench(spark, [])).count() == 0
    assert D.contaminated(docs([]), bench(spark, [(1, item)])).count() == 0


def test_every_copy_that_scores_enough_is_found(spark, docs):
    rnd = random.Random(11)
    item = [f"w{k}" for k in range(64)]
    rows = []
    for a, n in ((0, 26), (20, 28), (32, 32)):                  # passages of 0.41 to 0.5 of the segment
        rows.append([f"x{k}" for k in range(40)] + item[a:a + n] + [f"y{k}" for k in range(40)])
    for start in range(5):                                      # one word in five replaced
        rows.append([f"z{k}" if k % 5 == start else w for k, w in enumerate(item)])
    rows += [[f"r{k}" if rnd.random() < share else w for k, w in enumerate(item)] for share in (0.2, 0.25, 0.3) for _ in range(40)]
    size = len(item)
    want = {i: plain_align(item, r) / size for i, r in enumerate(rows)}
    want = {i: s for i, s in want.items() if s >= 0.4}
    assert len(want) > 60 and set(range(8)) <= set(want)
    table = [(i, " ".join(r)) for i, r in enumerate(rows)]
    # alone, and beside exact copies, which make every gram present and the kept ones the commoner
    for extra in ([], [(1000 + k, " ".join(item)) for k in range(3)]):
        got = {r.doc_id: r.score for r in D.contaminated(docs(table + extra), bench(spark, [(1, " ".join(item))])).collect()}
        assert got == want | {i: 1.0 for i, _ in extra}


def test_words_held_bound_the_alignment():
    g = np.random.default_rng(4)
    items = g.integers(10, 30, (200, 12)).astype(np.uint64)
    windows = g.integers(10, 30, (200, 25)).astype(np.uint64)
    assert (D.held(items, windows) >= D.align(items, windows)).all()
