import random
import zlib

import numpy as np

from loadlens.llm import toxicity as X


def corpus(spark, docs, n=400):
    rnd = random.Random(5)
    bad = ["grumbo", "fleck", "nastor"]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randrange(30)) for _ in range(rnd.randrange(5, 60))]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words)))
        if rnd.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return rows, labels, bad


def test_held_out_accuracy_and_no_leak(spark, docs):
    rows, labels, bad = corpus(spark, docs, 1600)               # of 400 documents only 35 are known positives
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in X.toxicity(docs(rows), table).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    truth = {i: any(w in t.split() for w in bad) for i, t in rows}
    out = [i for i in got if got[i].held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0} == set(out)
    assert np.mean([got[i].predicted == truth[i] for i in out]) > 0.95
    # held-out labels are never read: turning them around changes nothing
    turned = spark.createDataFrame([(i, q, 1 - t if got[i].held_out else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in X.toxicity(docs(rows), turned).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_nulls_ties_and_empty_tables(spark, docs):
    rows = [(1, None), (2, ""), (None, "x"), (3, "word " * 40000), (3, "a")]
    labels = spark.createDataFrame([(1, 0, None), (None, 0, 1), (2, 0, 1), (2, 0, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = X.toxicity(docs(rows), labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert X.toxicity(docs(rows), labels.limit(0)).where("predicted = 1").count() == 0
    assert X.toxicity(docs([]), labels).count() == 0
    assert X.drop_toxic(docs(rows), labels.limit(0)).columns == docs(rows).columns


def test_risk_never_turns_negative():
    rnd = np.random.default_rng(1)
    pos = [np.unique(rnd.integers(0, 50, 8)) for _ in range(60)]
    unl = [np.unique(rnd.integers(20, 300, 8)) for _ in range(300)]
    m = X.fit(pos, unl, 0.2)
    score = lambda rows: np.array([1 / (1 + np.exp(-(m.weights[r].sum() + m.bias))) for r in rows])
    assert score(pos).mean() > 0.5 > score(unl).mean()
