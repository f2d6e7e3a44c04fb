import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from loadlens.llm import rule_quality as Q
from loadlens.llm import texts as T


def corpus(spark, docs, n=700):
    r = np.random.default_rng(7)
    vocabulary = ["".join(r.choice(list("abcdefghilmnoprstu"), 3 + k % 7)) for k in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = r.choice(vocabulary, 20 + int(r.integers(0, 80))).tolist()
        kind = i % 6
        if kind == 0:
            words = [words[0]] * len(words)
        elif kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words) + ".", "abc"[i % 3]))
        if i % 4:
            labels.append((i, int(kind > 1), 0))
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: i % 6 > 1 for i in range(n)}


def test_held_out_accuracy_and_no_leak(spark, docs):
    table, labels, truth = corpus(spark, docs)
    got = {r.doc_id: r for r in Q.quality(table, labels).collect()}
    assert len(got) == 700 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    out = [i for i in got if got[i].held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0} == set(out)
    assert np.mean([got[i].predicted == truth[i] for i in out]) > 0.98
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = table.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q"))
    assert {r.doc_id: r for r in Q.quality(moved, flipped).collect()} == got


def test_odd_rows(spark, docs):
    table, labels, _ = corpus(spark, docs, 120)
    odd = docs([(None, "some words here"), (900, None), (901, ""), (902, "x" * 3_000_000), (903, " \t\n "), (5, "Five again!!")])
    clash = table.union(odd).withColumn("score", F.lit("s")).withColumn("stat_words", F.lit(1)).withColumn("_quality", F.lit(2))
    more = labels.union(spark.createDataFrame([(5, None, 0), (None, 1, 0), (77777, 0, 0), (5, 1, 0)], labels.schema))
    got = Q.quality(clash, more).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 126 and by[900] == by[901] and not [r for r in got if r.doc_id is None][0].held_out
    assert all(0 <= r.score <= 1 for r in got)
    nothing = Q.quality(table, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in nothing} == {0.5} and len(nothing) == 120
    good = Q.quality(table, labels.withColumn("quality", F.lit(1))).collect()
    assert {r.predicted for r in good} == {1}
    assert Q.quality(table.limit(0), labels).count() == 0


def test_statistics_equal_plain_counts():
    texts = ["", "Ab c.  c. c.\nAb\n\nAb", "ÄÖ 12 3x!! ## a,b !", "\n", "one", "  lead and trail  \n", "x\ny\nx"]
    raw = [t.encode() for t in texts]
    got = Q.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, row in zip(texts, got):
        s = dict(zip(Q.NAMES, row))
        words = [w for w in re.split(r"[ \t-\r]+", t) if w]
        low = [w.lower() if w.isascii() else w for w in words]
        lines = (t[:-1] if t.endswith("\n") else t).split("\n") if t else []
        n = max(len(words), 1)
        assert s["chars"] == len(t) and s["words"] == len(words) and s["lines"] == len(lines)
        assert np.isclose(s["distinct_words"], len(set(low)) / n) and np.isclose(s["distinct_lines"], len(set(lines)) / max(len(lines), 1))
        assert np.isclose(s["repeated_words"], sum(a == b for a, b in zip(low, low[1:])) / n)
        assert np.isclose(s["commonest_word"], max((low.count(w) for w in low), default=0) / n)
        assert np.isclose(s["capitals"], sum("A" <= c <= "Z" for c in t) / max(len(t), 1))
        assert s["longest_word"] == max((len(w.encode()) for w in words), default=0)
        plain = re.compile(r"[^\W\d_]+[.,]?")
        assert np.isclose(s["plain_words"], sum(bool(plain.fullmatch(w)) for w in words) / n)
        symbol = re.compile(r"[!-+\-/:-@\[-`{-~]")
        assert np.isclose(s["symbols"], len(symbol.findall(t)) / max(len(t), 1))
        assert np.isclose(s["marked_words"], sum(len(w) > 1 and bool(symbol.fullmatch(w[-1]) and symbol.fullmatch(w[-2])) for w in words) / n)
        assert np.isclose(s["bare_symbols"], sum(not re.search(r"\w", w) for w in words) / n)


def test_compiled_rules_equal_numpy(spark):
    """The Spark column gives what the rules say, and the lasso leaves most of the grown rules out."""
    r = np.random.default_rng(8)
    x = r.random((800, len(Q.NAMES)))
    y = ((x[:, 3] > 0.6) & (x[:, 5] < 0.5)).astype(float)
    model = Q.fit(x, y)
    grown = Q.grow_rules(x, y, Q._thresholds(x))[0]
    assert 0 < len(model.rules) < len(grown) / 2
    logit = np.full(800, model.bias)
    for rule in model.rules:
        hold = np.ones(800, bool)
        for name, low, high in rule.bounds:
            v = x[:, Q.NAMES.index(name)]
            hold &= (v > low) & (v <= high)
        logit += rule.weight * hold
    want = 1 / (1 + np.exp(-logit))
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], ["i", *[f"stat_{n}" for n in Q.NAMES]])
    got = df.select("i", model.column().alias("p")).orderBy("i").toPandas().p.to_numpy()
    assert np.allclose(got, want) and np.mean((got >= 0.5) == y) > 0.97


def test_lasso_reaches_its_optimum():
    """At the optimum the gradient is the penalty on kept weights and at most the penalty on the others."""
    r = np.random.default_rng(9)
    x = (r.random((400, 12)) < 0.4).astype(float)
    y = (r.random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1])))).astype(float)
    w, b = Q.lasso(x, y, 0.02, np.zeros(12), 0.0, 5000)
    g = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) / 400
    assert np.allclose(g[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-4) and (np.abs(g[w == 0]) <= 0.0201).all() and (w == 0).any()


def test_slices_do_not_change_statistics():
    texts = ["Some words!! here", "again again again", "", "Ü ü\nÜ"] * 5
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    every = Q.statistics(data, off)
    for i, t in enumerate(raw):
        assert np.allclose(Q.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)])), every[i:i + 1])
    assert T.SLICE_BYTES > 0
