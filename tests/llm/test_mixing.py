import collections
import random

import pytest

from loadlens.llm import mixing as M


def rows_of(seed=3):
    rnd = random.Random(seed)
    sizes = {"a": 900, "b": 300, "c": 120, None: 41, "e": 3}
    rows = [(s, k) for s, n in sizes.items() for k in range(n)]
    rnd.shuffle(rows)
    return [(i, "t", s) for i, (s, _) in enumerate(rows)]


def plain(blocks, quota):
    """Slot by slot over the whole mix, the same rules without plans."""
    order, done = [], collections.Counter()
    cycle = 0
    while any(done[s] < blocks[s] for s in blocks):
        m = {s: min(quota[s], blocks[s] - cycle * quota[s]) for s in blocks}
        m = {s: k for s, k in m.items() if k > 0}
        q, own = sum(m.values()), collections.Counter()
        for t in range(1, q + 1):
            due = [((own[s] + 1) * q + m[s] - 1) // m[s] for s in m if own[s] < m[s] and own[s] * q // m[s] < t]
            assert due
            best = min(due)
            order.append({s for s in m if own[s] < m[s] and own[s] * q // m[s] < t and ((own[s] + 1) * q + m[s] - 1) // m[s] == best})
            assert best >= t
            yield order[-1], (own, m, q, t, done)
        cycle += 1


@pytest.mark.parametrize("weights", [None, {"a": 1.0, "b": 5.0, "c": 2.0}])
def test_all_rows_once_in_slots_that_follow_the_weights(spark, docs, weights, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 100)
    df = docs(rows_of())
    got = M.mix(df, weights, block=4, cycle=40).collect()
    assert sorted(r.doc_id for r in got) == list(range(df.count()))
    slots = collections.defaultdict(set)
    places = collections.defaultdict(list)
    for r in got:
        slots[r.mix_slot].add((r.source, r.mix_block))
        places[r.mix_slot].append(r.mix_place)
    assert sorted(slots) == list(range(len(slots))) and all(len(v) == 1 for v in slots.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    order = [next(iter(slots[k])) for k in sorted(slots)]
    per = collections.defaultdict(list)
    for s, b in order:
        per[s].append(b)
    assert all(v == list(range(len(v))) for v in per.values())  # a source's blocks in their order
    # less than a block from the shares while all sources last
    sizes = spark.createDataFrame([(s, len(v)) for s, v in per.items()], "s string, blocks long")
    quota = {r.s: r.quota for r in M._quotas(sizes, weights, 40).collect()}
    total = sum(quota.values())
    full = min(len(per[s]) // quota[s] for s in per) * total
    seen = collections.Counter()
    for t, (s, _) in enumerate(order[:full], 1):
        seen[s] += 1
        assert all(abs(seen[x] - t * quota[x] / total) < 1 for x in quota)


def test_plan_meets_every_deadline(spark):
    sources = spark.createDataFrame([("a", 50, 7), ("b", 20, 5), ("c", 9, 1), ("d", 3, 3)], "s string, blocks long, quota long")
    plan = M.plans(sources).collect()
    assert plan and len({(r.first, r.at) for r in plan}) == len(plan)
    share = collections.Counter((r.first, r.s) for r in plan)
    for r in plan:
        m = share[r.first, r.s]
        assert r.k * r.slots // m <= r.at < -(-(r.k + 1) * r.slots // m)


def test_empty_and_tiny_tables(docs):
    assert M.mix(docs([])).count() == 0
    got = M.mix(docs([(1, "a", "s"), (1, "a", "s"), (None, None, None)])).collect()
    assert len(got) == 3 and sorted({r.mix_slot for r in got}) == [0, 1]


def test_columns_that_clash_are_kept(spark):
    names = ["s", "b", "n", "start", "first", "k", "at", "slots", "slot0", "quota", "mix_row", "mix_slot"]
    df = spark.createDataFrame([(i, f"src{i % 2}", *[f"{c}{i}" for c in names]) for i in range(40)],
                               "doc_id long, source string, " + ", ".join(f"{c} string" for c in names))
    got = M.mix(df, block=4).collect()
    assert sorted((r.doc_id, r.s, r.mix_row) for r in got) == [(i, f"s{i}", f"mix_row{i}") for i in range(40)]
    assert sorted({r.mix_slot for r in got}) == list(range(10))


@pytest.mark.parametrize("case", ["thirds", "few", "many", "early"])
def test_mix_stays_with_the_target_weights(docs, case):
    sizes, weights = {
        "thirds": ({"a": 1300, "b": 520, "c": 270}, {"a": .6283, "b": .2471, "c": .1246}),
        "few": ({"a": 1500, "b": 12}, {"a": .996, "b": .004}),
        "many": ({f"s{k}": 3 for k in range(300)} | {"hot": 450}, {f"s{k}": 3. for k in range(300)} | {"hot": 450.}),
        "early": ({"a": 40, "b": 300, "c": 100}, {"a": 5., "b": 1., "c": 2.}),
    }[case]
    names = [s for s, n in sizes.items() for _ in range(n)]
    got = M.mix(docs([(i, "t", s) for i, s in enumerate(names)]), weights, block=1).select("source", "mix_slot").collect()
    order = [s for _, s in sorted((r.mix_slot, r.source) for r in got)]
    assert sorted(order) == sorted(names)
    # slots passed and targets at each moment of the ideal mix, a step at a time between the ends of sources
    moments = [0.0, *sorted({sizes[s] / weights[s] for s in sizes})]
    passed = [sum(min(sizes[s], weights[s] * x) for s in sizes) for x in moments]
    seen = collections.Counter()
    for t, s in enumerate(order, 1):
        seen[s] += 1
        j = next(j for j in range(1, len(passed)) if t <= passed[j] + 1e-6)
        x = moments[j - 1] + (t - passed[j - 1]) / (passed[j] - passed[j - 1]) * (moments[j] - moments[j - 1])
        assert all(abs(seen[k] - min(sizes[k], weights[k] * x)) < 2.5 for k in sizes)
