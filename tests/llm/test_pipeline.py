import corpus_pipeline as P
import pytest

from loadlens.llm import decontaminate, secrets, shingle_join, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in P.STAGES:
        new = stage(spark, docs, sf)
        new = P.store(new, name)
        out.append((name, docs, new))
        docs = new
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_takes_effect_on_what_the_one_before_kept(spark, sf, stages):
    columns = stages[0][1].columns
    labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    (_, d0, tox), (_, _, near), (_, _, clean), (_, _, red), (_, _, mixed) = stages
    assert all(new.columns == columns for _, _, new in stages[:-1])
    rejected = {r.doc_id for r in toxicity.toxicity(d0, labels).where("predicted = 1").collect()}
    assert ids(tox) == sorted(set(ids(d0)) - rejected)
    assert ids(near) == sorted(r.component_id for r in shingle_join.shingle_join(tox).select("component_id").distinct().collect())
    leaked = {r.doc_id for r in decontaminate.contaminated(near, bench).collect()}
    assert ids(clean) == sorted(set(ids(near)) - leaked)
    assert ids(red) == ids(clean)
    assert secrets.scan(red).where("n_assign + n_access + n_hex > 0").count() == 0
    assert ids(mixed) == ids(red) and {"mix_slot", "mix_place"} <= set(mixed.columns)


def test_run_equals_its_stages(spark, sf, stages):
    assert sorted(map(tuple, P.run(spark, sf).collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_nulls_repeats_and_extra_columns(spark, sf, docs):
    d = docs([(1, None), (1, None), (2, ""), (None, "alone"), (3, "some words that stay here"), (3, "some words that stay here")])
    for _, stage in P.STAGES:
        d = stage(spark, d, sf)
    assert {r.doc_id for r in d.collect()} == {1, 2, 3, None}
    d = docs([])
    for _, stage in P.STAGES:
        d = stage(spark, d, sf)
    assert d.count() == 0
