"""Run-store IO, streaming = batch equivalence, reports."""

import datetime as dt
import json
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from loadlens.operators import report as RP
from loadlens.sources import runstore as IO
from loadlens.sources.tables import hourly_runs, order_runs
from loadlens.streaming import jobs as ST


def _dir():
    return tempfile.mkdtemp(prefix="loadlens-test-", dir="/tmp")


def test_store_retention_snapshot(spark, sf):
    d = _dir() + "/runs"
    r = order_runs(spark, sf)
    IO.store_runs(r, d)
    snap = IO.snapshot(IO.read_runs(spark, d), d, now=dt.datetime(2024, 1, 1))
    assert snap.endswith("_backup_20240101_000000") and spark.read.parquet(snap).count() == r.count()
    with pytest.raises(Exception):
        IO.snapshot(IO.read_runs(spark, d), d, now=dt.datetime(2024, 1, 1))
    as_of = "1998-08-02 00:00:00"
    deleted = IO.apply_retention(spark, d, 1095, as_of)
    cutoff = dt.datetime(1998, 8, 2) - dt.timedelta(days=1095)
    left = IO.read_runs(spark, d)
    assert left.where(F.col("timestamp") < F.lit(cutoff)).count() == 0
    assert left.count() + deleted == r.count()
    assert left.count() == r.where(F.col("timestamp") >= F.lit(cutoff)).count()


def test_configs_roundtrip_and_domain(spark):
    d = _dir()
    from loadlens.operators.loadplan import config_grid
    g = config_grid(spark)
    IO.save_configs(g, d + "/cfg")
    valid, invalid = IO.load_configs(spark, d + "/cfg")
    assert valid.count() == 131 and invalid.count() == 0
    bad = [{"test_id": "x", "test_type": "soak", "network_condition": "wifi"}]
    with open(d + "/arr.json", "w") as f:
        json.dump(bad, f)
    v, i = IO.load_configs(spark, d + "/arr.json", multiline=True)
    assert v.count() == 0 and i.count() == 1


def test_export_report_only_json(spark):
    with pytest.raises(ValueError):
        IO.export_report(spark.range(1), _dir() + "/r", fmt="xml")


def test_audit_report_files(spark):
    d = _dir()
    for name, txt in (("run_a", "Performance score 0.5\nSEO score 0.9"), ("run_b", "nothing here")):
        with open(f"{d}/{name}.txt", "w") as f:
            f.write(txt)
    out = {r.test_id: r for r in IO.read_audit_reports(spark, f"{d}/*.txt").collect()}
    assert out["run_a"].performance_score == 0.5 and out["run_a"].seo_score == 0.9
    assert out["run_b"].performance_score == 0.0


def test_stream_rollup_equals_batch_on_closed_windows(spark, sf):
    d = _dir()
    q = ST.run_to_table(ST.hourly_rollup(ST.event_stream(spark, f"{sf}/events.parquet")), d + "/o", d + "/ck")
    q.awaitTermination()
    s = {r.window_start: r for r in spark.read.parquet(d + "/o").collect()}
    b = {r.window_start: r for r in hourly_runs(spark, sf).collect()}
    assert 0 < len(s) <= len(b) and len(b) - len(s) <= 2
    for k, r in s.items():
        assert r.total_requests == b[k].total_requests and r.total_failures == b[k].total_failures
        assert r.avg_response_time == pytest.approx(b[k].avg_response_time)


def test_recommendations_lines(spark):
    overall = spark.createDataFrame([("requests_per_sec", "error_rate,avg_latency", "Degrading")],
                                    "improving_metrics string, degrading_metrics string, overall_performance_direction string")
    types = spark.createDataFrame([(0, "Low Performance"), (1, "High Performance"), (2, "Unreliable")],
                                  "cluster int, cluster_type string")
    lines = [r.line for r in RP.recommendations({"m": "concurrent_users"}, overall, types).orderBy("line_no").collect()]
    assert lines[0].startswith("Focus optimization efforts on 'concurrent_users'")
    assert lines[1].startswith("Performance is degrading")
    assert lines[2] == "Focus on improving: error_rate, avg_latency"
    assert lines[3] == "Investigate clusters [0, 2] which show poor performance patterns"
    assert lines[-4:] == RP.GENERAL_RECOMMENDATIONS
    rep = RP.assemble_report("t", {"lines": RP.recommendations({}, None, None)}, generated_at="x").first().report
    assert json.loads(rep)["title"] == "t" and len(json.loads(rep)["lines"]) == 4


def test_live_alerts_do_not_depend_on_batches_and_reread_thresholds(spark):
    """Rates per event-time hour are the same for any cut of the stream; late events are dropped; new thresholds take effect."""
    d = _dir()
    schema = ST.EVENTS_SCHEMA
    base = dt.datetime(2024, 1, 1)

    def events(rows):
        return spark.createDataFrame([(i, base + dt.timedelta(minutes=m), 1, "view", float(v), "{}") for i, (m, v) in enumerate(rows)], schema)

    def limits(folder, high):
        spark.createDataFrame([("view", high, -1.0)], "event_type string, z_score_3 double, iqr_lower double").coalesce(1).write.mode(
            "overwrite").parquet(folder)
    hours = [(10, 5), (20, 50), (70, 50), (80, 60), (130, 5), (190, 5), (400, 5)]
    got = []
    for k, cut in enumerate(([7], [1, 3, 7], [2, 4, 5, 7])):
        f = f"{d}/{k}"
        limits(f + "/th", 40.0)
        at = 0
        for end in cut:
            events(hours[at:end]).coalesce(1).write.mode("append").parquet(f + "/in/events.parquet")
            at = end
            src = ST.event_stream(spark, f + "/in/events.parquet/*.parquet")
            ST.flag_batches(src, f + "/th", f + "/flagged", f + "/ck1").awaitTermination()
            ST.alert_windows(f + "/flagged", f + "/rates", f + "/ck2", spark).awaitTermination()
        got.append(sorted((r.window_start, r.anomaly_count, r.events) for r in spark.read.parquet(f + "/rates").collect()))
    assert got[0] == got[1] == got[2] == [(base, 1, 2), (base + dt.timedelta(hours=1), 2, 2), (base + dt.timedelta(hours=2), 0, 1),
                                          (base + dt.timedelta(hours=3), 0, 1)]
    f = f"{d}/0"
    limits(f + "/th", 1.0)                                      # every event exceeds the new threshold
    events([(30, 90), (401, 5), (900, 5)]).coalesce(1).write.mode("append").parquet(f + "/in/events.parquet")
    ST.flag_batches(ST.event_stream(spark, f + "/in/events.parquet/*.parquet"), f + "/th", f + "/flagged", f + "/ck1").awaitTermination()
    ST.alert_windows(f + "/flagged", f + "/rates", f + "/ck2", spark).awaitTermination()
    now = sorted((r.window_start, r.anomaly_count, r.events) for r in spark.read.parquet(f + "/rates").collect())
    assert now == got[0] + [(base + dt.timedelta(hours=6), 1, 2)]      # the event of the first hour came too late


def test_retention_removes_a_cutoff_month_that_is_wholly_old(spark):
    d = _dir() + "/runs"
    rows = [(f"jan{i}", "api", dt.datetime(2024, 1, 5 + i % 10)) for i in range(20)]
    rows += [(f"mar{i}", "api", dt.datetime(2024, 3, 5)) for i in range(5)]
    IO.store_runs(spark.createDataFrame(rows, "test_id string, test_type string, timestamp timestamp"), d)
    assert IO.apply_retention(spark, d, 30, "2024-02-28 00:00:00") == 20
    assert sorted(r.test_id for r in IO.read_runs(spark, d).collect()) == [f"mar{i}" for i in range(5)]
    assert IO.apply_retention(spark, d, 30, "2024-02-28 00:00:00") == 0


def test_retention_keeps_the_young_part_of_the_cutoff_month(spark):
    d = _dir() + "/runs"
    make = lambda n, day: spark.createDataFrame(
        [(f"{n}{i}", "api", dt.datetime(2024, 1, day)) for i in range(4)], "test_id string, test_type string, timestamp timestamp")
    IO.store_runs(make("a", 3).unionByName(make("b", 28)), d, batch="one")
    IO.store_runs(make("c", 4), d, batch="two")
    IO.store_runs(make("d", 29), d, batch="three")
    assert IO.apply_retention(spark, d, 10, "2024-01-30 00:00:00") == 8
    assert sorted(r.test_id[0] for r in IO.read_runs(spark, d).collect()) == ["b"] * 4 + ["d"] * 4


def test_retention_is_one_step_for_readers_and_can_be_repeated(spark, monkeypatch):
    """A failure before the commit changes nothing; one after it leaves the new state; the next run finishes the work."""
    make = lambda n, day: spark.createDataFrame(
        [(f"{n}{i}", "api", dt.datetime(2024, 1, day)) for i in range(4)], "test_id string, test_type string, timestamp timestamp")

    def fail(*_):
        raise RuntimeError("executor lost")

    def ids(d):
        return sorted(r.test_id[0] for r in IO.read_runs(spark, d).collect())
    for step, before in (("_commit", True), ("_delete", False)):
        d = _dir() + "/runs"
        IO.store_runs(make("a", 3).unionByName(make("b", 28)), d, batch="one")
        IO.store_runs(make("c", 4), d, batch="two")
        with monkeypatch.context() as m:
            m.setattr(IO, step, fail)
            with pytest.raises(RuntimeError):
                IO.apply_retention(spark, d, 10, "2024-01-30 00:00:00")
        assert ids(d) == (["a"] * 4 + ["b"] * 4 + ["c"] * 4 if before else ["b"] * 4)
        assert IO.apply_retention(spark, d, 10, "2024-01-30 00:00:00") == (8 if before else 0)
        assert ids(d) == ["b"] * 4
        assert len(IO._glob(spark, f"{d}/month=*/batch=*")) == 1         # neither old nor staged folders are left
        assert IO.apply_retention(spark, d, 1, "2024-01-30 00:00:00") == 4 and ids(d) == []
        IO.store_runs(make("b", 28).unionByName(make("d", 29)), d, batch="one")      # a replayed batch replaces what was left of it
        assert ids(d) == ["b"] * 4 + ["d"] * 4


def test_batches_with_other_columns_and_replays(spark):
    d = _dir() + "/runs"
    first = spark.createDataFrame([("a", "api", dt.datetime(2024, 1, 1))], "test_id string, test_type string, timestamp timestamp")
    IO.store_runs(first, d, batch="1")
    second = first.withColumns({"test_id": F.lit("b"), "concurrent_users": F.lit(7), "other": F.lit("x")})
    for _ in range(2):
        IO.store_runs(second, d, batch="2")
    got = {r.test_id: r for r in IO.read_runs(spark, d).collect()}
    assert len(got) == 2 and IO.read_runs(spark, d).count() == 2
    assert got["a"].concurrent_users is None and got["b"].concurrent_users == 7
    assert json.loads(got["b"].metadata)["other"] == "x" and "other" not in got["b"].asDict()


def test_recent_runs_read_only_their_months(spark):
    d = _dir() + "/runs"
    rows = [(f"r{m}", "api", dt.datetime(2024, m, 1)) for m in range(1, 7)]
    IO.store_runs(spark.createDataFrame(rows, "test_id string, test_type string, timestamp timestamp"), d)
    recent = IO.recent_runs(spark, d, 24 * 40, "2024-06-02 00:00:00")
    assert sorted(r.test_id for r in recent.collect()) == ["r5", "r6"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)   # plans as text aren't cut short
    try:
        assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ >= 2024-04", recent._jdf.queryExecution().toString())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_metadata_is_packed_after_the_shuffle(spark):
    rows = [(f"r{m}", "api", dt.datetime(2024, m, 1), "x" * 10) for m in range(1, 7)]
    df = spark.createDataFrame(rows, "test_id string, test_type string, timestamp timestamp, note string")
    plan = IO.dealt(df, "all", metadata=True)._jdf.queryExecution().sparkPlan().toString()
    assert "metadata#" in plan and "metadata" not in plan[plan.index("Exchange"):]
    d = _dir() + "/packed"
    IO.store_runs(df, d, batch="all")
    assert sorted((r.test_id, r.month, r.metadata) for r in IO.read_runs(spark, d).collect()) == \
        [(f"r{m}", f"2024-{m:02d}", '{"note":"xxxxxxxxxx"}') for m in range(1, 7)]
