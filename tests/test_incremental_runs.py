"""Incremental runs: idempotent re-runs and late data closing an open row."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.incremental import ModuleSpec, read_state, run_module
from tessera.operators.tables import TableSpec, read_table
from tessera.plans.medallion.silver import pair_start_end

EV = ("organization_id string, clusterId string, SparkContextID string, Event string, ExecutorID long, "
      "fileCreateDate date, executorInfo string, Timestamp long, RemovedReason string")


def test_module_rerun_is_idempotent(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "ms", F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")))
    target = TableSpec("events_copy", str(tmp_path / "t"), keys=("event_id",), mode="merge", tenant_col=None)
    spec = ModuleSpec(1, "copy", max_days=10)
    state = str(tmp_path / "state")
    start = 1704067200000  # 2024-01-01
    source = lambda a, b: src.filter((F.col("ms") >= a) & (F.col("ms") < b)).drop("ms")
    s1 = run_module(spark, spec, state, source, target, start + 40 * 86_400_000, start, "r1")
    s2 = run_module(spark, spec, state, source, target, start + 40 * 86_400_000, start, "r2")
    s3 = run_module(spark, spec, state, source, target, start + 40 * 86_400_000, start, "r3")
    s4 = run_module(spark, spec, state, source, target, start + 40 * 86_400_000, start, "r4")
    assert (s1, s2, s3) == ("SUCCESS", "SUCCESS", "SUCCESS") and s4.startswith("EMPTY")
    assert read_table(spark, target).count() == src.count()
    assert read_state(spark, state).count() == 4


def test_late_end_event_closes_open_row(spark, tmp_path):
    d = dt.date(2024, 1, 1)
    run1 = spark.createDataFrame([("o", "c", "ctx", "SparkListenerExecutorAdded", 1, d, "h", 1000, None)], EV)
    run2 = spark.createDataFrame([("o", "c", "ctx", "SparkListenerExecutorRemoved", 1, dt.date(2024, 1, 3), None,
                                   9000, "lost")], EV)
    lagged_all = run1.unionByName(run2)
    target = TableSpec("executors", str(tmp_path / "ex"), keys=("clusterId", "SparkContextID", "ExecutorID"),
                       mode="merge", tenant_col="organization_id")

    def build(lagged, new):
        return pair_start_end(lagged, new, "SparkListenerExecutorAdded", "SparkListenerExecutorRemoved",
                              ["ExecutorID"], {"addedTimestamp": F.col("Timestamp")},
                              {"removedTimestamp": F.col("Timestamp")}, "addedTimestamp", "removedTimestamp", 0,
                              lag_days=30).select("organization_id", "clusterId", "SparkContextID", "ExecutorID",
                                                  "addedTimestamp", "removedTimestamp")
    from tessera.operators.tables import write_upsert
    write_upsert(build(run1, run1), target)
    first = read_table(spark, target).first()
    assert first["removedTimestamp"] is None  # open row
    write_upsert(build(lagged_all, run2), target)
    rows = read_table(spark, target).collect()
    assert len(rows) == 1 and rows[0]["removedTimestamp"] == 9000  # closed by the late end event


def test_rollback_module_and_small_helpers(spark, tmp_path):
    from tessera.functions.columns import date_spine, days_between_inclusive
    from tessera.operators.incremental import impute_first_run, rollback_module
    from tessera.operators.quality import rebuild_and_compare, schema_report
    st = str(tmp_path / "state")
    spark.createDataFrame([(1, "m", "r1", 0, 100, "SUCCESS", 1, dt.datetime(2020, 1, 1)),
                           (1, "m", "r2", 100, 200, "SUCCESS", 1, dt.datetime(2020, 1, 2))],
                          "module_id int, module_name string, run_id string, from_ts long, until_ts long, "
                          "status string, written_rows long, recorded_at timestamp").write.parquet(st)
    target = TableSpec("t", str(tmp_path / "t"), keys=("k",), incremental_cols=("ms",), tenant_col=None)
    spark.createDataFrame([(1, 50), (2, 150)], "k int, ms long").write.parquet(target.path)
    rep = rollback_module(spark, st, 1, 150, [target], dry_run=True)
    assert rep["from_ms"] == 100 and read_table(spark, target).count() == 2
    rollback_module(spark, st, 1, 150, [target], dry_run=False)
    assert [r["k"] for r in read_table(spark, target).collect()] == [1]
    assert read_state(spark, st).filter(F.col("status").startswith("ROLLED BACK")).count() == 1
    d = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 4))], "a date, b date")
    assert d.select(F.size(date_spine("a", "b"))).first()[0] == 3
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 3, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert ts.select(days_between_inclusive("a", "b")).first()[0] == 3
    log = spark.createDataFrame([("o", "c1", 10, "create")], "organization_id string, k string, timestamp long, "
                                                             "actionName string")
    snap = spark.createDataFrame([("o", "c1", 5), ("o", "c2", 7), ("o", "c2", 9)],
                                 "organization_id string, k string, snap long")
    out = impute_first_run(log, snap, ["organization_id", "k"], ["snap"], F.lit(1), "timestamp")
    imputed = out.filter(F.col("actionName") == "snapImpute").collect()
    assert len(imputed) == 1 and imputed[0]["k"] == "c2" and imputed[0]["snap"] == 9
    sr = {r["check"]: r["passed"] for r in schema_report(log, ["k", "nope"], ["a"], ["a"]).collect()}
    assert sr == {"required:k": True, "required:nope": False, "partition_columns": True}
    a = spark.createDataFrame([(1,), (2,)], "k int")
    v = {r["table"]: r["status"] for r in rebuild_and_compare({"same": (a, a, ["k"]), "diff": (a, a.limit(1), ["k"])})
         .collect()}
    assert v == {"same": "PASS", "diff": "FAIL"}


def test_module_failure_is_recorded(spark, tmp_path):
    import pytest
    target = TableSpec("bad", str(tmp_path / "bad"), keys=("k",), mode="append", tenant_col=None)
    state = str(tmp_path / "state")
    spec = ModuleSpec(7, "bad")

    def source(a, b):
        return spark.range(5).select(F.col("id").alias("k"), F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception):
        run_module(spark, spec, state, source, target, 10**6, 0, "r1")
    st = read_state(spark, state).collect()
    assert len(st) == 1 and st[0]["status"].startswith("FAILED") and st[0]["until_ts"] == st[0]["from_ts"]


def test_rollback_is_one_tenants_and_touches_only_its_partitions(spark, tmp_path):
    import os

    from tessera.operators.incremental import STATE_SCHEMA, compute_window, rollback_module
    from tessera.operators.tables import write_append
    st = str(tmp_path / "state")
    day = dt.datetime(2020, 1, 1)
    spark.createDataFrame([(o, 1, "m", f"{o}{i}", i * 100, i * 100 + 100, "SUCCESS", 1, day) for o in "ab" for i in range(2)], STATE_SCHEMA).write.parquet(st)
    assert compute_window(read_state(spark, st), ModuleSpec(1, "m", tenant="a"), 10 ** 12, 0)[0] == 200
    assert compute_window(read_state(spark, st), ModuleSpec(1, "m", tenant="c"), 10 ** 12, 7)[0] == 7
    t = TableSpec("t", str(tmp_path / "t"), keys=("k",), incremental_cols=("ms",), partition_by=("d",))
    rows = [("a", 1, 50, 1), ("a", 2, 150, 2), ("a", 3, 20, 2), ("b", 4, 150, 2), ("b", 5, 150, 3), ("a", 6, None, 2)]
    write_append(spark.createDataFrame(rows, "organization_id string, k int, ms long, d int"), t)
    kept_file = os.listdir(f"{t.path}/d=3")
    rollback_module(spark, st, 1, 150, [t], dry_run=False, tenant="a")
    assert sorted(r["k"] for r in read_table(spark, t).collect()) == [1, 3, 4, 5, 6]
    assert os.listdir(f"{t.path}/d=3") == kept_file
    marked = read_state(spark, st).filter(F.col("status").startswith("ROLLED BACK")).collect()
    assert [r["organization_id"] for r in marked] == ["a"]
