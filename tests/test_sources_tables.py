import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import tables as K
from tessera.operators.aggregations import nest_children, roll_metrics_to_run, spark_util_by_run, summarize_children
from tessera.sources import files as S
from conftest import rows


def test_date_partitioned_scan(spark, tmp_path):
    base = str(tmp_path / "audit")
    df = spark.createDataFrame([(1, dt.date(2024, 1, d)) for d in (1, 2, 3, 5)], "v int, date date")
    df.write.partitionBy("date").json(base)
    out = S.read_date_partitioned(spark, base, "json", "2024-01-02", "2024-01-05")
    assert sorted(r["date"] for r in out.collect()) == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    one = S.read_date_partitioned(spark, base, "json", "2024-01-05", "2024-01-05")
    assert one.count() == 1
    with pytest.raises(FileNotFoundError):
        S.read_date_partitioned(spark, base, "json", "2025-01-01", "2025-01-02")


def test_api_pages_envelope_csv_and_dims(spark, tmp_path):
    p = tmp_path / "pages.json"
    p.write_text(json.dumps({"clusters": [{"cluster_id": "a"}, {"cluster_id": "b"}], "has_more": False}))
    assert rows(S.read_api_pages(spark, str(p), "clusters")) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        S.explode_api_pages(spark.read.json(str(p)), "jobs")
    body = json.dumps({"records": [{"time": "2024-01-01T00:00:01Z", "properties": {"a": 1}}]})
    env = spark.createDataFrame([(body,)], "body string")
    out = S.explode_envelope(env, "body", "struct<records:array<struct<time:string, properties:struct<a:int>>>>")
    r = out.first()
    assert r["a"] == 1 and r["timestamp"] == 1704067201000
    csv = tmp_path / "nodes.csv"
    csv.write_text("API_Name,vCPUs\nm5,4\n")
    nodes = S.read_reference_csv(spark, str(csv), "API_Name string, vCPUs int", "2020-01-01", "org")
    assert nodes.first()["isActive"] is True and nodes.first()["vCPUs"] == 4
    assert S.sku_price_dimension(spark, "org", "2020-01-01").count() == 4
    lp = S.log_prefixes(spark.createDataFrame([("dbfs:/logs/", "c1"), ("dbfs:/logs", "c1")], "d string, c string"),
                        "d", "c")
    assert rows(lp) == [("dbfs:/logs/c1/eventlog",)]
    qh = spark.createDataFrame([(5, (1, 2)), (100, (3, 4))], "t long, metrics struct<x:int, y:int>")
    assert S.query_history_scan(qh, "t", 10, 200, lag_days=0).columns == ["t", "x", "y"]


def test_table_ops(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "k int, org string, price double")
    st = K.stamp(df, "run-1", workspace="ws")
    assert {"Pipeline_SnapTS", "run_id", "workspace_name"} <= set(st.columns)
    spec = K.TableSpec("t", str(tmp_path / "t"), keys=("k",), partition_by=("org",), skew_noise_col="noise")
    laid = K.layout_for_write(df, spec, front=["price"], noise_buckets=4)
    assert laid.columns[0] == "price" and "noise" in laid.columns
    assert spec.effective_keys == ["k", "org", "organization_id"]
    rb = K.rollback_run(spark.createDataFrame([(1, "r1"), (2, "r2"), (3, None)], "k int, run_id string"), "r1")
    assert rows(rb, "k") == [(2,), (3,)]
    rt = K.rollback_to_time(spark.createDataFrame([(1, 100), (2, 300)], "k int, ms long"), ["ms"], 200)
    assert rows(rt, "k") == [(1,)]
    bf = K.backfill_by_map(spark.createDataFrame([("o1", None), ("o2", "keep")], "org string, ws string"), "ws", "org",
                           {"o1": "first", "o2": "second"})
    assert rows(bf) == [("o1", "first"), ("o2", "second")]
    up = K.unpivot_prices(spark.createDataFrame([("o", 0.5, 0.1)], "org string, interactive double, jobs double"),
                          ["org"], {"interactive": "interactive", "jobs": "automated"})
    assert rows(up) == [("o", "automated", 0.1), ("o", "interactive", 0.5)]
    src = str(tmp_path / "src")
    df.write.parquet(src)
    rep = K.snapshot_tables(spark, {"a": src, "b": src, "c": str(tmp_path / "missing")}, str(tmp_path / "snap"),
                            exclude=["b"])
    st_ = {r["table"]: r["status"] for r in rep.collect()}
    assert st_["a"] == "SUCCESS" and st_["b"] == "SKIPPED" and st_["c"].startswith("FAILED")
    K.publish_view(spark, "v_test", df, ["k", "price"], order_by=["price"], descending=True)
    assert [r[0] for r in spark.sql("select k from v_test").collect()] == [2, 1]
    assert K.read_table(spark, K.TableSpec("x", str(tmp_path / "nope"))).count() == 0
    dups = K.get_dups(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"])
    assert dups.count() == 2 and K.purge_duplicates(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]).count() == 1


def test_aggregations(spark):
    conv = spark.createDataFrame([(1, 0, "u", "hi"), (1, 1, "a", "yo"), (2, 0, "u", "x")],
                                 "conv int, turn int, role string, text string")
    s = {r["conv"]: r for r in summarize_children(conv, ["conv"], "turn", first={"first": "text"},
                                                   last={"last_role": "role"}).collect()}
    assert s[1]["n_children"] == 2 and s[1]["first"] == "hi" and s[1]["last_role"] == "a"
    n = {r["conv"]: r for r in nest_children(conv, ["conv"], "turn").collect()}
    assert [c["text"] for c in n[1]["children"]] == ["hi", "yo"]
    st = spark.createDataFrame([("r", 1, 2.0, 1.0), ("r", 1, 4.0, 2.0)], "run string, d int, m double, c double")
    rolled = roll_metrics_to_run(st, ["run"], firsts=["d"], avgs=["m"], maxs=["m"], sums=["c"]).first()
    assert rolled["state_rows"] == 2 and rolled["c"] == 3.0
    jobs = spark.createDataFrame([("run1", "c", [1, 2])], "run_id string, cluster string, stages array<int>")
    tasks = spark.createDataFrame([("c", 1, 3_600_000), ("c", 2, 3_600_000), ("c", 3, 99)],
                                  "cluster string, StageID int, ms long")
    u = spark_util_by_run(jobs, tasks, ["run_id"], "stages", ["cluster"], "ms").first()
    assert u["spark_task_runtime_H"] == 2.0


def test_incremental_read_log_register_errors(spark, tmp_path):
    spec = K.TableSpec("ev", str(tmp_path / "ev"), keys=("k",), incremental_cols=("ms", "d"), partition_by=("d",),
                       tenant_col=None)
    df = spark.createDataFrame([(1, 1000, dt.date(1970, 1, 1)), (2, 90_000_000, dt.date(1970, 1, 2)),
                                (3, 200_000_000, dt.date(1970, 1, 3))], "k int, ms long, d date")
    K.write_append(df, spec)
    out = K.read_incremental(spark, spec, 86_400_000, 172_800_000)
    assert rows(out, "k") == [(2,)]
    K.log_write(spark, str(tmp_path / "log"), "r1", "ev", "append", 3)
    K.log_write(spark, str(tmp_path / "log"), "r2", "ev", "merge", 1)
    assert K.latest_write(spark.read.parquet(str(tmp_path / "log"))).first()["run_id"] == "r2"
    K.register_table(spark, "ev_registered", spec.path)
    assert spark.table("ev_registered").count() == 3
    errs = K.TableSpec("errs", str(tmp_path / "errs"), tenant_col=None)
    K.write_errors(spark.createDataFrame([("c1", 0, 1000, "timeout")], "cluster_id string, from_epoch long, "
                                         "until_epoch long, msg string"), errs)
    assert "from_ts" in spark.read.parquet(errs.path).columns
