"""Hand-made telemetry fixtures for the silver/gold builders (costs worked out by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.plans.medallion.gold import cluster_state_fact, job_run_cost_fact
from tessera.plans.medallion.silver import cluster_state_detail

EV_SCHEMA = ("organization_id string, cluster_id string, timestamp long, type string, "
             "details struct<cluster_size:struct<autoscale:struct<max_workers:long,min_workers:long>,"
             "num_workers:long>, current_num_workers:long, target_num_workers:long, user:string>")
UNTIL = 10_000_000


def _ev(org, cid, ts, typ, size=None, cur=None, tgt=None):
    return (org, cid, ts, typ, ((None, size), cur, tgt, "u"))


@pytest.fixture()
def events(spark):
    rows = [_ev("o1", "c1", 0, "CREATING", size=2), _ev("o1", "c1", 60_000, "RUNNING", cur=2),
            _ev("o1", "c1", 120_000, "RESIZING", cur=2, tgt=4), _ev("o1", "c1", 180_000, "RUNNING", cur=4),
            _ev("o1", "c1", 3_600_000, "TERMINATING"),
            _ev("o1", "c2", 0, "CREATING", size=1), _ev("o1", "c2", 1000, "RUNNING", cur=1),
            _ev("o1", "c2", 5000, "STARTING"), _ev("o1", "c2", 6000, "RUNNING", cur=1)]
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_state_detail_chain(events):
    d = cluster_state_detail(events, UNTIL).orderBy("cluster_id", "timestamp").collect()
    c1 = [r for r in d if r["cluster_id"] == "c1"]
    assert [r["state"] for r in c1] == ["CREATING", "RUNNING", "RESIZING", "RUNNING", "TERMINATING"]
    assert [r["is_running"] for r in c1] == [True, True, True, True, False]
    assert [r["current_num_workers"] for r in c1] == [2, 2, 2, 4, 0]
    assert [r["target_num_workers"] for r in c1] == [2, 2, 4, 4, 0]
    assert c1[1]["unixTimeMS_state_end"] == 119_999 and c1[-1]["unixTimeMS_state_end"] == UNTIL
    assert c1[1]["uptime_in_state_S"] == pytest.approx(59.999)
    c2 = [r for r in d if r["cluster_id"] == "c2"]
    # damaged chain: one imputed TERMINATING 1 ms after the RUNNING row
    assert [r["state"] for r in c2] == ["CREATING", "RUNNING", "TERMINATING", "STARTING", "RUNNING"]
    assert c2[2]["timestamp"] == 1001 and c2[2]["is_running"] is False
    assert c2[3]["counter_reset"] == 1 and c2[3]["reset_partition"] > c2[1]["reset_partition"]


@pytest.fixture()
def dims(spark):
    spec = spark.createDataFrame([("o1", "c1", "c1name", None, 10, "m5", "m5", "13.3", "Standard", "STANDARD"),
                                  ("o1", "c2", "job-1-run-2", None, 10, "m5", "m5", "13.3", "Standard", "PHOTON")],
                                 "organization_id string, cluster_id string, cluster_name string, custom_tags string, "
                                 "timestamp long, driver_node_type_id string, node_type_id string, "
                                 "spark_version string, cluster_type string, runtime_engine string")
    snap = spark.createDataFrame([("o1", "c1", "c1name", {"a": "b"}, 0, None, "m5", "m5", "13.3", "STANDARD")],
                                 "organization_id string, cluster_id string, cluster_name string, "
                                 "custom_tags map<string,string>, start_time long, terminated_time long, "
                                 "driver_node_type_id string, node_type_id string, spark_version string, "
                                 "runtime_engine string")
    inst = spark.createDataFrame([("o1", "M5 ", 4, 1.0, 0.2, dt.date(1970, 1, 1), None)],
                                 "organization_id string, API_Name string, vCPUs int, Hourly_DBUs double, "
                                 "Compute_Contract_Price double, activeFrom date, activeUntil date")
    dbu = spark.createDataFrame([("o1", "interactive", 0.55, dt.date(1970, 1, 1)),
                                 ("o1", "automated", 0.15, dt.date(1970, 1, 1))],
                                "organization_id string, sku string, contract_price double, activeFrom date")
    return spec, snap, inst, dbu


def test_cluster_state_fact_costs(events, dims):
    spec, snap, inst, dbu = dims
    fact = cluster_state_fact(cluster_state_detail(events, UNTIL), spec, snap, inst, dbu, UNTIL)
    rows = {(r["cluster_id"], r["unixTimeMS_state_start"]): r for r in fact.collect()}
    run = rows[("c1", 60_000)]
    h = 59_999 / 1000 / 3600
    assert run["sku"] == "interactive" and run["dbu_rate"] == 0.55
    assert run["driver_dbu_cost"] == pytest.approx(1.0 * h * 0.55)
    assert run["worker_dbu_cost"] == pytest.approx(1.0 * h * 2 * 0.55)
    assert run["worker_compute_cost"] == pytest.approx(0.2 * h * 2)
    assert run["total_cost"] == pytest.approx((0.55 * 3 + 0.2 * 3) * h)
    resize = rows[("c1", 120_000)]
    assert resize["worker_compute_cost"] == pytest.approx(0.2 * (59_999 / 3.6e6) * 4)  # compute uses target
    term = rows[("c1", 3_600_000)]
    assert term["total_cost"] == 0
    assert rows[("c2", 1000)]["uptime_in_state_S"] == 0  # ends where the imputed TERMINATING starts
    c2 = rows[("c2", 6000)]
    h2 = (UNTIL - 6000) / 3.6e6
    assert c2["sku"] == "automated" and c2["driver_dbu_cost"] == pytest.approx(1.0 * h2 * 0.15 * 2)  # PHOTON x2


def test_job_run_cost_split(spark, events, dims):
    spec, snap, inst, dbu = dims
    fact = cluster_state_fact(cluster_state_detail(events, UNTIL), spec, snap, inst, dbu, UNTIL)
    runs = spark.createDataFrame([("o1", "r1", "c1", "existing", 30_000, 200_000),
                                  ("o1", "r2", "c1", "existing", 100_000, 150_000)],
                                 "organization_id string, run_id string, cluster_id string, cluster_type string, "
                                 "run_start_ms long, run_end_ms long")
    out = {r["run_id"]: r for r in job_run_cost_fact(fact, runs, UNTIL).collect()}
    assert out["r1"]["cluster_states"] == 4  # CREATING(initial), RUNNING, RESIZING, RUNNING(terminal)
    assert out["r2"]["cluster_states"] == 2
    # exact shares never exceed the state cost
    st = fact.filter((F.col("cluster_id") == "c1") & (F.col("unixTimeMS_state_start") == 60_000)).first()
    assert out["r1"]["total_cost"] > 0 and out["r2"]["total_cost"] > 0
    assert out["r2"]["total_cost"] <= st["total_cost"] + fact.filter(
        (F.col("cluster_id") == "c1") & (F.col("unixTimeMS_state_start") == 120_000)).first()["total_cost"]
    ref = {r["run_id"]: r for r in job_run_cost_fact(fact, runs, UNTIL, overlap_mode="reference").collect()}
    assert set(ref) == {"r1", "r2"}


def test_stream_gold(spark):
    import json
    prog = lambda b, ts: json.dumps({"id": "s1", "runId": "r1", "name": "q", "timestamp": ts, "batchId": b,
                                     "numInputRows": 5, "stateOperators": [], "sources": [{"x": 1}]})
    rows = [("o", "c", "ctx", "org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent", None, 100,
             "s1", "r1", "q"),
            ("o", "c", "ctx", "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent",
             prog(0, "2024-01-01T00:00:01.000Z"), 200, None, None, None),
            ("o", "c", "ctx", "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent",
             prog(0, "2024-01-01T00:00:02.000Z"), 300, None, None, None),
            ("o", "c", "ctx", "org.apache.spark.sql.streaming.StreamingQueryListener$QueryTerminatedEvent", None, 400,
             "s1", "r1", None)]
    ev = spark.createDataFrame(rows, "organization_id string, clusterId string, SparkContextID string, Event string, "
                                     "progress string, Timestamp long, id string, runId string, name string")
    ex = spark.createDataFrame([("o", "c", "ctx", 9, "stream id = s1 runId = r1 batch = 0")],
                               "organization_id string, clusterId string, SparkContextID string, executionId long, "
                               "description string")
    from tessera.plans.medallion.gold import spark_stream_gold
    out = {r["stream_batch_id"]: r for r in spark_stream_gold(ev, ex).collect()}
    assert set(out) == {-1, 0}
    assert out[0]["stream_timestamp"] == 1704067202000 and out[0]["stateOperators"] is None
    assert out[0]["execution_ids"] == [9] and out[-1]["stream_name"] == "q"
    sliced = {r["stream_batch_id"]: r["stream_name"] for r in spark_stream_gold(ev, ex, slice_ms=1000.0).collect()}
    assert sliced == {k: v["stream_name"] for k, v in out.items()}


def test_cost_facts_sliced_equal_unsliced(spark, events, dims):
    spec, snap, inst, dbu = dims
    sd = cluster_state_detail(events, UNTIL)
    a = cluster_state_fact(sd, spec, snap, inst, dbu, UNTIL)
    b = cluster_state_fact(sd, spec, snap, inst, dbu, UNTIL, slice_ms=50_000)
    cols = ["cluster_id", "unixTimeMS_state_start", "total_cost", "sku", "dbu_rate"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    runs = spark.createDataFrame([("o1", "r1", "c1", "existing", 30_000, 200_000),
                                  ("o1", "r2", "c1", "existing", 100_000, 150_000)],
                                 "organization_id string, run_id string, cluster_id string, cluster_type string, "
                                 "run_start_ms long, run_end_ms long")
    x = job_run_cost_fact(a, runs, UNTIL).select("run_id", "total_cost", "cluster_states").collect()
    y = job_run_cost_fact(a, runs, UNTIL, slice_ms=40_000).select("run_id", "total_cost", "cluster_states").collect()
    assert sorted(map(tuple, x)) == sorted(map(tuple, y))


def test_state_detail_sliced_equals_unsliced(events):
    a = cluster_state_detail(events, UNTIL)
    b = cluster_state_detail(events, UNTIL, slice_ms=700)
    cols = ["cluster_id", "timestamp", "state", "is_running", "current_num_workers", "target_num_workers",
            "counter_reset", "reset_partition", "unixTimeMS_state_end", "uptime_since_restart_S", "days_in_state"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
