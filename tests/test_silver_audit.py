import json

import pytest
from pyspark.sql import functions as F

from tessera.plans.medallion.silver_audit import cluster_spec, job_runs, job_status, pools_spec
from tessera.plans.medallion.silver import account_logins, account_mods, notebooks

RP = ("struct<cluster_id:string, clusterId:string, cluster_name:string, driver_node_type_id:string, "
      "node_type_id:string, num_workers:string, spark_version:string, spark_conf:string, custom_tags:string, "
      "instance_pool_id:string, job_id:string, jobId:string, runId:string, run_id:string, resourceId:string, "
      "name:string, new_settings:string, fields_to_remove:string, jobTerminalState:string, clusterId2:string, "
      "targetUserName:string, targetUserId:string, notebookId:string, path:string, instance_id:string>")
SCHEMA = (f"organization_id string, serviceName string, actionName string, timestamp long, date date, "
          f"requestId string, requestParams {RP}, response struct<result:string, statusCode:long>, "
          f"userIdentity struct<email:string>, sourceIPAddress string, userAgent string")


def _row(svc, act, ts, rid, rp=None, result=None, email="a@x", status=200):
    keys = [f.split(":")[0] for f in RP[len("struct<"):-1].split(", ")]
    rpv = tuple((rp or {}).get(k) for k in keys)
    return ("o1", svc, act, ts, None, rid, rpv, (result, status), (email,), "1.1.1.1", "ua")


@pytest.fixture()
def audit(spark):
    rows = [
        _row("clusters", "create", 100, "r1", {"cluster_name": "c-one", "node_type_id": "m5", "spark_version":
             "13.3.x_photon_scala2.12", "spark_conf": json.dumps({"spark.platform.cluster.profile": "singleNode"})},
             result=json.dumps({"cluster_id": "c1"}), email="creator@x"),
        _row("clusters", "edit", 200, "r2", {"cluster_id": "c1", "cluster_name": "c-one", "node_type_id": "m6",
                                             "driver_node_type_id": "d6"}, email="editor@x"),
        _row("clusters", "edit", 300, "r3", {"cluster_name": "c-one", "node_type_id": "m7"}, email="editor2@x"),
        _row("clusters", "changeClusterAcl", 310, "r4", {"cluster_id": "c1"}),
        _row("clusters", "delete", 320, "r6", {"cluster_id": "c1"}, email="deleter@x"),
        _row("clusters", "delete", 330, "r7", {"cluster_id": "c1"}, email="deleter2@x"),
        _row("clusters", "edit", 350, "r5", {"cluster_id": "c1", "cluster_name": "c-one"}, email="editor3@x"),
        _row("jobs", "create", 100, "j1", {"name": "job one", "new_settings": None},
             result=json.dumps({"job_id": 7})),
        _row("jobs", "update", 200, "j2", {"job_id": "7", "new_settings": json.dumps({"timeout_seconds": 60}),
                                           "fields_to_remove": json.dumps(["name"])}),
        _row("jobs", "runNow", 300, "j3", {"job_id": "7"}, result=json.dumps({"run_id": 55})),
        _row("jobs", "runStart", 310, "j4", {"runId": "55", "clusterId": "c1"}),
        _row("jobs", "runSucceeded", 400, "j5", {"runId": "55", "jobTerminalState": "Succeeded"}),
        _row("jobs", "submitRun", 500, "j6", {}, result=json.dumps({"run_id": 56})),
        _row("jobs", "cancel", 600, "j7", {"run_id": "56"}),
        _row("instancePools", "create", 50, "p1", {"node_type_id": "m5"},
             result=json.dumps({"instance_pool_id": "p1"})),
        _row("accounts", "login", 10, "l1", {}), _row("accounts", "login", 11, "l2", {}, email="dbadmin"),
        _row("accounts", "add", 20, "m1", {"targetUserName": "u@x"}),
        _row("accounts", "updateUser", 30, "m2", {"targetUserName": "u@x", "targetUserId": "99"}),
        _row("notebook", "createNotebook", 40, "n1", {"notebookId": "5", "path": "/Users/a/nb"}),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_cluster_spec(audit, spark):
    snap = spark.createDataFrame([], "organization_id string, cluster_id string, cluster_name string, "
                                     "driver_node_type_id string, node_type_id string, spark_version string, "
                                     "Pipeline_SnapTS long")
    out = cluster_spec(audit, snap).orderBy("timestamp").collect()
    assert [r["actionName"] for r in out] == ["create", "edit", "edit", "edit"]
    assert [r["cluster_id"] for r in out] == ["c1", "c1", "c1", "c1"]  # id at 300 repaired from the next row
    assert out[0]["cluster_type"] == "Single Node" and out[0]["runtime_engine"] == "PHOTON"
    assert out[1]["driver_node_type_id"] == "d6" and out[2]["driver_node_type_id"] == "d6"  # last known
    assert out[0]["driver_node_type_id"] == "m5"  # falls back to the worker type
    assert out[2]["createdBy"] == "creator@x" and out[2]["lastEditedBy"] == "editor2@x"
    assert all(r["deleted_by"] == "deleter@x" for r in out) and out[0]["is_automated"] is False


def test_job_status(audit):
    out = job_status(audit).orderBy("timestamp").collect()
    assert [r["job_id"] for r in out] == [7, 7]
    assert out[0]["job_name"] == "job one"
    assert out[1]["job_name"] is None  # removed by fields_to_remove on update
    assert out[1]["timeout_seconds"] == 60


def test_job_runs(audit):
    out = {r["run_id"]: r for r in job_runs(audit).collect()}
    assert out[55]["terminalState"] == "Succeeded" and out[55]["TaskRunTime"]["runTimeMS"] == 100
    assert out[55]["TaskExecutionRunTime"]["runTimeMS"] == 90 and out[55]["cluster_id"] == "c1"
    assert out[56]["terminalState"] == "Cancelled" and out[56]["TaskRunTime"]["runTimeMS"] == 100


def test_pools_and_audit_facts(audit, spark):
    snap = spark.createDataFrame([("o1", "p1", 1000, "m5-large")],
                                 "organization_id string, instance_pool_id string, Pipeline_SnapTS long, "
                                 "instance_pool_name string")
    p = pools_spec(audit, snap).collect()
    assert len(p) == 1 and p[0]["instance_pool_id"] == "p1" and p[0]["node_type_id"] == "m5"
    assert p[0]["instance_pool_name"] == "m5-large" and p[0]["create_details"]["created_by"] == "a@x"
    assert account_logins(audit).count() == 1
    mods = account_mods(audit).orderBy("timestamp").collect()
    assert [m["user_id"] for m in mods] == ["99", "99"]
    assert notebooks(audit).first()["notebook_name"] == "nb"


def test_publish_gold_tables(audit, spark):
    from tessera.plans.medallion.published import GOLD_TABLES, publish_gold
    snap = spark.createDataFrame([], "organization_id string, cluster_id string, cluster_name string, "
                                     "driver_node_type_id string, node_type_id string, spark_version string, "
                                     "Pipeline_SnapTS long")
    g = publish_gold(cluster_spec(audit, snap), "cluster", missing="null")
    assert g.columns == [o for o, _ in GOLD_TABLES["cluster"]]
    r = g.orderBy("unixTimeMS").first()
    assert r["action"] == "create" and r["date"] is not None and r["created_by"] == "creator@x"
    with pytest.raises(ValueError, match="jobrun: silver columns not built"):
        publish_gold(job_runs(audit).drop("run_id"), "jobrun")
    jr = publish_gold(job_runs(audit), "jobrun", missing="null")
    assert set(r["run_id"] for r in jr.collect()) == {55, 56}
    assert publish_gold(notebooks(audit), "notebook", missing="null").first()["notebook_name"] == "nb"


def test_job_run_meta_and_task_detail(audit, spark):
    from tessera.plans.medallion.silver_audit import job_runs_with_meta, job_runs_with_task_detail
    runs = job_runs(audit)
    tasks = json.dumps([{"task_key": "only", "job_cluster_key": "jc", "notebook_task": {"notebook_path": "/n"}}])
    clusters = json.dumps([{"job_cluster_key": "jc", "new_cluster": {"node_type_id": "m5"}}])
    status = spark.createDataFrame([("o1", 7, 50, "job seven", tasks, clusters)],
                                   "organization_id string, job_id long, timestamp long, job_name string, "
                                   "tasks string, job_clusters string")
    spec = spark.createDataFrame([("o1", "c1", 10, "cname")],
                                 "organization_id string, cluster_id string, timestamp long, cluster_name string")
    enriched = job_runs_with_meta(runs, cluster_spec=spec, job_status=status)
    out = {r["run_id"]: r for r in job_runs_with_task_detail(enriched).collect()}
    r55 = out[55]
    assert r55["job_name"] == "job seven" and r55["cluster_name"] == "cname"
    assert r55["task_key"] == "only" and r55["task_detail"]["notebook_task"]["notebook_path"] == "/n"
    assert r55["job_cluster"]["node_type_id"] == "m5"
    wh = spark.createDataFrame([(1, "c", None, json.dumps([{"task_key": "q", "sql_task": {"warehouse_id": "w1"}}]),
                                 None, None)],
                               "run_id long, cluster_id string, task_key string, tasks string, cluster_name string, "
                               "run_name string")
    w = job_runs_with_task_detail(wh).first()
    assert w["cluster_id"] == "w1" and w["clusterType"] == "sqlWarehouse" and w["run_name"] == "q"


def test_audit_builders_sliced_equal_plain(audit, spark):
    snap = spark.createDataFrame([], "organization_id string, cluster_id string, cluster_name string, "
                                     "driver_node_type_id string, node_type_id string, spark_version string, "
                                     "Pipeline_SnapTS long")
    cols = ["cluster_id", "actionName", "timestamp", "driver_node_type_id", "createdBy", "lastEditedBy"]
    a = sorted(map(tuple, cluster_spec(audit, snap).select(cols).collect()))
    b = sorted(map(tuple, cluster_spec(audit, snap, slice_ms=60).select(cols).collect()))
    assert a == b
    jc = ["job_id", "timestamp", "job_name", "timeout_seconds"]
    assert sorted(map(tuple, job_status(audit).select(jc).collect())) == \
        sorted(map(tuple, job_status(audit, slice_ms=60).select(jc).collect()))
    mods = sorted(map(tuple, account_mods(audit).select("timestamp", "user_id").collect()))
    assert mods == sorted(map(tuple, account_mods(audit, slice_ms=5).select("timestamp", "user_id").collect()))


def test_job_status_legacy_and_repairs(spark):
    rows = [_row("jobs", "create", 100, "a", {"name": "x", "new_settings": json.dumps(
                {"notebook_task": {"notebook_path": "/nb"}})}, result=json.dumps({"job_id": 3})),
            _row("jobs", "runNow", 200, "b", {"job_id": "3"}, result=json.dumps({"run_id": 9})),
            _row("jobs", "repairRun", 300, "c", {"run_id": "9"}, result=json.dumps({"repair_id": 1})),
            _row("jobs", "repairRun", 400, "d", {"run_id": "9"}, result=json.dumps({"repair_id": 2}))]
    audit = spark.createDataFrame(rows, SCHEMA)
    js = job_status(audit).first()
    assert json.loads(js["task_detail_legacy"]["notebook_task"])["notebook_path"] == "/nb"
    jr = job_runs(audit).first()
    assert jr["repair_id"] == 2 and len(jr["repair_details"]) == 2
