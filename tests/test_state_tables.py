"""Null partitions, map columns and run lineage on small rows."""

import json
import os
import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import tables as K
from tessera.operators import windows as W
from tessera.operators.lineage import nest_runs, resolve_roots, summarize_runs
from tessera.session import ensure_checkpoint_dir

ROWS = "k int, part string, v int, run_id string"


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    spec = K.TableSpec("t", str(tmp_path / "t"), keys=("k",), partition_by=("part",), mode="merge", tenant_col=None)
    K.write_upsert(spark.createDataFrame([(1, None, 1, "a"), (2, None, 2, "a"), (3, "x", 3, "a")], ROWS), spec)
    update = spark.createDataFrame([(2, None, 20, "b"), (4, None, 40, "b")], ROWS)
    want = [(1, None, 1, "a"), (2, None, 20, "b"), (3, "x", 3, "a"), (4, None, 40, "b")]
    for _ in range(2):  # a repeated merge changes nothing
        K.write_upsert(update, spec)
        assert rows(K.read_table(spark, spec), "k", "part", "v", "run_id") == want


def test_rollback_reaches_the_null_partition(spark, tmp_path):
    spec = K.TableSpec("t", str(tmp_path / "t"), keys=("k",), partition_by=("part",), tenant_col=None)
    K.write_append(spark.createDataFrame([(1, None, 1, "a"), (2, "x", 2, "a"), (3, None, 3, "bad"), (4, "x", 4, "bad")], ROWS), spec)
    assert K.keep_rows(spark, spec, lambda t: K.rollback_run(t, "bad")) == 2
    assert rows(K.read_table(spark, spec), "k") == [(1,), (2,)]


def test_failed_merge_run_is_rolled_back_in_a_null_partition(spark, tmp_path):
    from tessera.operators.incremental import ModuleSpec, run_module
    import pytest
    spec = K.TableSpec("t", str(tmp_path / "t"), keys=("k",), partition_by=("part",), mode="append", tenant_col=None)
    K.write_append(spark.createDataFrame([(1, None, 1, "old")], ROWS), spec)

    def breaks(frm, until):
        K.write_append(spark.createDataFrame([(2, None, 2, "now")], ROWS), spec)  # rows that the run got out before it failed
        raise RuntimeError("source gone")
    with pytest.raises(RuntimeError):
        run_module(spark, ModuleSpec(1, "m"), str(tmp_path / "state"), breaks, spec, 2_000, 1_000, "now")
    assert rows(K.read_table(spark, spec), "k") == [(1,)]


def test_map_columns_have_a_total_order(spark):
    rng = random.Random(4)
    data = []
    for i in range(200):
        pairs = [(k, rng.choice([None, 1, 2])) for k in "abc"]
        rng.shuffle(pairs)
        m = None if rng.random() < 0.1 else dict(pairs)
        data.append((i % 3, i // 60, m, [{"n": dict(pairs[:2])}], (dict(pairs[1:]),)))
    schema = "k int, t int, m map<string,int>, l array<map<string,map<string,int>>>, s struct<x:map<string,int>>"
    a = W.dedup_by_key(spark.createDataFrame(data, schema), ["k"], ["t"])
    rng.shuffle(data)
    b = W.dedup_by_key(spark.createDataFrame(data, schema).repartition(7), ["k"], ["t"])
    assert a.schema == spark.createDataFrame([], schema).schema
    assert "Window" not in a._jdf.queryExecution().toString()
    key = lambda r: json.dumps([r["k"], r["t"], r["m"], r["l"], r["s"]["x"]], sort_keys=True)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    w = W.dedup_by_key_window(spark.createDataFrame(data, schema), ["k"], ["t"])
    assert sorted(map(key, w.collect())) == sorted(map(key, a.collect()))


def brute_roots(links):
    out = {}
    for i in links:
        path, at = [i], i
        while links.get(at) is not None and links[at] != at and links[at] in links and links[at] not in path:
            at = links[at]
            path.append(at)
        nxt = links.get(at)
        circle = nxt is not None and nxt != at and nxt in links
        if circle:
            out[i] = (i, None, 0, True)
        else:
            out[i] = (at, path[-2] if len(path) > 1 else None, len(path) - 1, nxt is not None and nxt != at)
    return out


def test_roots_equal_a_walk(spark):
    rng = random.Random(9)
    for n in (1, 40, 120):
        links = {i: rng.choice([None, i, *range(n + 5)]) if rng.random() < 0.3 else (i - 1 if i else None) for i in range(n)}
        data = [(i, x if i % 2 else None, x if i % 2 == 0 else None) for i, x in links.items()]
        df = spark.createDataFrame(data, "run_id long, parent long, context long")
        got = {r["run_id"]: (r["root"], r["top"], r["depth"], r["orphan"]) for r in resolve_roots(df, "run_id", ["parent", "context"]).collect()}
        assert got == brute_roots(links)


def test_nesting_places_every_run_once(spark):
    data = [("t1", 1, None, 5), ("t1", 2, 1, 4), ("t1", 3, 2, 3), ("t1", 4, 3, 2), ("t1", 5, 99, 1), ("t2", 2, None, 7), ("t2", 6, 2, 1), ("t1", None, 1, 3), ("t1", 7, 1, 1)]
    df = spark.createDataFrame(data, "org string, run_id long, parent long, cost long")
    r = resolve_roots(df, "run_id", ["parent"], ["org"])
    nested = {(x["org"], x["run_id"]): x for x in nest_runs(r, "run_id", ["cost"], ["org"]).collect()}
    assert set(nested) == {("t1", 1), ("t1", 5), ("t2", 2), ("t1", None)}
    one = nested["t1", 1]
    assert [c["run_id"] for c in one["children"]] == [7, 2] and [c["run_id"] for c in one["children"][1]["workflow_children"]] == [4, 3]
    assert nested["t1", 5]["orphan"] and nested["t1", 5]["children"] is None
    s = {(x["org"], x["root"]): (x["n_runs"], x["n_children"], x["max_depth"], x["cost"]) for x in summarize_runs(r, ["org"], ["cost"]).collect()}
    assert s["t1", 1] == (5, 2, 3, 15) and s["t2", 2] == (2, 1, 1, 8)
    assert resolve_roots(df.where("false"), "run_id", ["parent"], ["org"]).count() == 0


def test_job_runs_of_several_tasks_and_their_lineage(spark):
    from tessera.plans.medallion.silver_audit import job_runs, job_runs_rolled_up
    fields = ("job_id", "runId", "multitaskParentRunId", "parentRunId", "taskKey", "taskDependencies", "clusterId", "jobTaskType", "jobTerminalState", "workflow_context")
    schema = ("organization_id string, serviceName string, actionName string, timestamp long, requestId string, requestParams struct<" + ", ".join(f"{f}:string" for f in fields)
              + ">, response struct<result:string>, userIdentity struct<email:string>")

    def event(action, ts, result=None, **p):
        return ("o", "jobs", action, ts, f"r{ts}", tuple(p.get(f) for f in fields), (json.dumps(result) if result else None,), ("a@x",))
    audit = spark.createDataFrame([
        event("runNow", 10, {"run_id": 1}, job_id="7"),
        event("runStart", 11, runId="2", multitaskParentRunId="1", taskKey="a", clusterId="c", jobTaskType="notebook"),
        event("runStart", 12, runId="3", multitaskParentRunId="1", taskKey="b", taskDependencies='["a"]', clusterId="c"),
        event("runSucceeded", 20, runId="2", multitaskParentRunId="1", jobTerminalState="Succeeded"),
        event("runFailed", 21, runId="3", multitaskParentRunId="1", jobTerminalState="Failed", jobTaskType="python"),
        event("submitRun", 30, {"run_id": 4}, workflow_context=json.dumps({"root_run_id": 2})),
        event("runStart", 31, runId="4"), event("runSucceeded", 33, runId="4", jobTerminalState="Succeeded"),
        event("submitRun", 40, {"run_id": 5}, workflow_context=json.dumps({"root_run_id": 99})),
    ], schema)
    runs = {r["run_id"]: r for r in job_runs(audit).collect()}
    assert set(runs) == {2, 3, 4, 5}
    assert runs[2]["job_run_id"] == runs[3]["job_run_id"] == 1 and runs[2]["job_id"] == 7
    assert runs[3]["task_dependencies"] == ["a"] and runs[3]["task_type"] == "python" and runs[2]["task_type"] == "notebook"
    assert runs[3]["TaskRunTime"]["runTimeMS"] == 11 and runs[5]["TaskRunTime"]["runTimeMS"] is None
    rolled = {r["run_id"]: r for r in job_runs_rolled_up(job_runs(audit)).collect()}
    assert set(rolled) == {2, 3, 5} and [c["run_id"] for c in rolled[2]["children"]] == [4]
    assert rolled[5]["orphan"] and not rolled[2]["orphan"]


def test_set_history_equals_a_replay(spark):
    rng = random.Random(11)
    data = []
    for i in range(400):
        key = rng.choice(["hot", "hot", "hot", "x", None])
        changes = rng.choice([None, [], [(f"m{rng.randrange(4)}", rng.choice([None, "r", "w"])) for _ in range(rng.randint(1, 3))]])
        data.append((key, i // 3, i, changes, rng.choice([True, False, False, False, None])))
    sets, want = {}, {}
    for key, _, i, changes, replaces in data:
        now = {} if replaces else dict(sets.get(key, {}))
        for m, v in changes or []:
            now[m] = v
        sets[key] = {m: v for m, v in now.items() if v is not None}
        want[i] = sorted(sets[key].items())
    df = spark.createDataFrame(data, "k string, t int, i int, changes array<struct<member:string, value:string>>, replaces boolean")
    from tessera.operators.scd import set_at_events, set_history
    for bucket, width in ((None, 10_000), (F.floor(F.col("t") / 20), 7)):
        numbered, history = set_history(df, ["k"], ["t", "i"], bucket=bucket, slice_rows=width)
        got = {r["i"]: [tuple(m) for m in r["members"]] for r in set_at_events(numbered, history, ["k"], slice_rows=width).collect()}
        assert got == want


def test_job_permissions_and_people(spark):
    from tessera.operators.scd import set_at_events
    from tessera.plans.medallion.silver_audit import job_acl_history, job_status
    fields = ("job_id", "resourceId", "targetUserId", "aclPermissionSet", "access_control_list", "grants", "new_settings", "name")
    schema = ("organization_id string, date date, serviceName string, actionName string, timestamp long, requestId string, requestParams struct<" + ", ".join(f"{f}:string" for f in fields)
              + ">, response struct<result:string, statusCode:long>, userIdentity struct<email:string>")

    def event(action, ts, who, result=None, status=200, **p):
        return ("o", None, "jobs", action, ts, f"r{ts}", tuple(p.get(f) for f in fields), (json.dumps(result) if result else None, status), (who,))
    audit = spark.createDataFrame([
        event("create", 1, "ann", {"job_id": 7}, access_control_list=json.dumps([{"user_name": "ann", "permission_level": "OWNER"}, {"group_name": "ops", "permission_level": "VIEW"}])),
        event("changeJobAcl", 2, "ann", resourceId="7", targetUserId="bob", aclPermissionSet="RUN"),
        event("changeJobAcl", 3, "eve", status=403, resourceId="7", targetUserId="eve", aclPermissionSet="OWNER"),
        event("changeJobAcl", 4, "ann", resourceId="7", targetUserId="ops", aclPermissionSet="[]"),
        event("update", 5, "bob", job_id="7", new_settings=json.dumps({"name": "x"})),
        event("resetJobAcl", 6, "ann", job_id="7", grants=json.dumps([{"permission": "VIEW", "user_id": 5}])),
        event("delete", 8, "ann", job_id="7"),
    ], schema)
    for slice_ms in (None, 2):
        numbered, history = job_acl_history(audit, slice_ms)
        got = {r["timestamp"]: [tuple(m) for m in r["members"]] for r in set_at_events(numbered, history, ["organization_id", "job_id"]).collect()}
        assert got == {1: [("ann", "OWNER"), ("ops", "VIEW")], 2: [("ann", "OWNER"), ("bob", "RUN"), ("ops", "VIEW")], 4: [("ann", "OWNER"), ("bob", "RUN")], 6: [("5", "VIEW")]}
        people = {r["timestamp"]: (r["created_by"], r["created_ts"], r["last_edited_by"], r["last_edited_ts"], r["deleted_by"], r["deleted_ts"]) for r in job_status(audit, slice_ms=slice_ms).collect()}
        assert people[1] == ("ann", 1, "ann", 1, None, None) and people[6] == ("ann", 1, "bob", 5, None, None) and people[8] == ("ann", 1, "bob", 5, "ann", 8)


def test_cost_fact_refresh_equals_one_run(spark, tmp_path):
    """An open run is closed, a run on a state that went on is priced anew, a settled one stays."""
    from tessera.plans.medallion.gold import COST_COLS, job_run_cost_fact, refresh_job_run_costs
    H = 3_600_000

    def states(rows):
        return spark.createDataFrame([("o", "c", a * H, b * H, "RUNNING", float(b - a), 0.0, *[x * (b - a) for x in (1.0, 2.0, 3.0, 4.0)]) for a, b in rows],
                                     "organization_id string, cluster_id string, unixTimeMS_state_start long, unixTimeMS_state_end long, state string, "
                                     "uptime_in_state_H double, worker_potential_core_H double, " + ", ".join(f"{c} double" for c in COST_COLS))

    def runs(rows):
        return spark.createDataFrame([("o", i, "c", "existing", a * H, None if b is None else b * H, f"n{i}") for i, a, b in rows],
                                     "organization_id string, run_id long, cluster_id string, cluster_type string, run_start_ms long, run_end_ms long, job_name string")
    spec = K.TableSpec("f", str(tmp_path / "f"), keys=("run_id", "cluster_id"), mode="merge")
    assert refresh_job_run_costs(spark, spec, states([(0, 10)]), runs([]), 0, 10 * H) is None
    one = refresh_job_run_costs(spark, spec, states([(0, 4), (4, 10)]), runs([(1, 1, 3), (2, 5, 6), (3, 7, None)]), 0, 10 * H)
    assert {r["run_id"]: r["open_run"] for r in one.collect()} == {1: False, 2: False, 3: True}
    late_states, late_runs = states([(0, 4), (4, 14), (14, 20)]), runs([(1, 1, 3), (2, 5, 6), (3, 7, 16), (4, 12, 13)])
    two = refresh_job_run_costs(spark, spec, late_states, late_runs, 10 * H, 20 * H)
    assert {r["run_id"] for r in two.collect()} == {2, 3, 4}
    cols = ["run_id", "run_end", "open_run", "job_name", "cluster_states", "avg_cluster_share", "avg_overlapping_runs", *COST_COLS, "total_driver_cost", "total_worker_cost", "total_cost"]
    assert rows(K.read_table(spark, spec), *cols) == rows(job_run_cost_fact(late_states, late_runs, 20 * H), *cols)
    assert refresh_job_run_costs(spark, spec, late_states, late_runs, 20 * H, 30 * H) is not None  # the last state went on


def test_reference_overlaps_equal_all_pairs(spark):
    from tessera.operators.joins import overlap_runtime_reference
    rng = random.Random(21)
    data = []
    for i in range(260):
        s = rng.randrange(1000, 1060)
        data.append((rng.choice(["hot", "hot", "x"]), i, s, s + rng.choice([0, 0, 1, 3, 9, 20, -4]), s - rng.randrange(5), s + rng.randrange(30)))
    data += [("alone", 900, 5, 5, 1, 9), ("bad", 901, 9, 5, 1, 9)]
    want = {}
    for g, i, os, oe, oss, _ in data:
        n = t = 0
        for h, _, ls, le, _, lse in data:
            if g == h:
                if ls < os and os < le < oe:
                    n, t = n + 1, t + le - oss
                elif os < ls < oe and le > oe:
                    n, t = n + 1, t + lse - os
                elif os <= ls <= oe and os <= le <= oe:
                    n, t = n + 1, t + le - os
        if n:
            want[g, i] = (t, n - 1)
    df = spark.createDataFrame(data, "g string, i int, s long, e long, ss long, se long")
    for bucket in (None, 7.0):
        out = overlap_runtime_reference(df, ["g"], "i", "s", "e", "ss", "se", bucket)
        assert {(r["g"], r["i"]): (r["cum_runtime"], r["overlapping_runs"]) for r in out.collect()} == want
    assert overlap_runtime_reference(df.where("false"), ["g"], "i", "s", "e", "ss", "se").count() == 0


def test_bounded_lookups_sliced_equal_plain(spark):
    from tessera.operators.timeseries import TimeSeries
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice("ab"), rng.randrange(60), i, rng.choice([None, 1.0])) for i in range(90)], "k string, t long, i int, own double")
    right = spark.createDataFrame([(rng.choice("ab"), rng.randrange(60), rng.choice([None, j]), rng.choice([None, 2.0, 3.0])) for j in range(90)], "k string, t long, j int, own double")
    for back, ahead in ((3, 0), (1, 2), (0, 3), (None, 2), (5, None), (2, 1)):
        plain = TimeSeries(left, "t", ("k",)).lookup_when(TimeSeries(right, "t", ("k",)), lookback_rows=back, lookahead_rows=ahead)
        sliced = TimeSeries(left, "t", ("k",)).lookup_when(TimeSeries(right, "t", ("k",)), lookback_rows=back, lookahead_rows=ahead, slice_size=7)
        assert rows(sliced) == rows(plain)


def test_every_gold_table_is_typed_alike(spark):
    """A frame of the key columns alone is published in the declared types, all else null."""
    from tessera.plans.medallion import published as P
    for name, mapping in P.GOLD_TABLES.items():
        keys = ["organization_id", *P.GOLD_KEYS[name]]
        df = spark.createDataFrame([["x"] * len(keys)], ", ".join(f"{k} string" for k in keys))
        out = P.publish_gold(df, name)
        assert out.columns == [o for o, _ in mapping] and out.count() == 1
        for o, src in mapping:
            want = spark.createDataFrame([], f"c {P.PUBLISHED_TYPES[o]}").schema["c"].dataType if o in P.PUBLISHED_TYPES else None
            if want is not None and not src.startswith("@"):
                assert out.schema[o].dataType == want, (name, o)


def test_a_second_intake_reads_nothing(spark, tmp_path):
    from pyspark.sql import types as T
    from tessera.plans.medallion.bronze import land_spark_events
    logs = tmp_path / "logs" / "c1" / "eventlog" / "host" / "ctx"
    logs.mkdir(parents=True)
    schema = T.StructType([T.StructField("Event", T.StringType()), T.StructField("Job ID", T.LongType()), T.StructField("sparkPlanInfo", T.StringType()),
                           T.StructField("Properties", T.StructType([T.StructField("spark.x", T.StringType())]))])

    def take(run, **window):
        return [f.collect() for f in land_spark_events(spark, str(tmp_path / "logs"), str(tmp_path / "land"), str(tmp_path / "ckpt"), run, schema, "o", **window)]
    (logs / "one").write_text('{"Event": "a", "Job ID": 1, "sparkPlanInfo": "wide"}\n[1]\nbroken\n\n')
    good, bad = take("r1")
    assert [(r["Event"], r["JobID"], r["clusterId"], r["SparkContextId"]) for r in good] == [("a", 1, "c1", "ctx")] and "sparkPlanInfo" not in good[0]
    assert sorted(r["_corrupt_record"] for r in bad) == ["", "[1]", "broken"]
    assert take("r2") == [[], []]
    (logs / "two").write_text('{"Event": "b", "Job ID": 2}\n')
    assert [r["JobID"] for r in take("r3")[0]] == [2]
    (logs / "three").write_text('{"Event": "c", "Job ID": 3}\n')
    assert take("r4", until_ms=1)[0] == []  # landed, outside the window of this run


def test_log_destinations_of_audit_and_snapshot(spark):
    from tessera.sources.files import log_destinations, log_prefixes
    audit = spark.createDataFrame([("o", "c1", json.dumps({"dbfs": {"destination": "dbfs:/a/"}})), ("o", "c1", json.dumps({"s3": {"destination": "s3://b", "region": "x"}})),
                                   ("o", "c2", None), ("o", None, json.dumps({"dbfs": {"destination": "lost"}}))], "organization_id string, cluster_id string, cluster_log_conf string")
    snap = spark.createDataFrame([("o", "c1", (("old",),)), ("o", "c3", (("dbfs:/c",),)), ("p", "c1", (("q",),)), ("o", "c4", None)],
                                 "organization_id string, cluster_id string, cluster_log_conf struct<dbfs:struct<destination:string>>")
    both = log_destinations(audit, snap)
    assert rows(both, "organization_id", "cluster_id", "destination") == [("o", "c1", "dbfs:/a/"), ("o", "c1", "s3://b"), ("o", "c3", "dbfs:/c"), ("p", "c1", "q")]
    assert rows(log_destinations(snapshot=snap), "destination") == [("dbfs:/c",), ("old",), ("q",)]
    assert ("dbfs:/a/c1/eventlog",) in rows(log_prefixes(both, "destination", "cluster_id"))


def test_run_lookups_sliced_equal_plain(spark):
    from tessera.plans.medallion.silver_audit import job_runs_with_meta
    rng = random.Random(8)
    runs = spark.createDataFrame([("o", i, rng.choice([None, "c", "c", "d"]), rng.choice([None, 1, 2]), rng.randrange(100), f"r{i}") for i in range(60)],
                                 "organization_id string, run_id long, cluster_id string, job_id long, submissionTime long, run_name string")
    spec = spark.createDataFrame([("o", rng.choice([None, "c", "d"]), t, f"n{t}") for t in range(0, 100, 7)], "organization_id string, cluster_id string, timestamp long, cluster_name string")
    status = spark.createDataFrame([("o", rng.choice([None, 1]), t, f"j{t}", None, None) for t in range(0, 100, 9)], "organization_id string, job_id long, timestamp long, job_name string, tasks string, job_clusters string")
    a, b = (rows(job_runs_with_meta(runs, spec, job_status=status, slice_ms=s), "run_id", "cluster_name", "job_name") for s in (None, 10))
    assert a == b and {r[1] for r in a if r[0] in {x["run_id"] for x in runs.where("cluster_id IS NULL").collect()}} == {None}


def test_cluster_security_and_pool_details(spark):
    from tessera.plans.medallion.silver_audit import cluster_type, pools_spec, security_profile
    confs = [(json.dumps({"x.cluster.profile": "singleNode", "spark.y.acl.dfAclsEnabled": "true", "spark.y.repl.allowedLanguages": "python,sql"}), "ann"),
             (json.dumps({"spark_y_passthrough_enabled": True, "spark.y.pyspark.enableProcessIsolation": "no"}), None), (None, None), ("{}", None)]
    df = spark.createDataFrame(confs, "conf string, who string")
    got = [(r["t"], *r["p"]) for r in df.select(cluster_type(F.col("conf"), F.lit(None).cast("string")).alias("t"), security_profile(F.col("conf"), F.col("who"), F.lit("m")).alias("p")).collect()]
    assert got == [("Single Node", "ann", "m", True, True, False, False, ["python", "sql"]), ("Standard", None, "m", False, False, True, False, ["All"]),
                   ("Standard", None, "m", False, False, False, False, ["All"]), ("Standard", None, "m", False, False, False, False, ["All"])]
    audit = spark.createDataFrame([("o", "instancePools", "edit", 5, "r", ("p1", None), (None, 200), ("a",), "1.1.1.1")],
                                  "organization_id string, serviceName string, actionName string, timestamp long, requestId string, requestParams struct<instance_pool_id:string, node_type_id:string>, "
                                  "response struct<result:string, statusCode:long>, userIdentity struct<email:string>, sourceIPAddress string")
    snap = spark.createDataFrame([("o", "p1", 9, {"zone": "z"}, "n")], "organization_id string, instance_pool_id string, Pipeline_SnapTS long, aws_attributes map<string,string>, node_type_id string")
    from tessera.plans.medallion.published import publish_gold
    r = publish_gold(pools_spec(audit, snap), "instancepool").first()
    assert r["aws_attributes"] == '{"zone":"z"}' and r["node_type_id"] == "n" and r["serviceName"] == "instancePools"
    assert r["request_details"]["sourceIPAddress"] == "1.1.1.1" and r["request_details"]["response"]["statusCode"] == 200


def test_views_of_published_tables(spark):
    from tessera.plans.medallion.gold import publish_consumer_views
    from tessera.plans.medallion.published import GOLD_TABLES, publish_gold, view_columns
    stage = spark.createDataFrame([("o", 3)], "organization_id string, StageID long")
    publish_consumer_views(spark, {"sparkstage": publish_gold(stage, "sparkstage")}, prefix="w_")
    assert spark.table("w_sparkstage").columns == [c for c in view_columns("sparkstage") if c != "workspace_name"]
    assert all(view_columns(t)[:2] == ("organization_id", "workspace_name") and len(set(view_columns(t))) == len(view_columns(t)) for t in GOLD_TABLES)


def test_first_jump_needs_no_table_of_links(spark):
    """Of three levels, two tables are written: the runs after one jump and the rest after two."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("e", "d"), ("f", "e")], "run_id string, parent string")
    before = set(os.listdir(folder))
    got = {r["run_id"]: (r["root"], r["top"], r["depth"], r["orphan"]) for r in resolve_roots(df, "run_id", ["parent"]).collect()}
    assert got == {"a": ("a", None, 0, False), "b": ("a", "b", 1, False), "c": ("a", "b", 2, False), "d": ("d", None, 0, True), "e": ("d", "e", 1, True), "f": ("d", "e", 2, True)}
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("stage-")]) == 2
