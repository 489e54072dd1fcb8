"""Silver builders over the audit log (V8 pools, V9 cluster spec, V11 job status, V12
job runs). Audit ``requestParams`` differ per service, so every field is read through
``_rp``: present -> the field, absent -> a typed null (decided at plan time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import epoch_ms, is_automated, runtime_struct
from tessera.operators.incremental import impute_first_run
from tessera.operators.lineage import nest_runs, resolve_roots
from tessera.operators.schema import nested_col_exists
from tessera.operators.scd import set_history
from tessera.operators.timeseries import TimeSeries
from tessera.operators.windows import dedup_by_key, fill_forward, fill_unless_removed, future_fill

ORG = "organization_id"


def _rp(df: DataFrame, name: str, dtype: str = "string") -> Column:
    path = f"requestParams.{name}"
    return F.col(path).cast(dtype) if nested_col_exists(df.schema, path, True) else F.lit(None).cast(dtype)


def _result(path: str, dtype: str = "string") -> Column:
    return F.get_json_object(F.col("response.result"), f"$.{path}").cast(dtype)


def _ok() -> Column:
    return F.coalesce(F.col("response.statusCode"), F.lit(200)) == 200


def _slices(slice_ms: float | None, col: str = "timestamp") -> Column | None:
    """Time-slice bucket for the skew-safe operator forms (None = plain windows)."""
    return F.floor(F.col(col) / F.lit(float(slice_ms))).cast("long") if slice_ms else None


def _snap_ms(df: DataFrame, col: str = "Pipeline_SnapTS") -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return epoch_ms(col, dt)
    return F.col(col).cast("long")


# ------------------------------------------------------------------ V8 pools

# Pool attributes that the audit log and the snapshot both carry.
POOL_ATTRS = ("node_type_id", "idle_instance_autotermination_minutes", "min_idle_instances", "max_capacity",
              "preloaded_spark_versions", "enable_elastic_disk", "custom_tags", "instance_pool_name",
              "aws_attributes", "azure_attributes")


def _text(df: DataFrame, c: str) -> Column:
    """A snapshot column as text: nested ones as JSON, as the audit log writes them."""
    nested = isinstance(df.schema[c].dataType, (T.StructType, T.MapType, T.ArrayType))
    return F.to_json(c) if nested else F.col(c).cast("string")


def pools_spec(audit: DataFrame, pools_snapshot: DataFrame, first_run: bool = False,
               from_ms: int | None = None, slice_ms: float | None = None) -> DataFrame:
    """V8: pool create/edit/delete events; pool id from the create response; one row per
    (pool, action, timestamp) (every event kept - the reference's window kept only the
    first per pool); snapshot looked up as-of with unlimited look-ahead; the
    attributes filled forward with the snapshot as second choice; create/delete details
    on successful events, filled forward. First run: pools never seen get an imputed row."""
    a = audit.filter((F.col("serviceName") == "instancePools") & F.col("actionName").isin("create", "edit", "delete"))
    pid = F.when(F.col("actionName") == "create", _result("instance_pool_id")).otherwise(_rp(a, "instance_pool_id"))
    asked = F.struct(*[(F.col(c) if c in a.columns else F.lit(None).cast("string")).alias(c) for c in (
        "requestId", "response", "sessionId", "sourceIPAddress", "userAgent")])
    base = a.select(ORG, "serviceName", "timestamp", F.to_date(F.timestamp_millis("timestamp")).alias("date"), "actionName", "requestId", pid.alias("instance_pool_id"),
                    asked.alias("request_details"),
                    *[_rp(a, c).alias(c) for c in POOL_ATTRS],
                    F.col("userIdentity.email").alias("user_email"), _ok().alias("__ok"))
    base = base.filter(F.col("instance_pool_id").isNotNull())
    base = dedup_by_key(base, [ORG, "instance_pool_id", "actionName", "timestamp"], ["requestId"])
    snap = pools_snapshot.select(ORG, "instance_pool_id", _snap_ms(pools_snapshot).alias("timestamp"),
                                 *[_text(pools_snapshot, c).alias(f"snap_{c}") for c in POOL_ATTRS
                                   if c in pools_snapshot.columns])
    d = TimeSeries(base, "timestamp", (ORG, "instance_pool_id")).lookup_when(
        TimeSeries(snap, "timestamp", (ORG, "instance_pool_id")), lookahead_rows=None, slice_size=slice_ms)
    lookups = {c: [f"snap_{c}"] for c in POOL_ATTRS if f"snap_{c}" in d.columns}
    d = fill_forward(d, list(POOL_ATTRS), [ORG, "instance_pool_id"], ["timestamp", "requestId"], lookups=lookups,
                     bucket=_slices(slice_ms))
    d = d.withColumns({
        "create_details": F.when((F.col("actionName") == "create") & F.col("__ok"),
                                 F.struct(F.col("user_email").alias("created_by"), F.col("timestamp").alias("created_at"))),
        "delete_details": F.when((F.col("actionName") == "delete") & F.col("__ok"),
                                 F.struct(F.col("user_email").alias("deleted_by"), F.col("timestamp").alias("deleted_at")))})
    d = fill_forward(d, ["create_details"], [ORG, "instance_pool_id"], ["timestamp", "requestId"],
                     bucket=_slices(slice_ms))
    d = d.drop("__ok", *[c for c in d.columns if c.startswith("snap_")])
    if first_run and from_ms is not None:
        snap_rows = pools_snapshot.select(ORG, "instance_pool_id", _snap_ms(pools_snapshot).alias("__snap"),
                                          *[_text(pools_snapshot, c).alias(c) for c in POOL_ATTRS
                                            if c in pools_snapshot.columns])
        d = impute_first_run(d, snap_rows, [ORG, "instance_pool_id"], ["__snap"], F.lit(from_ms), "timestamp").drop(
            "__snap")
    return d


# ------------------------------------------------------------------ V9 cluster spec

def _conf_value(conf_json: Column, ending: str) -> Column:
    """The value of the conf key that ends in ``ending`` (dots or underscores between its words),
    whatever the platform's prefix; null if there is none."""
    key = '"[^"]*' + ending.replace(".", "[._]") + '"\\s*:\\s*'
    quoted, bare = (F.regexp_extract(conf_json, key + v, 1) for v in ('"([^"]*)"', '([^",{}\\[\\]\\s]+)'))
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(bare, F.lit("")))


def security_profile(conf_json: Column, single_user: Column, mode: Column) -> Column:
    """V9: who may use a cluster and how: access lists, credentials passed through, isolated
    processes (all off unless the conf says so) and the languages allowed."""
    on = lambda ending: F.coalesce(_conf_value(conf_json, ending).try_cast("boolean"), F.lit(False))
    return F.struct(
        single_user.alias("user_name"), mode.alias("mode"), single_user.isNotNull().alias("is_single_user"), on("acl.dfAclsEnabled").alias("table_acls_enabled"),
        on("passthrough.enabled").alias("credential_passthrough_enabled"), on("pyspark.enableProcessIsolation").alias("isolation_enabled"),
        F.coalesce(F.split(_conf_value(conf_json, "repl.allowedLanguages"), ","), F.array(F.lit("All"))).alias("repl_languages_permitted"))


# Further cluster-spec fields published as they are (output, request field).
CLUSTER_EXTRA_FIELDS = (
    ("autoTermination_minutes", "autotermination_minutes"), ("enable_elastic_disk", "enable_elastic_disk"),
    ("cluster_log_conf", "cluster_log_conf"), ("init_scripts", "init_scripts"), ("aws_attributes", "aws_attributes"),
    ("azure_attributes", "azure_attributes"), ("spark_env_vars", "spark_env_vars"),
    ("acl_path_prefix", "acl_path_prefix"), ("idempotency_token", "idempotency_token"),
    ("cluster_source", "cluster_source"),
)


def cluster_type(spark_conf_json: Column, custom_tags_json: Column) -> Column:
    """Single Node / Serverless / SQL Analytics / Standard. The profile is the value of
    the conf key ending in ``cluster.profile`` (whatever the platform prefix)."""
    profile = _conf_value(spark_conf_json, "cluster.profile")
    return (F.when(profile == "singleNode", "Single Node").when(profile == "serverless", "Serverless")
            .when(F.get_json_object(custom_tags_json, "$.SqlEndpointId").isNotNull(), "SQL Analytics")
            .otherwise("Standard"))


def runtime_engine(own: Column, spark_version: Column) -> Column:
    return F.coalesce(own, F.when(spark_version.contains("_photon_"), "PHOTON"), F.lit("STANDARD"))


def _repaired(d: DataFrame, col: str, by: str, max_rows: int | None, slice_ms: float | None) -> DataFrame:
    """A missing ``col`` from the next row with the same ``by``. Rows without ``by`` name nothing:
    they stay as they are instead of forming one series of strangers."""
    known = future_fill(d.filter(F.col(by).isNotNull()), [col], [ORG, by], ["timestamp", "requestId"], max_rows=max_rows,
                        out_suffix="__f", bucket=_slices(slice_ms))
    return known.withColumn(col, F.coalesce(col, f"{col}__f")).drop(f"{col}__f").unionByName(d.filter(F.col(by).isNull()))


def _lookup_by(d: DataFrame, other: DataFrame, key_col: str, slice_ms: float | None, lookahead_rows: int | None = 0) -> DataFrame:
    """As-of lookup by (tenant, ``key_col``). Rows without the key (often most rows) match
    nothing: they stay out of the series instead of forming one huge null series."""
    key = (ORG, key_col)
    found = TimeSeries(d.filter(F.col(key_col).isNotNull()), "timestamp", key).lookup_when(
        TimeSeries(other.filter(F.col(key_col).isNotNull()), "timestamp", key), lookahead_rows=lookahead_rows, slice_size=slice_ms)
    return found.unionByName(d.filter(F.col(key_col).isNull()), allowMissingColumns=True)


def _pool_lookup(d: DataFrame, pools: DataFrame, pool_id: str, slice_ms: float | None) -> DataFrame:
    return _lookup_by(d, pools, pool_id, slice_ms, lookahead_rows=None)


def cluster_spec(audit: DataFrame, clusters_snapshot: DataFrame, pools: DataFrame | None = None,
                 first_run: bool = False, from_ms: int | None = None, slice_ms: float | None = None,
                 repair_rows: int | None = None) -> DataFrame:
    """V9: cluster create/edit events (+ first-run snapshot imputation) with id/name
    repaired from later rows (W8; ``repair_rows`` bounds how many), pool node types looked up as-of, driver
    type by priority (driver pool -> worker pool -> own -> last known -> worker type),
    cluster type from the conf/tag JSON, security profile, creator and last editor
    histories, runtime engine."""
    a = audit.filter((F.col("serviceName") == "clusters") & (F.col("actionName") != "changeClusterAcl"))
    cid = F.coalesce(F.when(F.col("actionName") == "create", _result("cluster_id")), _rp(a, "cluster_id"),
                     _rp(a, "clusterId"))
    base = a.select(ORG, "timestamp", "date", "actionName", "requestId", cid.alias("cluster_id"),
                    _rp(a, "cluster_name").alias("cluster_name"), _rp(a, "driver_node_type_id").alias("driver_node_type_id"),
                    _rp(a, "node_type_id").alias("node_type_id"), _rp(a, "num_workers", "int").alias("num_workers"),
                    _rp(a, "autoscale").alias("autoscale"), _rp(a, "spark_version").alias("spark_version"),
                    _rp(a, "spark_conf").alias("spark_conf"), _rp(a, "custom_tags").alias("custom_tags"),
                    _rp(a, "instance_pool_id").alias("instance_pool_id"),
                    _rp(a, "driver_instance_pool_id").alias("driver_instance_pool_id"),
                    _rp(a, "single_user_name").alias("single_user_name"),
                    _rp(a, "data_security_mode").alias("data_security_mode"),
                    _rp(a, "runtime_engine").alias("runtime_engine"),
                    *[_rp(a, src).alias(out) for out, src in CLUSTER_EXTRA_FIELDS],
                    F.col("userIdentity.email").alias("user_email"), _ok().alias("__ok"))
    base = _repaired(base, "cluster_id", "cluster_name", repair_rows, slice_ms)
    base = _repaired(base, "cluster_name", "cluster_id", repair_rows, slice_ms)
    creators = dedup_by_key(base.filter((F.col("actionName") == "create") & F.col("__ok")).select(
        ORG, "cluster_id", "timestamp", F.col("user_email").alias("createdBy")), [ORG, "cluster_id"], ["timestamp"]
    ).drop("timestamp")
    # one deleter per cluster (first successful delete): a repeated delete never multiplies rows
    deleters = dedup_by_key(base.filter(F.col("actionName").isin("delete", "permanentDelete") & F.col("__ok")).select(
        ORG, "cluster_id", "timestamp", F.col("user_email").alias("deleted_by")), [ORG, "cluster_id"], ["timestamp"]
    ).drop("timestamp")
    d = base.filter(F.col("actionName").isin("create", "edit") & F.col("cluster_id").isNotNull())
    d = dedup_by_key(d, [ORG, "cluster_id", "actionName", "timestamp"], ["requestId"])
    if first_run and from_ms is not None:
        snap = clusters_snapshot.select(ORG, "cluster_id", "cluster_name", "driver_node_type_id", "node_type_id",
                                        "spark_version", _snap_ms(clusters_snapshot).alias("__snap"))
        d = impute_first_run(d, snap, [ORG, "cluster_id"], ["__snap"], F.lit(from_ms), "timestamp").drop("__snap")
    if pools is not None:
        pname = F.col("instance_pool_name") if "instance_pool_name" in pools.columns else F.lit(None).cast("string")
        pl = pools.select(ORG, "instance_pool_id", "timestamp", F.col("node_type_id").alias("pool_node_type"),
                          pname.alias("instance_pool_name"))
        d = _pool_lookup(d, pl, "instance_pool_id", slice_ms)
        dp = pl.withColumnsRenamed({"instance_pool_id": "driver_instance_pool_id", "pool_node_type": "driver_pool_node_type",
                                    "instance_pool_name": "driver_instance_pool_name"})
        d = _pool_lookup(d, dp, "driver_instance_pool_id", slice_ms)
    else:
        d = d.withColumns({"pool_node_type": F.lit(None).cast("string"),
                           "driver_pool_node_type": F.lit(None).cast("string"),
                           "instance_pool_name": F.lit(None).cast("string"),
                           "driver_instance_pool_name": F.lit(None).cast("string")})
    d = d.withColumn("node_type_id", F.coalesce("pool_node_type", "node_type_id"))
    d = d.withColumn("__own_driver", F.col("driver_node_type_id"))
    d = fill_forward(d, ["__own_driver"], [ORG, "cluster_id"], ["timestamp", "actionName"], bucket=_slices(slice_ms))
    d = d.withColumn("driver_node_type_id", F.coalesce("driver_pool_node_type", "pool_node_type", "driver_node_type_id",
                                                       "__own_driver", "node_type_id")).drop("__own_driver")
    d = d.withColumn("__editor", F.when(F.col("actionName") == "edit", F.col("user_email")))
    d = fill_forward(d, ["__editor"], [ORG, "cluster_id"], ["timestamp", "actionName"],
                     bucket=_slices(slice_ms)).withColumnRenamed("__editor", "lastEditedBy")
    d = d.join(creators, [ORG, "cluster_id"], "left").join(deleters, [ORG, "cluster_id"], "left")
    kind = cluster_type(F.col("spark_conf"), F.col("custom_tags"))
    d = d.withColumns({"num_workers": F.when(kind == "Single Node", 0).otherwise(F.col("num_workers")),  # whatever was asked for
                       "enable_elastic_disk": F.coalesce(F.col("enable_elastic_disk") != "false", F.lit(True))})
    return d.select(
        ORG, "cluster_id", "actionName", "timestamp", "date", "cluster_name", "driver_node_type_id", "node_type_id",
        "num_workers", "autoscale", "spark_version", "spark_conf", "custom_tags", "instance_pool_id",
        "driver_instance_pool_id", "instance_pool_name", "driver_instance_pool_name", kind.alias("cluster_type"),
        security_profile(F.col("spark_conf"), F.col("single_user_name"), F.col("data_security_mode")).alias("security_profile"), "createdBy", "lastEditedBy",
        runtime_engine(F.col("runtime_engine"), F.coalesce(F.col("spark_version"), F.lit(""))).alias("runtime_engine"),
        *[out for out, _ in CLUSTER_EXTRA_FIELDS], "deleted_by",
        is_automated(F.col("cluster_name")).alias("is_automated"))


# ------------------------------------------------------------------ V11 job status

# Audit actions that change a job.
JOB_ACTIONS = ("create", "delete", "reset", "update", "resetJobAcl", "changeJobAcl")
# Settings filled per job from new_settings / the snapshot, and the
# types the numeric / boolean ones are published with.
JOB_SETTINGS = ("name", "tags", "format", "schedule", "email_notifications", "existing_cluster_id", "job_clusters",
                "new_cluster", "tasks", "libraries", "git_source", "max_concurrent_runs", "max_retries",
                "timeout_seconds", "retry_on_timeout", "min_retry_interval_millis")
# Single-task job definitions kept together as task_detail_legacy
# (python_wheel_task included - the reference drops it by mistake).
JOB_LEGACY_TASKS = ("notebook_task", "spark_python_task", "python_wheel_task", "spark_jar_task", "spark_submit_task",
                    "shell_command_task", "pipeline_task")
JOB_SETTING_TYPES = {"max_concurrent_runs": "long", "max_retries": "long", "timeout_seconds": "long",
                     "retry_on_timeout": "boolean", "min_retry_interval_millis": "long"}


def job_status(audit: DataFrame, jobs_snapshot: DataFrame | None = None, slice_ms: float | None = None) -> DataFrame:
    """Job create/update/reset/delete/ACL events -> config history per job. Job id:
    create -> response, changeJobAcl -> resourceId, else job_id. The newest snapshot is
    looked up as-of (ms, unlimited look-ahead). Each setting: on ``update`` naming it
    in ``fields_to_remove`` -> null, else the new value, else filled forward, else the
    snapshot's value (W5)."""
    a = audit.filter((F.col("serviceName") == "jobs") & F.col("actionName").isin(*JOB_ACTIONS))
    job_id = (F.when(F.col("actionName") == "create", _result("job_id", "long"))
              .when(F.col("actionName") == "changeJobAcl", _rp(a, "resourceId", "long"))
              .otherwise(_rp(a, "job_id", "long")))
    base = a.select(ORG, "timestamp", "date", "actionName", "requestId", F.col("response.statusCode").alias("status_code"),
                    job_id.alias("job_id"), _rp(a, "name").alias("name_param"), _rp(a, "new_settings").alias("new_settings"),
                    _rp(a, "fields_to_remove").alias("fields_to_remove"), F.col("userIdentity.email").alias("user_email"),
                    *[_rp(a, s).alias(f"req_{s}") for s in JOB_SETTINGS + JOB_LEGACY_TASKS])
    base = base.filter(F.col("job_id").isNotNull())
    base = dedup_by_key(base, [ORG, "timestamp", "actionName", "requestId", "status_code"], ["job_id"])
    for s in JOB_SETTINGS + JOB_LEGACY_TASKS:
        base = base.withColumn(s, F.coalesce(F.get_json_object("new_settings", f"$.{s}"), F.col(f"req_{s}")))
    base = base.withColumn("name", F.coalesce(F.when(F.col("actionName") == "create", F.col("name_param")), F.col("name")))
    if jobs_snapshot is not None:
        snap = jobs_snapshot.select(ORG, F.col("job_id").cast("long").alias("job_id"),
                                    _snap_ms(jobs_snapshot).alias("timestamp"),
                                    F.to_json("settings").alias("snap_settings"),
                                    *[(F.col(c) if c in jobs_snapshot.columns else F.lit(None)).cast(t).alias(n) for c, t, n in (
                                        ("creator_user_name", "string", "snap_created_by"), ("created_time", "long", "snap_created_ts"))])
        base = TimeSeries(base, "timestamp", (ORG, "job_id")).lookup_when(
            TimeSeries(snap, "timestamp", (ORG, "job_id")), lookahead_rows=None, slice_size=slice_ms)
    else:
        base = base.withColumns({"snap_settings": F.lit(None).cast("string"), "snap_created_by": F.lit(None).cast("string"), "snap_created_ts": F.lit(None).cast("long")})
    w_keys, order = [ORG, "job_id"], ["timestamp", "requestId"]
    every = JOB_SETTINGS + JOB_LEGACY_TASKS
    # who made, edited and deleted the job, and when; the first two hold until the next such event
    act, who, at = F.col("actionName"), F.col("user_email"), F.col("timestamp")
    made, edited = act == "create", act.isin("update", "reset")
    people = {"created_by": F.when(made, who), "created_ts": F.when(made, at), "last_edited_by": F.when(edited, who), "last_edited_ts": F.when(edited, at)}
    filled = fill_forward(base.withColumns({f"__ff_{s}": F.col(s) for s in every} | people),
                          [*[f"__ff_{s}" for s in every], *people], w_keys, order, bucket=_slices(slice_ms))
    filled = filled.withColumns({
        "created_by": F.coalesce("created_by", "snap_created_by"), "created_ts": F.coalesce("created_ts", "snap_created_ts"),
        "deleted_by": F.when(act == "delete", who), "deleted_ts": F.when(act == "delete", at)})
    filled = filled.withColumns({"last_edited_by": F.coalesce("last_edited_by", "created_by"), "last_edited_ts": F.coalesce("last_edited_ts", "created_ts")})
    upd = F.col("actionName") == "update"
    out = filled.withColumns({s: fill_unless_removed(
        F.col(s), F.col("fields_to_remove"), s,
        F.coalesce(F.col(f"__ff_{s}"), F.get_json_object("snap_settings", f"$.{s}")), upd) for s in every})
    out = out.withColumn("task_detail_legacy", F.struct(*[F.col(t) for t in JOB_LEGACY_TASKS])).drop(
        *JOB_LEGACY_TASKS)
    out = out.withColumns({c: F.col(c).try_cast(t) for c, t in JOB_SETTING_TYPES.items()})
    return out.drop(*[f"__ff_{s}" for s in every], *[f"req_{s}" for s in every], "snap_settings", "snap_created_by",
                    "snap_created_ts", "name_param").withColumnRenamed("name", "job_name")


# How the audit log writes a job's permissions.
ACL_LIST = "array<struct<user_name:string, group_name:string, permission_level:string>>"
ACL_GRANTS = "array<struct<permission:string, user_id:string>>"


def job_acl_history(audit: DataFrame, slice_ms: float | None = None) -> tuple[DataFrame, DataFrame]:
    """V11 permissions: who may do what on a job, from when to when. ``create`` and ``resetJobAcl``
    replace the whole list (their ``access_control_list`` or ``grants``), ``changeJobAcl`` sets one
    user's permission (an empty one takes it away). Returns ``(events, history)`` as
    ``set_history`` does; ``set_at_events`` of them gives the list in force after each event."""
    a = audit.filter((F.col("serviceName") == "jobs") & F.col("actionName").isin("create", "resetJobAcl", "changeJobAcl") & _ok())
    act = F.col("actionName")
    job_id = (F.when(act == "create", _result("job_id", "long")).when(act == "changeJobAcl", _rp(a, "resourceId", "long"))
              .otherwise(F.coalesce(_rp(a, "job_id", "long"), _rp(a, "resourceId", "long"))))
    pair = lambda who, what: F.struct(who.alias("member"), F.nullif(what, F.lit("")).alias("value"))
    listed = F.transform(F.from_json(_rp(a, "access_control_list"), ACL_LIST), lambda x: pair(F.coalesce(x["user_name"], x["group_name"]), x["permission_level"]))
    granted = F.transform(F.from_json(_rp(a, "grants"), ACL_GRANTS), lambda x: pair(x["user_id"], x["permission"]))
    one = F.array(pair(_rp(a, "targetUserId"), F.nullif(_rp(a, "aclPermissionSet"), F.lit("[]"))))
    none = F.array().cast("array<struct<member:string, value:string>>")
    changes = F.when(act == "changeJobAcl", one).otherwise(F.coalesce(listed, granted, none))
    ev = a.select(ORG, job_id.alias("job_id"), "timestamp", "requestId", "actionName", changes.alias("changes"), (act != "changeJobAcl").alias("replaces"))
    ev = dedup_by_key(ev.filter(F.col("job_id").isNotNull()), [ORG, "job_id", "timestamp", "requestId", "actionName"])
    return set_history(ev, [ORG, "job_id"], ["timestamp", "requestId", "actionName"], bucket=_slices(slice_ms))


# ------------------------------------------------------------------ V12 job runs

def job_runs(audit: DataFrame) -> DataFrame:
    """Submissions (runNow / submitRun / runTriggered) LEFT JOIN starts LEFT JOIN
    completions (runSucceeded / runFailed) LEFT JOIN cancellations LEFT JOIN repairs, each
    extract first per run key; run times from submission and from start to
    ``array_max(completion, cancellation)`` (open stays null); Cancelled wins.

    A submission is one job run; a multi-task job run starts one task run for each task, whose
    start names it as ``multitaskParentRunId``. So there is one row per task run (``run_id``),
    with ``job_run_id`` common to the tasks of one submission; a run that never started has one
    row under its job run's id. Starts win over completions for what both report."""
    a = audit.filter(F.col("serviceName") == "jobs")
    act = F.col("actionName")

    def extract(cond: Column, ids: dict[str, Column], cols: dict[str, Column], at: str) -> DataFrame:
        d = a.filter(cond).select(ORG, *[c.alias(n) for n, c in ids.items()], F.col("timestamp"), F.col("requestId"),
                                  *[c.alias(n) for n, c in cols.items()])
        d = d.dropna(subset=[list(ids)[-1]])
        return dedup_by_key(d, [ORG, *ids], ["timestamp", "requestId"]).drop("requestId").withColumnRenamed("timestamp", at)

    manual = F.when(act == "runNow", F.struct(*[_rp(a, p).alias(p) for p in (
        "notebook_params", "jar_params", "python_params", "spark_submit_params", "python_named_params", "sql_params", "pipeline_params", "dbt_commands")]))
    trigger = F.coalesce(_rp(a, "jobTriggerType"), F.when(act == "runNow", F.lit("manual")))
    sub = extract(act.isin("runNow", "submitRun", "runTriggered"),
                  {"job_run_id": F.coalesce(_result("run_id", "long"), _rp(a, "runId", "long"), _rp(a, "run_id", "long"))},
                  {"job_id": F.coalesce(_rp(a, "job_id", "long"), _rp(a, "jobId", "long")),
                   "run_name": _rp(a, "run_name"), "submission_action": act, "trigger_type": trigger,
                   "submitted_by": F.col("userIdentity.email"), "workflow_context": _rp(a, "workflow_context"),
                   "manual_override_params": manual}, "submissionTime")
    multi, task = _rp(a, "multitaskParentRunId", "long"), _rp(a, "runId", "long")
    keys = {"job_run_id": F.coalesce(multi, task), "run_id": task}
    # What both a start and a completion report of a task run (output, request field, type).
    both = (("multitask_parent_run_id", "multitaskParentRunId", "long"), ("parent_run_id", "parentRunId", "long"),
            ("task_key", "taskKey", "string"), ("task_dependencies", "taskDependencies", "string"), ("id_in_job", "idInJob", "long"),
            ("clusterType", "jobClusterType", "string"), ("task_type", "jobTaskType", "string"), ("repair_of", "repairId", "long"))
    shared = {out: _rp(a, src, kind) for out, src, kind in both}
    start = extract(act == "runStart", keys, {"cluster_id": _rp(a, "clusterId"), **shared}, "startTime")
    done = extract(act.isin("runSucceeded", "runFailed"), keys,
                   {"jobTerminalState": _rp(a, "jobTerminalState"), "completion_action": act,
                    **{f"{out}__done": c for out, c in shared.items()}}, "completionTime")
    cancel = extract(act == "cancel", {"run_id": _rp(a, "run_id", "long")}, {"cancelled_by": F.col("userIdentity.email")},
                     "cancellationTime")
    # every repair of a run, first event per repair id, as one sorted list per run (a run
    # is repaired a handful of times, so the list is bounded by the run's own repairs)
    rep = a.filter(act == "repairRun").select(
        ORG, _rp(a, "run_id", "long").alias("run_id"), _result("repair_id", "long").alias("repair_id"),
        F.col("timestamp"), F.col("requestId"),
        F.struct(F.col("timestamp").alias("repair_timestamp"), _rp(a, "rerun_tasks").alias("rerun_tasks"),
                 _rp(a, "latest_repair_id").alias("latest_repair_id"),
                 F.struct(*[_rp(a, p).alias(p) for p in ("jar_params", "python_params", "spark_submit_params",
                                                         "notebook_params")]).alias("repair_params"),
                 F.col("userIdentity.email").alias("repairedBy"), F.col("requestId").alias("repairRequestId"))
        .alias("detail")).filter(F.col("run_id").isNotNull())
    rep = dedup_by_key(rep, [ORG, "run_id", "repair_id"], ["timestamp", "requestId"])
    repair = rep.groupBy(ORG, "run_id").agg(F.max("repair_id").alias("repair_id"),
                                            F.max("timestamp").alias("repairTime"),
                                            F.sort_array(F.collect_list("detail")).alias("repair_details"))
    # starts and completions meet first: a task run may report only one of them
    tasks = start.join(done, [ORG, "job_run_id", "run_id"], "full_outer")
    tasks = tasks.withColumns({out: F.coalesce(out, f"{out}__done") for out, _, _ in both}).drop(*[f"{out}__done" for out, _, _ in both])
    m = sub.join(tasks, [ORG, "job_run_id"], "left").withColumns({"task_run_id": F.col("run_id"), "run_id": F.coalesce("run_id", "job_run_id")})
    m = m.join(cancel, [ORG, "run_id"], "left").join(repair, [ORG, "run_id"], "left")
    end = F.array_max(F.array("completionTime", "cancellationTime"))
    return m.withColumns({
        "task_dependencies": F.from_json("task_dependencies", "array<string>"),
        "timeDetails": F.struct("startTime", "submissionTime", "cancellationTime", "completionTime"),
        "TaskRunTime": runtime_struct(F.col("submissionTime"), end, ntz=True),
        "TaskExecutionRunTime": runtime_struct(F.col("startTime"), end, ntz=True),
        "terminalState": F.when(F.col("cancellationTime").isNotNull(), F.lit("Cancelled"))
        .otherwise(F.col("jobTerminalState"))})


def job_runs_rolled_up(runs: DataFrame) -> DataFrame:
    """Runs nested under the run they belong to, so that a fact counts no cost twice. A
    run's parent is ``parent_run_id`` or else the root run of its ``workflow_context``; tasks of a
    multi-task run are roots. Runs whose parent is not in ``runs`` stay as roots marked ``orphan``."""
    d = runs.withColumn("__context_root", F.get_json_object("workflow_context", "$.root_run_id").cast("long"))
    resolved = resolve_roots(d, "run_id", ["parent_run_id", "__context_root"], [ORG]).drop("__context_root")
    return nest_runs(resolved, "run_id", ["submissionTime"], [ORG])


# ------------------------------------------------------------------ V12 enrichment (as-of meta, N2)

# Minimal shapes of a task and a job cluster used to pick run details.
TASK_SCHEMA = ("array<struct<task_key:string, job_cluster_key:string, existing_cluster_id:string, "
               "max_retries:long, min_retry_interval_millis:long, retry_on_timeout:boolean, "
               "notebook_task:struct<notebook_path:string>, spark_python_task:struct<python_file:string>, "
               "python_wheel_task:struct<package_name:string, entry_point:string>, "
               "spark_jar_task:struct<main_class_name:string>, sql_task:struct<warehouse_id:string>, "
               "pipeline_task:struct<pipeline_id:string>>>")
JOB_CLUSTER_SCHEMA = ("array<struct<job_cluster_key:string, new_cluster:struct<spark_version:string, "
                      "node_type_id:string, driver_node_type_id:string, num_workers:long>>>")
TASK_KINDS = ("notebook_task", "spark_python_task", "python_wheel_task", "spark_jar_task", "sql_task",
              "pipeline_task")


def _as_array(df: DataFrame, col: str, schema: str) -> Column:
    dt = df.schema[col].dataType
    return F.from_json(F.col(col), schema) if isinstance(dt, T.StringType) else F.col(col)


def job_runs_with_meta(runs: DataFrame, cluster_spec: DataFrame | None = None,
                       clusters_snapshot: DataFrame | None = None, job_status: DataFrame | None = None,
                       jobs_snapshot: DataFrame | None = None, slice_ms: float | None = None) -> DataFrame:
    """V12 enrichment: cluster name as-of the run (cluster spec first, the snapshot fills
    what it left null), then job name / tasks / job clusters as-of the run (job status
    first, then the jobs snapshot); the run name stands in for a missing job name.
    ``slice_ms`` splits the runs of a busy cluster or job by time; runs without a cluster or
    job id form no series."""
    d = runs.withColumn("timestamp", F.col("submissionTime"))
    if cluster_spec is not None:
        cs = cluster_spec.select(ORG, "cluster_id", "timestamp", "cluster_name")
        d = _lookup_by(d, cs, "cluster_id", slice_ms)
    if clusters_snapshot is not None:
        sn = clusters_snapshot.select(ORG, "cluster_id", _snap_ms(clusters_snapshot).alias("timestamp"),
                                      "cluster_name")
        d = _lookup_by(d, sn, "cluster_id", slice_ms)
    meta = ["job_name", "tasks", "job_clusters"]
    if job_status is not None:
        js = job_status.select(ORG, "job_id", "timestamp", *[F.col(c).cast("string").alias(c) for c in meta
                                                              if c in job_status.columns])
        d = _lookup_by(d, js, "job_id", slice_ms)
    if jobs_snapshot is not None:
        sn = jobs_snapshot.select(ORG, F.col("job_id").cast("long").alias("job_id"),
                                  _snap_ms(jobs_snapshot).alias("timestamp"),
                                  F.col("settings.name").alias("job_name"),
                                  F.to_json("settings.tasks").alias("tasks"),
                                  F.to_json("settings.job_clusters").alias("job_clusters"))
        d = _lookup_by(d, sn, "job_id", slice_ms)
    if "job_name" in d.columns:
        d = d.withColumn("job_name", F.coalesce("job_name", "run_name"))
    return d.drop("timestamp")


def job_runs_with_task_detail(df: DataFrame) -> DataFrame:
    """The run's own task (matched on ``task_key``; a single-task job takes its only
    task) and that task's job cluster, picked with ``filter`` on the arrays: no explode,
    no join back, no shuffle. SQL-warehouse tasks report the warehouse as the cluster."""
    if "tasks" not in df.columns:
        return df
    tasks = _as_array(df, "tasks", TASK_SCHEMA)
    d = df.withColumn("__tasks", tasks)
    if "task_key" not in d.columns:
        d = d.withColumn("task_key", F.lit(None).cast("string"))
    d = d.withColumn("task_key", F.when(F.col("task_key").isNull() & (F.size("__tasks") == 1),
                                        F.col("__tasks")[0]["task_key"]).otherwise(F.col("task_key")))
    d = d.withColumn("__task", F.get(F.filter("__tasks", lambda t: t["task_key"] == F.col("task_key")), 0))
    kinds = [k for k in TASK_KINDS]
    d = d.withColumns({
        "job_cluster_key": F.col("__task.job_cluster_key"),
        "max_retries": F.col("__task.max_retries"),
        "retry_on_timeout": F.col("__task.retry_on_timeout"),
        "task_detail": F.struct(*[F.col(f"__task.{k}").alias(k) for k in kinds]),
    })
    if "job_clusters" in df.columns:
        jcs = _as_array(df, "job_clusters", JOB_CLUSTER_SCHEMA)
        d = d.withColumn("job_cluster", F.get(F.filter(jcs, lambda c: c["job_cluster_key"] == F.col("job_cluster_key")),
                                              0)["new_cluster"])
    wh = F.col("task_detail.sql_task.warehouse_id")
    if "cluster_name" not in d.columns:
        d = d.withColumn("cluster_name", F.lit(None).cast("string"))
    d = d.withColumns({
        "cluster_name": F.coalesce("cluster_name", "job_cluster_key", "task_key"),
        "cluster_id": F.when(wh.isNotNull(), wh).otherwise(F.col("cluster_id")),
        "clusterType": F.when(wh.isNotNull(), F.lit("sqlWarehouse")).otherwise(
            F.col("clusterType") if "clusterType" in d.columns else F.lit(None).cast("string")),
        "run_name": F.coalesce("run_name", "task_key"),
    })
    return d.drop("__tasks", "__task", "tasks", *(["job_clusters"] if "job_clusters" in df.columns else []))
