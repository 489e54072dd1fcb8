"""Silver layer (V1-V15): refined facts built only from the operators in ``tessera``.

Each builder is ``fn(df_or_frames, ...) -> DataFrame`` and stays lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import runtime_struct, to_ts
from tessera.operators.joins import join_with_lag
from tessera.operators.schema import map_to_struct, nested_col_exists, promote_struct
from tessera.operators.windows import dedup_by_key, future_fill

# Fixed values (reference semantics): state names of the cluster state machine.
RUNNING_STATES = ("STARTING", "INIT_SCRIPTS_STARTED", "RUNNING", "CREATING", "RESIZING", "UPSIZE_COMPLETED",
                  "DRIVER_HEALTHY")
NON_BILLABLE_STATES = ("STARTING", "TERMINATING", "CREATING", "RESTARTING")
RESET_AFTER_STATES = ("TERMINATING", "RESTARTING", "EDITED")

CLUSTER_KEYS = ("organization_id", "cluster_id")

# Generic Spark job properties promoted to typed fields
# (scrubbed property key -> published field name). Platform-specific keys (cluster
# tags, notebook ids, ...) are supplied by the caller through ``extra``.
POWER_PROPERTIES = (
    ("sparkappname", "AppName"), ("sparkjobGroupid", "JobGroupID"), ("sparkdriverhost", "DriverHostIP"),
    ("sparkdrivermaxResultSize", "DriverMaxResults"), ("sparkexecutorid", "ExecutorID"),
    ("sparkexecutormemory", "ExecutorMemory"), ("sparksqlexecutionid", "ExecutionID"),
    ("sparksqlexecutionparent", "ExecutionParent"), ("sparkrddscope", "RDDScope"),
    ("sparksqlshufflepartitions", "ShufflePartitions"), ("user", "UserEmail"), ("userID", "UserID"),
)


def power_properties(props: Column, extra: Sequence[tuple[str, str]] = (),
                     cluster_details: Sequence[tuple[str, str]] = ()) -> Column:
    """The property map promoted to a typed struct (missing keys -> null): the
    generic Spark keys, the caller's ``extra`` keys, and an optional nested
    ``ClusterDetails`` struct of platform keys."""
    get = lambda k: F.try_element_at(props, F.lit(k))
    fields = [get(k).alias(a) for k, a in list(POWER_PROPERTIES) + list(extra)]
    if cluster_details:
        fields.append(F.struct(*[get(k).alias(a) for k, a in cluster_details]).alias("ClusterDetails"))
    return F.struct(*fields)


# ------------------------------------------------------------------ V10 cluster state detail

def cluster_state_detail(events: DataFrame, until_ms: int, slice_ms: float | None = None,
                         look_rows: int | None = None) -> DataFrame:
    """Cluster events -> one row per state with running flag, worker counts,
    state start/end (next start - 1 ms; open end = ``until_ms``), uptimes, reset
    sessions, billing flags and the dates the state touches.

    W10 state machine: on/off switch (TERMINATING off, CREATING/STARTING on); an
    *invalid chain* (the next switch equals the switch before it, e.g. RUNNING ->
    STARTING without TERMINATING) gets one imputed TERMINATING row 1 ms after the row.
    The look-arounds are unbounded; ``look_rows`` bounds them to so many rows.

    Plan: one look-around pass before the imputation and five after it (row numbers;
    switch/size/state/timestamp look-arounds; running-flag look-arounds; two running
    sums). Bounded frames are carried (row number, value) pairs checked for distance.
    ``slice_ms`` splits every pass by time slice, so a very busy cluster is never one
    task; between sliced passes the lineage is checkpointed. Sliced equals unsliced.
    """
    from tessera.operators.windows import as_pair, lookaround, row_numbers, running_sum, within_rows
    from tessera.session import cut_lineage
    k = list(CLUSTER_KEYS)
    bucket = (lambda: F.floor(F.col("timestamp") / F.lit(float(slice_ms))).cast("long")) if slice_ms else (
        lambda: None)
    cut = cut_lineage if slice_ms else (lambda x: x)
    d = promote_struct(events, "details").withColumnRenamed("type", "state")
    d = d.withColumn("running_switch", F.when(F.col("state") == "TERMINATING", F.lit(False))
                     .when(F.col("state").isin("CREATING", "STARTING"), F.lit(True)))
    # the next row's "previous switch" is the last switch up to and including this row
    d = cut(lookaround(d, k, ["timestamp", "state"], bucket(), last_nonnull=["running_switch"],
                       next_row=["running_switch"]))
    invalid = (F.col("running_switch__nx").isNotNull()
               & (F.col("running_switch__nx") == F.col("running_switch__lnn")))
    d = d.withColumn("__copies", F.when(invalid, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    d = d.select("*", F.explode("__copies").alias("imputed")).drop("__copies", "running_switch__nx",
                                                                   "running_switch__lnn")
    d = d.withColumns({"state": F.when(F.col("imputed"), F.lit("TERMINATING")).otherwise(F.col("state")),
                       "timestamp": F.when(F.col("imputed"), F.col("timestamp") + 1).otherwise(F.col("timestamp")),
                       "running_switch": F.when(F.col("imputed"), F.lit(None).cast("boolean"))
                       .otherwise(F.col("running_switch")),
                       "__size": F.coalesce(F.col("current_num_workers"), F.col("cluster_size.num_workers"),
                                            F.col("cluster_size.autoscale.min_workers"))})
    o2 = ["timestamp", "imputed", "state"]
    d = cut(row_numbers(d, k, o2, bucket(), out="__rn"))
    d = d.withColumns({"__psw": as_pair("__rn", "running_switch"), "__psz": as_pair("__rn", "__size")})
    d = cut(lookaround(d, k, o2, bucket(), last_nonnull_before=["__psw", "__psz"], first_nonnull_after=["__psw"],
                       prev_row=["state"], next_row=["timestamp"]))
    run = F.coalesce(F.when(F.col("imputed"), F.lit(False)), F.col("running_switch"),
                     within_rows("__rn", F.col("__psw__lnb"), look_rows, True),
                     ~within_rows("__rn", F.col("__psw__fna"), look_rows, False))
    d = d.withColumn("__run1", F.when(run.isNull() & F.col("state").isin(*RUNNING_STATES), F.lit(True)).otherwise(run))
    d = d.withColumn("__prun", as_pair("__rn", "__run1"))
    d = cut(lookaround(d, k, o2, bucket(), last_nonnull_before=["__prun"], first_nonnull_after=["__prun"]))
    d = d.withColumn("is_running", F.coalesce(F.col("__run1"), within_rows("__rn", F.col("__prun__lnb"), look_rows, True),
                                              ~within_rows("__rn", F.col("__prun__fna"), look_rows, False), F.lit(False)))
    size_back = within_rows("__rn", F.col("__psz__lnb"), look_rows, True)
    d = d.withColumn("current_num_workers", F.coalesce(
        F.when(~F.col("is_running"), F.lit(None).cast("long")).otherwise(F.coalesce(F.col("__size"), size_back)),
        F.lit(0).cast("long")))
    d = d.withColumn("target_num_workers", F.coalesce(
        F.when(~F.col("is_running"), F.lit(None).cast("long"))
         .when(F.col("state") == "CREATING", F.coalesce(F.col("cluster_size.num_workers"),
                                                        F.col("cluster_size.autoscale.min_workers")))
         .otherwise(F.coalesce(F.col("target_num_workers"), F.col("current_num_workers"))), F.lit(0).cast("long")))
    # Resets, state ends, uptimes
    d = d.withColumns({
        "counter_reset": F.when(F.col("state__pv").isin(*RESET_AFTER_STATES) | ~F.col("is_running"), 1).otherwise(0),
        "unixTimeMS_state_start": F.col("timestamp"),
        "unixTimeMS_state_end": F.coalesce(F.col("timestamp__nx") - 1, F.lit(until_ms)),
    })
    d = d.select(*k, "is_running", "imputed", "timestamp", "state", "current_num_workers", "target_num_workers",
                 "counter_reset", "unixTimeMS_state_start", "unixTimeMS_state_end")
    d = cut(running_sum(d, "counter_reset", k, o2, out="reset_partition", bucket=bucket()))
    d = d.withColumn("__uptime_ms", F.col("unixTimeMS_state_end") - F.col("unixTimeMS_state_start"))
    d = running_sum(d, "__uptime_ms", k + ["reset_partition"], o2, out="__since_ms", bucket=bucket())
    d = d.withColumns({
        "timestamp_state_start": to_ts("unixTimeMS_state_start", ntz=True),
        "timestamp_state_end": to_ts("unixTimeMS_state_end", ntz=True),
        "uptime_in_state_S": (F.col("unixTimeMS_state_end") - F.col("unixTimeMS_state_start")) / 1000,
    })
    d = d.withColumns({
        "state_start_date": F.to_date("timestamp_state_start"),
        "uptime_since_restart_S": F.when(F.col("counter_reset") == 1, F.lit(0.0)).otherwise(
            F.coalesce(F.col("__since_ms"), F.lit(0)) / 1000),
        "cloud_billable": F.col("is_running"),
        "platform_billable": F.col("is_running") & ~F.col("state").isin(*NON_BILLABLE_STATES),
        "uptime_in_state_H": F.col("uptime_in_state_S") / 3600,
        "state_dates": F.sequence(F.to_date("timestamp_state_start"), F.to_date("timestamp_state_end")),
    })
    return d.withColumn("days_in_state", F.size("state_dates")).drop("imputed", "__uptime_ms", "__since_ms")


# ------------------------------------------------------------------ V1-V5 Spark event start/end pairs

def pair_start_end(frame_lagged: DataFrame, frame_new: DataFrame, start_event: str, end_event: str,
                   keys: Sequence[str], start_cols: dict[str, Column], end_cols: dict[str, Column],
                   start_ts: str, end_ts: str, from_ms: int, lag_days: int = 1) -> DataFrame:
    """Common shape of V1-V5: start rows (from the lagged frame, first per key) LEFT
    lag-joined to end rows (new frame, last per key) on ``keys`` + tenant/cluster/context
    with ``fileCreateDate`` lag; rows kept when ``coalesce(end, start, 0) >= from``;
    run-time struct from start and end. The event files of both sides go along as
    ``startFilenameGroup`` and ``endFilenameGroup``, where the input has them."""
    base = ["organization_id", "clusterId", "SparkContextID", *keys]
    start_cols = {**start_cols, **({"startFilenameGroup": F.col("filenameGroup")} if "filenameGroup" in frame_lagged.columns else {})}
    end_cols = {**end_cols, **({"endFilenameGroup": F.col("filenameGroup")} if "filenameGroup" in frame_new.columns else {})}
    s = frame_lagged.filter(F.col("Event") == start_event).select(
        *base, F.col("fileCreateDate"), *[c.alias(n) for n, c in start_cols.items()])
    s = dedup_by_key(s, base, [start_ts])
    e = frame_new.filter(F.col("Event") == end_event).select(
        *base, F.col("fileCreateDate"), *[c.alias(n) for n, c in end_cols.items()])
    e = dedup_by_key(e, base, [end_ts], descending=True)
    j = join_with_lag(s, e, base, "fileCreateDate", lagging_side="left", lag_days=lag_days, how="left",
                      skew_safe=True)
    j = j.filter(F.coalesce(F.col(end_ts), F.col(start_ts), F.lit(0)) >= from_ms)
    return j.withColumn("runtime", runtime_struct(F.col(start_ts), F.col(end_ts), ntz=True)).withColumn(
        "startTimestamp", F.col("runtime.startEpochMS"))


def _of_either(j: DataFrame, name: str) -> DataFrame:
    """What the end event says of the whole, else the start event (an open row)."""
    return j.withColumn(name, F.coalesce(f"__end_{name}", f"__start_{name}")).drop(f"__end_{name}", f"__start_{name}")


def _present(df: DataFrame, *names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names if n in df.columns}


def spark_executors(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    """V1: executor added LEFT JOIN removed within 30 days."""
    return pair_start_end(lagged, new, "SparkListenerExecutorAdded", "SparkListenerExecutorRemoved", ["ExecutorID"],
                          {"executorInfo": F.col("executorInfo"), "addedTimestamp": F.col("Timestamp")},
                          {"RemovedReason": F.col("RemovedReason"), "removedTimestamp": F.col("Timestamp")},
                          "addedTimestamp", "removedTimestamp", from_ms, lag_days=30)


def spark_jobs(lagged: DataFrame, new: DataFrame, from_ms: int, property_keys: Sequence[str] | None = None) -> DataFrame:
    """V3: job start LEFT JOIN job end; properties map promoted to a typed struct (P19,
    the fixed key list by default)."""
    start = {"StageIDs": F.col("StageIDs"), "SubmissionTime": F.col("SubmissionTime")}
    if "Properties" in lagged.columns:
        start["PowerProperties"] = (map_to_struct(F.col("Properties"), property_keys) if property_keys
                                    else power_properties(F.col("Properties")))
    return pair_start_end(lagged, new, "SparkListenerJobStart", "SparkListenerJobEnd", ["JobID"], start,
                          {"JobResult": F.col("JobResult"), "CompletionTime": F.col("CompletionTime")},
                          "SubmissionTime", "CompletionTime", from_ms)


def spark_stages(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    """V4: stage submitted LEFT JOIN completed on (StageID, StageAttemptID)."""
    j = pair_start_end(lagged, new, "SparkListenerStageSubmitted", "SparkListenerStageCompleted",
                          ["StageID", "StageAttemptID"],
                          {"SubmissionTime": F.col("StageInfo.SubmissionTime"), "__start_StageInfo": F.col("StageInfo"),
                           "Details": F.col("StageInfo.Details")},
                          {"CompletionTime": F.col("StageInfo.CompletionTime"), "__end_StageInfo": F.col("StageInfo"),
                           "NumberofTasks": F.col("StageInfo.NumberofTasks"),
                           "FailureReason": F.col("StageInfo.FailureReason")},
                          "SubmissionTime", "CompletionTime", from_ms)
    return _of_either(j, "StageInfo")


def spark_tasks(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    """V5: task start LEFT JOIN task end on 9 keys."""
    keys = ["StageID", "StageAttemptID", "TaskID", "TaskAttempt", "ExecutorID", "Host"]
    def prep(df):
        return df.withColumns({"TaskID": F.col("TaskInfo.TaskID"), "TaskAttempt": F.col("TaskInfo.Attempt"),
                               "ExecutorID": F.col("TaskInfo.ExecutorID"), "Host": F.col("TaskInfo.Host")})
    j = pair_start_end(prep(lagged), prep(new), "SparkListenerTaskStart", "SparkListenerTaskEnd", keys,
                       {"LaunchTime": F.col("TaskInfo.LaunchTime"), "__start_TaskInfo": F.col("TaskInfo")},
                       {"FinishTime": F.col("TaskInfo.FinishTime"), "TaskMetrics": F.col("TaskMetrics"),
                        "TaskEndReason": F.col("TaskEndReason"), "__end_TaskInfo": F.col("TaskInfo"),
                        **_present(new, "TaskExecutorMetrics", "TaskType")},
                       "LaunchTime", "FinishTime", from_ms)
    return _of_either(j, "TaskInfo")


def sql_executions(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    """V2: execution start LEFT JOIN end (earliest start, latest end per id)."""
    return pair_start_end(lagged, new, "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart",
                          "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd", ["executionId"],
                          {"description": F.col("description"), "SqlExecStartTime": F.col("time"), **_present(lagged, "details")},
                          {"SqlExecEndTime": F.col("time")}, "SqlExecStartTime", "SqlExecEndTime", from_ms)


def applications(events: DataFrame) -> DataFrame:
    """App id, name, start ts."""
    return events.filter(F.col("Event") == "SparkListenerApplicationStart").select(
        "organization_id", "clusterId", "SparkContextID", F.col("AppID").alias("appId"),
        F.col("AppName").alias("appName"), to_ts(F.col("Timestamp"), ntz=True).alias("startTS"))


# ------------------------------------------------------------------ V6, V7, V13, V14 (audit log)

def account_logins(audit: DataFrame) -> DataFrame:
    """V6: web logins (service accounts, action containing 'login', not dbadmin) UNION
    ssh logins (service ssh, action login, relabelled 'ssh'), with login details."""
    web = audit.filter((F.col("serviceName") == "accounts") & F.lower("actionName").contains("login")
                       & (F.coalesce(F.col("userIdentity.email"), F.lit("")) != "dbadmin"))
    ssh = audit.filter((F.col("serviceName") == "ssh") & (F.col("actionName") == "login"))
    cols = [F.col("organization_id"), F.col("date"), F.col("timestamp"), F.col("requestId"),
            F.col("userIdentity.email").alias("login_user"), F.col("sourceIPAddress").alias("from_ip_address"),
            F.col("userAgent").alias("user_agent")]
    w = web.select(*cols, F.col("actionName").alias("login_type"), F.lit(None).cast(
        "struct<instance_id:string,container_id:string>").alias("ssh_login_details"))
    def rp(name):
        p = f"requestParams.{name}"
        return F.col(p).cast("string") if nested_col_exists(audit.schema, p, True) else F.lit(None).cast("string")
    s = ssh.select(*cols, F.lit("ssh").alias("login_type"), F.struct(
        rp("instance_id").alias("instance_id"), rp("container_id").alias("container_id")).alias("ssh_login_details"))
    return w.unionByName(s)


# Audit actions that change an account.
MOD_ACTIONS = ("add", "addPrincipalToGroup", "removePrincipalFromGroup", "setAdmin", "updateUser", "delete")


def account_mods(audit: DataFrame, slice_ms: float | None = None) -> DataFrame:
    """V7: six account actions; a null ``user_id`` takes the first later non-null id of
    the same user name, however far away (W8). Rows without a user name belong to no user:
    they keep their own id and stay out of the series."""
    def rp(name):
        p = f"requestParams.{name}"
        return F.col(p).cast("string") if nested_col_exists(audit.schema, p, True) else F.lit(None).cast("string")
    d = audit.filter((F.col("serviceName") == "accounts") & F.col("actionName").isin(*MOD_ACTIONS)).select(
        "organization_id", "date", "timestamp", "actionName", "requestId",
        F.col("userIdentity.email").alias("modified_by"), rp("targetUserName").alias("user_name"),
        rp("targetUserId").alias("user_id"), rp("endpoint").alias("endpoint"), rp("targetGroupName").alias("group_name"),
        rp("targetGroupId").alias("group_id"), *_present(audit, "sourceIPAddress", "userAgent", "response").values())
    bucket = F.floor(F.col("timestamp") / F.lit(float(slice_ms))).cast("long") if slice_ms else None
    named = d.where(F.col("user_name").isNotNull())
    filled = future_fill(named, ["user_id"], ["organization_id", "user_name"], ["timestamp", "requestId"],
                         out_suffix="__f", bucket=bucket)
    filled = filled.withColumn("user_id", F.coalesce("user_id", "user_id__f")).drop("user_id__f")
    return filled.unionByName(d.where(F.col("user_name").isNull()))


def notebooks(audit: DataFrame) -> DataFrame:
    """Notebook actions; the name is the last path segment when missing."""
    def rp(name):
        p = f"requestParams.{name}"
        return F.col(p).cast("string") if nested_col_exists(audit.schema, p, True) else F.lit(None).cast("string")
    d = audit.filter(F.col("serviceName") == "notebook").select(
        "organization_id", "date", "timestamp", "actionName", "requestId",
        rp("notebookId").alias("notebook_id"), rp("path").alias("notebook_path"),
        rp("notebookName").alias("notebook_name"), F.col("userIdentity.email").alias("user_email"), rp("clusterId").alias("cluster_id"),
        *[rp(n).alias(n) for n in ("oldName", "oldPath", "newName", "newPath", "parentPath")], *_present(audit, "response").values())
    last_seg = F.element_at(F.split("notebook_path", "/"), -1)
    return d.withColumn("notebook_name", F.coalesce("notebook_name", last_seg))


def sql_query_history(df: DataFrame) -> DataFrame:
    """Metrics struct flattened."""
    return promote_struct(df, "metrics") if "metrics" in df.columns else df
