"""G1: the published gold tables - one projection each.

Fixed values: the published column names of each gold table, with the silver column each
comes from, in the reference's order. ``@ts`` stands for the timestamp and ``@date`` for
the date derived from the table's epoch-ms column (seconds precision, as published).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import to_ts
from tessera.plans.medallion.silver_audit import JOB_CLUSTER_SCHEMA, TASK_SCHEMA

# Fixed values: (published name, silver column) per gold table.
CLUSTER = [
    ("cluster_id", "cluster_id"), ("action", "actionName"), ("unixTimeMS", "timestamp"), ("timestamp", "@ts"),
    ("date", "@date"), ("cluster_name", "cluster_name"), ("driver_node_type", "driver_node_type_id"),
    ("node_type", "node_type_id"), ("num_workers", "num_workers"), ("autoscale", "autoscale"),
    ("auto_termination_minutes", "autoTermination_minutes"), ("enable_elastic_disk", "enable_elastic_disk"),
    ("is_automated", "is_automated"), ("cluster_type", "cluster_type"), ("security_profile", "security_profile"),
    ("cluster_log_conf", "cluster_log_conf"), ("init_scripts", "init_scripts"), ("custom_tags", "custom_tags"),
    ("cluster_source", "cluster_source"), ("aws_attributes", "aws_attributes"),
    ("azure_attributes", "azure_attributes"), ("spark_env_vars", "spark_env_vars"), ("spark_conf", "spark_conf"),
    ("acl_path_prefix", "acl_path_prefix"), ("driver_instance_pool_id", "driver_instance_pool_id"),
    ("instance_pool_id", "instance_pool_id"), ("driver_instance_pool_name", "driver_instance_pool_name"),
    ("instance_pool_name", "instance_pool_name"), ("spark_version", "spark_version"),
    ("runtime_engine", "runtime_engine"), ("idempotency_token", "idempotency_token"),
    ("organization_id", "organization_id"), ("deleted_by", "deleted_by"), ("created_by", "createdBy"),
    ("last_edited_by", "lastEditedBy"),
]
JOB = [
    ("organization_id", "organization_id"), ("workspace_name", "workspace_name"), ("job_id", "job_id"),
    ("action", "actionName"), ("unixTimeMS", "timestamp"), ("timestamp", "@ts"), ("date", "@date"),
    ("job_name", "job_name"), ("tags", "tags"), ("job_type", "job_type"), ("job_format", "format"),
    ("existing_cluster_id", "existing_cluster_id"), ("new_cluster", "new_cluster"), ("tasks", "tasks"),
    ("job_clusters", "job_clusters"), ("libraries", "libraries"), ("git_source", "git_source"),
    ("timeout_seconds", "timeout_seconds"), ("max_concurrent_runs", "max_concurrent_runs"),
    ("max_retries", "max_retries"), ("retry_on_timeout", "retry_on_timeout"),
    ("min_retry_interval_millis", "min_retry_interval_millis"), ("schedule", "schedule"),
    ("task_detail_legacy", "task_detail_legacy"), ("is_from_dlt", "is_from_dlt"),
    ("aclPermissionSet", "aclPermissionSet"), ("targetUserId", "targetUserId"), ("session_id", "sessionId"),
    ("request_id", "requestId"), ("user_agent", "userAgent"), ("response", "response"),
    ("source_ip_address", "sourceIPAddress"), ("created_by", "created_by"), ("created_ts", "created_ts"),
    ("deleted_by", "deleted_by"), ("deleted_ts", "deleted_ts"), ("last_edited_by", "last_edited_by"),
    ("last_edited_ts", "last_edited_ts"),
]
JOB_RUN = [
    ("organization_id", "organization_id"), ("workspace_name", "workspace_name"), ("job_id", "job_id"),
    ("job_name", "job_name"), ("tags", "tags"), ("run_id", "run_id"), ("job_run_id", "job_run_id"),
    ("task_run_id", "task_run_id"), ("task_key", "task_key"), ("cluster_id", "cluster_id"),
    ("cluster_name", "cluster_name"), ("multitask_parent_run_id", "multitask_parent_run_id"),
    ("parent_run_id", "parent_run_id"), ("task_detail", "task_detail"), ("task_dependencies", "task_dependencies"),
    ("task_runtime", "TaskRunTime"), ("task_execution_runtime", "TaskExecutionRunTime"),
    ("job_cluster_key", "job_cluster_key"), ("cluster_type", "clusterType"), ("job_cluster", "job_cluster"),
    ("new_cluster", "new_cluster"), ("task_type", "task_type"), ("terminal_state", "terminalState"),
    ("job_trigger_type", "trigger_type"), ("schedule", "schedule"), ("libraries", "libraries"),
    ("manual_override_params", "manual_override_params"), ("repair_id", "repair_id"),
    ("repair_details", "repair_details"), ("run_name", "run_name"), ("timeout_seconds", "timeout_seconds"),
    ("retry_on_timeout", "retry_on_timeout"), ("max_retries", "max_retries"),
    ("min_retry_interval_millis", "min_retry_interval_millis"), ("max_concurrent_runs", "max_concurrent_runs"),
    ("run_as_user_name", "run_as_user_name"), ("workflow_context", "workflow_context"),
    ("task_detail_legacy", "task_detail_legacy"), ("submitRun_details", "submitRun_details"),
    ("created_by", "submitted_by"), ("last_edited_by", "last_edited_by"), ("request_detail", "requestDetails"),
    ("time_detail", "timeDetails"), ("startEpochMS", "submissionTime"),
]
NOTEBOOK = [
    ("organization_id", "organization_id"), ("notebook_id", "notebook_id"), ("notebook_name", "notebook_name"),
    ("notebook_path", "notebook_path"), ("cluster_id", "cluster_id"), ("action", "actionName"),
    ("unixTimeMS", "timestamp"), ("timestamp", "@ts"), ("date", "@date"), ("old_name", "oldName"),
    ("old_path", "oldPath"), ("new_name", "newName"), ("new_path", "newPath"), ("parent_path", "parentPath"),
    ("user_email", "user_email"), ("request_id", "requestId"), ("response", "response"),
]
ACCOUNT_MOD = [
    ("organization_id", "organization_id"), ("mod_unixTimeMS", "timestamp"), ("mod_date", "date"),
    ("action", "actionName"), ("endpoint", "endpoint"), ("modified_by", "modified_by"), ("user_name", "user_name"),
    ("user_id", "user_id"), ("group_name", "group_name"), ("group_id", "group_id"),
    ("from_ip_address", "sourceIPAddress"), ("user_agent", "userAgent"), ("request_id", "requestId"),
    ("response", "response"),
]
POOLS = [
    ("serviceName", "serviceName"), ("actionName", "actionName"), ("organization_id", "organization_id"),
    ("timestamp", "timestamp"), ("date", "date"), ("instance_pool_id", "instance_pool_id"),
    ("instance_pool_name", "instance_pool_name"), ("node_type_id", "node_type_id"),
    ("idle_instance_autotermination_minutes", "idle_instance_autotermination_minutes"),
    ("min_idle_instances", "min_idle_instances"), ("max_capacity", "max_capacity"),
    ("preloaded_spark_versions", "preloaded_spark_versions"), ("aws_attributes", "aws_attributes"),
    ("azure_attributes", "azure_attributes"), ("custom_tags", "custom_tags"), ("create_details", "create_details"),
    ("delete_details", "delete_details"), ("request_details", "request_details"),
]
SPARK_STAGE = [
    ("organization_id", "organization_id"), ("spark_context_id", "SparkContextID"), ("stage_id", "StageID"),
    ("stage_attempt_id", "StageAttemptID"), ("cluster_id", "clusterId"), ("unixTimeMS", "startTimestamp"),
    ("timestamp", "@ts"), ("date", "@date"), ("stage_runtime", "runtime"), ("stage_info", "StageInfo"),
    ("event_log_start", "startFilenameGroup"), ("event_log_end", "endFilenameGroup"),
]
SPARK_TASK = [
    ("organization_id", "organization_id"), ("spark_context_id", "SparkContextID"), ("task_id", "TaskID"),
    ("task_attempt_id", "TaskAttempt"), ("stage_id", "StageID"), ("stage_attempt_id", "StageAttemptID"),
    ("cluster_id", "clusterId"), ("executor_id", "ExecutorID"), ("host", "Host"), ("unixTimeMS", "startTimestamp"),
    ("timestamp", "@ts"), ("date", "@date"), ("task_runtime", "runtime"), ("task_metrics", "TaskMetrics"),
    ("task_executor_metrics", "TaskExecutorMetrics"), ("task_info", "TaskInfo"), ("task_type", "TaskType"),
    ("task_end_reason", "TaskEndReason"), ("event_log_start", "startFilenameGroup"),
    ("event_log_end", "endFilenameGroup"),
]
SPARK_EXECUTION = [
    ("organization_id", "organization_id"), ("spark_context_id", "SparkContextID"), ("execution_id", "executionId"),
    ("cluster_id", "clusterId"), ("description", "description"), ("details", "details"),
    ("unixTimeMS", "startTimestamp"), ("timestamp", "@ts"), ("date", "@date"), ("sql_execution_runtime", "runtime"),
    ("event_log_start", "startFilenameGroup"), ("event_log_end", "endFilenameGroup"),
]
SPARK_EXECUTOR = [
    ("organization_id", "organization_id"), ("spark_context_id", "SparkContextID"), ("executor_id", "ExecutorID"),
    ("cluster_id", "clusterId"), ("executor_info", "executorInfo"), ("removed_reason", "RemovedReason"),
    ("executor_alivetime", "runtime"), ("unixTimeMS", "startTimestamp"), ("timestamp", "@ts"), ("date", "@date"),
    ("event_log_start", "startFilenameGroup"), ("event_log_end", "endFilenameGroup"),
]

GOLD_TABLES = {"cluster": CLUSTER, "job": JOB, "jobrun": JOB_RUN, "notebook": NOTEBOOK, "account_mods": ACCOUNT_MOD,
               "instancepool": POOLS, "sparkstage": SPARK_STAGE, "sparktask": SPARK_TASK,
               "sparkexecution": SPARK_EXECUTION, "sparkexecutor": SPARK_EXECUTOR}


# The columns that make a row of each table; a frame without them is no such table.
GOLD_KEYS = {"cluster": ("cluster_id",), "job": ("job_id",), "jobrun": ("run_id",), "notebook": ("notebook_id",), "account_mods": ("actionName",),
             "instancepool": ("instance_pool_id",), "sparkstage": ("StageID",), "sparktask": ("TaskID",), "sparkexecution": ("executionId",), "sparkexecutor": ("ExecutorID",)}

# The types of published columns; all others are text, or what silver builds.
_LONG = ("unixTimeMS", "mod_unixTimeMS", "job_id", "run_id", "job_run_id", "task_run_id", "multitask_parent_run_id", "parent_run_id", "repair_id",
         "timeout_seconds", "max_concurrent_runs", "max_retries", "min_retry_interval_millis", "created_ts", "deleted_ts", "last_edited_ts", "startEpochMS",
         "stage_id", "stage_attempt_id", "task_id", "task_attempt_id", "execution_id")
_RUNTIME = "struct<startEpochMS:long, startTS:timestamp_ntz, endEpochMS:long, endTS:timestamp_ntz, runTimeMS:long, runTimeS:double, runTimeM:double, runTimeH:double>"
_FILES = "struct<filename:string, byCluster:string, byDriverHost:string, bySparkContext:string>"
PUBLISHED_TYPES = {
    **dict.fromkeys(_LONG, "long"), "num_workers": "int", "auto_termination_minutes": "int",
    **dict.fromkeys(("is_automated", "enable_elastic_disk", "retry_on_timeout", "is_from_dlt"), "boolean"),
    "tags": "map<string,string>", "tasks": TASK_SCHEMA, "job_clusters": JOB_CLUSTER_SCHEMA, "task_dependencies": "array<string>",
    "schedule": "struct<quartz_cron_expression:string, timezone_id:string, pause_status:string>", "security_profile": "struct<user_name:string, mode:string, is_single_user:boolean, table_acls_enabled:boolean, credential_passthrough_enabled:boolean, "
                        "isolation_enabled:boolean, repl_languages_permitted:array<string>>",
    "create_details": "struct<created_by:string, created_at:long>", "delete_details": "struct<deleted_by:string, deleted_at:long>",
    **dict.fromkeys(("task_runtime", "task_execution_runtime", "stage_runtime", "sql_execution_runtime", "executor_alivetime"), _RUNTIME),
    **dict.fromkeys(("event_log_start", "event_log_end"), _FILES),
    "time_detail": "struct<startTime:long, submissionTime:long, cancellationTime:long, completionTime:long>",
}


def _as_published(c: Column, have: T.DataType, ddl: str) -> Column:
    """A silver column in its published type: JSON text is parsed, nested values become JSON text,
    plain ones are cast (what does not fit is null). Nested silver values keep their own fields."""
    plain = ddl in ("string", "long", "int", "boolean")
    nested = isinstance(have, (T.StructType, T.MapType, T.ArrayType))
    if isinstance(have, T.NullType):
        return F.lit(None).cast(ddl)
    if plain:
        return F.to_json(c) if nested and ddl != "string" else c if nested else c.try_cast(ddl)
    return c if nested else F.from_json(c.cast("string"), ddl)


def publish_gold(df: DataFrame, table: str, missing: str = "null") -> DataFrame:
    """A silver frame as the published columns of ``table``, in one ``select`` and in the
    types of ``PUBLISHED_TYPES``, so that a table looks alike whatever its source carried: a column
    that silver did not build is a null of its type. ``missing="error"`` refuses such frames
    instead and names the columns; a frame without the table's key columns is always refused."""
    mapping = GOLD_TABLES[table]
    absent = [src for _, src in mapping if src not in ("@ts", "@date") and src not in df.columns]
    refused = absent if missing == "error" else [src for src in absent if src in ("organization_id", *GOLD_KEYS[table])]
    if refused:
        raise ValueError(f"{table}: silver columns not built: {', '.join(refused)}")
    epoch = next((src for out, src in mapping if out in ("unixTimeMS", "mod_unixTimeMS")), None)
    at = to_ts(F.col(epoch)) if epoch in df.columns else F.lit(None).cast("timestamp")
    cols: list[Column] = []
    for out, src in mapping:
        ddl = PUBLISHED_TYPES.get(out, "string")
        if src in ("@ts", "@date"):
            c = at if src == "@ts" else at.cast("date")
        elif src in absent:
            c = F.lit(None).cast(ddl)
        elif out in PUBLISHED_TYPES or isinstance(df.schema[src].dataType, T.NullType):
            c = _as_published(F.col(src), df.schema[src].dataType, ddl)
        else:
            c = F.col(src)
        cols.append(c.alias(out))
    return df.select(*cols)


# Published columns that the consumer views leave out.
_NOT_VIEWED = {"job": ("unixTimeMS", "job_type", "job_format"), "jobrun": ("startEpochMS",), "sparktask": ("task_executor_metrics",)}


def view_columns(table: str) -> tuple[str, ...]:
    """A published table's consumer view: the tenant and its workspace, then the published
    columns but a few technical ones."""
    front = ("organization_id", "workspace_name")
    return front + tuple(out for out, _ in GOLD_TABLES[table] if out not in (*front, *_NOT_VIEWED.get(table, ())))
