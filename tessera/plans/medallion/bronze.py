"""Bronze layer (B1-B5): raw snapshots, audit log, cluster events and Spark event logs
cleaned into stable, queryable shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import string_ts_to_epoch_ms
from tessera.operators.schema import (FieldRules, NameRule, cull_nested,
                                      nested_col_exists, rebuild_struct, resolve_case_conflicts,
                                      scrub_schema, struct_col_to_map, struct_from_json, struct_to_map)
from tessera.operators.tables import new_files
from tessera.sources.files import read_json_quarantine

# Fixed values (reference): struct fields of a cluster spec that become maps.
NEW_CLUSTER_MAPS = ("custom_tags", "spark_conf", "spark_env_vars", "aws_attributes", "azure_attributes")
CLUSTER_SNAPSHOT_MAPS = ("default_tags", "custom_tags", "spark_conf", "spark_env_vars", "aws_attributes",
                         "azure_attributes")
POOL_SNAPSHOT_MAPS = ("custom_tags", "default_tags", "aws_attributes", "azure_attributes")
TASK_PARAM_MAPS = ("notebook_task.base_parameters", "python_wheel_task.named_parameters", "sql_task.parameters")
EVENT_LOG_DROP_COLS = ("Classpath Entries", "System Properties", "sparkPlanInfo", "Spark Properties",
                       "HadoopProperties", "Hadoop Properties", "SparkContext Id", "Stage Infos")
PROPERTIES_RULES = (NameRule(r"\s", ""), NameRule(r"\.", ""), NameRule("[^a-zA-Z0-9]", "_"))


def _to_map(c: Column, dt: T.DataType) -> Column:
    return struct_col_to_map(c, dt)


def _clean_array(df: DataFrame, path: str, element_paths: Sequence[str]) -> Column | None:
    """A3: per-element cleanup of an array<struct> with ``transform`` (no explode, no
    regroup shuffle, order kept); absent / non-array -> None."""
    if not nested_col_exists(df.schema, path, True):
        return None
    dt = df.select(path).schema.fields[0].dataType
    if not isinstance(dt, T.ArrayType) or not isinstance(dt.elementType, T.StructType):
        return None
    rep = {p: _to_map for p in element_paths}
    return F.transform(F.col(path), lambda e: rebuild_struct(e, dt.elementType, rep))


def clean_jobs_snapshot(df: DataFrame) -> DataFrame:
    """B1: scrub names; tasks and job_clusters cleaned element-wise (parameter structs and
    the five cluster-spec structs -> maps); settings.tags and base parameters -> maps;
    void columns dropped."""
    d = scrub_schema(df)
    task_paths = list(TASK_PARAM_MAPS) + [f"new_cluster.{m}" for m in NEW_CLUSTER_MAPS]
    inv: dict = {}
    tasks = _clean_array(d, "settings.tasks", task_paths)
    clusters = _clean_array(d, "settings.job_clusters", [f"new_cluster.{m}" for m in NEW_CLUSTER_MAPS])
    if "settings" in d.columns and isinstance(d.schema["settings"].dataType, T.StructType):
        st = d.schema["settings"].dataType
        rep = {"tags": _to_map, "notebook_task.base_parameters": _to_map}
        rep.update({f"new_cluster.{m}": _to_map for m in NEW_CLUSTER_MAPS})
        if tasks is not None:
            rep["tasks"] = lambda c, t: tasks
        if clusters is not None:
            rep["job_clusters"] = lambda c, t: clusters
        d = d.withColumn("settings", rebuild_struct(F.col("settings"), st, rep))
    return scrub_schema(d, drop_void=True)


def clean_clusters_snapshot(df: DataFrame) -> DataFrame:
    """B2: scrub, then six struct columns -> maps (absent -> typed null map)."""
    d = scrub_schema(df)
    return d.withColumns({c: struct_to_map(d, c) for c in CLUSTER_SNAPSHOT_MAPS})


def clean_pools_snapshot(df: DataFrame) -> DataFrame:
    """B2 (pools): scrub, four struct columns -> maps."""
    d = scrub_schema(df)
    return d.withColumns({c: struct_to_map(d, c) for c in POOL_SNAPSHOT_MAPS})


def audit_log(raw: DataFrame, case_pairs: dict[str, str] | None = None) -> DataFrame:
    """Audit rows with case-conflicting request parameters merged (P16) and the
    tenant fields inside ``requestParams`` stripped. Request parameters that come as JSON text
    become one struct with the fields of all services."""
    d = raw
    if "requestParams" in d.columns and isinstance(d.schema["requestParams"].dataType, T.StringType):
        d = struct_from_json(d, "requestParams")
    if case_pairs and "requestParams" in d.columns:
        d = resolve_case_conflicts(d, "requestParams", case_pairs)
    if "requestParams" in d.columns and isinstance(d.schema["requestParams"].dataType, T.StructType):
        drop = [f for f in ("organization_id", "orgId", "version")
                if f in d.schema["requestParams"].dataType.fieldNames()]
        if drop:
            d = d.withColumn("requestParams", F.col("requestParams").dropFields(*drop))
    return d


def cluster_events(pages: DataFrame, tenant: str) -> DataFrame:
    """Explode ``events``, promote, scrub; attribute structs -> maps; tenant id.
    No ``events`` column -> empty result (the run records EMPTY with progress)."""
    if "events" not in pages.columns:
        return pages.limit(0)
    d = scrub_schema(pages.select(F.explode("events").alias("e")).select("e.*"))
    if "details" in d.columns and isinstance(d.schema["details"].dataType, T.StructType):
        rep = {f"{a}.{m}": _to_map for a in ("attributes", "previous_attributes")
               for m in ("custom_tags", "spark_conf", "spark_env_vars")}
        d = d.withColumn("details", rebuild_struct(F.col("details"), d.schema["details"].dataType, rep))
    return d.withColumn("organization_id", F.lit(tenant))


def file_group(filename: Column) -> Column:
    """Path prefixes of 3, 5 and 6 segments next to the file name."""
    seg = F.split(filename, "/")
    return F.struct(filename.alias("filename"), F.array_join(F.slice(seg, 1, 3), "/").alias("byCluster"),
                    F.array_join(F.slice(seg, 1, 5), "/").alias("byDriverHost"),
                    F.array_join(F.slice(seg, 1, 6), "/").alias("bySparkContext"))


def spark_events(spark: SparkSession, listing: DataFrame, tracker: DataFrame, bad: DataFrame,
                 schema: T.StructType, tenant: str) -> tuple[DataFrame, DataFrame]:
    """New in-range event-log files only (S4), read with an explicit schema and a
    quarantine for malformed lines (S3, wide columns dropped), ``Timestamp`` repaired
    from the lower-case string twin (P17), lineage columns from the path (S2), names
    scrubbed with the ``Properties`` exception, property structs -> maps, executorId
    renamed, ``TaskMetrics.UpdatedBlocks`` culled, class-path key filtered."""
    todo = new_files(listing.filter("within_range"), tracker, bad)
    paths = [r["filename"] for r in todo.select("filename").collect()]  # file names only (metadata)
    if not paths:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "_corrupt_record string, filename string")
    good, quarantined = read_json_quarantine(spark, paths, schema, drop_cols=EVENT_LOG_DROP_COLS,
                                             keep_file_as="_src_file")
    return _shaped_events(good, tenant), quarantined


def land_spark_events(spark: SparkSession, root: str, land: str, checkpoint: str, run_id: str, schema: T.StructType, tenant: str,
                      from_ms: int | None = None, until_ms: int | None = None, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """B5 without a list of files on the driver: new event-log lines are landed by a drained file
    stream whose checkpoint remembers every file (``land_new_lines``); the lines of this run, from
    files changed in ``[from, until)``, are parsed and shaped like ``spark_events``. A second call
    under another run id finds no new file and returns no rows."""
    from tessera.sources.files import LANDED, land_new_lines, parse_landed
    land_new_lines(spark, root, land, checkpoint, run_id, glob)
    lines = spark.read.schema(LANDED).parquet(land).where(F.col("run_id") == run_id)
    if from_ms is not None:
        lines = lines.where(F.col("mod_ms") >= from_ms)
    if until_ms is not None:
        lines = lines.where(F.col("mod_ms") < until_ms)
    good, bad = parse_landed(lines, schema, EVENT_LOG_DROP_COLS, "_src_file")
    return _shaped_events(good, tenant), bad


def _shaped_events(d: DataFrame, tenant: str) -> DataFrame:
    """Repaired times, lineage from the path, scrubbed names and property maps of event-log rows."""
    if "timestamp" in d.columns and "Timestamp" in d.columns:
        fix = F.when(F.col("Timestamp").isNull() & F.col("timestamp").isNotNull() & (
            F.col("Event") == "org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent"),
            string_ts_to_epoch_ms(F.col("timestamp"))).otherwise(F.col("Timestamp"))
        d = d.withColumn("Timestamp", fix).drop("timestamp")
    fname = F.col("_src_file")
    seg = F.split(fname, "/")
    n = F.size(seg)
    d = d.withColumns({"filename": fname, "SparkContextId": F.get(seg, n - 2),
                       "clusterId": F.get(seg, n - 5)}).drop("_src_file")
    if "Stage ID" in d.columns and "stageId" in d.columns:
        spec = F.col("Event") == "org.apache.spark.scheduler.SparkListenerSpeculativeTaskSubmitted"
        d = d.withColumns({"Stage ID": F.when(spec, F.col("stageId")).otherwise(F.col("Stage ID")),
                           "Stage Attempt ID": F.when(spec, F.col("stageAttemptId")).otherwise(F.col("Stage Attempt ID"))
                           }).drop("stageId", "stageAttemptId")
    d = d.withColumn("filenameGroup", file_group(F.col("filename")))
    exc = ()
    if "Properties" in d.columns:
        exc = (FieldRules(d.schema["Properties"], PROPERTIES_RULES),)
    d = scrub_schema(d, exc)
    d = d.withColumns({c: struct_to_map(d, c) for c in ("Properties", "modifiedConfigs", "extraTags")})
    if "executorId" in d.columns:
        d = d.withColumnRenamed("executorId", "blackListedExecutorIds")
    if "TaskMetrics" in d.columns and isinstance(d.schema["TaskMetrics"].dataType, T.StructType):
        d = cull_nested(d, "TaskMetrics", ["UpdatedBlocks"])
    d = d.withColumn("organization_id", F.lit(tenant)).withColumn(
        "Properties", F.map_filter("Properties", lambda k, v: k != "sparkexecutorextraClassPath"))
    return d
