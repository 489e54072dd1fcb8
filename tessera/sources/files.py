"""Scans (S1-S10, S13): date-partitioned folders, JSON with quarantine, file listings,
API pages landed as files, reference CSVs, literal dimensions."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (reference defaults): contract prices per SKU.
DEFAULT_SKU_PRICES = (("interactive", 0.55), ("automated", 0.15), ("sqlCompute", 0.22), ("jobsLight", 0.10))

# Payload array column of each API page kind.
API_PAYLOAD = {"jobs": "jobs", "clusters": "clusters", "clusterEvents": "events", "pools": "instance_pools",
               "profiles": "instance_profiles", "workspace": "objects", "dbfs": "files", "sqlHistory": "res"}


def read_date_partitioned(spark: SparkSession, path: str, fmt: str, from_date, until_date,
                          date_col: str = "date", schema: T.StructType | None = None) -> DataFrame:
    """Read only ``<path>/date=YYYY-MM-DD`` folders in ``[from, until)`` (one day when
    equal). The folders are named in one glob, so nothing else under ``path`` is listed,
    however many days it holds; missing folders are simply absent. Fails when nothing is in
    range."""
    f, u = _dt.date.fromisoformat(str(from_date)), _dt.date.fromisoformat(str(until_date))
    days = [(f + _dt.timedelta(days=i)).isoformat() for i in range(max(1, (u - f).days))]
    r = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    try:
        out = r.load(f"{path.rstrip('/')}/{date_col}={{{','.join(days)}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        out = None
    if out is None or out.isEmpty():
        raise FileNotFoundError(f"no data under {path} for [{f}, {u})")
    return out


def path_lineage(df: DataFrame, path_col: str, prefixes: Sequence[int] = (3, 5, 6),
                 segments: Sequence[int] = (2, 3)) -> DataFrame:
    """Path split on ``/``; chosen 0-based segments become columns, prefixes of
    n segments are re-joined, plus the segment count."""
    segs = F.split(F.col(path_col), "/")
    cols = {f"segment_{i}": F.get(segs, i) for i in segments}
    cols.update({f"prefix{n}": F.array_join(F.slice(segs, 1, n), "/") for n in prefixes})
    cols["n_segments"] = F.size(segs).cast("long")
    return df.withColumns(cols)


def with_source_file(df: DataFrame, out: str = "filename") -> DataFrame:
    """The source file of every row (file metadata column, no UDF)."""
    return df.withColumn(out, F.col("_metadata.file_path"))


def read_json_quarantine(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType,
                         drop_cols: Sequence[str] = (), keep_file_as: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S3: JSON with an explicit schema (no inference pass, wide columns never parsed);
    malformed lines split into a quarantine frame."""
    s = schema if "_corrupt_record" in schema.fieldNames() else schema.add("_corrupt_record", T.StringType())
    df = (spark.read.schema(s).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(paths))
    df = df.drop(*[c for c in drop_cols if c in df.columns]).withColumn("filename", F.col("_metadata.file_path"))
    # parse once: the parsed rows are staged as Parquet in the shared checkpoint folder
    # (survives executor loss) and both splits read the staged copy
    from tessera.operators.tables import persist_and_reload
    df = persist_and_reload(df)
    good = df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    good = good.withColumnRenamed("filename", keep_file_as) if keep_file_as else good.drop("filename")
    bad = df.filter(F.col("_corrupt_record").isNotNull()).select("_corrupt_record", "filename")
    return good, bad


LANDED = "value string, filename string, file_bytes long, mod_ms long, run_id string"


def land_new_lines(spark: SparkSession, root: str, target: str, checkpoint: str, run_id: str, glob: str = "*",
                   batch_bytes: int | None = None) -> None:
    """The lines of every file under ``root`` that no earlier call has read, appended
    to ``target`` (``LANDED``) under ``run_id``.

    A file stream drained with ``availableNow``: its checkpoint is the tracker of files, so names
    never pass through the driver's code, a file is read once however often this runs, and a run
    that is cut short goes on where it stopped. ``batch_bytes`` bounds a batch; within one, the
    scan deals files to tasks by size, the largest first."""
    r = spark.readStream.schema("value string").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if batch_bytes is not None:
        r = r.option("maxBytesPerTrigger", str(batch_bytes))
    lines = r.format("text").load(root).select(
        "value", F.col("_metadata.file_path").alias("filename"), F.col("_metadata.file_size").alias("file_bytes"),
        F.unix_millis("_metadata.file_modification_time").alias("mod_ms"), F.lit(run_id).alias("run_id"))
    w = lines.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    w.start(target).awaitTermination()


def parse_landed(lines: DataFrame, schema: T.StructType, drop_cols: Sequence[str] = (), keep_file_as: str = "filename") -> tuple[DataFrame, DataFrame]:
    """S3 on landed lines: ``(good, bad)`` by an explicit schema, of which only the columns that are
    kept are parsed; lines that are no JSON object of that schema go to the quarantine frame."""
    wanted = T.StructType([f for f in schema.fields if f.name not in drop_cols] + [T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.withColumn("__r", F.from_json("value", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    broken = F.col("__r._corrupt_record").isNotNull() | F.col("__r").isNull()
    good = parsed.where(~broken).select(*[F.col(f"__r.`{f.name}`").alias(f.name) for f in wanted.fields[:-1]], F.col("filename").alias(keep_file_as))
    return good, parsed.where(broken).select(F.col("value").alias("_corrupt_record"), "filename")


def list_files(spark: SparkSession, root: str, glob: str = "*", from_ms: int | None = None,
               until_ms: int | None = None) -> DataFrame:
    """A distributed file listing as a table (path, modification ms, size,
    in-range flag) via the ``binaryFile`` source with the content column pruned."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
          .load(root).select(F.col("path").alias("filename"),
                             F.unix_millis(F.col("modificationTime")).alias("mod_ms"),
                             F.col("length").alias("size")))
    rng = F.lit(True)
    if from_ms is not None:
        rng = rng & (F.col("mod_ms") >= from_ms)
    if until_ms is not None:
        rng = rng & (F.col("mod_ms") < until_ms)
    return df.withColumn("within_range", rng).withColumn("failed", F.lit(False)).withColumn(
        "fail_msg", F.lit(None).cast("string"))


def log_destinations(audit: DataFrame | None = None, snapshot: DataFrame | None = None, id_col: str = "cluster_id",
                     conf_col: str = "cluster_log_conf", tenant_col: str = "organization_id") -> DataFrame:
    """(tenant, cluster id, destination) of every cluster that logs somewhere. ``audit`` rows
    (cluster specs, the conf as JSON text) say all places a cluster has logged to, the
    ``snapshot`` (the conf as a struct, one field a kind of storage) where it logs now. What the
    audit log says of a cluster wins; the snapshot speaks for clusters it does not name."""
    places = []
    for df in (audit, snapshot):
        if df is None:
            continue
        dt = df.schema[conf_col].dataType
        text = F.col(conf_col) if isinstance(dt, T.StringType) else F.to_json(conf_col)
        by_kind = F.map_values(F.from_json(text, "map<string,struct<destination:string>>"))
        d = df.select(tenant_col, F.col(id_col).alias("cluster_id"), F.explode(by_kind).alias("p"))
        places.append(d.select(tenant_col, "cluster_id", F.col("p.destination").alias("destination")).where("cluster_id IS NOT NULL AND destination IS NOT NULL").distinct())
    if not places:
        raise ValueError("log destinations come from the audit log, a snapshot or both")
    if len(places) == 1:
        return places[0]
    return places[0].unionByName(places[1].join(places[0], [tenant_col, "cluster_id"], "left_anti"))


def log_prefixes(df: DataFrame, dest_col: str, id_col: str, suffix: str = "eventlog") -> DataFrame:
    """``<dest without one trailing slash>/<cluster id>/<suffix>``, distinct."""
    dest = F.regexp_replace(F.col(dest_col), "/$", "")
    return df.select(F.concat_ws("/", dest, F.col(id_col), F.lit(suffix)).alias("prefix")).distinct()


def explode_api_pages(pages: DataFrame, payload: str) -> DataFrame:
    """Landed API response pages -> one row per payload element, fields promoted.
    A missing payload column fails; pages that hold no payload give no rows."""
    if payload not in pages.columns:
        raise ValueError(f"payload column {payload} missing from the API pages")
    return pages.select(F.explode(F.col(payload)).alias("r")).select("r.*")


def read_api_pages(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return explode_api_pages(spark.read.json(path), API_PAYLOAD[kind])


def explode_envelope(df: DataFrame, body_col: str, schema: T.StructType | str) -> DataFrame:
    """Envelope body text -> struct -> ``explode(records)`` -> ``properties.*`` promoted,
    ``time`` -> ts / epoch ms / date."""
    recs = df.select(F.explode(F.from_json(F.col(body_col), schema).getField("records")).alias("r")).select("r.*")
    ts = F.to_timestamp(F.col("time"))
    recs = recs.withColumns({"timestamp": F.unix_millis(ts), "date": ts.cast("date")})
    if "properties" in recs.columns:
        recs = recs.select("*", "properties.*").drop("properties")
    return recs


def audit_from_envelope(landed: DataFrame, body_col: str = "body", passed: Sequence[str] = ("organization_id",)) -> DataFrame:
    """Landed envelope bodies -> audit rows. The body's own schema and those of the JSON
    texts inside it (``identity``, ``requestParams``, ``response``) are found by one aggregate each
    over all rows, so services whose fields differ share one struct that holds the fields of all;
    a field of conflicting types is text. ``passed`` columns of the input go along."""
    from tessera.operators.schema import infer_json_schema, struct_from_json
    kept = [c for c in passed if c in landed.columns]
    bodies = landed.select(*kept, F.from_json(F.col(body_col), infer_json_schema(landed, body_col)).alias("b"))
    recs = bodies.select(*kept, F.explode("b.records").alias("r")).select(*kept, "r.*")
    ts = F.to_timestamp("time")
    recs = recs.withColumns({"timestamp": F.unix_millis(ts), "date": ts.cast("date")}).drop("time")
    names = {"identity": "userIdentity", "operationVersion": "version"}
    recs = recs.withColumnsRenamed({c: n for c, n in names.items() if c in recs.columns})
    if "properties" in recs.columns:
        recs = recs.select("*", "properties.*").drop("properties")
    for c in ("userIdentity", "requestParams", "response"):
        if c in recs.columns and isinstance(recs.schema[c].dataType, T.StringType):
            recs = struct_from_json(recs, c)
    return recs


def read_reference_csv(spark: SparkSession, path: str, schema: T.StructType | str, active_from: str,
                       tenant: str) -> DataFrame:
    """Header CSV with a given schema, plus SCD-2 columns."""
    return (spark.read.option("header", True).schema(schema).csv(path)
            .withColumns({"organization_id": F.lit(tenant), "activeFrom": F.lit(active_from).cast("date"),
                          "activeUntil": F.lit(None).cast("date"), "isActive": F.lit(True)}))


def sku_price_dimension(spark: SparkSession, tenant: str, active_from: str,
                        prices: Sequence[tuple[str, float]] = DEFAULT_SKU_PRICES) -> DataFrame:
    """Literal dimension of contract prices per SKU (4 rows)."""
    rows = [(tenant, s, float(p), _dt.date.fromisoformat(active_from), None, True) for s, p in prices]
    return spark.createDataFrame(rows, "organization_id string, sku string, contract_price double, "
                                       "activeFrom date, activeUntil date, isActive boolean")


def query_history_scan(df: DataFrame, ts_col: str, from_ms: int, until_ms: int, lag_days: int = 2) -> DataFrame:
    """The pull window starts ``lag_days`` before ``from`` (running queries are
    re-read and re-merged); ``metrics.*`` flattened."""
    lo = from_ms - lag_days * 86_400_000
    d = df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < until_ms))
    if "metrics" in d.columns:
        d = d.select("*", "metrics.*").drop("metrics")
    return d
