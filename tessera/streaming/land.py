"""Structured Streaming (X1-X6): source with a per-trigger cap, raw land with a
checkpoint, drain-then-stop, checkpoint-path checks, exactly-once repair, late closing.

All queries use the built-in triggers: ``availableNow`` drains what is there in
bounded micro-batches and stops (the reference's "stop when a batch is small"
listener), and the checkpoint makes a restart resume exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None,
                max_per_trigger: int | None = None, starting_timestamp_ms: int | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """Stream source. For Kafka the cap is ``maxOffsetsPerTrigger`` and a lost
    checkpoint restarts from ``startingTimestamp``; for file sources the cap is
    ``maxFilesPerTrigger``. A first run starts from the beginning."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    opts = dict(options or {})
    if max_per_trigger is not None:
        opts["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(max_per_trigger)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        if starting_timestamp_ms is not None:
            opts["startingTimestamp"] = str(starting_timestamp_ms)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path) if path is not None else r.load()


def raw_land_columns(df: DataFrame, run_id: str, tenant: str, body_col: str = "body") -> DataFrame:
    """Body as string + tenant + run id (the raw land shape)."""
    body = F.col(body_col).cast("string") if body_col in df.columns else F.to_json(F.struct("*"))
    return df.select(body.alias("body"), F.lit(tenant).alias("organization_id"), F.lit(run_id).alias("run_id"),
                     F.current_timestamp().alias("landed_at"))


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Does the folder hold any file? Asked of Spark's reader, so every file system works."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        return not files.limit(1).isEmpty()
    except AnalysisException:
        return False


def validate_checkpoint_path(spark: SparkSession, checkpoint: str, target: str, first_run: bool) -> None:
    """The checkpoint is not the data path (nor inside it); on a first run it must
    be empty or absent, on later runs present - on any file system Spark can read."""
    c, t = checkpoint.rstrip("/"), target.rstrip("/")
    if c == t or c.startswith(t + "/"):
        raise ValueError("checkpoint location must not be the target data path")
    held = _holds_files(spark, c)
    if first_run and held:
        raise ValueError("first run but the checkpoint already holds state")
    if not first_run and not held:
        raise ValueError("checkpoint missing for a continuing stream")


def land_stream(df: DataFrame, target: str, checkpoint: str, query_name: str,
                partition_by: Sequence[str] = (), drain: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """X2 + X3: append micro-batches to ``target``; ``drain=True`` uses
    ``trigger(availableNow=True)`` and blocks until everything available is landed."""
    w = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .queryName(query_name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if drain else w.trigger(processingTime="1 minute")
    q = w.start(target)
    if drain:
        q.awaitTermination()
    return q


def exactly_once(df: DataFrame, keys: Sequence[str], event_time: str | None = None,
                 watermark: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key. Streaming: ``dropDuplicatesWithinWatermark`` with a
    watermark on ``event_time`` (bounded state). Rows later than the watermark are
    dropped by Spark, so the bound is the caller's choice, and ``late_rows`` tells how
    many a query dropped. Batch: W1 with a total order."""
    if df.isStreaming:
        if event_time is None or watermark is None:
            raise ValueError("streaming de-duplication needs an event-time column and a watermark")
        wm = event_time
        if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
            # watermarks need TIMESTAMP; the cast only shifts all values alike
            wm = "__wm"
            df = df.withColumn(wm, F.col(event_time).cast("timestamp"))
        out = df.withWatermark(wm, watermark).dropDuplicatesWithinWatermark(list(keys))
        return out.drop("__wm") if wm == "__wm" else out
    from tessera.operators.windows import dedup_by_key
    return dedup_by_key(df, keys, order)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches dropped for being later than the watermark."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def close_late(starts: DataFrame, ends: DataFrame, keys: Sequence[str], start_time: str, end_time: str,
               max_lag: str = "30 days") -> DataFrame:
    """X6 streaming twin of the lag join: start events left-outer-joined to end events
    of the same key arriving up to ``max_lag`` later. Watermarks on both sides bound
    the state; an unmatched start is emitted (open) once the watermark passes."""
    def _ltz(d, c):
        return d.withColumn(c, F.col(c).cast("timestamp")) if isinstance(
            d.schema[c].dataType, T.TimestampNTZType) else d
    s = _ltz(starts, start_time).withWatermark(start_time, max_lag).alias("s")
    e = _ltz(ends, end_time).withWatermark(end_time, max_lag).alias("e")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"s.{k}") == F.col(f"e.{k}"))
    cond = cond & (F.col(f"e.{end_time}") >= F.col(f"s.{start_time}")) & (
        F.col(f"e.{end_time}") <= F.col(f"s.{start_time}") + F.expr(f"INTERVAL {max_lag}"))
    return s.join(e, cond, "leftOuter")
