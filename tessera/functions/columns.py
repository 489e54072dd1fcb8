"""Column macros (F1-F25): plain ``Column -> Column`` functions, all JVM-side built-ins.

Nothing here touches rows in Python; each helper returns a Catalyst expression that
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- epoch helpers

def epoch_us(c, dtype: T.DataType | None = None) -> Column:
    """Microseconds since the epoch for a timestamp column.

    ``timestamp_ntz`` columns are converted without any session time zone
    (``timestampdiff`` against the NTZ epoch); ``timestamp`` uses ``unix_micros``.
    """
    c = _c(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c)


def epoch_ms(c, dtype: T.DataType | None = None) -> Column:
    """Milliseconds since the epoch (floor), time-zone independent for NTZ."""
    return F.floor(epoch_us(c, dtype) / F.lit(1000)).cast("long")


def ntz_from_epoch_ms(c) -> Column:
    """epoch ms (long) -> ``timestamp_ntz`` keeping the milliseconds."""
    return F.timestamp_add("MILLISECOND", _c(c).cast("long"), F.expr(EPOCH_NTZ))


# ---------------------------------------------------------------- F1-F5 time

def to_ts(raw, input_resolution: str = "milli", output_type: str = "timestamp", ntz: bool = False) -> Column:
    """epoch -> timestamp/date. Milliseconds are truncated to the second, as the
    reference's ``from_unixtime(x/1000)`` does. Output types other than
    timestamp/date are refused. ``ntz=True`` gives ``timestamp_ntz`` (no session time
    zone involved)."""
    if output_type not in ("timestamp", "date"):
        raise ValueError(f"Unsupported output type: {output_type}")
    raw = _c(raw)
    secs = F.floor(raw.cast("double") / 1000) if input_resolution == "milli" else raw.cast("long")
    if ntz:
        ts = F.timestamp_add("SECOND", secs.cast("long"), F.expr(EPOCH_NTZ))
        return ts if output_type == "timestamp" else F.to_date(ts)
    ts = F.timestamp_seconds(secs)
    return ts if output_type == "timestamp" else ts.cast("date")


def runtime_struct(start, end, input_resolution: str = "milli", ntz: bool = False) -> Column:
    """run-time struct from two epoch-ms longs. Open end (null) stays null in every
    derived field. Division chain as in the reference: ms/1000/60/60."""
    start, end = _c(start), _c(end)
    ms = end - start
    s = ms / 1000
    m = s / 60
    h = m / 60
    return F.struct(
        start.alias("startEpochMS"),
        to_ts(start, input_resolution, ntz=ntz).alias("startTS"),
        end.alias("endEpochMS"),
        to_ts(end, input_resolution, ntz=ntz).alias("endTS"),
        ms.alias("runTimeMS"),
        s.alias("runTimeS"),
        m.alias("runTimeM"),
        h.alias("runTimeH"),
    )


def string_ts_to_epoch_ms(c, require_millis: bool = True) -> Column:
    """ISO string -> epoch ms. With ``require_millis`` (reference behaviour) a
    string without a millisecond part gives null; otherwise whole seconds are used."""
    c = _c(c)
    ts = F.try_to_timestamp(c)
    base = F.unix_seconds(ts) * 1000
    frac = F.substring(c, -4, 3)
    has_ms = frac.rlike("^[0-9]{3}$")
    with_ms = base + frac.try_cast("long")
    if require_millis:
        return F.when(has_ms, with_ms).cast("long")
    return F.when(has_ms, with_ms).otherwise(base).cast("long")


def epoch_ms_to_ts(c) -> Column:
    """epoch ms (number or numeric text) -> timestamp keeping ms; bad text -> null."""
    return F.timestamp_millis(_c(c).try_cast("long"))


def ts_to_epoch_ms(c) -> Column:
    """timestamp text/column -> epoch ms as double; bad text -> null."""
    ts = _c(c).try_cast("timestamp")
    return F.unix_millis(ts).cast("double")


def add_ticks(c, dtype: T.DataType, n: int = 1) -> Column:
    """add n ticks by type: timestamp -> ms, date -> days, double -> n/1000, integral -> n."""
    c = _c(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_add("MILLISECOND", F.lit(n), c)
    if isinstance(dtype, T.DateType):
        return F.date_add(c, n)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c + F.lit(n / 1000.0)
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return c + F.lit(n)
    raise TypeError(f"add_ticks: unsupported type {dtype.simpleString()}")


def subtract_ticks(c, dtype: T.DataType, n: int = 1) -> Column:
    return add_ticks(c, dtype, -n)


# ---------------------------------------------------------------- F8-F16 helpers

def is_automated(cluster_name) -> Column:
    """F8: job clusters are named like ``job-<id>-run-<id>``."""
    return _c(cluster_name).like("job-%-run-%")


def derive_sku(is_automated_col, spark_version, cluster_type) -> Column:
    """SKU from automation flag, runtime version and cluster type."""
    auto = _c(is_automated_col)
    light = _c(spark_version).like("apache_spark_%")
    ct = _c(cluster_type)
    return (F.when(auto & light, "jobsLight")
            .when(auto & ~light, "automated")
            .when(ct == "SQL Analytics", "sqlCompute")
            .when(ct == "Serverless", "serverless")
            .when(~auto, "interactive")
            .otherwise("unknown"))


def cluster_id_from_audit() -> Column:
    """cluster id of an audit row by action name."""
    svc, act = F.col("serviceName"), F.col("actionName")
    return (F.when((svc == "clusters") & act.like("%Result"), F.col("requestParams.clusterId"))
            .when((svc == "clusters") & act.isin("permanentDelete", "delete", "resize", "edit"),
                  F.col("requestParams.cluster_id"))
            .when((svc == "clusters") & (act == "create"),
                  F.get_json_object(F.col("response.result"), "$.cluster_id"))
            .otherwise(F.col("requestParams.cluster_id")))


def clean_description(c) -> Column:
    """``<br/>`` and newlines -> space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(c), "<br/>", " "), "\\n", " "))


def token_after(tokens, key: str, skip: int = 1) -> Column:
    """token ``skip`` places after ``key`` in a token array (``id = x`` -> skip=1 over
    the ``=``). Null when the key is absent or the index is past the end (``get`` never
    raises under ANSI)."""
    tokens = _c(tokens)
    pos = F.array_position(tokens, key)  # 1-based, 0 when absent
    return F.when(pos > 0, F.get(tokens, (pos + F.lit(skip)).cast("int")))


def stream_details(tokens) -> Column:
    """F13 applied to streaming descriptions: stream id, run id, batch id."""
    tokens = _c(tokens)
    batch = F.coalesce(token_after(tokens, "batchId"), token_after(tokens, "batch"))
    return F.struct(token_after(tokens, "id").alias("stream_id"),
                    token_after(tokens, "runId").alias("stream_run_id"),
                    batch.alias("stream_batch_id"))


def date_spine(from_date, until_date) -> Column:
    """one row per date in ``[from, until)`` (use with ``F.explode``)."""
    return F.sequence(_c(from_date), F.date_sub(_c(until_date), 1))


def split_part(c, sep: str, index0: int) -> Column:
    """``split`` + 0-based index; out of range -> null."""
    return F.get(F.split(_c(c), sep), index0)


def days_between_inclusive(start_ts, end_ts) -> Column:
    """number of calendar dates touched by ``[start, end]`` (open end -> null)."""
    return (F.datediff(_c(end_ts).cast("date"), _c(start_ts).cast("date")) + 1).cast("long")


def null_of(dtype: T.DataType | str) -> Column:
    """typed null."""
    return F.lit(None).cast(dtype)
