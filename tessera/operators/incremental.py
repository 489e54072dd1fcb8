"""Incremental framework (I1-I6): typed window filters, module windows, run state."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.windows import latest_by_key


def _to_datetime(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    if isinstance(v, (int, float)):
        return _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=int(v))
    return _dt.datetime.fromisoformat(str(v))


def incremental_filters(schema: T.StructType, cols: Sequence[str], from_time, until_time,
                        lag_days: int = 0, partition_cols: Sequence[str] = ()) -> list[Column]:
    """Typed ``[from - lag, until)`` predicates for every incremental column.

    long -> epoch ms; timestamp / timestamp_ntz -> a literal of the same type (so the
    predicate is pushed to the Parquet scan unchanged); date -> ``[from - lag, until + 1
    day)`` and only for partition columns (so it prunes folders). Other types fail; lag
    days need a date or timestamp column."""
    lo = _to_datetime(from_time) - _dt.timedelta(days=lag_days)
    hi = _to_datetime(until_time)
    out = []
    for c in cols:
        dt = schema[c].dataType
        if isinstance(dt, T.LongType):
            if lag_days and not any(isinstance(schema[x].dataType, (T.DateType, T.TimestampType,
                                                                  T.TimestampNTZType)) for x in cols):
                raise ValueError("lag days need a date or timestamp incremental column")
            ms = lambda d: int((d - _dt.datetime(1970, 1, 1)).total_seconds() * 1000)
            out += [F.col(c) >= F.lit(ms(lo)), F.col(c) < F.lit(ms(hi))]
        elif isinstance(dt, T.TimestampNTZType):
            out += [F.col(c) >= F.lit(lo.isoformat(" ")).cast("timestamp_ntz"),
                    F.col(c) < F.lit(hi.isoformat(" ")).cast("timestamp_ntz")]
        elif isinstance(dt, T.TimestampType):
            out += [F.col(c) >= F.lit(lo.isoformat(" ")).cast("timestamp"),
                    F.col(c) < F.lit(hi.isoformat(" ")).cast("timestamp")]
        elif isinstance(dt, T.DateType):
            if c not in partition_cols:
                continue
            out += [F.col(c) >= F.lit(lo.date().isoformat()).cast("date"),
                    F.col(c) < F.lit((hi.date() + _dt.timedelta(days=1)).isoformat()).cast("date")]
        else:
            raise TypeError(f"incremental column {c} has unsupported type {dt.simpleString()}")
    return out


def ids_with_new_activity(new_rows: DataFrame, snapshot: DataFrame, id_col: str, snapshot_order: Sequence[str],
                          running: Column) -> DataFrame:
    """Ids with rows in the new window UNION ids whose newest snapshot row is in a
    running state (newest = W2 strict, a partial aggregate)."""
    newest = latest_by_key(snapshot, [id_col], list(snapshot_order))
    return (new_rows.select(id_col).unionByName(newest.filter(running).select(id_col)).distinct())


def impute_first_run(log_rows: DataFrame, snapshot: DataFrame, keys: Sequence[str], snapshot_order: Sequence[str],
                     from_time: Column, ts_col: str) -> DataFrame:
    """Ids never seen in the log get one ``snapImpute`` row from their newest
    snapshot row, stamped at the module's from-time; unioned with the log rows."""
    newest = latest_by_key(snapshot, list(keys), list(snapshot_order))
    missing = newest.join(log_rows.select(*keys).distinct(), on=list(keys), how="left_anti")
    imputed = missing.withColumn(ts_col, from_time).withColumn("actionName", F.lit("snapImpute"))
    return log_rows.unionByName(imputed, allowMissingColumns=True)


# ------------------------------------------------------------------ I2-I4 module windows and run state

STATE_SCHEMA = ("organization_id string, module_id int, module_name string, run_id string, from_ts long, "
                "until_ts long, status string, written_rows long, recorded_at timestamp")
TENANT = "organization_id"


@dataclass(frozen=True)
class ModuleSpec:
    module_id: int
    name: str
    depends_on: Sequence[int] = field(default_factory=tuple)
    max_days: int = 60
    tenant: str | None = None  # windows, state and rollbacks are one tenant's own


def latest_successful_state(state: DataFrame) -> DataFrame:
    """Newest SUCCESS or EMPTY% row per tenant and module (strict; ties by run id)."""
    ok = state.filter((F.col("status") == "SUCCESS") | F.col("status").startswith("EMPTY"))
    keys = [c for c in (TENANT,) if c in state.columns] + ["module_id"]
    return latest_by_key(ok, keys, ["until_ts", "recorded_at", "run_id"])


def _of_tenant(state: DataFrame, tenant: str | None) -> DataFrame:
    return state.filter(F.col(TENANT).eqNullSafe(F.lit(tenant))) if TENANT in state.columns else state


def compute_window(state: DataFrame, spec: ModuleSpec, snap_ms: int, primordial_ms: int) -> tuple[int, int]:
    """``from`` = last successful until or primordial; ``until`` = min(from + max days,
    snap), then capped by the most lagging dependency's until. Reads one tiny row per
    module (metadata, not data)."""
    ids = [spec.module_id, *spec.depends_on]
    rows = {r["module_id"]: r["until_ts"] for r in
            latest_successful_state(_of_tenant(state, spec.tenant).filter(F.col("module_id").isin(ids))).select(
                "module_id", "until_ts").collect()}
    frm = rows.get(spec.module_id, primordial_ms)
    until = min(frm + spec.max_days * 86_400_000, snap_ms)
    dep = [rows[d] for d in spec.depends_on if d in rows]
    if spec.depends_on and len(dep) < len(spec.depends_on):
        return frm, frm  # dependency never ran: EMPTY without progress
    if dep:
        until = min(until, min(dep))
    return frm, max(until, frm)


def run_status(frm: int, until: int, source_empty: bool, failed: bool = False) -> str:
    """Equal times -> EMPTY (no progress); empty source -> EMPTY with progress;
    error -> FAILED; else SUCCESS."""
    if failed:
        return "FAILED"
    if frm == until:
        return "EMPTY: window has no width"
    if source_empty:
        return "EMPTY: no new data"
    return "SUCCESS"


def read_state(spark, state_path: str) -> DataFrame:
    from tessera.operators.tables import table_exists
    if table_exists(spark, state_path):
        return spark.read.parquet(state_path)
    return spark.createDataFrame([], STATE_SCHEMA)


def run_module(spark, spec: ModuleSpec, state_path: str, source, target, snap_ms: int, primordial_ms: int,
               run_id: str) -> str:
    """Run one module for its window and record one state row.

    ``source(from_ms, until_ms) -> DataFrame`` builds the lazy input; ``target`` is a
    ``TableSpec`` (append or merge). Equal times -> EMPTY without progress; empty source
    -> EMPTY with progress; an error -> FAILED and the rows this run appended are rolled
    back; else SUCCESS. Re-running a finished window writes nothing (idempotent)."""
    import datetime as _d

    from tessera.operators.tables import keep_rows, rollback_run, table_exists, write_append, write_upsert
    state = read_state(spark, state_path)
    frm, until = compute_window(state, spec, snap_ms, primordial_ms)
    rows = 0
    try:
        if frm == until:
            status = run_status(frm, until, True)
        else:
            df = source(frm, until)
            if df.isEmpty():
                status = run_status(frm, until, True)
            else:
                from pyspark.sql import Observation
                # the written row count is gathered by the write job itself (no extra pass)
                obs = Observation(f"written_{spec.module_id}")
                df = df.withColumn("run_id", F.lit(run_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
                if target.mode == "merge":
                    write_upsert(df, target)
                else:
                    write_append(df, target)
                rows = int(obs.get.get("rows", 0))
                status = run_status(frm, until, False)
    except Exception as e:  # noqa: BLE001 - recorded in the state table, then re-raised
        status = f"FAILED: {type(e).__name__}"
        if table_exists(spark, target.path):  # a merge is staged first: only its own rows can be there
            keep_rows(spark, target, lambda d: rollback_run(d, run_id) if "run_id" in d.columns else d)
        _append_state(spark, state_path, spec, run_id, frm, frm, status, 0, _d)
        raise
    progress = until if not status.startswith("EMPTY: window") else frm
    _append_state(spark, state_path, spec, run_id, frm, progress, status, rows, _d)
    return status


def _append_state(spark, path, spec, run_id, frm, until, status, rows, _d):
    row = [(spec.tenant, spec.module_id, spec.name, run_id, int(frm), int(until), status, int(rows), _d.datetime.now())]
    spark.createDataFrame(row, STATE_SCHEMA).write.mode("append").parquet(path)


def rollback_module_state(state: DataFrame, module_id: int, rollback_ms: int,
                          tenant: str | None = None) -> tuple[DataFrame, int | None]:
    """K11 (state part): the runs of ``module_id`` whose window ends at or after the
    rollback time get their status prefixed ``ROLLED BACK: ``; returns the new state and
    the ``from`` time of the first such run (rows at or after it must leave the module's
    targets - ``tables.rollback_to_time``). ``None`` when nothing is rolled back. Reads one
    aggregate row (metadata)."""
    hit = (F.col("module_id") == module_id) & (F.col("until_ts") >= rollback_ms)
    if TENANT in state.columns:
        hit = hit & F.col(TENANT).eqNullSafe(F.lit(tenant))
    first = state.filter(hit).agg(F.min("from_ts").alias("f")).first()["f"]
    new_state = state.withColumn("status", F.when(hit & ~F.col("status").startswith("ROLLED BACK"),
                                                  F.concat(F.lit("ROLLED BACK: "), F.col("status")))
                                 .otherwise(F.col("status")))
    return new_state, first


def rollback_module(spark, state_path: str, module_id: int, rollback_ms: int, targets: Sequence,
                    dry_run: bool = True, tenant: str | None = None) -> dict:
    """Roll one tenant's module back to a time: state rows marked, target rows of the
    tenant whose incremental columns reach the first rolled-back window removed (only
    partitions that lose rows are rewritten). ``dry_run`` only reports what would change."""
    from tessera.operators.tables import keep_rows, rollback_to_time
    state = read_state(spark, state_path)
    new_state, cut_ms = rollback_module_state(state, module_id, rollback_ms, tenant)
    report = {"module_id": module_id, "from_ms": cut_ms, "targets": [t.name for t in targets]}
    if dry_run or cut_ms is None:
        return report
    for t in targets:
        others = None if tenant is None or t.tenant_col is None else ~F.col(t.tenant_col).eqNullSafe(F.lit(tenant))
        keep_rows(spark, t, lambda d, t=t, o=others: rollback_to_time(d, list(t.incremental_cols), cut_ms, o))
    from tessera.operators.tables import persist_and_reload
    persist_and_reload(new_state).write.mode("overwrite").parquet(state_path)
    return report
