"""Cost macros and summaries (F6, F7, F10, A1, A2 helpers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compute_cost(is_cloud_billable, cost_per_hour, node_count, hours, smoothing=None) -> Column:
    """price/h x hours x nodes x smoothing when billable, else 0; never null."""
    sm = _c(smoothing) if smoothing is not None else F.lit(1)
    v = _c(cost_per_hour) * _c(hours) * _c(node_count) * sm
    return F.coalesce(F.when(_c(is_cloud_billable), v).otherwise(F.lit(0)), F.lit(0))


def dbu_cost(is_billable, dbu_per_hour, dbu_rate, node_count, hours, runtime_engine, sku,
             smoothing=None) -> Column:
    """usage units/h x hours x nodes x rate x smoothing; doubled for the PHOTON engine
    unless the SKU is SQLCOMPUTE; 0 when not billable; never null."""
    sm = _c(smoothing) if smoothing is not None else F.lit(1)
    base = _c(dbu_per_hour) * _c(hours) * _c(node_count) * _c(dbu_rate) * sm
    photon = F.upper(_c(runtime_engine)) == "PHOTON"
    not_sql = ~(F.upper(_c(sku)) == "SQLCOMPUTE")
    b = _c(is_billable)
    return F.coalesce(F.when(b & photon & not_sql, base * 2).when(b, base).otherwise(F.lit(0)), F.lit(0))


def applicable_workers(state="state", target="target_num_workers", current="current_num_workers") -> Column:
    """Workers billed in a state: the target while down-sizing, else the current count."""
    return F.when((_c(state) == "RESIZING") & (_c(target) < _c(current)), _c(target)).otherwise(_c(current))


def node_metric(node_type: str, metric: str, multiply_time: bool, state="state",
                uptime_s="uptime_in_state_S") -> Column:
    """driver metric, or worker metric x applicable workers; x uptime seconds when
    asked; 2 dp; 0 while TERMINATING."""
    nt = node_type.lower()
    if nt == "driver":
        base = F.col(f"driverSpecs.{metric}")
    elif nt == "worker":
        base = F.col(f"workerSpecs.{metric}") * applicable_workers(state)
    else:
        raise ValueError("node_type must be 'driver' or 'worker'")
    v = F.round(base * _c(uptime_s), 2) if multiply_time else F.round(base, 2)
    return F.when(_c(state) == "TERMINATING", F.lit(0)).otherwise(v)


def cost_summary(df: DataFrame, metrics: Sequence[str], by: Sequence[str], precision: int,
                 smoother: Column | None = None) -> DataFrame:
    """A1: ``greatest(round(sum(metric x smoother), p), 0)`` per metric by group columns.
    Missing columns fail at plan time. One hash aggregate with map-side partials."""
    names = {f.lower() for f in df.columns}
    for m in list(metrics) + list(by):
        if m.lower() not in names:
            raise ValueError(f"cost_summary: column {m} does not exist")
    sm = smoother if smoother is not None else F.lit(1)
    aggs = [F.greatest(F.round(F.sum(F.col(m) * sm), precision), F.lit(0)).alias(m) for m in metrics]
    return df.groupBy(*by).agg(*aggs)
