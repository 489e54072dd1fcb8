"""Aggregations (A2-A5, A7-A9, A11) and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def summarize_children(df: DataFrame, parent_keys: Sequence[str], order: str,
                       first: dict[str, str] | None = None, last: dict[str, str] | None = None,
                       count_as: str = "n_children") -> DataFrame:
    """A5 summary form: child count, first/last child attributes by ``order``
    (``min_by``/``max_by``). A partial aggregate: a parent with a third of all rows is
    combined map-side and never gathered into one array."""
    aggs = [F.count(F.lit(1)).alias(count_as)]
    aggs += [F.min_by(F.col(c), F.col(order)).alias(a) for a, c in (first or {}).items()]
    aggs += [F.max_by(F.col(c), F.col(order)).alias(a) for a, c in (last or {}).items()]
    return df.groupBy(*parent_keys).agg(*aggs)


def nest_children(df: DataFrame, parent_keys: Sequence[str], order: str, out: str = "children") -> DataFrame:
    """A4 / A5: children nested under their parent as an array of structs sorted by
    ``order`` (``sort_array`` of structs whose first field is the order column). The
    array is the result itself, so it is bounded by the parent's own fan-out."""
    rest = [c for c in df.columns if c not in parent_keys and c != order]
    return df.groupBy(*parent_keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order), *[F.col(c) for c in rest]))).alias(out))


def rollup_children(parents: DataFrame, children: DataFrame, parent_key: str, child_parent_key: str,
                    order: str, out: str = "children") -> DataFrame:
    """A5: one lineage level: children nested and joined to their parent row."""
    nested = nest_children(children, [child_parent_key], order, out)
    return parents.join(nested, parents[parent_key] == nested[child_parent_key], "left").drop(child_parent_key)


def roll_metrics_to_run(df: DataFrame, by: Sequence[str], firsts: Sequence[str] = (), avgs: Sequence[str] = (),
                        maxs: Sequence[str] = (), sums: Sequence[str] = (), precision: int = 6) -> DataFrame:
    """A2: roll state rows to one row per run: ``any_value`` (equal within the group),
    rounded averages, max, rounded sums floored at 0, and the row count."""
    aggs = [F.any_value(F.col(c)).alias(c) for c in firsts]
    aggs += [F.round(F.avg(F.col(c)), precision).alias(c) for c in avgs]
    aggs += [F.max(F.col(c)).alias(c) for c in maxs]
    aggs += [F.greatest(F.round(F.sum(F.col(c)), precision), F.lit(0)).alias(c) for c in sums]
    aggs.append(F.count(F.lit(1)).alias("state_rows"))
    return df.groupBy(*by).agg(*aggs)


def spark_util_by_run(jobs: DataFrame, tasks: DataFrame, run_keys: Sequence[str], stage_ids_col: str,
                      join_keys: Sequence[str], runtime_ms_col: str) -> DataFrame:
    """Stage ids exploded, tasks summed per run, hours rounded to 4 dp. Tasks are
    pre-aggregated per stage first (partial aggregate) so the join carries one row per
    stage, not per task."""
    per_stage = tasks.groupBy(*join_keys, "StageID").agg(F.sum(F.col(runtime_ms_col)).alias("__ms"))
    ex = jobs.select(*run_keys, *[k for k in join_keys if k not in run_keys],
                     F.explode(F.col(stage_ids_col)).alias("StageID"))
    j = ex.join(per_stage, on=list(join_keys) + ["StageID"], how="inner")
    return j.groupBy(*run_keys).agg(F.round(F.sum("__ms") / F.lit(3_600_000.0), 4).alias("spark_task_runtime_H"))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """Global max and count in one pass."""
    return df.agg(F.max(F.col(col)).alias(f"max_{col}"), F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ set operations

def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """U1 / U2."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: ``EXCEPT`` (distinct) -> left-anti join + distinct in the plan."""
    return a.subtract(b)
