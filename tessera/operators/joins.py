"""Joins (J4-J14) and the overlap operator.

Scale rules applied here:
* every join has equi keys; range conditions stay residual filters on top of them;
* range joins add a *time bucket* to the equi keys (the range side is exploded over
  the buckets it covers), so a hot key is spread over many tasks and only pairs that
  share a time bucket are ever compared;
* no side is broadcast by hint unless its size is bounded by construction; AQE
  converts joins at runtime from measured sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import epoch_us

# --------------------------------------------------------------------------- helpers


def _time_bucket_expr(c: Column, dtype: T.DataType, bucket: str) -> Column:
    """Bucket id for a date/timestamp/number: day, month, year or a numeric width."""
    if bucket == "day":
        return F.unix_date(c.cast("date")).cast("long")
    if bucket == "month":
        d = c.cast("date")
        return (F.year(d) * 12 + F.month(d) - 1).cast("long")
    if bucket == "year":
        return F.year(c.cast("date")).cast("long")
    width = float(bucket)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(epoch_us(c, dtype) / F.lit(width * 1e6)).cast("long")
    return F.floor(c / F.lit(width)).cast("long")


def _bucket_range(start: Column, end: Column, dtype: T.DataType, bucket: str) -> Column:
    """Array of bucket ids covered by ``[start, end]``."""
    return F.sequence(_time_bucket_expr(start, dtype, bucket), _time_bucket_expr(end, dtype, bucket))


# --------------------------------------------------------------------------- J4 / J5


def join_with_lag(left: DataFrame, right: DataFrame, keys: Sequence[str], lag_date_col: str,
                  lagging_side: str = "left", lag_days: int = 1, how: str = "inner",
                  skew_safe: bool = False) -> DataFrame:
    """Keys equal AND ``lagging.date >= date_sub(other.date, lag_days)`` (one-sided).

    ``left``/``inner``: the right side's keys and date are dropped; ``right``: the left
    side's keys and date are dropped (left columns first). Spark plans the equi keys as
    a sort-merge / hash join and keeps the date bound as a residual filter.

    ``skew_safe`` (outer joins): AQE can split a hot key only on the preserved side of an
    outer join. Planned instead as the inner join (both sides splittable) UNION the
    preserved rows without a partner. Those are found from one row per key of the
    other side - its min or max date, a map-side combined aggregate - because "some
    partner satisfies the date bound" only depends on that extreme.
    """
    if skew_safe and how in ("left", "right"):
        return _lag_join_skew_safe(left, right, keys, lag_date_col, lagging_side, lag_days, how)
    if lagging_side not in ("left", "right"):
        raise ValueError("lagging_side must be 'left' or 'right'")
    if how not in ("left", "inner", "right"):
        raise ValueError("only left, right and inner lag joins are supported")
    for d in (left, right):
        if lag_date_col not in d.columns:
            raise ValueError(f"{lag_date_col} must exist on both sides of the join")
        if not isinstance(d.schema[lag_date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"{lag_date_col} must be a date or timestamp on both sides")
    jcols = list(keys) + [lag_date_col]
    sfx = "__lagjoin"
    if how in ("left", "inner"):
        l, r = left, right.withColumnsRenamed({c: c + sfx for c in jcols})
        eq = [F.col(k) == F.col(k + sfx) for k in keys]
        mine, other = (F.col(lag_date_col), F.col(lag_date_col + sfx))
        if lagging_side == "right":
            mine, other = other, mine
    else:
        l, r = left.withColumnsRenamed({c: c + sfx for c in jcols}), right
        eq = [F.col(k + sfx) == F.col(k) for k in keys]
        mine, other = (F.col(lag_date_col + sfx), F.col(lag_date_col))
        if lagging_side == "right":
            mine, other = other, mine
    cond = eq[0]
    for e in eq[1:]:
        cond = cond & e
    cond = cond & (mine >= F.date_sub(other, lag_days))
    out = l.join(r, cond, how)
    return out.select(*[c for c in out.columns if not c.endswith(sfx)])


def _lag_join_skew_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], d: str, lagging_side: str,
                        lag_days: int, how: str) -> DataFrame:
    inner = join_with_lag(left, right, keys, d, lagging_side, lag_days, "inner")
    if how == "left":
        kept, other = left, right
        kept_is_lagging = lagging_side == "left"
        other_cols = [c for c in right.columns if c not in list(keys) + [d]]
    else:
        kept, other = right, left
        kept_is_lagging = lagging_side == "right"
        other_cols = [c for c in left.columns if c not in list(keys) + [d]]
    # kept lagging: kept.d >= other.d - lag  <=>  min(other.d) <= kept.d + lag
    # other lagging: other.d >= kept.d - lag <=>  max(other.d) >= kept.d - lag
    ext = (F.min if kept_is_lagging else F.max)(F.col(d)).alias("__ext")
    agg = other.groupBy(*keys).agg(ext)
    ok = (F.col("__ext") <= F.date_add(F.col(d), lag_days)) if kept_is_lagging else (
        F.col("__ext") >= F.date_sub(F.col(d), lag_days))
    lonely = kept.join(agg, on=list(keys), how="left").filter(F.col("__ext").isNull() | ~ok).drop("__ext")
    pad = lonely.withColumns({c: F.lit(None).cast(other.schema[c].dataType) for c in other_cols})
    if how == "left":
        return inner.unionByName(pad.select(*inner.columns))
    rin = _right_inner(left, right, keys, d, lagging_side, lag_days)
    return rin.unionByName(pad.select(*rin.columns))


def _right_inner(left, right, keys, d, lagging_side, lag_days):
    """The inner join with the column layout of a right lag join (left's remaining
    columns first, then every right column)."""
    sfx = "__lagjoin"
    jcols = list(keys) + [d]
    l = left.withColumnsRenamed({c: c + sfx for c in jcols})
    cond = None
    for k in keys:
        c = F.col(k + sfx) == F.col(k)
        cond = c if cond is None else cond & c
    mine, oth = (F.col(d + sfx), F.col(d)) if lagging_side == "left" else (F.col(d), F.col(d + sfx))
    out = l.join(right, cond & (mine >= F.date_sub(oth, lag_days)), "inner")
    return out.select(*[c for c in out.columns if not c.endswith(sfx)])


def prev_day_condition(a_date: Column, b_date: Column) -> Column:
    """J5 as a condition: ``a.d == b.d OR a.d == b.d - 1``."""
    return (a_date == b_date) | (a_date == F.date_sub(b_date, 1))


def previous_day_expand(df: DataFrame, date_col: str, out: str) -> DataFrame:
    """J5 building block: each row on day d is offered to days d and d+1 (``out``), so
    "same or previous day" becomes an equi key. Useful to pre-aggregate before joining."""
    d = F.col(date_col).cast("date")
    return df.withColumn(out, F.explode(F.array(d, F.date_add(d, 1))))


def same_or_previous_day_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                              left_date: str, right_date: str, how: str = "left") -> DataFrame:
    """J5 as a pure equi-join: a right row on day d matches left rows on day d or d+1,
    so the right side is exploded to ``{d, d+1}`` and joined on ``(keys, day)``. The
    OR never becomes a key-only join with a residual (which would compare every pair
    of a hot key)."""
    r = right.withColumn("__d", F.explode(F.array(F.col(right_date).cast("date"),
                                                  F.date_add(F.col(right_date).cast("date"), 1))))
    l = left.withColumn("__d", F.col(left_date).cast("date"))
    return l.join(r, on=list(keys) + ["__d"], how=how).drop("__d")


# --------------------------------------------------------------------------- J6 / J7


def interval_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], ts: str,
                  active_from: str, active_until: str, open_until: Column | None = None,
                  how: str = "left", normalize_keys: bool = True, bucket: str = "month") -> DataFrame:
    """Point-in-range join: keys equal (after ``trim(lower())`` when asked) and
    ``active_from <= ts <= coalesce(active_until, open_until)``.

    The dimension is exploded over ``bucket`` slices of its validity range
    and equi-joined on ``(keys, bucket)``, so a hot key (a segment with a third of the
    facts) is spread over many tasks; AQE turns the join into a broadcast at runtime
    when the measured dimension stage is small.
    """
    dkeys = [f"__k{i}" for i in range(len(keys))]
    norm = (lambda c: F.trim(F.lower(F.col(c)))) if normalize_keys else (lambda c: F.col(c))
    until = F.coalesce(F.col(active_until), open_until) if open_until is not None else F.col(active_until)
    d = dim.select(*[norm(k).alias(dk) for k, dk in zip(keys, dkeys)],
                   *[F.col(c) for c in dim.columns if c not in keys]).withColumn("__until", until)
    f = facts.withColumns({dk: norm(k) for k, dk in zip(keys, dkeys)})
    rng = (F.col(ts) >= F.col(active_from)) & (F.col(ts) <= F.col("__until"))
    tdt = facts.schema[ts].dataType
    d = d.withColumn("__tb", F.explode(_bucket_range(F.col(active_from), F.col("__until"), tdt, bucket)))
    f = f.withColumn("__tb", _time_bucket_expr(F.col(ts), tdt, bucket))
    f = f.withColumnsRenamed({dk: f"__f{dk}" for dk in dkeys})
    cond = F.col("__tb") == F.col("__dtb")
    d = d.withColumnRenamed("__tb", "__dtb")
    for dk in dkeys:
        cond = cond & (F.col(f"__f{dk}") == F.col(dk))
    out = f.join(d, cond & rng, how)
    return out.drop(*dkeys, *[f"__f{dk}" for dk in dkeys], "__until", "__tb", "__dtb")


def containment_join(runs: DataFrame, states: DataFrame, keys: Sequence[str],
                     run_start: str, run_end: str, state_start: str, state_end: str,
                     bucket: str | None = "month") -> DataFrame:
    """States strictly inside a run of the same key:
    ``state.start > run.start AND state.end < run.end``.

    Runs are exploded over the ``bucket`` slices they cover; a state goes to the slice
    of its start, so each (run, state) candidate is met exactly once and only pairs in
    the same slice are compared. Both column sets must be disjoint except ``keys``. An
    inner join: the range is part of the join condition. ``bucket=None``, for keys known to
    have few states, compares a run with all states of its key and moves it once."""
    r, s, on = runs, states, list(keys)
    if bucket is not None:
        r = runs.withColumn("__tb", F.explode(_bucket_range(F.col(run_start), F.col(run_end),
                                                            runs.schema[run_start].dataType, bucket)))
        s = states.withColumn("__tb", _time_bucket_expr(F.col(state_start), states.schema[state_start].dataType, bucket))
        on = on + ["__tb"]
    s = s.withColumnsRenamed({c: f"{c}__s" for c in on})
    cond = (F.col(state_start) > F.col(run_start)) & (F.col(state_end) < F.col(run_end))
    for c in on:
        cond = cond & (F.col(c) == F.col(f"{c}__s"))
    return r.join(s, cond).drop("__tb", *[f"{c}__s" for c in on])


# --------------------------------------------------------------------------- A6 / J8


# Fixed value: up to so many runs a group is one row's list; its pairs are at most so many a run.
_FEW_RUNS = 32


def _by_group_size(base: DataFrame, g: Sequence[str], times: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of groups with at most ``_FEW_RUNS`` rows, all with both times, and all other
    rows (larger groups, a null in the key or in a time). Only the larger groups' keys are
    listed; rows meet that list unshuffled where it fits a broadcast."""
    from tessera.operators.tables import persist_and_reload
    named, unnamed = F.lit(True), F.lit(False)
    for c in g:
        named, unnamed = named & F.col(c).isNotNull(), unnamed | F.col(c).isNull()
    timed = F.lit(True)
    for c in times:
        timed = timed & F.col(c).isNotNull()
    large = base.where(named).groupBy(*g).agg(F.count("*").alias("__n"), F.count_if(timed).alias("__timed"))
    large = persist_and_reload(large.where((F.col("__n") > _FEW_RUNS) | (F.col("__timed") < F.col("__n"))).select(*g))
    few = base.where(named).join(large, list(g), "left_anti")
    return few, base.where(named).join(large, list(g), "left_semi").unionByName(base.where(unnamed))


def _each_of_few(few: DataFrame, g: Sequence[str], cols: Sequence[str]) -> tuple[DataFrame, Callable]:
    """Every row beside the list of its group's rows, and a sum over that list."""
    listed = few.groupBy(*g).agg(F.collect_list(F.struct(*cols)).alias("__all"))
    each = listed.select(*g, "__all", F.explode("__all").alias("__o")).select(*g, "__all", "__o.*")
    return each, lambda of: F.aggregate("__all", F.lit(0).cast("long"), lambda total, x: total + of(x))


def _overlap_of_few(few: DataFrame, g: Sequence[str]) -> DataFrame:
    """What the sweep of ``overlap_runtime_exact`` finds per run, from its group's list."""
    each, total = _each_of_few(few, g, ["__id", "__s", "__e"])
    s, e, none = F.col("__s"), F.col("__e"), F.lit(0).cast("long")
    until = lambda t: total(lambda x: F.greatest(t - x["__s"], none) - F.greatest(t - x["__e"], none))
    number = lambda cond: total(lambda x: cond(x).cast("long"))
    each = each.select(*g, "__id", "__s", "__e", until(s).alias("I_s"), until(e).alias("I_e"), number(lambda x: x["__e"] <= s).alias("B"),
                       number(lambda x: x["__s"] < e).alias("A"), number(lambda x: (x["__s"] == s) & (x["__e"] == s)).alias("Z"))
    return each.groupBy(*g, "__id").agg(*[F.max(c).alias(c) for c in ("I_s", "I_e", "B", "A", "Z")],
                                        F.first("__s").alias("__s"), F.first("__e").alias("__e"))


def _overlap_in_lists(df: DataFrame, g: Sequence[str], run_id: str, start: str, end: str, among: Column) -> DataFrame:
    """Every row of ``df`` with what the sweep of ``overlap_runtime_exact`` finds for its run, from
    the list of its group's runs ``among`` which it is counted. Only windows by the group, so rows
    that are dealt by some of its columns do not move again."""
    none = F.lit(0).cast("long")
    one, whole = Window.partitionBy(*g, run_id), Window.partitionBy(*g)
    s, e = (F.when(among, F.col(c).cast("long")) for c in (start, end))
    times = F.when(among, F.struct(s.alias("s"), e.alias("e")))
    # the finer window comes first: its order serves the windows after it
    d = df.withColumn("__own", F.max(times).over(one))
    d = d.withColumn("__all", F.collect_list(times).over(whole))
    until = lambda t, x: F.greatest(t - x["s"], none) - F.greatest(t - x["e"], none)
    sums = F.aggregate("__all", F.struct(*[none.alias(c) for c in ("I_s", "I_e", "B", "A", "Z")]), lambda a, x: F.struct(
        (a["I_s"] + until(s, x)).alias("I_s"), (a["I_e"] + until(e, x)).alias("I_e"), (a["B"] + (x["e"] <= s).cast("long")).alias("B"),
        (a["A"] + (x["s"] < e).cast("long")).alias("A"), (a["Z"] + ((x["s"] == s) & (x["e"] == s)).cast("long")).alias("Z")))
    found = F.col(run_id).isNotNull()
    for c in g:
        found = found & F.col(c).isNotNull()
    d = d.withColumn("__sums", F.when(found & among, sums)).drop("__all")
    top = {c: F.max(f"__sums.{c}").over(one) for c in ("I_s", "I_e", "B", "A", "Z")}
    s, e = F.col("__own.s"), F.col("__own.e")
    return d.withColumns({"cum_runtime": top["I_e"] - top["I_s"],
                          "overlapping_runs": top["A"] - top["B"] - (s < e).cast("long") + F.when(s == e, top["Z"]).otherwise(none)}).drop("__own", "__sums")


def overlap_runtime_exact(df: DataFrame, group: Sequence[str], run_id: str, start: str,
                          end: str, bucket_width: float | None = None, among: Column | None = None) -> DataFrame:
    """A6 (``exact`` mode) without forming pairs: for each run i of a group,

    * ``cum_runtime`` = sum over runs j of the group (i included) of
      ``max(0, min(e_i, e_j) - max(s_i, s_j))`` = integral of the active-run count over
      ``[s_i, e_i)``;
    * ``overlapping_runs`` = number of other runs j with ``s_j < e_i AND e_j > s_i``
      = ``#{s_j < e_i} - #{e_j <= s_i} - [s_i < e_i] + [s_i = e_i] * #{s_j = e_j = s_i}``
      (the last term puts back zero-length runs sitting exactly on a zero-length run).

    A sweep: +1/-1 boundary events ordered by time give running counts and sums, from
    which ``I(t) = sum_j |[s_j, e_j) ∩ (-inf, t)|`` is read at ``s_i`` and ``e_i``. Start
    and end must be integral (e.g. epoch ms). Cost is linear per group (one sort).
    With ``bucket_width`` the running sums are split by time slice (per-slice range
    frames plus the totals of all earlier slices), so a hot group spans many tasks.
    Groups of at most ``_FEW_RUNS`` runs need no sweep: their runs are gathered once and the
    same sums are taken over that list, so a row moves once.

    ``among`` is for a caller that knows all groups to be that small: every row of ``df`` comes back
    with the two columns (null where its run is not counted); rows where it holds are counted.
    """
    g = list(group)
    if among is not None:
        return _overlap_in_lists(df, g, run_id, start, end, among)
    base = df.select(*g, F.col(run_id).alias("__id"), F.col(start).cast("long").alias("__s"),
                     F.col(end).cast("long").alias("__e"))
    few, base = _by_group_size(base, g, ["__s", "__e"])
    ev = base.select(*g, "__id", F.explode(F.array(
        F.struct(F.col("__s").alias("t"), F.lit(0).alias("kind"), F.col("__s").alias("s"), F.col("__e").alias("e")),
        F.struct(F.col("__e").alias("t"), F.lit(1).alias("kind"), F.col("__s").alias("s"), F.col("__e").alias("e")),
    )).alias("x")).select(*g, "__id", "x.*")
    is_s = (F.col("kind") == 0).cast("long")
    is_e = (F.col("kind") == 1).cast("long")
    ev = ev.withColumns({"__cs": is_s, "__ss": is_s * F.col("t"), "__ce": is_e, "__se": is_e * F.col("t")})
    part = g + (["__b"] if bucket_width is not None else [])
    if bucket_width is not None:
        ev = ev.withColumn("__b", F.floor(F.col("t") / F.lit(float(bucket_width))).cast("long"))
    w = Window.partitionBy(*part).orderBy("t")
    lt = w.rangeBetween(Window.unboundedPreceding, -1)
    le = w.rangeBetween(Window.unboundedPreceding, 0)
    sums = ["__cs", "__ss", "__ce", "__se"]
    ev = ev.select(
        *part, "__id", "t", "kind", "s", "e",
        *[F.coalesce(F.sum(c).over(lt), F.lit(0)).alias(f"{c}_lt") for c in sums],
        F.coalesce(F.sum("__ce").over(le), F.lit(0)).alias("__ce_le"),
        F.coalesce(F.sum((F.col("kind") == 0).cast("long") * (F.col("s") == F.col("e")).cast("long"))
                   .over(w.rangeBetween(0, 0)), F.lit(0)).alias("zero_at"))
    if bucket_width is not None:
        tot = (base.select(*g, F.explode(F.array(
            F.struct(F.col("__s").alias("t"), F.lit(1).alias("cs"), F.col("__s").alias("ss"), F.lit(0).alias("ce"),
                     F.lit(0).cast("long").alias("se")),
            F.struct(F.col("__e").alias("t"), F.lit(0).alias("cs"), F.lit(0).cast("long").alias("ss"),
                     F.lit(1).alias("ce"), F.col("__e").alias("se")))).alias("x"))
            .select(*g, F.floor(F.col("x.t") / F.lit(float(bucket_width))).cast("long").alias("__b"), "x.*")
            .groupBy(*g, "__b").agg(*[F.sum(c).cast("long").alias(f"__tot_{c}") for c in ("cs", "ss", "ce", "se")]))
        wb = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        tot = tot.select(*g, "__b", *[F.coalesce(F.sum(f"__tot_{c}").over(wb), F.lit(0)).alias(f"__off_{c}")
                                      for c in ("cs", "ss", "ce", "se")])
        ev = ev.join(tot, g + ["__b"], "left")
        ev = ev.withColumns({
            "__cs_lt": F.col("__cs_lt") + F.col("__off_cs"), "__ss_lt": F.col("__ss_lt") + F.col("__off_ss"),
            "__ce_lt": F.col("__ce_lt") + F.col("__off_ce"), "__se_lt": F.col("__se_lt") + F.col("__off_se"),
            "__ce_le": F.col("__ce_le") + F.col("__off_ce")})
    integral = (F.col("t") * F.col("__cs_lt") - F.col("__ss_lt") - F.col("t") * F.col("__ce_lt")
                + F.col("__se_lt"))
    ev = ev.withColumn("I", integral)
    per = ev.groupBy(*g, "__id").agg(
        F.max(F.when(F.col("kind") == 0, F.col("I"))).alias("I_s"),
        F.max(F.when(F.col("kind") == 1, F.col("I"))).alias("I_e"),
        F.max(F.when(F.col("kind") == 0, F.col("__ce_le"))).alias("B"),
        F.max(F.when(F.col("kind") == 1, F.col("__cs_lt"))).alias("A"),
        F.max(F.when(F.col("kind") == 0, F.col("zero_at"))).alias("Z"),
        F.first("s").alias("__s"), F.first("e").alias("__e"))
    per = per.unionByName(_overlap_of_few(few, g))
    return per.select(
        *g, F.col("__id").alias(run_id),
        (F.col("I_e") - F.col("I_s")).alias("cum_runtime"),
        (F.col("A") - F.col("B") - (F.col("__s") < F.col("__e")).cast("long")
         + F.when(F.col("__s") == F.col("__e"), F.col("Z")).otherwise(F.lit(0))).alias("overlapping_runs"))


def _kinds_of_few(few: DataFrame, g: Sequence[str]) -> DataFrame:
    """Time and number of the three kinds of overlap of ``overlap_runtime_reference`` per run, from
    its group's list; a state bound that is null counts as the group's first start, as there."""
    each, total = _each_of_few(few, g, ["__id", "s", "e", "ss", "se"])
    s, e, first = F.col("s"), F.col("e"), F.array_min(F.transform("__all", lambda x: x["s"]))
    kinds = lambda x: (
        ((x["s"] < s) & (x["e"] > s) & (x["e"] < e), x["e"] - F.coalesce("ss", first)),
        ((x["s"] > s) & (x["s"] < e) & (x["e"] > e), F.coalesce(x["se"], first) - s),
        (x["s"].between(s, e) & x["e"].between(s, e), x["e"] - s))

    def either(x, value):
        (a, va), (b, vb), (c, vc) = kinds(x)
        return F.when(a, value(va)).when(b, value(vb)).when(c, value(vc)).otherwise(F.lit(0).cast("long"))
    return each.where(s <= e).select(*g, "__id", total(lambda x: either(x, lambda v: v)).alias("__t"),
                                     total(lambda x: either(x, lambda v: F.lit(1).cast("long"))).alias("__n"))


def overlap_runtime_reference(df: DataFrame, group: Sequence[str], run_id: str, run_start: str,
                              run_end: str, state_start: str, state_end: str,
                              bucket: float | None = None) -> DataFrame:
    """A6 / J8 (``reference`` mode): three kinds of overlap of an observed run with the runs of
    its group, without forming pairs:

    (a) lookup starts before and ends during: ``lookup.run_end - obs.state_start``;
    (b) starts during and ends after: ``lookup.state_end - obs.run_start``;
    (c) starts and ends within (inclusive, self included): ``lookup.run_end - obs.run_start``.
    ``overlapping_runs`` = matches - 1. A lookup that spans the whole observer is not counted, one
    that ends before it starts only in (c); an observer that does gets no row.

    (a) and (b) are differences of prefix counts over the sorted starts and ends, less the runs
    that lie within the observer; those, and (c), ask for starts at or after one bound *and* ends
    at or before another. That is counted by the bits of a run's rank by start: two ranks differ
    first in one bit, so at every bit the runs of a block whose bit is set are counted for the
    observers of the block whose bit is not, in order of their ends. A run is read once a bit:
    n log n rows, each in a running sum. With ``bucket`` (a width on the run times) all running
    sums are split by time slice, so a group of any size spans many tasks. Times are integral.

    Groups of at most ``_FEW_RUNS`` runs are gathered once and each run compared with its list."""
    from tessera.operators.tables import persist_and_reload
    from tessera.operators.windows import lookaround, row_numbers
    g = list(group)
    cut = (lambda t: F.floor(F.col(t) / F.lit(float(bucket))).cast("long")) if bucket else (lambda t: None)
    base = df.select(*g, F.col(run_id).alias("__id"), *[F.col(c).cast("long").alias(n) for c, n in (
        (run_start, "s"), (run_end, "e"), (state_start, "ss"), (state_end, "se"))]).where("s IS NOT NULL AND e IS NOT NULL")
    sizes = base.groupBy(*g).agg(F.count("*").alias("n"), F.min("s").alias("zero"))  # times count from the group's first start
    few, base = _by_group_size(base, g, ["s", "e"])
    few = _kinds_of_few(few, g)
    base = base.join(sizes, g).select(*g, "__id", "n", *[(F.col(c) - F.col("zero")).alias(c) for c in ("s", "e", "ss", "se")])
    base = persist_and_reload(base.withColumn("__row", F.monotonically_increasing_id()))
    good, zero = F.col("s") <= F.col("e"), F.col("s") == F.col("e")
    number = lambda cond, c=F.lit(1): F.when(cond, c).otherwise(0).cast("long")
    obs = base.where(good)

    # prefix sums over starts and ends, read just before and just after both times of an observer
    sums = ["n_e", "t_e", "n_s", "x_s", "n_z", "x_z"]
    none = {c: F.lit(0).cast("long") for c in sums}

    def at(src, t, order, tag, **weights):
        return src.select(*g, "__row", F.col(t).alias("t"), F.lit(order).alias("o"), F.lit(tag).alias("q"), *[F.coalesce((none | weights)[c], none[c]).alias(c) for c in sums])
    marks = [at(obs, "e", 1, "", n_e=F.lit(1).cast("long"), t_e=F.col("e"), n_z=number(zero), x_z=number(zero, F.col("se"))),
             at(obs, "s", 1, "", n_s=F.lit(1).cast("long"), x_s=F.col("se"))]
    marks += [at(obs, t, order, f"{t}{order}") for t in ("s", "e") for order in (0, 2)]
    line = marks[0]
    for m in marks[1:]:
        line = line.unionByName(m)
    line = lookaround(line, g, ["t", "o", "__row", "q"], cut("t"), cumsum=sums).where("q <> ''")
    line = line.groupBy("__row").agg(*[F.max(F.when(F.col("q") == q, F.col(f"{c}__cs"))).alias(f"{c}_{q}") for q in ("s0", "s2", "e0", "e2") for c in sums])

    # points (start, end) against three corners: start >= s and end <= e, start >= s and end < e, start > s and end <= e
    low, high = F.least("s", "e"), F.greatest("s", "e")
    point = F.struct(low.alias("x"), F.lit(1).alias("ox"), high.alias("y"), F.lit(1).alias("oy"), F.lit(0).alias("q"))
    corner = lambda q, ox, oy: F.struct(F.col("s").alias("x"), F.lit(ox).alias("ox"), F.col("e").alias("y"), F.lit(oy).alias("oy"), F.lit(q).alias("q"))
    every = F.when(good, F.array(point, corner(1, 0, 2), corner(2, 0, 0), corner(3, 2, 2))).otherwise(F.array(point))
    weights = {"c_n": F.lit(1).cast("long"), "c_t": F.col("e"), "g_n": number(good), "g_t": number(good, F.col("e")), "g_x": number(good, F.col("se"))}
    pts = base.withColumn("p", F.explode(every)).select(*g, "__row", "n", "p.*", *[F.when(F.col("p.q") == 0, F.coalesce(w, F.lit(0))).otherwise(0).cast("long").alias(c) for c, w in weights.items()])
    ranked = persist_and_reload(row_numbers(pts, g, ["x", "ox", "__row", "q"], cut("x"), out="r"))
    is_set = lambda k: F.getbit("r", k) == F.when(F.col("q") == 0, 1).otherwise(0)
    bits = F.filter(F.sequence(F.lit(0), F.floor(F.log2(F.col("n") * 4 + 1)).cast("int")), is_set)
    split = ranked.withColumn("k", F.explode(bits)).withColumn("block", F.floor(F.col("r") / F.pow(F.lit(2.0), F.col("k") + 1)).cast("long")).drop("r", "n", "x", "ox")
    split = lookaround(split, [*g, "k", "block"], ["y", "oy", "__row", "q"], cut("y"), cumsum=list(weights)).where("q > 0")
    inside = split.groupBy("__row").agg(*[F.sum(F.when(F.col("q") == q, F.col(f"{c}__cs"))).alias(f"{c}_{q}") for q in (1, 2, 3) for c in weights])

    got = obs.join(line, "__row").join(inside, "__row", "left").na.fill(0)
    longer = F.col("s") < F.col("e")
    c = F.col
    a_n = c("n_e_e0") - c("n_e_s2") - (c("g_n_2") - (c("n_z_s2") - c("n_z_s0")))
    a_t = c("t_e_e0") - c("t_e_s2") - (c("g_t_2") - (c("n_z_s2") - c("n_z_s0")) * c("s"))
    b_n = c("n_s_e0") - c("n_s_s2") - (c("g_n_3") - (c("n_z_e2") - c("n_z_e0")))
    b_x = c("x_s_e0") - c("x_s_s2") - (c("g_x_3") - (c("x_z_e2") - c("x_z_e0")))
    within = lambda x: F.when(longer, x).otherwise(0)  # noqa: E731  (nothing starts or ends inside an instant)
    time = within(a_t - a_n * c("ss")) + within(b_x - b_n * c("s")) + c("c_t_1") - c("c_n_1") * c("s")
    got = got.withColumns({"__t": time, "__n": within(a_n) + within(b_n) + c("c_n_1")})
    got = got.select(*g, "__id", "__t", "__n").unionByName(few)
    return got.groupBy(*g, F.col("__id").alias(run_id)).agg(F.sum("__t").alias("cum_runtime"), (F.sum("__n") - 1).alias("overlapping_runs"))


# --------------------------------------------------------------------------- J9-J14


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J9."""
    return df.join(other.select(*keys), on=list(keys), how="left_anti")


def semi_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a match, never multiplied by duplicates on the other side."""
    return df.join(other.select(*keys), on=list(keys), how="left_semi")


def compare_key_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of per-key row counts (partial aggregates first)."""
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("src_count"))
    cb = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("tgt_count"))
    return (ca.join(cb, on=list(keys), how="full_outer")
              .withColumn("src_count", F.coalesce("src_count", F.lit(0)))
              .withColumn("tgt_count", F.coalesce("tgt_count", F.lit(0)))
              .withColumn("diff", F.col("src_count") - F.col("tgt_count")))


def renamed_key_join(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "left") -> DataFrame:
    """Join where key names differ (left name -> right name); right keys dropped."""
    cond = None
    for lk, rk in pairs.items():
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    out = left.join(right, cond, how)
    for rk in pairs.values():
        out = out.drop(right[rk])
    return out


def top_keys(df: DataFrame, keys: Sequence[str], k: int = 40) -> DataFrame:
    """A8 + O1: the ``k`` most frequent keys (tie by key)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), *[F.col(c).asc() for c in keys]).limit(k))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salt: int = 16,
                how: str = "inner") -> DataFrame:
    """Skew salting of the measured hot keys only. A key is hot when it holds at least
    1/(4 * salt) of the big side's rows, so there are at most 4 * salt of them and their list
    is broadcast. A hot key's big rows get a random salt in ``[0, salt)`` and its small rows
    are repeated once per salt; all other rows keep salt 0 and are never copied.

    Exact for ``inner`` and ``left`` (each big row meets every match once). Joins that
    preserve the small side are refused: its copies would count as unmatched."""
    if how not in ("inner", "left"):
        raise ValueError("salted joins are inner or left (the big side is preserved)")
    keys = list(keys)
    least = big.count() / (4 * salt)
    hot = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where((F.col("__n") >= least) & (F.col("__n") > 1))
    hot = hot.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)], F.lit(True).alias("__hot"))
    same = [F.col(k) == F.col(f"__h{i}") for i, k in enumerate(keys)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    mark = [f"__h{i}" for i in range(len(keys))]
    b = (big.join(F.broadcast(hot), cond, "left")
         .withColumn("__salt", F.when(F.col("__hot"), (F.rand(17) * salt).cast("int")).otherwise(0)).drop("__hot", *mark))
    s = (small.join(F.broadcast(hot), cond, "left")
         .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0)))))
         .drop("__hot", *mark))
    return b.join(s, on=keys + ["__salt"], how=how).drop("__salt")
