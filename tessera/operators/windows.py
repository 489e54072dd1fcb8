"""Window operators.

Skew rule used throughout: a window partitioned by a series key puts a whole key into
one task. Every *unbounded* fill / running total here therefore takes an optional
``bucket`` column (a coarse time or id slice that is non-decreasing in the window
order). With a bucket the work is split in two stages that are exact:

1. the window runs per ``(keys, bucket)``  -> hot keys are spread over many tasks;
2. one row per ``(keys, bucket)`` carries its last value / total forward over the
   bucket table and is joined back. Window and join use the same never-null group columns
   (``_sliced``), so the rows keep the partitioning of stage 1 and move once, whether or
   not the bucket table fits a broadcast. The input is read twice: for the rows and,
   column-pruned and combined on the map side, for the bucket table.

One-row-per-key picks (W1, W2) are aggregates (``min``/``max`` of a struct) so Spark
combines map-side before the shuffle, which also absorbs hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNB_PREC = Window.unboundedPreceding


def _cols(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _names(x) -> list[str]:
    return [c for c in _cols(x)]


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return isinstance(dt, T.MapType) or isinstance(dt, T.ArrayType) and _has_map(dt.elementType)


def _ordered(c: Column, dt: T.DataType) -> Column:
    """``c`` with every map, however deep, as its entries sorted by key: equal maps become equal
    values, and all of them have a total order."""
    if not _has_map(dt):
        return c
    if isinstance(dt, T.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), _ordered(e["value"], dt.valueType).alias("value")))
        return F.array_sort(pairs)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _ordered(x, dt.elementType))
    inner = F.struct(*[_ordered(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields])
    return F.when(c.isNotNull(), inner)


def _restored(c: Column, dt: T.DataType) -> Column:
    """The value that ``_ordered`` stands for (its map entries in key order)."""
    if not _has_map(dt):
        return c
    if isinstance(dt, T.MapType):
        return F.map_from_entries(F.transform(c, lambda e: F.struct(e["key"].alias("key"), _restored(e["value"], dt.valueType).alias("value"))))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _restored(x, dt.elementType))
    inner = F.struct(*[_restored(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields])
    return F.when(c.isNotNull(), inner)


def series_window(keys, order, desc: bool = False) -> Window:
    ordc = [F.col(c).desc() if desc else F.col(c).asc() for c in _names(order)]
    w = Window.partitionBy(*_names(keys)) if keys else Window.partitionBy()
    return w.orderBy(*ordc)


# ------------------------------------------------------------------ W1 / W2 / W7

def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                 descending: bool = False) -> DataFrame:
    """Keep the first row per key by ``order`` (then by every other column, so the
    pick is a total order and repeats run to run).

    Plan: ``groupBy(keys).agg(min(struct(order..., rest...)))`` -> a partial aggregate on
    the map side, then one shuffle of at most one row per key per task. Maps are compared
    by their sorted entries, so frames with map columns take the same plan: no window
    holds a whole key, and which of two tied rows stays does not depend on the shuffle.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    agg = F.max if descending else F.min
    packed = agg(F.struct(*[_ordered(F.col(c), df.schema[c].dataType).alias(c) for c in order + rest])).alias("__r")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[_restored(F.col("__r").getField(c), df.schema[c].dataType).alias(c) for c in order + rest]).select(*df.columns)


def dedup_by_key_window(df: DataFrame, keys, order, descending: bool = False) -> DataFrame:
    """W1 as ``row_number() == 1`` over the same total order (whole keys per task; for
    comparison only)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    oc = [_ordered(F.col(c), df.schema[c].dataType) for c in list(order) + rest]
    w = Window.partitionBy(*keys).orderBy(*[c.desc() if descending else c.asc() for c in oc])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str | Sequence[str],
                  keep_ties: bool = False) -> DataFrame:
    """Newest row(s) per key. ``keep_ties=False`` is the strict form (one row, ties
    broken by the remaining columns); ``keep_ties=True`` is ``rank() == 1``: the max is
    found by a partial aggregate and the rows are picked by an equi-join on
    ``(keys, max ts)`` (no window over a whole key)."""
    order = _names(ts)
    if not keep_ties:
        return dedup_by_key(df, keys, order, descending=True)
    mx = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__m")).select(
        *[F.col(k).alias(f"{k}__m") for k in keys], *[F.col(f"__m.{c}").alias(f"{c}__m") for c in order])
    cond = None
    for c in list(keys) + order:  # null-safe: a null time ties with null, as rank() does
        e = df[c].eqNullSafe(mx[f"{c}__m"])
        cond = e if cond is None else cond & e
    return df.join(mx, cond, how="left_semi")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, with the key's copy count.
    Counting is a partial aggregate; rows are picked by a join on the key."""
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).filter("dup_count > 1")
    return df.join(cnt, on=list(keys), how="inner")


# ------------------------------------------------------------------ fills

def _last_within(c: Column, w: Window, include_current: bool) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(UNB_PREC, 0 if include_current else -1))


def first_within(c: str, w: Window, include_current: bool) -> Column:
    """First non-null ``c`` at (or strictly) after the row. Spark reads a frame that ends at
    ``UNBOUNDED FOLLOWING`` anew for every row, so its cost is quadratic in the window's rows;
    ``lead`` without nulls is one pass over them and finds the same value."""
    name = c.replace("`", "``")
    later = F.expr(f"lead(`{name}`, 1) IGNORE NULLS").over(w)
    return F.coalesce(F.col(f"`{name}`"), later) if include_current else later


def carry(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
          direction: str = "forward", include_current: bool = True, bucket: Column | None = None,
          suffix: str = "__carry") -> DataFrame:
    """Adds ``<col><suffix>`` = last non-null value at/before the row (``forward``) or the
    first non-null value at/after it (``backward``) within ``keys`` by ``order``.

    With ``bucket`` the exact two-stage plan described in the module docstring is used.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    fwd = direction == "forward"
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
        return df.withColumns({f"{c}{suffix}": _last_within(F.col(c), w, include_current) if fwd else first_within(c, w, include_current)
                               for c in cols})

    b = "__bucket"
    d, part = _sliced(df, keys, b, bucket)
    w = Window.partitionBy(*part).orderBy(*order)
    d = d.withColumns({f"{c}__in": _last_within(F.col(c), w, include_current) if fwd else first_within(c, w, include_current) for c in cols})
    # one row per (keys, bucket): its last (first) non-null value of each column. This
    # reads the input again (column-pruned) but combines map-side, so only about one
    # row per (key, slice) and task is shuffled - cheaper than a second full shuffle.
    pick = F.max if fwd else F.min
    summ = d.groupBy(*keys, *[c for c in [b, *part] if c not in keys]).agg(*[
        pick(F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order], F.col(c).alias("__v"))))
        .getField("__v").alias(f"{c}__b") for c in cols])
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(b)
    if fwd:
        summ = summ.select(*part, *[F.last(F.col(f"{c}__b"), True).over(wb.rowsBetween(UNB_PREC, -1))
                                      .alias(f"{c}__x") for c in cols])
    else:
        summ = summ.select(*part, *[first_within(f"{c}__b", wb, False).alias(f"{c}__x") for c in cols])
    d = _join_back(d, summ, part)
    d = d.withColumns({f"{c}{suffix}": F.coalesce(F.col(f"{c}__in"), F.col(f"{c}__x")) for c in cols})
    return d.drop(b, *[f"{c}__in" for c in cols], *[f"{c}__x" for c in cols])


def _never_null(c: Column, dt: T.DataType) -> Column:
    """The value, or one fixed value of its type for null."""
    if isinstance(dt, T.NumericType):
        return F.coalesce(c, F.lit(0).cast(dt))
    plain = {T.StringType: "", T.BooleanType: "false", T.DateType: "1970-01-01",
             T.TimestampType: "1970-01-01 00:00:00", T.TimestampNTZType: "1970-01-01 00:00:00"}
    if type(dt) in plain:
        return F.coalesce(c, F.lit(plain[type(dt)]).cast(dt))
    return F.coalesce(F.to_json(F.struct(c)), F.lit(""))


def _sliced(df: DataFrame, keys: Sequence[str], b: str, bucket: Column) -> tuple[DataFrame, list[str]]:
    """``df`` with its slice column ``b``, and the columns that name a (keys, slice) group.

    Window partitions treat null as a value, joins do not. Where a key or the slice can be
    null, the group is named by two columns that cannot (the value or a fixed one, and
    whether it was null). The window and the join back both use them, so the join finds
    the rows already partitioned and sorted by shuffle: the rows move once."""
    d = df.withColumn(b, bucket)
    cols, part = {}, []
    for i, k in enumerate([*keys, b]):
        f = d.schema[k]
        if not f.nullable:
            part.append(k)
            continue
        cols[f"__p{i}"], cols[f"__z{i}"] = _never_null(F.col(k), f.dataType), F.col(k).isNull()
        part += [f"__p{i}", f"__z{i}"]
    return d.withColumns(cols), part


def _join_back(rows: DataFrame, summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """Left join of the per-slice summary back onto the rows by the group's columns: plain
    equality on columns that are never null, the partitioning of the window before. AQE
    broadcasts the summary when it is small; beyond that only the summary moves."""
    helper = [c for c in part if c.startswith(("__p", "__z"))]
    return rows.join(summary, list(part), "left").drop(*helper)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None,
                out: str = "__rn") -> DataFrame:
    """1-based row number within ``keys`` by a total ``order``; with ``bucket`` it is the
    exact two-stage running count (per-slice counts plus all earlier slices)."""
    if bucket is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return running_sum(df.withColumn("__one", F.lit(1).cast("long")), "__one", keys, order, out=out,
                       bucket=bucket).drop("__one")


def carry_within_rows(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                      max_rows: int, direction: str = "forward", include_current: bool = True,
                      bucket: Column | None = None, suffix: str = "__carry") -> DataFrame:
    """Last (first) non-null value among the ``max_rows`` rows before (after) the row -
    ``rowsBetween(-n, 0 | -1)`` / ``rowsBetween(0 | 1, n)``.

    With ``bucket``: every row gets its exact row number (two-stage count); the pair
    (row number, value) of non-null rows is carried with the slice-split ``carry`` and
    kept only when it lies within ``max_rows`` rows. Equal to the bounded window."""
    keys, order, cols = list(keys), list(order), list(cols)
    fwd = direction == "forward"
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        if fwd:
            fr = w.rowsBetween(-max_rows, 0 if include_current else -1)
            return df.withColumns({f"{c}{suffix}": F.last(F.col(c), True).over(fr) for c in cols})
        fr = w.rowsBetween(0 if include_current else 1, max_rows)
        return df.withColumns({f"{c}{suffix}": F.first(F.col(c), True).over(fr) for c in cols})
    d = row_numbers(df, keys, order, bucket, out="__rn")
    d = d.withColumns({f"{c}__pair": F.when(F.col(c).isNotNull(), F.struct(F.col("__rn").alias("rn"),
                                                                             F.col(c).alias("__v"))) for c in cols})
    d = carry(d, [f"{c}__pair" for c in cols], keys, order, direction, include_current, bucket, suffix="__cp")
    dist = (lambda p: F.col("__rn") - p.getField("rn")) if fwd else (lambda p: p.getField("rn") - F.col("__rn"))
    d = d.withColumns({f"{c}{suffix}": F.when(dist(F.col(f"{c}__pair__cp")) <= max_rows,
                                              F.col(f"{c}__pair__cp").getField("__v")) for c in cols})
    return d.drop("__rn", *[f"{c}__pair" for c in cols], *[f"{c}__pair__cp" for c in cols])


def fill_forward(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                 lookups: dict[str, Sequence[str]] | None = None, own_priority: bool = True,
                 bucket: Column | None = None, max_rows: int | None = None) -> DataFrame:
    """``coalesce(last_non_null(col), last_non_null(lookup1), ...)`` over rows up to
    the current one. ``own_priority=False`` leaves the column's own history out.
    ``max_rows`` bounds the look-back (W9, e.g. 1000); bounded frames use one window."""
    lookups = lookups or {}
    srcs = sorted({s for c in cols for s in ([c] if own_priority else []) + list(lookups.get(c, []))})
    if max_rows is not None:
        d = carry_within_rows(df, srcs, keys, order, max_rows, "forward", True, bucket)
    else:
        d = carry(df, srcs, keys, order, "forward", True, bucket)
    out = {}
    for c in cols:
        chain = ([f"{c}__carry"] if own_priority else []) + [f"{s}__carry" for s in lookups.get(c, [])]
        out[c] = F.coalesce(*[F.col(x) for x in chain]) if len(chain) > 1 else F.col(chain[0])
    return d.withColumns(out).drop(*[f"{s}__carry" for s in srcs])


def future_fill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                bucket: Column | None = None, max_rows: int | None = None,
                out_suffix: str = "") -> DataFrame:
    """First non-null value at or after the row (optionally bounded to ``max_rows``)."""
    if max_rows is not None:
        d = carry_within_rows(df, cols, keys, order, max_rows, "backward", True, bucket)
        return d.withColumns({f"{c}{out_suffix}": F.col(f"{c}__carry") for c in cols}).drop(
            *[f"{c}__carry" for c in cols if f"{c}{out_suffix}" != f"{c}__carry"])
    d = carry(df, cols, keys, order, "backward", True, bucket)
    return d.withColumns({f"{c}{out_suffix}": F.col(f"{c}__carry") for c in cols}).drop(
        *[f"{c}__carry" for c in cols])


def carry_both(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
               bucket: Column | None = None) -> DataFrame:
    """``carry`` forward (``<c>__prev``) and backward (``<c>__next``), both including the
    current row, in ONE pass: one window node, one per-slice summary holding both the
    last and the first non-null, one join back."""
    keys, order, cols = list(keys), list(order), list(cols)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
        return df.withColumns({**{f"{c}__prev": _last_within(F.col(c), w, True) for c in cols},
                               **{f"{c}__next": first_within(c, w, True) for c in cols}})
    b = "__bucket"
    d, part = _sliced(df, keys, b, bucket)
    w = Window.partitionBy(*part).orderBy(*order)
    d = d.withColumns({**{f"{c}__pin": _last_within(F.col(c), w, True) for c in cols},
                       **{f"{c}__nin": first_within(c, w, True) for c in cols}})
    packed = {c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order], F.col(c).alias("__v")))
              for c in cols}
    summ = d.groupBy(*keys, *[c for c in [b, *part] if c not in keys]).agg(*[F.max(packed[c]).getField("__v").alias(f"{c}__last") for c in cols],
                                   *[F.min(packed[c]).getField("__v").alias(f"{c}__first") for c in cols])
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(b)
    summ = summ.select(*part,
                       *[F.last(F.col(f"{c}__last"), True).over(wb.rowsBetween(UNB_PREC, -1)).alias(f"{c}__px")
                         for c in cols],
                       *[first_within(f"{c}__first", wb, False).alias(f"{c}__nx") for c in cols])
    d = _join_back(d, summ, part)
    d = d.withColumns({**{f"{c}__prev": F.coalesce(F.col(f"{c}__pin"), F.col(f"{c}__px")) for c in cols},
                       **{f"{c}__next": F.coalesce(F.col(f"{c}__nin"), F.col(f"{c}__nx")) for c in cols}})
    return d.drop(b, *[f"{c}__{x}" for c in cols for x in ("pin", "nin", "px", "nx")])


def lookaround(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None,
               last_nonnull: Sequence[str] = (), first_nonnull: Sequence[str] = (),
               next_row: Sequence[str] = (), prev_row: Sequence[str] = (),
               last_nonnull_before: Sequence[str] = (), first_nonnull_after: Sequence[str] = (),
               cumsum: Sequence[str] = ()) -> DataFrame:
    """Several look-arounds in ONE pass over ``keys`` (``bucket`` = time/id slices):

    * ``<c>__lnn`` / ``<c>__lnb``: last non-null at/before the row, strictly before it;
    * ``<c>__fnn`` / ``<c>__fna``: first non-null at/after the row, strictly after it;
    * ``<c>__nx``: the next row's value (``lead``); ``<c>__pv``: the previous row's (``lag``);
    * ``<c>__cs``: running sum up to and including the row.

    With a bucket: one window node per ``(key, slice)``, one per-slice summary (last/first
    non-null, first/last row), one small window over the slice table, one join back -
    equal to the plain windows. Without: plain windows over the key."""
    keys, order = list(keys), list(order)
    if bucket is None:
        w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(*order)
        cols = {}
        cols.update({f"{c}__lnn": _last_within(F.col(c), w, True) for c in last_nonnull})
        cols.update({f"{c}__lnb": _last_within(F.col(c), w, False) for c in last_nonnull_before})
        cols.update({f"{c}__fnn": first_within(c, w, True) for c in first_nonnull})
        cols.update({f"{c}__fna": first_within(c, w, False) for c in first_nonnull_after})
        cols.update({f"{c}__nx": F.lead(F.col(c), 1).over(w) for c in next_row})
        cols.update({f"{c}__pv": F.lag(F.col(c), 1).over(w) for c in prev_row})
        cols.update({f"{c}__cs": F.sum(F.col(c)).over(w.rowsBetween(UNB_PREC, 0)) for c in cumsum})
        return df.withColumns(cols)
    b = "__bucket"
    d, part = _sliced(df, keys, b, bucket)
    w = Window.partitionBy(*part).orderBy(*order)
    fwd = [(c, "lnn", True) for c in last_nonnull] + [(c, "lnb", False) for c in last_nonnull_before]
    bwd = [(c, "fnn", True) for c in first_nonnull] + [(c, "fna", False) for c in first_nonnull_after]
    cols = {}
    cols.update({f"{c}__{t}_in": _last_within(F.col(c), w, inc) for c, t, inc in fwd})
    cols.update({f"{c}__{t}_in": first_within(c, w, inc) for c, t, inc in bwd})
    cols.update({f"{c}__nx_in": F.lead(F.col(c), 1).over(w) for c in next_row})
    cols.update({f"{c}__pv_in": F.lag(F.col(c), 1).over(w) for c in prev_row})
    cols.update({f"{c}__cs_in": F.sum(F.col(c)).over(w.rowsBetween(UNB_PREC, 0)) for c in cumsum})
    if next_row:
        cols["__is_last"] = F.lead(F.lit(1), 1).over(w).isNull()
    if prev_row:
        cols["__is_first"] = F.lag(F.lit(1), 1).over(w).isNull()
    d = d.withColumns(cols)
    ordc = [F.col(o) for o in order]
    fcols = sorted({c for c, _, _ in fwd})
    bcols = sorted({c for c, _, _ in bwd})
    aggs = [F.max(F.when(F.col(c).isNotNull(), F.struct(*ordc, F.col(c).alias("__v")))).getField("__v").alias(f"{c}__ls")
            for c in fcols]
    aggs += [F.min(F.when(F.col(c).isNotNull(), F.struct(*ordc, F.col(c).alias("__v")))).getField("__v").alias(f"{c}__fs")
             for c in bcols]
    if next_row:
        aggs.append(F.min(F.struct(*ordc, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(next_row)])).alias("__frow"))
    if prev_row:
        aggs.append(F.max(F.struct(*ordc, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(prev_row)])).alias("__lrow"))
    aggs += [F.sum(F.col(c)).alias(f"{c}__tot") for c in cumsum]
    summ = d.groupBy(*keys, *[c for c in [b, *part] if c not in keys]).agg(*aggs)
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(b)
    sel = [*part]
    sel += [F.last(F.col(f"{c}__ls"), True).over(wb.rowsBetween(UNB_PREC, -1)).alias(f"{c}__lx") for c in fcols]
    sel += [first_within(f"{c}__fs", wb, False).alias(f"{c}__fx") for c in bcols]
    sel += [F.lead(F.col("__frow").getField(f"__v{i}"), 1).over(wb).alias(f"{c}__nx_x") for i, c in enumerate(next_row)]
    sel += [F.lag(F.col("__lrow").getField(f"__v{i}"), 1).over(wb).alias(f"{c}__pv_x") for i, c in enumerate(prev_row)]
    sel += [F.sum(F.col(f"{c}__tot")).over(wb.rowsBetween(UNB_PREC, -1)).alias(f"{c}__off") for c in cumsum]
    d = _join_back(d, summ.select(*sel), part)
    out = {}
    out.update({f"{c}__{t}": F.coalesce(F.col(f"{c}__{t}_in"), F.col(f"{c}__lx")) for c, t, _ in fwd})
    out.update({f"{c}__{t}": F.coalesce(F.col(f"{c}__{t}_in"), F.col(f"{c}__fx")) for c, t, _ in bwd})
    out.update({f"{c}__nx": F.when(F.col("__is_last"), F.col(f"{c}__nx_x")).otherwise(F.col(f"{c}__nx_in"))
                for c in next_row})
    out.update({f"{c}__pv": F.when(F.col("__is_first"), F.col(f"{c}__pv_x")).otherwise(F.col(f"{c}__pv_in"))
                for c in prev_row})
    out.update({f"{c}__cs": F.col(f"{c}__cs_in") + F.coalesce(F.col(f"{c}__off"), F.lit(0)) for c in cumsum})
    d = d.withColumns(out)
    tmp = [b, "__is_last", "__is_first"] + [f"{c}__{t}_in" for c, t, _ in fwd + bwd] + \
        [f"{c}__lx" for c in fcols] + [f"{c}__fx" for c in bcols] + \
        [f"{c}__{x}" for c in next_row for x in ("nx_in", "nx_x")] + [f"{c}__{x}" for c in prev_row for x in ("pv_in", "pv_x")] + \
        [f"{c}__{x}" for c in cumsum for x in ("cs_in", "off")]
    return d.drop(*[t for t in tmp if t in d.columns])


def within_rows(rn: str, pair: Column, max_rows: int | None, forward: bool) -> Column:
    """Value of a carried (row number, value) pair when it lies within ``max_rows`` rows
    (``None``: any distance)."""
    if max_rows is None:
        return pair.getField("__v")
    dist = (F.col(rn) - pair.getField("rn")) if forward else (pair.getField("rn") - F.col(rn))
    return F.when(dist <= max_rows, pair.getField("__v"))


def as_pair(rn: str, c: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.struct(F.col(rn).alias("rn"), F.col(c).alias("__v")))


def fill_meta(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
              bucket: Column | None = None) -> DataFrame:
    """W4 (bidirectional fill): own value -> last non-null before -> first non-null after.
    Deterministic: the reference's random noise pass is replaced by ``bucket`` (exact).
    Both directions come from one pass (``carry_both``)."""
    d = carry_both(df, cols, keys, order, bucket)
    d = d.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}__prev"), F.col(f"{c}__next")) for c in cols})
    return d.drop(*[f"{c}__prev" for c in cols], *[f"{c}__next" for c in cols])


def fill_unless_removed(value: Column, removed_fields: Column, field_name: str,
                        filled: Column, is_update: Column) -> Column:
    """On an update event whose ``fields_to_remove`` (JSON array text) names the
    field, the field becomes null; otherwise the new value, else the filled-forward one."""
    removed = F.array_contains(F.from_json(removed_fields, "array<string>"), field_name)
    return (F.when(is_update & F.coalesce(removed, F.lit(False)), F.lit(None))
            .otherwise(F.coalesce(value, filled)))


# ------------------------------------------------------------------ running totals

def running_sum(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
                out: str = "running_sum", bucket: Column | None = None) -> DataFrame:
    """Running ``sum(value)`` over rows up to the current one within ``keys``.

    With ``bucket`` (non-decreasing in ``order``) the sum is exact and split in two
    stages: per-bucket running sums plus the total of all earlier buckets."""
    keys, order = list(keys), list(order)
    if bucket is None:
        w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(*order)
        return df.withColumn(out, F.sum(F.col(value)).over(w.rowsBetween(UNB_PREC, 0)))
    b = "__bucket"
    d, part = _sliced(df, keys, b, bucket)
    w = Window.partitionBy(*part).orderBy(*order)
    d = d.withColumn("__in", F.sum(F.col(value)).over(w.rowsBetween(UNB_PREC, 0)))
    tot = d.groupBy(*keys, *[c for c in [b, *part] if c not in keys]).agg(F.sum(F.col(value)).alias("__tot"))
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(b)
    tot = tot.select(*part, F.sum("__tot").over(wb.rowsBetween(UNB_PREC, -1)).alias("__off"))
    d = _join_back(d, tot, part)
    return d.withColumn(out, F.col("__in") + F.coalesce(F.col("__off"), F.lit(0))).drop(b, "__in", "__off")


def cumulative_batches(df: DataFrame, size_col: str, batch_size: int, keys: Sequence[str],
                       order: Sequence[str], bucket: Column | None = None,
                       out: str = "batch_id") -> DataFrame:
    """``ceil(running_sum(size) / batch_size)`` -> batch id (partitioned by tenant)."""
    d = running_sum(df, size_col, keys, order, out="running_size", bucket=bucket)
    return d.withColumn(out, F.ceil(F.col("running_size") / F.lit(float(batch_size))).cast("long"))


def reset_sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], reset_flag: Column,
                   duration: Column, out_session: str = "session_id",
                   out_uptime: str = "uptime_since_reset", bucket: Column | None = None,
                   session_col: str | None = None) -> DataFrame:
    """W11 (session numbering): ``session = running sum(reset_flag)``; the cumulative
    uptime is 0 on each reset row and otherwise the running sum of the session's
    durations up to and including the current row.

    With ``bucket`` both running sums use the exact two-stage plan, so neither a hot
    key nor one very long session is ever a single window partition. ``session_col``
    takes a session number already computed (e.g. fused into an earlier look-around)."""
    d = df.withColumn("__reset", reset_flag.cast("long")).withColumn("__dur", duration)
    if session_col is None:
        d = running_sum(d, "__reset", keys, order, out=out_session, bucket=bucket)
    elif session_col != out_session:
        d = d.withColumn(out_session, F.col(session_col))
    d = running_sum(d, "__dur", list(keys) + [out_session], order, out="__up", bucket=bucket)
    d = d.withColumn(out_uptime, F.when(F.col("__reset") == 1, F.lit(0)).otherwise(F.coalesce("__up", F.lit(0))))
    return d.drop("__reset", "__dur", "__up")


def state_end_from_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str,
                        until: Column, out: str = "state_end") -> DataFrame:
    """State end = next state's start - 1 ms; the open (last) state ends at ``until``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    nxt = F.lead(F.col(start), 1).over(w)
    return df.withColumn(out, F.coalesce(F.timestamp_add("MILLISECOND", F.lit(-1), nxt), until))


# ------------------------------------------------------------------ W12, W14, W15

def impute_by_group_chain(df: DataFrame, col: str, chain: Sequence[Sequence[str]], pick_by: str,
                          out: str | None = None) -> DataFrame:
    """Fill ``col`` from the first level of ``chain`` whose group holds a non-null
    value; within a group the value of the row with the smallest ``pick_by`` wins
    (``min_by``: deterministic, unlike an order-free ``first``).

    Each level is a partial aggregate joined back on its keys; AQE turns the join into
    a broadcast when the measured group table is small and splits skewed partitions
    otherwise (no whole group ever sits in one task)."""
    out = out or f"{col}_imputed"
    d = df
    parts = [F.col(col)]
    for i, level in enumerate(chain):
        level = list(level)
        g = (df.filter(F.col(col).isNotNull() & F.col(level[-1]).isNotNull())
               .groupBy(*level).agg(F.min_by(F.col(col), F.col(pick_by)).alias(f"__lvl{i}")))
        d = d.join(g, on=level, how="left")
        parts.append(F.col(f"__lvl{i}"))
    return d.withColumn(out, F.coalesce(*parts)).drop(*[f"__lvl{i}" for i in range(len(chain))])


def share_of_partition(df: DataFrame, value: str, keys: Sequence[str], out: str = "share") -> DataFrame:
    """``x / sum(x)`` over the partition. The partition total is a partial
    aggregate joined back (no whole-key window); 0 total -> null (``try_divide``)."""
    tot = df.groupBy(*keys).agg(F.sum(F.col(value)).alias("__tot"))
    return (df.join(tot, on=list(keys), how="left")
              .withColumn(out, F.try_divide(F.col(value), F.col("__tot"))).drop("__tot"))


def shift_one(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
              direction: str = "previous", bucket: Column | None = None, suffix: str = "__shift") -> DataFrame:
    """``lag(c, 1)`` (``previous``) or ``lead(c, 1)`` (``next``) within ``keys``.

    With ``bucket`` the shift runs per ``(key, slice)``; a slice's first (last) row takes
    the last (first) row of the previous (next) non-empty slice from a one-row-per-slice
    summary, so the result equals the plain window and no key is one task."""
    keys, order, cols = list(keys), list(order), list(cols)
    prev = direction == "previous"
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        fn = F.lag if prev else F.lead
        return df.withColumns({f"{c}{suffix}": fn(F.col(c), 1).over(w) for c in cols})
    b = "__bucket"
    d, part = _sliced(df, keys, b, bucket)
    w = Window.partitionBy(*part).orderBy(*order)
    fn = F.lag if prev else F.lead
    d = d.withColumn("__edge", fn(F.lit(1), 1).over(w).isNull())
    d = d.withColumns({f"{c}__in": fn(F.col(c), 1).over(w) for c in cols})
    pack = F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    summ = d.groupBy(*keys, *[c for c in [b, *part] if c not in keys]).agg((F.max(pack) if prev else F.min(pack)).alias("__p"))
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(b)
    sfn = F.lag if prev else F.lead
    summ = summ.select(*part, *[sfn(F.col("__p").getField(f"__v{i}"), 1).over(wb).alias(f"{c}__x")
                                   for i, c in enumerate(cols)])
    d = _join_back(d, summ, part)
    d = d.withColumns({f"{c}{suffix}": F.when(F.col("__edge"), F.col(f"{c}__x")).otherwise(F.col(f"{c}__in"))
                       for c in cols})
    return d.drop(b, "__edge", *[f"{c}__in" for c in cols], *[f"{c}__x" for c in cols])


def row_delta(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
              out: str | None = None, bucket: Column | None = None) -> DataFrame:
    """``x - lag(x)`` within the series (slice-split with ``bucket``)."""
    d = shift_one(df, [value], keys, order, "previous", bucket, suffix="__prev")
    return d.withColumn(out or f"{value}_delta", F.col(value) - F.col(f"{value}__prev")).drop(f"{value}__prev")
