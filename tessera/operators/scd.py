"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scd2_apply(dim: DataFrame, new_values: DataFrame, keys: Sequence[str], value_col: str,
               change_date: Column, from_col: str = "active_from", until_col: str = "active_until",
               active_col: str = "is_active") -> DataFrame:
    """Q1: active rows (open ``until``, active flag) whose value differs from the new
    value become two rows: the old one expired at ``change_date`` and a new active one
    from ``change_date``. Unchanged active rows and history pass through.

    One join (active rows x new values on keys) and an ``explode`` of at most two
    structs per row; no window, no self-join."""
    keys = list(keys)
    cols = dim.columns
    active = F.col(active_col) & F.col(until_col).isNull()
    nv = new_values.select(*keys, F.col(value_col).alias("__new"))
    cur = dim.filter(active).join(nv, on=keys, how="left")
    hist = dim.filter(~active | F.col(active_col).isNull())
    changed = F.col("__new").isNotNull() & (F.col("__new") != F.col(value_col))
    expired = F.struct(*[
        (change_date.cast(dim.schema[until_col].dataType) if c == until_col else
         F.lit(False) if c == active_col else F.col(c)).alias(c) for c in cols])
    inserted = F.struct(*[
        (F.col("__new") if c == value_col else
         change_date.cast(dim.schema[from_col].dataType) if c == from_col else
         F.lit(None).cast(dim.schema[until_col].dataType) if c == until_col else
         F.lit(True) if c == active_col else F.col(c)).alias(c) for c in cols])
    same = F.struct(*[F.col(c) for c in cols])
    rows = F.when(changed, F.array(expired, inserted)).otherwise(F.array(same))
    out = cur.select(F.explode(rows).alias("r")).select("r.*")
    return out.unionByName(hist)


def scd2_validate(df: DataFrame, keys: Sequence[str], from_col: str = "active_from",
                  until_col: str = "active_until", active_col: str = "is_active",
                  snap_date: Column | None = None, raise_on_error: bool = False) -> DataFrame:
    """Report of *active* rows that break the type-2 chain of their key.

    Per key (``lower(trim(key))``) ordered by ``from``: open ``until`` is read as
    ``snap_date``; a row is valid when it is the first row and active, or when its
    ``from`` equals the previous row's ``until`` and every earlier row is inactive.
    Duplicates of ``(key, from, until)`` (``rank``/``row_number`` > 1) are reported too.
    Dimension tables are small; the windows run per key."""
    kc = [F.lower(F.trim(F.col(k))).alias(k) for k in keys]
    snap = snap_date if snap_date is not None else F.current_date()
    d = df.select(*kc, F.col(from_col), F.coalesce(F.col(until_col), snap).alias(until_col), F.col(active_col))
    w = Window.partitionBy(*keys).orderBy(from_col)
    wk = Window.partitionBy(*keys, from_col, until_col).orderBy(from_col, until_col)
    prior_active = F.max(F.col(active_col).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = (d.withColumn("previous_until", F.lag(F.col(until_col), 1).over(w))
          .withColumn("rnk", F.rank().over(wk).cast("long"))
          .withColumn("rn", F.row_number().over(wk).cast("long"))
          .withColumn("__prior_active", F.coalesce(prior_active, F.lit(1)))
          .withColumn("is_valid", F.when(F.col("previous_until").isNull() & F.col(active_col), F.lit(True))
                      .otherwise((F.col(from_col) == F.col("previous_until")) & (F.col("__prior_active") == 0))))
    bad = d.filter(F.col(active_col)).filter(~F.col("is_valid") | (F.col("rnk") > 1) | (F.col("rn") > 1))
    rep = bad.select(*keys, from_col, "rnk", "rn", "previous_until",
                     F.datediff(F.col(from_col), F.col("previous_until")).cast("long").alias("days_between"))
    if raise_on_error and not rep.isEmpty():
        raise ValueError("invalid type-2 input")
    return rep


# ------------------------------------------------------------------ set histories

def set_history(events: DataFrame, keys: Sequence[str], order: Sequence[str], changes: str = "changes",
                replaces: str = "replaces", bucket: Column | None = None, slice_rows: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """A set that events add to, remove from and replace, as validity ranges.

    ``changes`` is an array of (member, value) structs: a value puts the member into the key's set
    or changes its value, null takes it out (of a member's repeated changes in one event the last
    counts). ``replaces`` marks events after which the set is exactly their changes; null is no.

    Returns ``(numbered, history)``: the events with ``seq``, their number within the key by the
    total ``order``, and one row for each stay (keys, member, value, ``from_seq``, ``until_seq``;
    the last event that still sees it is ``until_seq - 1``, null if it stays).

    A stay ends at the member's next change or at the key's next replacement, whichever is first:
    a look-ahead over the key and one over (key, member). Both are split, by ``bucket`` (a time
    slice, non-decreasing in ``order``) and by ``slice_rows``, so neither a key nor a member with
    a third of all events is one task, and no set is ever gathered."""
    from tessera.operators.windows import dedup_by_key, lookaround, row_numbers, shift_one
    keys = list(keys)
    numbered = row_numbers(events, keys, order, bucket, out="seq")
    fine = F.floor(F.col("seq") / slice_rows)
    reset = numbered.withColumn("__reset", F.when(F.col(replaces), F.col("seq")))
    ahead = lookaround(reset, keys, ["seq"], fine, first_nonnull_after=["__reset"])
    each = ahead.select(*keys, "seq", F.col("__reset__fna").alias("__end"), F.posexplode(changes).alias("__at", "__c"))
    each = each.select(*keys, "seq", "__end", "__at", F.col("__c").getField("member").alias("member"), F.col("__c").getField("value").alias("value"))
    each = dedup_by_key(each, [*keys, "seq", "member"], ["__at"], descending=True).drop("__at")
    each = shift_one(each, ["seq"], [*keys, "member"], ["seq"], "next", bucket=fine, suffix="__next")
    history = each.filter(F.col("value").isNotNull()).select(
        *keys, "member", "value", F.col("seq").alias("from_seq"), F.least("seq__next", "__end").alias("until_seq"))
    return numbered, history


def set_at_events(numbered: DataFrame, history: DataFrame, keys: Sequence[str], out: str = "members", slice_rows: int = 1_000) -> DataFrame:
    """Every numbered event with the set in force after it: an array of (member, value) in order,
    empty if there is none. Stays are met slice by slice (a stay is copied once a slice), so a
    key's events and stays never meet in one task."""
    keys = list(keys)
    last = numbered.groupBy(*keys).agg(F.max("seq").alias("__last"))
    width = F.lit(slice_rows)
    part = lambda c: F.floor(c / width)
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    same = F.lit(True)
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    h = history.join(last.withColumnsRenamed(names), same).drop(*names.values())
    h = h.withColumn("__until", F.coalesce(F.col("until_seq") - 1, "__last")).withColumn("__s", F.explode(F.sequence(part(F.col("from_seq")), part(F.col("__until")))))
    h = h.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("__s").alias("__hs"), "from_seq", "__until", F.struct("member", "value").alias("__m"))
    e = numbered.withColumn("__s", part(F.col("seq")))
    met = e.select(*keys, "seq", "__s").join(h, same & (F.col("__s") == F.col("__hs")) & F.col("seq").between(F.col("from_seq"), F.col("__until")))
    sets = met.groupBy(*keys, "seq").agg(F.sort_array(F.collect_list("__m")).alias(out)).withColumnsRenamed({**names, "seq": "__seq"})
    got = numbered.join(sets, same & (F.col("seq") == F.col("__seq")), "left").drop(*names.values(), "__seq")
    return got.withColumn(out, F.coalesce(F.col(out), F.array().cast(sets.schema[out].dataType)))
