"""Run lineage (A5, V12): the root of every run over chains of links, and children nested under it.

A run names its parent by one of several links (a parent run, or the run that a workflow context
names). Roots are found by pointer doubling: every round a run's pointer jumps to its pointer's
pointer, so a chain of depth d takes about log2(d) rounds, each an equi-join of the runs that are
still on their way. Runs whose pointer has reached a root leave the loop; rounds are written to the
shared folder, so no round is computed twice. The first round also finds the links that lead nowhere and
meets the runs where the grouping by key has put them, so they are not written before it. If it has
brought all parents to their roots, the second one meets these only, and is the last.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.tables import persist_and_reload


#: Own columns of these types, and no more than so many, go along with a run through the rounds.
_LIGHT_TYPES, _LIGHT = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType), 4


def resolve_roots(runs: DataFrame, key: str, links: Sequence[str], scope: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """``runs`` (its scope, key and the columns ``keep``; all without it) plus

    * ``root``: the topmost run that the links reach (the run itself if it has no link);
    * ``top``: the run just below the root on that way (null for a root);
    * ``depth``: number of links up to the root;
    * ``orphan``: the run (or the root it reaches) has a link that leads nowhere.

    The first non-null of ``links`` counts. A link to the run itself is none. A link to a run that
    is not there, or a chain that runs in a circle, leaves the run a root of its own, marked as an
    orphan: no run is lost. ``key`` is unique within ``scope`` (of repeated runs the smallest link
    counts); runs with a null key or scope are roots that nothing links to.

    A few plain columns to keep go along with the runs, so these are not dealt once more at the end;
    others are joined to what was found."""
    scope = list(scope)
    ids = [*scope, key]
    kept = list(runs.columns if keep is None else dict.fromkeys([*ids, *keep]))
    own = {f"__own{i}": c for i, c in enumerate(c for c in kept if c not in ids)}
    light = len(own) <= _LIGHT and all(isinstance(runs.schema[c].dataType, _LIGHT_TYPES) for c in own.values())
    link = F.coalesce(*[F.col(c) for c in links])
    link = F.when(link != F.col(key), link)
    named = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    if light:
        # every row goes on; one of each key, that ``one`` marks, is what others meet. All columns take part in the choice
        # (as all rows meet all runs, both sides then read the same shuffle)
        one, nodes = Window.partitionBy(*scope, "id"), runs.where(named).select(*scope, F.col(key).alias("id"), link.alias("link"), *[F.col(c).alias(x) for x, c in own.items()])
        nodes = nodes.withColumn("one", F.lag(F.lit(True)).over(one.orderBy("id", "link", *own)).isNull()).withColumn("link", F.min("link").over(one))
    else:
        own_cols, own = own, {}
        nodes = runs.where(named).groupBy(*scope, F.col(key).alias("id")).agg(F.min(link).alias("link")).withColumn("one", F.lit(True))
    # a run's state: ``at``, the run ``depth`` links above it, ``top``, the one just below that on the way, and
    # ``next``, the link of ``at`` (null: ``at`` is the root)
    state = [*scope, "id", "at", "next", "depth", "top", "orphan", "one", *own]
    none, yes = F.lit(None).cast(nodes.schema["id"].dataType), F.lit(True)

    # the first jump meets runs that are still dealt by their key; those without a link are written with it.
    # Only what cannot be told from the rest is written: ``up``, the run that the link leads to
    ahead = nodes.where("one").select(*scope, F.col("id").alias("link"), F.col("link").alias("next"), yes.alias("there"))
    there = F.col("there").isNotNull()
    first = nodes.where("link is not null").join(ahead, [*scope, "link"], "left").select(
        *scope, "id", F.when(there, F.col("link")).alias("up"), "next", (~there).alias("orphan"), "one", *own)
    first = persist_and_reload(first.unionByName(nodes.where("link is null").select(*scope, "id", none.alias("up"), none.alias("next"), F.lit(False).alias("orphan"), "one", *own)))
    linked = F.col("up").isNotNull()
    jumped_once = first.select(*scope, "id", F.coalesce("up", "id").alias("at"), "next", linked.cast("int").alias("depth"), F.when(linked, F.col("id")).alias("top"), "orphan", "one", *own)
    done, moving = [jumped_once.where("next is null")], jumped_once.where("next is not null")
    left = moving.count()
    if left and moving.select(*scope, F.col("at").alias("id")).distinct().join(moving.select(*scope, "id"), [*scope, "id"], "left_semi").isEmpty():
        # chains are short: every parent has come to its root, so runs take that over and meet no other runs
        parents = first.where(F.col("one") & F.col("next").isNull() & (linked | F.col("orphan"))).select(*scope, F.col("id").alias("at"), F.col("up").alias("up2"), F.col("orphan"))
        further = F.col("up2").isNotNull()
        done.append(persist_and_reload(moving.drop("next", "depth", "top", "orphan").join(parents, [*scope, "at"]).select(
            *scope, "id", F.coalesce("up2", "at").alias("at"), none.alias("next"), (further.cast("int") + 1).alias("depth"),
            F.when(further, F.col("at")).otherwise(F.col("id")).alias("top"), "orphan", "one", *own)))
        left = 0
    longest = first.count() if left else 0  # no chain is longer than the runs
    reach = 2
    while left and reach <= 2 * longest:
        seen = reduce(DataFrame.unionByName, [*done, moving]).where("one")
        ahead = seen.select(*scope, F.col("id").alias("next"), yes.alias("there"), F.col("at").alias("at2"), F.col("next").alias("next2"),
                            F.col("depth").alias("d2"), F.col("top").alias("t2"), F.col("orphan").alias("o2"))
        there = F.col("there").isNotNull()
        step = persist_and_reload(moving.join(ahead, [*scope, "next"], "left").select(
            *scope, "id", F.when(there, F.col("at2")).otherwise(F.col("at")).alias("at"), F.col("next2").alias("next"), F.when(there, F.col("depth") + 1 + F.col("d2")).otherwise(F.col("depth")).alias("depth"),
            F.when(there, F.when(F.col("d2") == 0, F.col("at")).otherwise(F.col("t2"))).otherwise(F.col("top")).alias("top"), F.coalesce("o2", F.lit(True)).alias("orphan"), "one", *own))
        done.append(step.where("next is null"))
        moving = step.where("next is not null")
        left = moving.count()
        reach *= 2
    if left:  # circles
        done.append(moving.withColumns({"at": F.col("id"), "depth": F.lit(0), "top": none, "orphan": yes}))
    found = reduce(DataFrame.unionByName, [f.select(*state) for f in done])
    facts = ["root", "top", "depth", "orphan"]
    if light:
        found = found.select(*scope, F.col("id").alias(key), *[F.col(x).alias(c) for x, c in own.items()], F.col("at").alias("root"), "top", "depth", "orphan")
        unnamed = runs.where(~named).select(*kept, F.col(key).alias("root"), F.lit(None).cast(runs.schema[key].dataType).alias("top"), F.lit(0).alias("depth"), F.lit(False).alias("orphan"))
        return found.select(*kept, *facts).unionByName(unnamed)
    out = runs.select(*ids, *own_cols.values()).join(found.select(*scope, F.col("id").alias(key), F.col("at").alias("root"), "top", "depth", "orphan"), ids, "left")
    return out.withColumns({"root": F.coalesce("root", F.col(key)), "depth": F.coalesce("depth", F.lit(0)), "orphan": F.coalesce("orphan", F.lit(False))}).select(*kept, *facts)


def nest_runs(resolved: DataFrame, key: str, order: Sequence[str], scope: Sequence[str] = (), children: str = "children",
              deeper: str = "workflow_children") -> DataFrame:
    """One row a root (of ``resolve_roots``): ``children`` lists the runs one link below it, each
    with ``workflow_children``, the runs below that one at any depth. Lists are sorted by ``order``
    and the key; every run stands in exactly one place, so costs count once. The lists are the
    result itself: use ``summarize_runs`` where a root has more runs than fit a row. Runs are dealt
    once, by their root; both levels of lists are made where they lie."""
    scope = list(scope)
    own = [c for c in resolved.columns if c not in ("root", "top", "orphan")]
    fields = [*order, key, *[c for c in own if c not in (*order, key)]]
    below = resolved.where("depth > 0").select(F.col("root").alias("__root"), F.when(F.col("depth") > 1, F.col("top")).alias("__top"), *dict.fromkeys([*scope, *fields, "depth"])).repartition(*scope, "__root")
    near, far = (F.collect_list(F.when(cond, F.struct(*fields))) for cond in (F.col("depth") == 1, F.col("depth") > 1))
    each = below.groupBy(*scope, "__root", F.coalesce("__top", key).alias("__child")).agg(near.alias("__near"), F.sort_array(far).alias("__far"))
    each = each.withColumn("__far", F.when(F.size("__far") > 0, F.col("__far")))
    lists = F.transform("__near", lambda run: F.struct(*[run[c].alias(c) for c in fields], F.col("__far").alias(deeper)))
    listed = each.select(*scope, F.col("__root").alias(key), lists.alias("__lists")).groupBy(*scope, key).agg(F.sort_array(F.flatten(F.collect_list("__lists"))).alias(children))
    return resolved.where("depth = 0").drop("root", "top", "depth").join(listed, [*scope, key], "left")


def summarize_runs(resolved: DataFrame, scope: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """One row a root: runs, runs one link below, deepest level and totals of ``sums`` over the
    whole lineage. A partial aggregate, so a root with a third of all runs is no single task's
    group."""
    return resolved.groupBy(*scope, "root").agg(
        F.count("*").alias("n_runs"), F.count_if(F.col("depth") == 1).alias("n_children"), F.max("depth").alias("max_depth"),
        *[F.sum(c).alias(c) for c in sums])
