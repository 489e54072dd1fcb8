"""More catalogue queries: operators that the first 47 do not reach, each over whole test
tables with DuckDB SQL for the same rows.

Index: q48 W14 · q49 A10/A11 · q50 A4 · q51 P6/P7/P8/P9 · q52 P12/P14 · q53 A7/N4 · q54 I6 ·
q55 X5 (batch) · q56 J14 · q57 J13/P3 · q58 V7/W8 · q59 G5/W12/F16 · q60 K3/K5/K10 (written
twice, rolled back) · q61 K11/K1 · q62 I4/W6 · q63 P22/P25/P4/P5 · q64 F14 · q65 F3/F5 ·
q66 K15/K12/K4 · q67 W5 · q68 F10/F12 · q69 V7 beyond 1000 rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import columns as C
from tessera.functions.cost import node_metric
from tessera.operators import aggregations as A
from tessera.operators import joins as J
from tessera.operators import quality as Q
from tessera.operators import schema as S
from tessera.operators import windows as W
from tessera.operators.tables import (TableSpec, backfill_by_map, purge_duplicates, read_table, rollback_run, rollback_to_time,
                                      stamp, write_append, write_upsert)
from tessera.plans.catalog import DAY_S, query, table
from tessera.session import ensure_checkpoint_dir


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("q48_share_of_partition", """
SELECT l_orderkey, l_linenumber, l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS share FROM lineitem
""")
def q48(spark, d):
    """Each line's share of its order's price."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return W.share_of_partition(li, "l_extendedprice", ["l_orderkey"]).drop("l_extendedprice")


@query("q49_distinct_and_global", """
SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL)) AS n_distinct,
       max(o_totalprice) AS max_o_totalprice, count(*) AS n_rows FROM orders
""")
def q49(spark, d):
    """Distinct pairs, and a global maximum with the row count."""
    o = table(spark, d, "orders")
    one, two = Q.distinct_count(o, ["o_custkey", "o_orderstatus"]), A.global_stats(o, "o_totalprice")
    return one.withColumn("k", F.lit(1)).join(two.withColumn("k", F.lit(1)), "k").drop("k")


@query("q50_nest_children", """
SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS lines
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY l_orderkey
""")
def q50(spark, d):
    """A4: an order's lines nested under it, in order."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    n = A.nest_children(li, ["l_orderkey"], "l_linenumber", "lines")
    text = F.transform("lines", lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit(":"), x["l_partkey"].cast("string")))
    return n.select("l_orderkey", F.size("lines").cast("long").alias("n"), F.array_join(text, ",").alias("lines"))


@query("q51_struct_edits", """
SELECT s_suppkey AS id, upper(s_name) AS who_name, s_nationkey + 1 AS who_nation, 'x' AS who_mark FROM supplier
""")
def q51(spark, d):
    """Replace a nested field, add one, drop one, flatten."""
    s = table(spark, d, "supplier")
    df = s.select(F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.lit(1).alias("gone")).alias("who"))
    df = S.apply_modify_struct(df, {"who.name": F.upper("who.name"), "who.nation": F.col("who.nation") + 1})
    return S.flatten(S.cull_nested(S.append_to_struct(df, "who", {"mark": F.lit("x"), "name": F.lit("no")}), "who", ["gone"]))


@query("q52_clean_names", """
SELECT p_partkey AS partkey, p_name AS name_of_part, p_retailprice AS a_b, p_retailprice * 2 AS a_b2 FROM part
""")
def q52(spark, d):
    """Cleaned names at the top and inside structs."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("name-of-part"),
                                       F.struct(F.col("p_retailprice").alias("a.b"), (F.col("p_retailprice") * 2).alias("a b2")).alias("in ner"))
    out = S.scrub_schema(p)
    assert S.nested_col_exists(out.schema, "inner.a_b") and not S.nested_col_exists(out.schema, "inner.a.b")
    return out.select("partkey", "name_of_part", "inner.a_b", F.col("inner.ab2").alias("a_b2"))


@query("q53_task_hours_by_run", """
WITH t AS (SELECT l_orderkey % 50 AS ctx, l_linenumber AS stage, sum(l_quantity) * 36000 AS ms FROM lineitem GROUP BY 1, 2)
SELECT o.o_custkey AS run_id, CAST(round(CAST(CAST(sum(t.ms) / 3600000.0 AS VARCHAR) AS DECIMAL(38, 18)), 4) AS DOUBLE) AS spark_task_runtime_H
FROM orders o, (VALUES (1), (2)) s(n) JOIN t ON t.ctx = o.o_orderkey % 50 AND t.stage = s.n + o.o_orderkey % 3 GROUP BY 1
""")
def q53(spark, d):
    """Task time of the stages that a run's jobs list."""
    tasks = table(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("ctx"), F.col("l_linenumber").cast("long").alias("StageID"), (F.col("l_quantity") * 36000).alias("ms"))
    third = F.col("o_orderkey") % 3
    jobs = table(spark, d, "orders").select(F.col("o_custkey").alias("run_id"), (F.col("o_orderkey") % 50).alias("ctx"), F.array(third + 1, third + 2).alias("stages"))
    return A.spark_util_by_run(jobs, tasks, ["run_id"], "stages", ["ctx"], "ms")


@query("q54_impute_first_run", """
SELECT o_custkey AS cluster_id, epoch_ms(o_orderdate) AS ts, 'edit' AS "actionName", CAST(NULL AS VARCHAR) AS node FROM orders
UNION ALL SELECT c_custkey, 1, 'snapImpute', c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
""")
def q54(spark, d):
    """Customers without any order get one row from their snapshot."""
    from tessera.operators.incremental import impute_first_run
    log = table(spark, d, "orders").select(F.col("o_custkey").alias("cluster_id"), C.epoch_ms("o_orderdate").alias("ts"), F.lit("edit").alias("actionName"), F.lit(None).cast("string").alias("node"))
    snap = table(spark, d, "customer").select(F.col("c_custkey").alias("cluster_id"), F.col("c_mktsegment").alias("node"))
    return impute_first_run(log, snap, ["cluster_id"], ["node"], F.lit(1).cast("long"), "ts")


@query("q55_exactly_once", "SELECT event_id, user_id, event_type FROM events")
def q55(spark, d):
    """X5 in batch: events landed twice are kept once."""
    from tessera.streaming.land import exactly_once
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return exactly_once(e.unionByName(e), ["event_id"])


@query("q56_salted_join", """
SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN part ON p_partkey = CASE WHEN l_linenumber <> 4 THEN l_partkey END
""")
def q56(spark, d):
    """Lines joined to parts with the hot parts salted; every fourth line has no key."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 4, F.col("l_partkey")).alias("k"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return J.salted_join(li, p, ["k"], salt=4, how="left").drop("k")


@query("q57_renamed_key_join", """
SELECT s_suppkey, s_name AS s_name_s, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def q57(spark, d):
    """Keys of different names, a suffixed column."""
    s = S.suffix_cols(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "_s", ["s_name"])
    return J.renamed_key_join(s, table(spark, d, "nation").select("n_nationkey", "n_name"), {"s_nationkey": "n_nationkey"}).drop("s_nationkey")


def _account_audit(spark, d, name, every: int):
    ev = table(spark, d, "events")
    last = F.col("event_id") % every == every - 1
    return ev.select(
        F.lit("o").alias("organization_id"), F.to_date("ts").alias("date"), C.epoch_ms("ts").alias("timestamp"), F.lit("accounts").alias("serviceName"),
        F.when(F.col("event_type") == "view", "login").otherwise("updateUser").alias("actionName"), F.format_string("%020d", "event_id").alias("requestId"),
        F.struct(F.lit("a@b.c").alias("email")).alias("userIdentity"),
        F.struct(name.alias("targetUserName"), F.when(last, F.concat(F.lit("id"), F.col("event_id").cast("string"))).alias("targetUserId")).alias("requestParams"))


def _account_sql(name: str, every: int) -> str:
    return f"""
WITH a AS (SELECT event_id, (epoch_us(ts) // 1000) AS t, {name} AS user_name, CASE WHEN event_id % {every} = {every - 1} THEN 'id' || event_id END AS own FROM events WHERE event_type <> 'view')
SELECT printf('%020d', event_id) AS "requestId", user_name,
       first_value(own IGNORE NULLS) OVER (PARTITION BY user_name ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS user_id FROM a
"""


@query("q58_account_mods", _account_sql("'u' || (user_id % 20)", 7))
def q58(spark, d):
    """A user's id from the next action that has it."""
    from tessera.plans.medallion.silver import account_mods
    name = F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string"))
    return account_mods(_account_audit(spark, d, name, 7), slice_ms=DAY_S * 1000.0).select("requestId", "user_name", "user_id")


def _step(n: int, ids: str, guard: str = "true") -> str:
    return f"""g{n} AS (SELECT {ids}, min_by(u{n - 1}, t) AS u FROM j{n - 1} WHERE u{n - 1} IS NOT NULL AND {guard} GROUP BY {ids}),
j{n} AS (SELECT j.*, coalesce(j.u{n - 1}, CASE WHEN {guard} THEN g.u END) AS u{n} FROM j{n - 1} j LEFT JOIN g{n} g USING ({ids}))"""


@query("q59_spark_job_users", f"""
WITH j0 AS (SELECT event_id, user_id % 4 AS ctx, user_id % 5 AS iso, user_id % 7 AS grp, event_id % 50 AS x, user_id % 9 AS principal, event_id % 13 AS repl, (epoch_us(ts) // 1000) * 1000000 + event_id AS t,
                   CASE WHEN event_type = 'purchase' AND user_id % 11 = 0 AND event_id % 7 = 0 THEN 'm' || (event_id % 11) END AS u0 FROM events),
{_step(1, "principal", "principal > 6")}, {_step(2, "ctx, iso", "iso > 2")}, {_step(3, "ctx, grp", "grp > 4")}, {_step(4, "ctx, x", "x > 40")}
SELECT event_id, coalesce(u4, CASE WHEN repl > 0 THEN last_value(u4 IGNORE NULLS) OVER (PARTITION BY ctx, repl ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END) AS user_email_imputed,
       CASE WHEN grp > 4 THEN CAST(grp AS VARCHAR) END AS db_job_id, CASE WHEN grp > 4 THEN '0' END AS db_id_in_job, 'c' || ctx AS cluster_id FROM j4
""")
def q59(spark, d):
    """Users imputed by principal over all contexts, then within a Spark context by isolation
    id, job group and execution, then by REPL up to the job; each step uses what the one before
    found, and jobs without an id form no group."""
    from tessera.plans.medallion.gold import spark_job_gold
    e = table(spark, d, "events")
    own = F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 11 == 0) & (F.col("event_id") % 7 == 0), F.concat(F.lit("m"), (F.col("event_id") % 11).cast("string")))
    some = lambda c, least: F.when(c > least, c)
    ctx, iso, grp, x = F.col("user_id") % 4, F.col("user_id") % 5, F.col("user_id") % 7, F.col("event_id") % 50
    jobs = e.select("event_id", F.lit("o").alias("organization_id"), F.concat(F.lit("c"), ctx.cast("string")).alias("cluster_id"), ctx.alias("SparkContextID"), some(iso, 2).alias("isolation_id"),
                    F.when(grp > 4, F.format_string("a_b_job-%d-run-0_c", grp)).alias("job_group_id"), some(x, 40).alias("execution_id"), some(F.col("user_id") % 9, 6).alias("principal_id"),
                    some(F.col("event_id") % 13, 0).alias("repl_id"), (C.epoch_ms("ts") * 1000000 + F.col("event_id")).alias("startTimestamp"), own.alias("user_email"))
    return spark_job_gold(jobs, slice_ms=DAY_S * 1e9).select("event_id", "user_email_imputed", "db_job_id", "db_id_in_job", "cluster_id")


@query("q60_upsert_twice", """
SELECT o_custkey, o_orderdate, max(o_totalprice) AS o_totalprice, 1 AS n FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1, 2
""")
def q60(spark, d):
    """A merge target written twice with overlapping, repeated rows, and a
    failed run's rows taken back. The key includes the incremental column."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice").groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("o_totalprice"))
    spec = TableSpec("t", _folder(spark, "upsert"), keys=("o_custkey",), incremental_cols=("o_orderdate",), partition_by=(), mode="merge", tenant_col=None)
    good = o.where("o_custkey % 2 = 0").withColumn("run_id", F.lit("good"))
    write_upsert(good.unionByName(good), spec)
    write_upsert(good.where("o_custkey % 4 = 0"), spec)
    write_upsert(o.where("o_custkey % 2 = 1").withColumn("run_id", F.lit("bad")), spec)
    kept = rollback_run(read_table(spark, spec), "bad")
    return kept.groupBy("o_custkey", "o_orderdate", "o_totalprice").agg(F.count("*").alias("n"))


@query("q61_rollback_to_time", """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN (epoch_us(ts) // 1000) END AS t FROM events WHERE event_id % 10 = 0 OR ts < TIMESTAMP '2024-01-15 00:00:00'
""")
def q61(spark, d):
    """Rows before a time stay, and so do rows without a time."""
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, C.epoch_ms("ts")).alias("t"))
    spec = TableSpec("t", _folder(spark, "rollback"), incremental_cols=("t",), tenant_col=None)
    write_append(e, spec)
    return rollback_to_time(read_table(spark, spec), ["t"], 1705276800000)


@query("q62_latest_state", """
SELECT module_id, run_id FROM (SELECT o_custkey AS module_id, CAST(o_orderkey AS VARCHAR) AS run_id,
  row_number() OVER (PARTITION BY o_custkey ORDER BY epoch_ms(o_orderdate) DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders WHERE o_orderstatus <> 'F') WHERE rn = 1
""")
def q62(spark, d):
    """The newest successful or empty run of each module."""
    from tessera.operators.incremental import latest_successful_state
    status = F.when(F.col("o_orderstatus") == "F", "FAILED: x").when(F.col("o_orderstatus") == "O", "SUCCESS").otherwise("EMPTY: no new data")
    st = table(spark, d, "orders").select(F.col("o_custkey").alias("module_id"), F.col("o_orderkey").cast("string").alias("run_id"), C.epoch_ms("o_orderdate").alias("until_ts"), status.alias("status"), F.lit(0).alias("recorded_at"))
    return latest_successful_state(st).select("module_id", "run_id")


@query("q63_fill_and_front", """
SELECT CASE WHEN c_custkey % 3 = 0 THEN '0' ELSE c_mktsegment END AS seg, c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_acctbal END AS bal, CAST(NULL AS BIGINT) AS absent FROM customer
""")
def q63(spark, d):
    """Fills, a moved column, required fields, a typed null."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("seg"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("bal"))
    out = S.move_to_front(S.fill_all_nas(c), ["seg"])
    S.require_fields(out, ["seg", "bal"])
    return out.withColumn("absent", S.handle_root_null(out, "nowhere", F.lit(1), T.LongType()))


@query("q64_date_spine", """
SELECT o_orderkey, CAST(unnest(range(CAST(o_orderdate AS TIMESTAMP), CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY * (1 + o_orderkey % 4), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
""")
def q64(spark, d):
    """One row per day of each order's span."""
    o = table(spark, d, "orders")
    first = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", F.explode(C.date_spine(first, F.date_add(first, (1 + F.col("o_orderkey") % 4).cast("int")))).alias("day"))


@query("q65_time_text_and_ticks", """
SELECT event_id, ((epoch_us(ts) // 1000) // 1000) * 1000 + event_id % 1000 AS ms, event_id + 2 AS plus, event_id - 1 AS minus FROM events
""")
def q65(spark, d):
    """ISO text with milliseconds to epoch milliseconds; ticks added."""
    e = table(spark, d, "events")
    text = F.concat(F.date_format(F.timestamp_seconds(F.floor(C.epoch_ms("ts") / 1000)), "yyyy-MM-dd'T'HH:mm:ss"), F.format_string(".%03dZ", F.col("event_id") % 1000))
    long = e.schema["event_id"].dataType
    return e.select("event_id", C.string_ts_to_epoch_ms(text).alias("ms"), C.add_ticks("event_id", long, 2).alias("plus"), C.subtract_ticks("event_id", long).alias("minus"))


@query("q66_backfill_and_purge", """
SELECT DISTINCT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '5-LOW' THEN 'later' ELSE 'as is' END AS pace, 'r1' AS run_id FROM orders
""")
def q66(spark, d):
    """A column filled from a map, repeated keys purged, rows stamped."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", F.lit("as is").alias("pace"))
    filled = backfill_by_map(o, "pace", "o_orderpriority", {"1-URGENT": "now", "5-LOW": "later"}).drop("o_orderpriority")
    return stamp(purge_duplicates(filled, ["o_custkey", "pace"]), "r1").drop("Pipeline_SnapTS")


@query("q67_fill_unless_removed", """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS v, event_type = 'click' AND event_id % 2 = 0 AS gone FROM events)
SELECT event_id, CASE WHEN gone THEN NULL ELSE coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS v FROM e
""")
def q67(spark, d):
    """A value filled forward unless an update removes the field."""
    e = table(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    f = W.carry(e, ["v"], ["user_id"], ["ts", "event_id"], bucket=F.floor(C.epoch_ms("ts") / F.lit(DAY_S * 1000)).cast("long"))
    removed = F.when(F.col("event_id") % 2 == 0, F.lit('["v","w"]')).otherwise(F.lit('["w"]'))
    return f.select("event_id", W.fill_unless_removed(F.col("v"), removed, "v", F.col("v__carry"), F.col("event_type") == "click").alias("v"))


@query("q68_node_metrics", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(round(CAST(CAST(0.5 * (CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 < o_orderkey % 5 THEN o_orderkey % 3 ELSE o_orderkey % 5 END) * 10.0 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) END AS worker_h,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 4.0 END AS driver_m, 'a b c' AS note FROM orders
""")
def q68(spark, d):
    """worker and driver metrics of a state; a cleaned description."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "TERMINATING").when(F.col("o_orderstatus") == "O", "RESIZING").otherwise("RUNNING").alias("state"),
        (F.col("o_orderkey") % 3).alias("target_num_workers"), (F.col("o_orderkey") % 5).alias("current_num_workers"), F.lit(10.0).alias("uptime_in_state_S"),
        F.struct(F.lit(0.5).alias("cost")).alias("workerSpecs"), F.struct(F.lit(4.0).alias("memory")).alias("driverSpecs"))
    return o.select("o_orderkey", node_metric("worker", "cost", True).cast("double").alias("worker_h"), node_metric("driver", "memory", False).cast("double").alias("driver_m"),
                    C.clean_description(F.lit(" a<br/>b\nc ")).alias("note"))


@query("q69_account_mods_far_id", _account_sql("'one'", 3000))
def q69(spark, d):
    """V7 with one user of all rows, whose id stands on every 3000th event only."""
    from tessera.plans.medallion.silver import account_mods
    return account_mods(_account_audit(spark, d, F.lit("one"), 3000), slice_ms=DAY_S * 1000.0).select("requestId", "user_name", "user_id")
