"""Catalogue queries over stored and nested state: merges and rollbacks on partitions without a
value, map columns, run lineage, facts that replace their own open rows, permission histories
and overlaps without pairs. Each runs over whole test tables, with DuckDB SQL for the same rows.

Index: q70 K1/K3/K10/K11 (null partitions) · q71 W1 (map columns) ·
q72 V12/A5 (run lineage) · q73 G4 (open runs, tenants, cluster types) · q74 V11 (set history) ·
q75 J1/J3 (bounded look-back under slicing) · q76 B5/S3/S4 (file intake) · q77 S8/B3 (audit envelopes) ·
q78 V7/G1/P24 (published account changes) · q79 V5/G1/P24 (published Spark tasks) ·
q80 V12 (runs of several tasks) · q81 V11 (job settings and people) · q82 G6/X7 (streaming queries).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import columns as C
from tessera.operators import windows as W
from tessera.operators.lineage import nest_runs, resolve_roots, summarize_runs
from tessera.operators.tables import TableSpec, keep_rows, persist_and_reload, read_table, rollback_run, rollback_to_time, write_append, write_upsert
from tessera.operators.scd import set_at_events, set_history
from tessera.plans.catalog import _G4_UNTIL_MS, DAY_S, _sround, query, table
from tessera.plans.catalog_more import _folder


@query("q70_null_partitions", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS part, o_orderdate,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS run_id
FROM orders WHERE (o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0) AND o_orderdate < TIMESTAMP '1997-06-01 00:00:00'
""")
def q70(spark, d):
    """K3, K10, K11 on a table whose partition value is null for half of its rows: written,
    merged, a failed run's rows appended and taken back, then rolled back to a time."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("part"), "o_orderdate", F.col("o_totalprice").alias("price"))
    spec = TableSpec("t", _folder(spark, "parted"), keys=("o_orderkey",), incremental_cols=("o_orderdate",), partition_by=("part",), mode="merge", tenant_col=None)
    write_upsert(o.where("o_orderkey % 3 <> 0").withColumn("run_id", F.lit("first")), spec)
    write_upsert(o.where("o_orderkey % 2 = 0").withColumns({"price": F.col("price") + 1, "run_id": F.lit("second")}), spec)
    write_append(o.withColumns({"o_orderkey": -F.col("o_orderkey"), "run_id": F.lit("bad")}), spec)
    keep_rows(spark, spec, lambda t: rollback_run(t, "bad"))
    keep_rows(spark, spec, lambda t: rollback_to_time(t, ["o_orderdate"], 865123200000))  # 1997-06-01
    return read_table(spark, spec).select("o_orderkey", "part", "o_orderdate", "price", "run_id")


@query("q71_first_of_map_rows", """
WITH e AS (SELECT event_type, event_id, ts, user_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM events),
m AS (SELECT event_type, date_trunc('hour', ts) AS h, k, user_id FROM e)
SELECT event_type, min(h) AS h, min_by(u, h) AS u, min_by(k, h) AS k FROM (
  SELECT event_type, h, user_id AS u, k, row_number() OVER (PARTITION BY event_type ORDER BY h, k, user_id) AS rn FROM m) WHERE rn = 1 GROUP BY event_type
""")
def q71(spark, d):
    """W1 with a map column and few, hot keys: ties on the time are broken by the map, entry
    by entry in key order, whatever order the entries were put in."""
    e = table(spark, d, "events")
    k, u = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(-1).cast("long")), F.col("user_id").cast("long")
    entries = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("a"), k, F.lit("b"), u)).otherwise(F.create_map(F.lit("b"), u, F.lit("a"), k))
    rows = e.select("event_type", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("h"), entries.alias("m"))
    first = W.dedup_by_key(rows, ["event_type"], ["h"])
    return first.select("event_type", "h", F.col("m")["b"].alias("u"), F.col("m")["a"].alias("k"))


@query("q72_run_lineage", """
WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
ord AS (SELECT o_orderkey AS o FROM orders WHERE o_orderstatus <> 'P'),
lines AS (SELECT o, n, count(*) AS parts, sum(q) AS q, string_agg('p' || o || '-' || n || '-' || p, ',' ORDER BY p) AS names FROM l GROUP BY o, n),
top AS (SELECT 'o' || ord.o AS run_id, false AS orphan, count(l.n) AS n_children, coalesce(sum(l.parts), 0) AS n_deeper, coalesce(sum(l.q), 0) AS quantity,
               coalesce(string_agg('l' || l.o || '-' || l.n || '(' || l.names || ')', ',' ORDER BY l.n), '') AS children FROM ord LEFT JOIN lines l ON l.o = ord.o GROUP BY ord.o),
alone AS (SELECT 'l' || o || '-' || n AS run_id, true AS orphan, parts AS n_children, 0 AS n_deeper, q AS quantity, string_agg('p' || o || '-' || n || '-' || p || '()', ',' ORDER BY p) AS children
          FROM (SELECT l.o, l.n, l.p, lines.parts, lines.q FROM l JOIN lines ON lines.o = l.o AND lines.n = l.n WHERE l.o NOT IN (SELECT o FROM ord)) GROUP BY o, n, parts, q)
SELECT run_id, orphan, CAST(n_children AS BIGINT) AS n_children, CAST(n_deeper AS BIGINT) AS n_deeper, CAST(n_children + n_deeper + 1 AS BIGINT) AS n_runs, quantity, children FROM top
UNION ALL SELECT run_id, orphan, CAST(n_children AS BIGINT), CAST(n_deeper AS BIGINT), CAST(n_children + n_deeper + 1 AS BIGINT), quantity, children FROM alone
""")
def q72(spark, d):
    """Orders, their lines (by a parent link) and the lines' parts (by a workflow
    context) nest as three levels; lines of orders that are not there stay as orphans."""
    o = table(spark, d, "orders").where("o_orderstatus <> 'P'")
    text = lambda mark, *cols: F.concat(F.lit(mark), F.concat_ws("-", *[F.col(c).cast("string") for c in cols]))
    none = F.lit(None).cast("string")
    line, part = text("l", "l_orderkey", "l_linenumber"), text("p", "l_orderkey", "l_linenumber", "l_partkey")
    runs = o.select(text("o", "o_orderkey").alias("run_id"), none.alias("parent"), none.alias("context"), F.lit(0.0).alias("quantity"), F.lit(0).cast("long").alias("seq"))
    # the parts of a line are dealt by the line; its first one brings the line's own run with it
    on_line = ["l_orderkey", "l_linenumber"]
    li = table(spark, d, "lineitem").select(*on_line, "l_partkey", "l_quantity").repartition(*on_line).groupBy(*on_line, "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    li = li.withColumn("first", F.lag(F.lit(True)).over(Window.partitionBy(*on_line).orderBy("l_partkey")).isNull())
    li = li.withColumn("of_line", F.explode(F.when(F.col("first"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    either = lambda a, b: F.when(F.col("of_line"), a).otherwise(b)
    runs = runs.unionByName(li.select(either(line, part).alias("run_id"), either(text("o", "l_orderkey"), none).alias("parent"), either(none, line).alias("context"),
                                      either(F.lit(0.0), F.col("quantity")).alias("quantity"), either(F.col("l_linenumber").cast("long"), F.col("l_partkey").cast("long")).alias("seq")))
    resolved = resolve_roots(runs, "run_id", ["parent", "context"], keep=["quantity", "seq"])
    nested = nest_runs(resolved.drop("quantity"), "run_id", ["seq"])
    below = F.transform("children", lambda c: F.concat(c["run_id"], F.lit("("), F.array_join(F.coalesce(c["workflow_children"]["run_id"], F.array().cast("array<string>")), ","), F.lit(")")))
    deeper = F.aggregate("children", F.lit(0).cast("long"), lambda n, c: n + F.coalesce(F.size(c["workflow_children"]).cast("long"), F.lit(0)))
    nested = nested.select("run_id", "orphan", F.coalesce(F.size("children").cast("long"), F.lit(0)).alias("n_children"), F.coalesce(deeper, F.lit(0)).alias("n_deeper"),
                           F.coalesce(F.array_join(below, ","), F.lit("")).alias("children"))
    totals = summarize_runs(resolved, sums=["quantity"]).select(F.col("root").alias("run_id"), "n_runs", "quantity")
    return nested.join(totals, "run_id")


# ------------------------------------------------------------------ q73 cost fact written window by window

_COSTS = {"driver_compute_cost": 1.0, "driver_dbu_cost": 2.0, "worker_compute_cost": 3.0, "worker_dbu_cost": 5.0}
_FIRST_UNTIL_MS = 833587200000  # 1996-06-01

_Q73_SQL = f"""
WITH o AS (SELECT 'a' AS org, o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
           UNION ALL SELECT 'b', o_orderkey, o_custkey, o_orderdate, o_totalprice * 2 FROM orders WHERE o_custkey % 4 = 0),
ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
st0 AS (SELECT org, o_custkey AS cluster_id, epoch_ms(o_orderdate) + o_orderkey AS state_start, o_totalprice / 1000.0 AS cost, o_orderkey % 5 = 0 AS starting FROM o),
st AS (SELECT *, coalesce(lead(state_start) OVER (PARTITION BY org, cluster_id ORDER BY state_start) - 1, {_G4_UNTIL_MS}) AS state_end FROM st0),
runs AS (SELECT o.org, o.o_orderkey AS run_id, o.o_custkey AS cluster_id, CASE WHEN o.o_orderkey % 3 = 0 THEN 'new' ELSE 'existing' END AS cluster_type,
                epoch_ms(o.o_orderdate) + o.o_orderkey + 3600000 AS run_start,
                greatest(epoch_ms(o.o_orderdate) + o.o_orderkey + 3600000, epoch_ms(ls.last_ship) + o.o_orderkey) AS run_end
         FROM o JOIN ls ON o.o_orderkey = ls.l_orderkey),
init AS (SELECT r.*, s.* EXCLUDE (org, cluster_id), CASE WHEN s.starting OR r.cluster_type = 'new' THEN s.state_end - s.state_start ELSE least(s.state_end, r.run_end) - r.run_start END AS tis
         FROM runs r ASOF JOIN st s ON r.org = s.org AND r.cluster_id = s.cluster_id AND r.run_start > s.state_start),
seq AS (SELECT org, cluster_id, run_end AS ts, 0 AS side, run_id, CAST(NULL AS BIGINT) AS s_start FROM runs UNION ALL SELECT org, cluster_id, state_end, 1, NULL, state_start FROM st),
term0 AS (SELECT *, lead(s_start) OVER (PARTITION BY org, cluster_id ORDER BY ts, side, run_id, s_start) AS pick FROM seq),
term AS (SELECT r.*, s.* EXCLUDE (org, cluster_id), r.run_end - s.state_start AS tis FROM term0 t JOIN runs r USING (org, run_id, cluster_id)
         JOIN st s ON s.org = r.org AND s.cluster_id = r.cluster_id AND s.state_start = t.pick
         WHERE t.side = 0 AND s.state_end >= r.run_end
           AND NOT EXISTS (SELECT 1 FROM init i WHERE i.org = r.org AND i.run_id = r.run_id AND i.cluster_id = r.cluster_id AND i.state_start = s.state_start)),
ends AS (SELECT * FROM init UNION ALL SELECT * FROM term),
mid AS (SELECT r.*, s.* EXCLUDE (org, cluster_id), s.state_end - s.state_start AS tis FROM runs r JOIN st s ON r.org = s.org AND r.cluster_id = s.cluster_id
        AND s.state_start > r.run_start AND s.state_end < r.run_end
        WHERE NOT EXISTS (SELECT 1 FROM ends i WHERE i.org = r.org AND i.run_id = r.run_id AND i.cluster_id = r.cluster_id AND i.state_start = s.state_start)),
rs AS (SELECT *, greatest(run_start, state_start) AS rss, least(run_end, state_end) AS rse, (state_end - state_start) / 3600000.0 AS uptime_h FROM (SELECT * FROM ends UNION ALL SELECT * FROM mid)),
ov AS (SELECT a.org, a.run_id, a.cluster_id, a.state_start, sum(greatest(0, least(a.rse, b.rse) - greatest(a.rss, b.rss))) AS cum,
              count(*) FILTER (WHERE b.run_id <> a.run_id AND b.rss < a.rse AND b.rse > a.rss) AS n_ov
       FROM rs a JOIN rs b ON a.org = b.org AND a.cluster_id = b.cluster_id AND a.state_start = b.state_start WHERE a.cluster_type = 'existing' AND b.cluster_type = 'existing' GROUP BY ALL),
f AS (SELECT rs.*, coalesce(ov.n_ov, 0) AS n_ov, CASE WHEN uptime_h = 0 THEN NULL ELSE (tis / 1000 / 3600) / uptime_h END AS util,
             CASE WHEN rs.cluster_type = 'new' OR coalesce(ov.cum, 0) = 0 THEN 1.0 ELSE least(CAST(tis AS DOUBLE) / CAST(ov.cum AS DOUBLE), 1.0) END AS share
      FROM rs LEFT JOIN ov ON rs.org = ov.org AND rs.run_id = ov.run_id AND rs.cluster_id = ov.cluster_id AND rs.state_start = ov.state_start AND rs.cluster_type = 'existing')
SELECT org AS organization_id, run_id, cluster_id, cluster_type, run_start, run_end, false AS open_run,
       {", ".join(f"greatest({_sround(f'sum(cost * {w} * util * share)', 6)}, 0) AS {c}" for c, w in _COSTS.items())},
       count(*) AS cluster_states, max(n_ov) AS max_overlapping_runs, {_sround("avg(n_ov)", 2)} AS avg_overlapping_runs,
       CAST(run_end // 86400000 - run_start // 86400000 + 1 AS BIGINT) AS n_days, 'n' || run_id AS run_name
FROM f GROUP BY org, run_id, cluster_id, cluster_type, run_start, run_end
"""


@query("q73_cost_fact_by_windows", _Q73_SQL)
def q73(spark, d):
    """G4 written twice: up to mid 1996, then up to the end. The second write re-reads its own
    open runs and the runs in states that went on, and replaces them; the stored fact equals one
    run over both windows. Two tenants share run and cluster ids; runs are on new and on existing
    clusters, some states are starting ones, and there are four costs."""
    from tessera.plans.medallion.gold import refresh_job_run_costs
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    o = o.withColumn("organization_id", F.lit("a")).unionByName(
        o.where("o_custkey % 4 = 0").withColumns({"o_totalprice": F.col("o_totalprice") * 2, "organization_id": F.lit("b")}))
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    at = C.epoch_ms("o_orderdate") + F.col("o_orderkey")
    keys, begun = ["organization_id", F.col("o_custkey").alias("cluster_id")], at + 3600000
    all_runs = o.join(last, o.o_orderkey == last.l_orderkey).select(
        *keys, F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderkey") % 3 == 0, "new").otherwise("existing").alias("cluster_type"),
        begun.alias("run_start_ms"), F.greatest(begun, C.epoch_ms("last_ship") + F.col("o_orderkey")).alias("run_end_ms"), F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("run_name"))
    all_runs = persist_and_reload(all_runs)  # both windows read the runs several times
    year = 365 * DAY_S * 1000.0
    spec = TableSpec("fact", _folder(spark, "costs"), keys=("run_id", "cluster_id"), mode="merge")
    since = 0
    for until in (_FIRST_UNTIL_MS, _G4_UNTIL_MS):
        st = o.select(*keys, at.alias("unixTimeMS_state_start"), (F.col("o_totalprice") / 1000.0).alias("cost"),
                      F.when(F.col("o_orderkey") % 5 == 0, "STARTING").otherwise("RUNNING").alias("state")).where(F.col("unixTimeMS_state_start") < until)
        st = W.shift_one(st, ["unixTimeMS_state_start"], ["organization_id", "cluster_id"], ["unixTimeMS_state_start"], "next",
                         bucket=F.floor(F.col("unixTimeMS_state_start") / F.lit(year)).cast("long"), suffix="__next")
        end = F.coalesce(F.col("unixTimeMS_state_start__next") - 1, F.lit(until))
        states = persist_and_reload(st.select("organization_id", "cluster_id", "unixTimeMS_state_start", end.alias("unixTimeMS_state_end"), "state",
                           ((end - F.col("unixTimeMS_state_start")) / 3600000.0).alias("uptime_in_state_H"), F.lit(0.0).alias("worker_potential_core_H"),
                           *[(F.col("cost") * w).alias(c) for c, w in _COSTS.items()]))
        known = all_runs.withColumn("run_end_ms", F.when(F.col("run_end_ms") < until, F.col("run_end_ms")))
        # a customer's state may last for years here, so the lag covers all of them
        refresh_job_run_costs(spark, spec, states, known, since, until, lag_ms=3000 * DAY_S * 1000, slice_ms=year, month_bucket_ms=60 * DAY_S * 1000)
        since = until
    return read_table(spark, spec).select("organization_id", "run_id", "cluster_id", "cluster_type", "run_start", "run_end", "open_run", *_COSTS,
                                          "cluster_states", "max_overlapping_runs", "avg_overlapping_runs", F.size("running_days").cast("long").alias("n_days"), "run_name")


_Q74_SQL = """
WITH e AS (SELECT event_id, user_id % 40 AS k, event_type AS t, event_id AS i, row_number() OVER (PARTITION BY user_id % 40 ORDER BY ts, event_id) AS seq FROM events),
m AS (SELECT unnest([0, 1, 2, 3, 4]) AS n),
op AS (SELECT e.*, m.n, CASE t WHEN 'signup' THEN CASE WHEN n = (i + 2) % 5 THEN 'w' WHEN n = i % 5 THEN 'r' ELSE '-' END
                              WHEN 'click' THEN CASE WHEN n = i % 5 THEN 'c' || (i % 3) END
                              WHEN 'error' THEN CASE WHEN n = i % 5 THEN '-' END
                              WHEN 'purchase' THEN CASE WHEN n = (i + 1) % 5 THEN 'p' WHEN n = i % 5 THEN 'q' END END AS v FROM e CROSS JOIN m),
s AS (SELECT event_id, k, seq, n, last_value(v IGNORE NULLS) OVER (PARTITION BY k, n ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM op)
SELECT event_id, k, seq, coalesce(string_agg('m' || n || ':' || v, ',' ORDER BY n) FILTER (v <> '-'), '') AS members FROM s GROUP BY event_id, k, seq
"""


@query("q74_set_history", _Q74_SQL)
def q74(spark, d):
    """A set that events replace, add to and take from, in force after every event; forty
    keys hold all events, as many slices as there are days hold a key."""
    i = F.col("event_id")
    pair = lambda n, v: F.struct(F.concat(F.lit("m"), (n % 5).cast("string")).alias("member"), v.cast("string").alias("value"))
    kind = F.col("event_type")
    changes = (F.when(kind == "signup", F.array(pair(i, F.lit("r")), pair(i + 2, F.lit("w")))).when(kind == "click", F.array(pair(i, F.concat(F.lit("c"), (i % 3).cast("string")))))
               .when(kind == "error", F.array(pair(i, F.lit(None)))).when(kind == "purchase", F.array(pair(i, F.lit("q")), pair(i + 1, F.lit("p")))))
    ev = table(spark, d, "events").select("event_id", "ts", (F.col("user_id") % 40).alias("k"), changes.alias("changes"), (kind == "signup").alias("replaces"))
    day = F.floor(C.epoch_ms("ts") / F.lit(DAY_S * 1000)).cast("long")
    numbered, history = set_history(ev, ["k"], ["ts", "event_id"], bucket=day, slice_rows=500)
    got = set_at_events(numbered, history, ["k"], slice_rows=100)
    return got.select("event_id", "k", "seq", F.array_join(F.transform("members", lambda m: F.concat(m["member"], F.lit(":"), m["value"])), ",").alias("members"))


@query("q75_bounded_lookup", """
WITH u AS (SELECT user_id, ts, 0 AS side, event_id, value, CAST(NULL AS BIGINT) AS view_id, CAST(NULL AS DOUBLE) AS view_value FROM events WHERE event_type = 'purchase'
           UNION ALL SELECT user_id, ts, 1, NULL, NULL, event_id, CASE WHEN event_id % 3 > 0 THEN value END FROM events WHERE event_type = 'view'),
w AS (SELECT *, last_value(view_id IGNORE NULLS) OVER b AS back_id, last_value(view_value IGNORE NULLS) OVER b AS back_value,
             first_value(view_id IGNORE NULLS) OVER f AS next_id, first_value(view_value IGNORE NULLS) OVER f AS next_value FROM u
      WINDOW b AS (PARTITION BY user_id ORDER BY ts, side, event_id, value, view_id, view_value ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
             f AS (PARTITION BY user_id ORDER BY ts, side, event_id, value, view_id, view_value ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
SELECT ts, user_id, event_id, value, coalesce(back_id, next_id) AS view_id, coalesce(back_value, next_value) AS view_value FROM w WHERE side = 0
""")
def q75(spark, d):
    """What a user viewed at most three rows before a purchase, else up to two rows
    after it, with each user's series split by day."""
    from tessera.operators.timeseries import TimeSeries
    ev = table(spark, d, "events")
    bought = ev.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    seen = ev.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("view_value"))
    return TimeSeries(bought, "ts", ("user_id",)).lookup_when(TimeSeries(seen, "ts", ("user_id",)), lookback_rows=3, lookahead_rows=2, slice_size=DAY_S)


@query("q76_file_intake", """
SELECT 'good' AS kind, CAST(event_id AS VARCHAR) AS id, 1 AS n, event_type AS "Event", 'ctx' || (user_id % 3) AS "SparkContextId", 'k' || (user_id % 3) AS "clusterId" FROM events
UNION ALL SELECT 'bad', 'no json ' || event_id, 1, NULL, NULL, NULL FROM events WHERE event_id % 100 = 0
""")
def q76(spark, d):
    """Events written as log files in two portions; the intake after each reads the
    new files only, and a third one reads nothing. Broken lines are set apart."""
    from tessera.plans.medallion.bronze import land_spark_events
    e = table(spark, d, "events").select("event_id", "event_type", (F.col("user_id") % 3).cast("int").alias("c"))
    line = F.to_json(F.struct(F.col("event_id").alias("Event ID"), F.col("event_type").alias("Event"), F.struct(F.col("c").cast("string").alias("spark.c")).alias("Properties")))
    lines = e.select("event_id", "c", F.explode(F.when(F.col("event_id") % 100 == 0, F.array(line, F.concat(F.lit("no json "), F.col("event_id").cast("string")))).otherwise(F.array(line))).alias("value"))
    root, land, ckpt = (_folder(spark, x) for x in ("logs", "landed", "intake"))
    schema = T.StructType([T.StructField("Event ID", T.LongType()), T.StructField("Event", T.StringType()), T.StructField("Properties", T.StructType([T.StructField("spark.c", T.StringType())]))])
    parts = []
    for run in (0, 1, 2):
        for c in (0, 1, 2):  # three contexts, each with its folder; none is written in the last round
            if run < 2:
                lines.where((F.col("c") == c) & (F.col("event_id") % 2 == run)).select("value").write.mode("append").text(f"{root}/k{c}/eventlog/host/ctx{c}")
        good, bad = land_spark_events(spark, root, land, ckpt, f"run{run}", schema, "o", glob="part-*")
        name = {"Event", "SparkContextId", "clusterId"}
        parts.append(good.select(F.lit("good").alias("kind"), F.col("EventID").cast("string").alias("id"), *sorted(name)).unionByName(
            bad.select(F.lit("bad").alias("kind"), F.col("_corrupt_record").alias("id"), *[F.lit(None).cast("string").alias(c) for c in sorted(name)])))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind", "id", "Event", "SparkContextId", "clusterId").agg(F.count("*").cast("int").alias("n"))


@query("q77_audit_envelopes", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'jobs' ELSE 'clusters' END AS service, epoch_ms(date_trunc('second', ts)) AS "timestamp", 'u' || user_id AS email,
       CASE WHEN event_type = 'view' THEN event_id % 7 END AS job_id, CASE WHEN event_type <> 'view' THEN 'c' || (event_id % 5) END AS cluster_id,
       CASE WHEN event_type <> 'view' AND event_id % 2 = 0 THEN event_id % 3 END AS workers, CASE WHEN event_id % 4 = 0 THEN 500 ELSE 200 END AS status, 'o' || (event_id // 50 % 2) AS organization_id FROM events
""")
def q77(spark, d):
    """Envelopes of fifty records, whose identity, request and response are JSON texts;
    requests of two services have different fields."""
    from tessera.sources.files import audit_from_envelope
    e = table(spark, d, "events")
    i, view = F.col("event_id"), F.col("event_type") == "view"
    job = F.to_json(F.struct((i % 7).alias("job_id")))
    cluster = F.to_json(F.struct(F.concat(F.lit("c"), (i % 5).cast("string")).alias("cluster_id"), F.struct(F.when(i % 2 == 0, i % 3).alias("workers")).alias("size")))
    text = lambda **c: F.to_json(F.struct(*[v.alias(k) for k, v in c.items()]))
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), F.lit("1").alias("operationVersion"), text(email=F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("identity"),
                   F.struct(F.when(view, "jobs").otherwise("clusters").alias("serviceName"), i.alias("requestId"), F.when(view, job).otherwise(cluster).alias("requestParams"),
                            text(statusCode=F.when(i % 4 == 0, 500).otherwise(200)).alias("response")).alias("properties"))
    box = F.floor(i / 50)
    bodies = e.groupBy(box.alias("box")).agg(F.to_json(F.struct(F.collect_list(rec).alias("records"))).alias("body"))
    rows = audit_from_envelope(bodies.withColumn("organization_id", F.concat(F.lit("o"), (F.col("box") % 2).cast("string"))))
    return rows.select(F.col("requestId").alias("event_id"), F.col("serviceName").alias("service"), "timestamp", F.col("userIdentity.email").alias("email"), F.col("requestParams.job_id").alias("job_id"),
                       F.col("requestParams.cluster_id").alias("cluster_id"), F.col("requestParams.size.workers").alias("workers"), F.col("response.statusCode").alias("status"), "organization_id")


@query("q78_published_accounts", """
WITH a AS (SELECT event_id, user_id, ts, epoch_us(ts) // 1000 AS t, CASE WHEN event_id % 20 > 0 THEN 'u' || (user_id % 20) END AS name, CASE WHEN event_id % 7 = 6 THEN 'id' || event_id END AS own, event_type FROM events)
SELECT 'o' AS organization_id, t AS "mod_unixTimeMS", CAST(ts AS DATE) AS mod_date, CASE WHEN event_type = 'view' THEN 'add' ELSE 'updateUser' END AS action, 'e' || (event_id % 3) AS endpoint, 'a@b.c' AS modified_by, name AS user_name,
       CASE WHEN name IS NULL THEN own ELSE first_value(own IGNORE NULLS) OVER (PARTITION BY name ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS user_id,
       'g' || (user_id % 4) AS group_name, CAST(NULL AS VARCHAR) AS group_id, CAST(NULL AS VARCHAR) AS from_ip_address, CAST(NULL AS VARCHAR) AS user_agent, printf('%020d', event_id) AS request_id, CAST(NULL AS VARCHAR) AS response FROM a
""")
def q78(spark, d):
    """Account changes as published; rows without a user name keep their own id, and
    columns that this source lacks are nulls of their type."""
    from tessera.plans.medallion.published import publish_gold
    from tessera.plans.medallion.silver import account_mods
    i = F.col("event_id")
    text = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    audit = table(spark, d, "events").select(
        F.lit("o").alias("organization_id"), F.to_date("ts").alias("date"), C.epoch_ms("ts").alias("timestamp"), F.lit("accounts").alias("serviceName"),
        F.when(F.col("event_type") == "view", "add").otherwise("updateUser").alias("actionName"), F.format_string("%020d", i).alias("requestId"), F.struct(F.lit("a@b.c").alias("email")).alias("userIdentity"),
        F.struct(F.when(i % 20 > 0, text("u", F.col("user_id") % 20)).alias("targetUserName"), F.when(i % 7 == 6, text("id", i)).alias("targetUserId"), text("e", i % 3).alias("endpoint"),
                 text("g", F.col("user_id") % 4).alias("targetGroupName")).alias("requestParams"))
    return publish_gold(account_mods(audit, slice_ms=DAY_S * 1000.0), "account_mods")


@query("q79_published_tasks", """
WITH t AS (SELECT l_orderkey AS o, l_linenumber AS n, max(l_partkey) AS p, min(epoch_ms(l_shipdate)) AS s FROM lineitem GROUP BY ALL)
SELECT 'o' AS organization_id, 'x' || (o % 9) AS spark_context_id, o AS task_id, 0 AS task_attempt_id, n AS stage_id, 0 AS stage_attempt_id, 'c' AS cluster_id, 'e' || (p % 3) AS executor_id, 'h' AS host, s AS "unixTimeMS",
       CAST(make_timestamp(s * 1000) AS DATE) AS date, CASE WHEN o % 4 > 0 THEN 1000 + p END AS run_ms, CASE WHEN o % 4 > 0 THEN p END AS bytes, s + CASE WHEN o % 4 > 0 THEN 1000 + p ELSE 0 END AS last_seen,
       CASE WHEN o % 4 > 0 THEN 'ResultTask' END AS task_type, 'a/b/c' AS log_start, CASE WHEN o % 4 > 0 THEN 'a/b/c' END AS log_end FROM t
""")
def q79(spark, d):
    """Task starts and ends paired and published, with task info, type and the log
    files of both events; every fourth task is still open."""
    from tessera.plans.medallion.bronze import file_group
    from tessera.plans.medallion.published import publish_gold
    from tessera.plans.medallion.silver import spark_tasks
    t = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("long").alias("n")).agg(F.max("l_partkey").alias("p"), F.min(C.epoch_ms("l_shipdate")).alias("s"))
    ended, long = F.col("o") % 4 > 0, lambda x: F.lit(x).cast("long")

    def events(rows, name, finish, metrics, kind):
        info = F.struct(F.col("o").alias("TaskID"), long(0).alias("Attempt"), F.concat(F.lit("e"), (F.col("p") % 3).cast("string")).alias("ExecutorID"), F.lit("h").alias("Host"), F.col("s").alias("LaunchTime"), finish.cast("long").alias("FinishTime"))
        return rows.select(F.lit("o").alias("organization_id"), F.lit("c").alias("clusterId"), F.concat(F.lit("x"), (F.col("o") % 9).cast("string")).alias("SparkContextID"), F.lit(name).alias("Event"), F.col("n").alias("StageID"),
                           long(0).alias("StageAttemptID"), info.alias("TaskInfo"), F.struct(metrics.cast("long").alias("bytes")).alias("TaskMetrics"), F.lit("Success").alias("TaskEndReason"), kind.cast("string").alias("TaskType"),
                           F.lit("2024-01-01").cast("date").alias("fileCreateDate"), file_group(F.lit("a/b/c/d/e/f/log")).alias("filenameGroup"))
    none = F.lit(None)
    log = events(t, "SparkListenerTaskStart", none, none, none).unionByName(events(t.where(ended), "SparkListenerTaskEnd", F.col("s") + 1000 + F.col("p"), F.col("p"), F.lit("ResultTask")))
    out = publish_gold(spark_tasks(log, log, 0), "sparktask")
    return out.select("organization_id", "spark_context_id", "task_id", "task_attempt_id", "stage_id", "stage_attempt_id", "cluster_id", "executor_id", "host", "unixTimeMS", "date", F.col("task_runtime.runTimeMS").alias("run_ms"),
                      F.col("task_metrics.bytes").alias("bytes"), F.coalesce("task_info.FinishTime", "task_info.LaunchTime").alias("last_seen"), "task_type", F.col("event_log_start.byCluster").alias("log_start"), F.col("event_log_end.byCluster").alias("log_end"))


# ------------------------------------------------------------------ q80-q82 silver and gold over an audit log made of the test tables

def _jobs_audit(rows, fields):
    """Audit rows of the jobs service from (ts, id, action, user, result) and request fields."""
    request = F.struct(*[(F.col(f) if f in rows.columns else F.lit(None)).cast("string").alias(f) for f in fields])
    return rows.select(
        F.lit("o").alias("organization_id"), F.date_from_unix_date(F.floor(F.col("ts") / 86_400_000).cast("int")).alias("date"), F.col("ts").alias("timestamp"), F.lit("jobs").alias("serviceName"),
        F.col("action").alias("actionName"), F.col("id").alias("requestId"), request.alias("requestParams"), F.struct(F.col("user").alias("email")).alias("userIdentity"),
        F.struct(F.col("result"), F.lit(200).cast("long").alias("statusCode")).alias("response"))


@query("q80_job_runs", """
WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, max(l_partkey) AS p, max(l_suppkey) AS s FROM lineitem GROUP BY ALL),
r AS (SELECT o_orderkey AS o, o_custkey AS job, epoch_ms(o_orderdate) + o_orderkey AS t FROM orders)
SELECT r.o AS job_run_id, coalesce(1000000000 + r.o * 10 + l.n, r.o) AS run_id, 1000000000 + r.o * 10 + l.n AS task_run_id, r.job AS job_id, 't' || l.n AS task_key, CASE WHEN l.p % 4 <> 0 THEN 'k' || (l.p % 3) END AS task_type,
       'c' || (l.s % 7) AS cluster_id, 'manual' AS trigger_type, CASE WHEN l.p % 10 = 0 THEN 'Cancelled' WHEN l.p % 4 IN (1, 2) THEN 'Succeeded' WHEN l.p % 4 = 3 THEN 'Failed' END AS terminal,
       CASE WHEN l.p % 4 <> 0 OR l.p % 10 = 0 THEN greatest(CASE WHEN l.p % 4 <> 0 THEN 5000 * l.n + l.p END, CASE WHEN l.p % 10 = 0 THEN 7000 END) END AS run_ms,
       CASE WHEN l.p % 4 <> 0 OR l.p % 10 = 0 THEN greatest(CASE WHEN l.p % 4 <> 0 THEN 5000 * l.n + l.p END, CASE WHEN l.p % 10 = 0 THEN 7000 END) - 1000 * l.n END AS execution_ms
FROM r LEFT JOIN l ON l.o = r.o
""")
def q80(spark, d):
    """Orders are submitted runs (some reported twice), their lines the tasks, of which some
    never complete and some are cancelled; only completions report the task type."""
    from tessera.plans.medallion.silver_audit import job_runs
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("job"), (C.epoch_ms("o_orderdate") + F.col("o_orderkey")).alias("t"))
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n")).agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"))
    ev = o.join(li, "o")
    p, n, task = F.col("p"), F.col("n"), F.lit(1_000_000_000) + F.col("o") * 10 + F.col("n")  # no id of an order
    text = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    common = lambda ts, mark, action: (ts.alias("ts"), text(mark, F.col("o")).alias("id"), action.alias("action"), F.lit("u").alias("user"))
    run = F.to_json(F.struct(F.col("o").alias("run_id")))
    rows = o.select(*common(F.col("t"), "a", F.lit("runNow")), run.alias("result"), F.col("job").alias("job_id"))
    again = o.where("o % 5 = 0").select(*common(F.col("t") + 9, "b", F.lit("runNow")), run.alias("result"), (F.col("job") + 1).alias("job_id"))
    at = dict(runId=task, multitaskParentRunId=F.col("o"))
    starts = ev.select(*common(F.col("t") + 1000 * n, "c", F.lit("runStart")), *[c.alias(k) for k, c in at.items()], text("t", n).alias("taskKey"), text("c", F.col("s") % 7).alias("clusterId"))
    ends = ev.where("p % 4 <> 0").select(*common(F.col("t") + 5000 * n + p, "d", F.when(p % 4 < 3, "runSucceeded").otherwise("runFailed")), *[c.alias(k) for k, c in at.items()],
                                         F.when(p % 4 < 3, "Succeeded").otherwise("Failed").alias("jobTerminalState"), text("k", p % 3).alias("jobTaskType"))
    cancels = ev.where("p % 10 = 0").select(*common(F.col("t") + 7000, "e", F.lit("cancel")), task.alias("run_id"))
    for part in (again, starts, ends, cancels):
        rows = rows.unionByName(part, allowMissingColumns=True)
    runs = job_runs(_jobs_audit(rows, ("job_id", "runId", "run_id", "multitaskParentRunId", "taskKey", "clusterId", "jobTerminalState", "jobTaskType")))
    return runs.select("job_run_id", "run_id", "task_run_id", "job_id", "task_key", "task_type", "cluster_id", "trigger_type", F.col("terminalState").alias("terminal"),
                       F.col("TaskRunTime.runTimeMS").alias("run_ms"), F.col("TaskExecutionRunTime.runTimeMS").alias("execution_ms"))


@query("q81_job_settings", """
WITH e AS (SELECT event_id AS i, user_id % 60 AS job, epoch_us(ts) // 1000 AS t, 'u' || user_id AS who, CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'update' WHEN 'purchase' THEN 'reset' WHEN 'error' THEN 'delete' END AS act FROM events),
v AS (SELECT *, CASE WHEN act = 'create' THEN 'n' || (i % 9) WHEN act = 'update' AND i % 3 = 0 THEN 'm' || (i % 9) END AS name, CASE WHEN act IN ('update', 'reset') AND i % 4 <> 0 THEN i % 100 END AS timeout,
             act = 'update' AND i % 5 = 0 AS gone FROM e WHERE act IS NOT NULL)
SELECT i AS event_id, job AS job_id, t AS "timestamp", act AS "actionName", last_value(name IGNORE NULLS) OVER w AS job_name,
       CASE WHEN gone THEN NULL ELSE last_value(timeout IGNORE NULLS) OVER w END AS timeout_seconds,
       last_value(CASE WHEN act = 'create' THEN who END IGNORE NULLS) OVER w AS created_by, last_value(CASE WHEN act = 'create' THEN t END IGNORE NULLS) OVER w AS created_ts,
       coalesce(last_value(CASE WHEN act IN ('update', 'reset') THEN who END IGNORE NULLS) OVER w, last_value(CASE WHEN act = 'create' THEN who END IGNORE NULLS) OVER w) AS last_edited_by,
       CASE WHEN act = 'delete' THEN who END AS deleted_by, CASE WHEN act = 'delete' THEN t END AS deleted_ts
FROM v WINDOW w AS (PARTITION BY job ORDER BY t, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def q81(spark, d):
    """Settings of sixty jobs through creates, updates (some remove a field), resets and
    deletes; who made, edited and deleted them."""
    from tessera.plans.medallion.silver_audit import job_status
    i, kind = F.col("event_id"), F.col("event_type")
    action = F.when(kind == "signup", "create").when(kind == "click", "update").when(kind == "purchase", "reset").when(kind == "error", "delete")
    text = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    job = F.col("user_id") % 60
    settings = F.to_json(F.struct(F.when((action == "update") & (i % 3 == 0), text("m", i % 9)).alias("name"), F.when(action.isin("update", "reset") & (i % 4 != 0), i % 100).alias("timeout_seconds")))
    rows = table(spark, d, "events").select(
        C.epoch_ms("ts").alias("ts"), F.format_string("%020d", i).alias("id"), action.alias("action"), text("u", F.col("user_id")).alias("user"), F.when(action == "create", F.to_json(F.struct(job.alias("job_id")))).alias("result"),
        F.when(action != "create", job).alias("job_id"), F.when(action == "create", text("n", i % 9)).alias("name"), F.when(action.isin("update", "reset"), settings).alias("new_settings"),
        F.when((action == "update") & (i % 5 == 0), F.lit('["timeout_seconds","other"]')).alias("fields_to_remove")).where("action IS NOT NULL")
    st = job_status(_jobs_audit(rows, ("job_id", "name", "new_settings", "fields_to_remove")), slice_ms=DAY_S * 1000.0)
    return st.select(F.col("requestId").cast("long").alias("event_id"), "job_id", "timestamp", "actionName", "job_name", "timeout_seconds", "created_by", "created_ts", "last_edited_by", "deleted_by", "deleted_ts")


@query("q82_streaming_queries", """
WITH e AS (SELECT event_id AS i, 's' || (user_id % 5) AS sid, 'r' || (user_id % 2) AS rid, epoch_us(ts) // 1000 AS t, event_type,
                  CASE WHEN event_type = 'signup' THEN -1 ELSE event_id % 300 END AS batch, CASE WHEN event_type = 'signup' OR event_id % 10 = 0 THEN 'n' || (event_id % 4) END AS name FROM events WHERE event_type <> 'error'),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid, rid, batch ORDER BY t DESC) AS rn FROM e) WHERE rn = 1),
x AS (SELECT 's' || (event_id % 5) AS sid, 'r' || (event_id % 2) AS rid, user_id % 300 AS batch, list_sort(list(DISTINCT event_id % 50)) AS ids FROM events GROUP BY ALL)
SELECT k.sid AS stream_id, k.rid AS stream_run_id, k.batch AS stream_batch_id, CASE WHEN event_type = 'signup' THEN 'Started' ELSE 'Progressed' END AS stream_segment, t AS stream_timestamp, CASE WHEN event_type <> 'signup' THEN i END AS num_input_rows,
       last_value(name IGNORE NULLS) OVER (PARTITION BY k.sid, k.rid ORDER BY t, k.batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_name, coalesce(array_to_string(x.ids, ','), '') AS executions
FROM k LEFT JOIN x ON x.sid = k.sid AND x.rid = k.rid AND x.batch = k.batch
""")
def q82(spark, d):
    """Streaming-query events, the newest of each batch, names filled forward, and the
    SQL executions whose description names the batch."""
    from tessera.plans.medallion.gold import STREAM_EVENT_PREFIX, spark_stream_gold
    i, kind = F.col("event_id"), F.col("event_type")
    text = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    ev = table(spark, d, "events")
    name = F.when((kind == "signup") | (i % 10 == 0), text("n", i % 4))
    sid, rid = text("s", F.col("user_id") % 5), text("r", F.col("user_id") % 2)
    progress = F.to_json(F.struct(sid.alias("id"), rid.alias("runId"), name.alias("name"), (i % 300).alias("batchId"), i.alias("numInputRows")))
    where = [F.lit(x).alias(k) for k, x in (("organization_id", "o"), ("clusterId", "c"), ("SparkContextID", "x"))]
    segment = F.when(kind == "signup", "Started").when(kind == "error", "Terminated").otherwise("Progress")
    log = ev.select(*where, F.concat(F.lit(STREAM_EVENT_PREFIX), segment, F.lit("Event")).alias("Event"), F.when(kind != "signup", progress).alias("progress"), C.epoch_ms("ts").alias("Timestamp"),
                    F.when(kind == "signup", sid).alias("id"), F.when(kind == "signup", rid).alias("runId"), F.when(kind == "signup", name).alias("name"))
    executions = ev.select(*where, (i % 50).alias("executionId"), F.concat(F.lit("x id = "), text("s", i % 5), F.lit(" runId = "), text("r", i % 2), F.lit(" batch = "), (F.col("user_id") % 300).cast("string")).alias("description"))
    got = spark_stream_gold(log, executions, slice_ms=DAY_S * 1000.0)
    ids = F.array_join(F.transform(F.coalesce("execution_ids", F.array().cast("array<long>")), lambda x: x.cast("string")), ",")
    return got.select("stream_id", "stream_run_id", "stream_batch_id", "stream_segment", "stream_timestamp", "num_input_rows", "stream_name", ids.alias("executions"))
