"""Driver query catalogue: each entry builds one operator's plan over the test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB SQL over
the same tables) return the same columns, names and rows. Every query reads whole
tables; the only limit is the top-k report's own ``LIMIT``.

Index (query -> SURVEY ids): q01 J1 (sliced) · q02 F2 · q03 J1 look-ahead · q04 J3 ·
q05 J4 (skew-safe) · q06 J5 · q07 J6 · q08 W1 · q09 W3 · q10 W4 · q11 W8 · q12 W2 ·
q13 J7 · q14 A6/J8 · q15 W11 · q16 W11 sessions · q17 W12 · q18 A1 · q19 G4 core/W14 ·
q20 P11 · q21 P10 · q22 P2 · q23 P13 · q24 Q1 · q25 Q2/W13 · q26 Q3 · q27 Q4 · q28 Q5/J12 ·
q29 Q7 · q30 I1 · q31 K3 · q32 S4 · q33 O1/A8 · q34 U2 · q35 W17 · q36 A5 · q37 S2/F15 ·
q38 F13 · q39 I5 · q40 K16 · q41 W7 · q42 W2 ties · q43 A2 · q44 W15 · q45 G4 ·
q46 V10 (W10+W11) · q47 G3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import epoch_ms, epoch_us, runtime_struct
from tessera.functions.cost import cost_summary
from tessera.operators import joins as J
from tessera.operators import quality as Q
from tessera.operators import schema as S
from tessera.operators import windows as W
from tessera.operators.incremental import incremental_filters
from tessera.operators.scd import scd2_apply, scd2_validate
from tessera.operators.tables import new_files, unpivot_prices, upsert_frame
from tessera.operators.timeseries import TimeSeries
from tessera.session import cut_lineage

def _sround(expr: str, places: int) -> str:
    """DuckDB SQL for Spark's ``round`` on a double: HALF_UP on the value's shortest
    decimal text (DuckDB's own ``round`` works on the binary value, so exact ties such
    as ``...2812375`` would round the other way)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

DAY_S = 86400


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events_day_bucket(col: str = "ts"):
    return F.floor(epoch_us(col) / F.lit(DAY_S * 1_000_000)).cast("long")


# ------------------------------------------------------------------ q01-q04 as-of

def _asof_sides(spark, d):
    ev = table(spark, d, "events")
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    v = ev.filter(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("view_event_id"), F.col("ts").alias("view_ts"),
        F.col("value").alias("view_value"))
    return TimeSeries(p, "ts", ("user_id",)), TimeSeries(v, "ts", ("user_id",))


_Q01_SQL = """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, event_id AS view_event_id, ts AS view_ts, value AS view_value
      FROM events WHERE event_type = 'view')
SELECT p.ts, p.user_id, p.event_id, p.value, v.view_event_id, v.view_ts, v.view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts > v.ts
"""


@query("q01_asof_lookup", _Q01_SQL)
def q01(spark, d):
    # weekly time slices: a user with a third of all events is still split over tasks
    p, v = _asof_sides(spark, d)
    return p.lookup_when(v, slice_size=7 * DAY_S)


@query("q02_runtime_struct", """
WITH l AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o.o_orderkey, epoch_ms(o.o_orderdate) AS s, epoch_ms(l.last_ship) AS e
      FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey)
SELECT o_orderkey, s AS start_epoch_ms,
       make_timestamp(CAST(floor(s / 1000) AS BIGINT) * 1000000) AS start_ts,
       e AS end_epoch_ms,
       make_timestamp(CAST(floor(e / 1000) AS BIGINT) * 1000000) AS end_ts,
       e - s AS run_time_ms, (e - s) / 1000 AS run_time_s, (e - s) / 1000 / 60 AS run_time_m,
       (e - s) / 1000 / 60 / 60 AS run_time_h
FROM b
""")
def q02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = o.join(last, o.o_orderkey == last.l_orderkey, "left")
    rt = runtime_struct(epoch_ms("o_orderdate"), epoch_ms("last_ship"), ntz=True)
    return j.select("o_orderkey", rt.alias("rt")).select(
        "o_orderkey",
        F.col("rt.startEpochMS").alias("start_epoch_ms"), F.col("rt.startTS").alias("start_ts"),
        F.col("rt.endEpochMS").alias("end_epoch_ms"), F.col("rt.endTS").alias("end_ts"),
        F.col("rt.runTimeMS").alias("run_time_ms"), F.col("rt.runTimeS").alias("run_time_s"),
        F.col("rt.runTimeM").alias("run_time_m"), F.col("rt.runTimeH").alias("run_time_h"))


@query("q03_asof_lookahead", """
WITH u AS (
  SELECT user_id, ts, event_id, value, CAST(NULL AS BIGINT) AS view_event_id,
         CAST(NULL AS TIMESTAMP) AS view_ts, CAST(NULL AS DOUBLE) AS view_value, 0 AS side
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT user_id, ts, NULL, NULL, event_id, ts, value, 1 FROM events WHERE event_type = 'view'),
f AS (
  SELECT *,
    coalesce(last_value(view_event_id IGNORE NULLS) OVER wb, first_value(view_event_id IGNORE NULLS) OVER wa) AS f_id,
    coalesce(last_value(view_ts IGNORE NULLS) OVER wb, first_value(view_ts IGNORE NULLS) OVER wa) AS f_ts,
    coalesce(last_value(view_value IGNORE NULLS) OVER wb, first_value(view_value IGNORE NULLS) OVER wa) AS f_value
  FROM u
  WINDOW wb AS (PARTITION BY user_id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wa AS (PARTITION BY user_id ORDER BY ts, side ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING))
SELECT ts, user_id, event_id, value, f_id AS view_event_id, f_ts AS view_ts, f_value AS view_value
FROM f WHERE side = 0
""")
def q03(spark, d):
    p, v = _asof_sides(spark, d)
    return p.lookup_when(v, lookahead_rows=1, slice_size=DAY_S)


@query("q04_asof_sliced", _Q01_SQL)
def q04(spark, d):
    p, v = _asof_sides(spark, d)
    return p.lookup_when(v, slice_size=DAY_S)


# ------------------------------------------------------------------ q05-q07 joins

@query("q05_join_with_lag", """
SELECT o.o_orderkey AS orderkey, CAST(o.o_orderdate AS DATE) AS event_date, o.o_custkey, o.o_totalprice,
       l.l_linenumber, l.l_quantity, l.l_shipdate
FROM orders o LEFT JOIN lineitem l
  ON o.o_orderkey = l.l_orderkey AND CAST(o.o_orderdate AS DATE) >= CAST(l.l_shipdate AS DATE) - 30
""")
def q05(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"),
                                         F.col("o_orderdate").cast("date").alias("event_date"),
                                         "o_custkey", "o_totalprice")
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"),
                                           F.col("l_shipdate").cast("date").alias("event_date"),
                                           "l_linenumber", "l_quantity", "l_shipdate")
    # skew-safe outer form: inner join (AQE splits hot keys on both sides) + orders with
    # no partner found from one row per key of lineitem
    return J.join_with_lag(o, l, ["orderkey"], "event_date", lagging_side="left", lag_days=30, how="left",
                           skew_safe=True)


@query("q06_prev_day_join", """
SELECT p.event_id, p.user_id, p.ts, count(v.event_id) AS n_views
FROM events p LEFT JOIN events v
  ON v.user_id = p.user_id AND v.event_type = 'view'
 AND (CAST(v.ts AS DATE) = CAST(p.ts AS DATE) OR CAST(v.ts AS DATE) = CAST(p.ts AS DATE) - 1)
WHERE p.event_type = 'purchase'
GROUP BY p.event_id, p.user_id, p.ts
""")
def q06(spark, d):
    ev = table(spark, d, "events")
    # views pre-aggregated per (user, day); J5's "same or previous day" as an equi-join:
    # a view day d serves purchase days d and d+1
    vd = (ev.filter(F.col("event_type") == "view")
            .groupBy("user_id", F.col("ts").cast("date").alias("vday")).agg(F.count(F.lit(1)).alias("n")))
    per_day = J.previous_day_expand(vd, "vday", "pday").groupBy("user_id", "pday").agg(
        F.sum("n").alias("n_views"))
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts",
                                                            F.col("ts").cast("date").alias("pday"))
    return (p.join(per_day, ["user_id", "pday"], "left")
             .select("event_id", "user_id", "ts", F.coalesce("n_views", F.lit(0)).cast("long").alias("n_views")))


@query("q07_interval_join", """
WITH oc AS (SELECT o.o_orderkey, c.c_mktsegment, CAST(o.o_orderdate AS DATE) AS o_date,
                   year(o.o_orderdate) AS yr, c.c_acctbal
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
per AS (SELECT c_mktsegment AS seg, yr, max(c_acctbal) AS rate FROM oc GROUP BY 1, 2),
dim AS (SELECT upper(seg) || ' ' AS seg, make_date(yr, 1, 1) AS active_from,
               CASE WHEN yr = max(yr) OVER (PARTITION BY seg) THEN NULL ELSE make_date(yr, 12, 31) END AS active_until,
               rate FROM per)
SELECT oc.o_orderkey, oc.c_mktsegment, oc.o_date, d.active_from, d.active_until, d.rate
FROM oc LEFT JOIN dim d
  ON trim(lower(d.seg)) = trim(lower(oc.c_mktsegment))
 AND oc.o_date >= d.active_from AND oc.o_date <= coalesce(d.active_until, DATE '2002-01-01')
""")
def q07(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    oc = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_mktsegment", F.col("o_orderdate").cast("date").alias("o_date"),
        F.year("o_orderdate").alias("yr"), "c_acctbal")
    per = oc.groupBy("c_mktsegment", "yr").agg(F.max("c_acctbal").alias("rate"))
    last = per.groupBy("c_mktsegment").agg(F.max("yr").alias("__last"))
    dim = per.join(last, "c_mktsegment").select(
        F.concat(F.upper("c_mktsegment"), F.lit(" ")).alias("c_mktsegment"),
        F.make_date("yr", F.lit(1), F.lit(1)).alias("active_from"),
        F.when(F.col("yr") == F.col("__last"), F.lit(None).cast("date"))
         .otherwise(F.make_date("yr", F.lit(12), F.lit(31))).alias("active_until"), "rate")
    out = J.interval_join(oc.drop("yr", "c_acctbal"), dim, ["c_mktsegment"], "o_date", "active_from",
                          "active_until", open_until=F.lit("2002-01-01").cast("date"), how="left")
    return out.select("o_orderkey", "c_mktsegment", "o_date", "active_from", "active_until", "rate")


# ------------------------------------------------------------------ q08-q12 windows

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]


@query("q08_dedup_by_key", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LI_ORDER)}) AS rn
      FROM lineitem) WHERE rn = 1
""")
def q08(spark, d):
    return W.dedup_by_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _blanked_events(spark, d):
    return table(spark, d, "events").select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


_BLANK_SQL = """SELECT event_id, user_id, ts, event_type,
                CASE WHEN event_type <> 'error' THEN value END AS value FROM events"""


@query("q09_fill_forward", f"""
WITH e AS ({_BLANK_SQL})
SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_value
FROM e
""")
def q09(spark, d):
    e = _blanked_events(spark, d).withColumn("filled_value", F.col("value"))
    return W.fill_forward(e, ["filled_value"], ["user_id"], ["ts", "event_id"], bucket=_events_day_bucket())


@query("q10_fill_meta", f"""
WITH e AS ({_BLANK_SQL})
SELECT *, coalesce(value,
   last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled_value
FROM e
""")
def q10(spark, d):
    e = _blanked_events(spark, d).withColumn("filled_value", F.col("value"))
    return W.fill_meta(e, ["filled_value"], ["user_id"], ["ts", "event_id"], bucket=_events_day_bucket())


@query("q11_future_fill", """
SELECT event_id, user_id, ts, event_type,
  first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS next_purchase_value
FROM events
""")
def q11(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("next_purchase_value"))
    return W.future_fill(e, ["next_purchase_value"], ["user_id"], ["ts", "event_id"], bucket=_events_day_bucket())


@query("q12_latest_snapshot", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def q12(spark, d):
    return W.latest_by_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ------------------------------------------------------------------ q13-q14 range joins

def _runs(spark, d):
    o = table(spark, d, "orders")
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    return o.join(last, o.o_orderkey == last.l_orderkey).select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("run_start"),
        F.greatest("o_orderdate", "last_ship").alias("run_end"), "o_orderdate")


_RUNS_SQL = """
ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
runs AS (SELECT o.o_custkey, o.o_orderkey, o.o_orderdate AS run_start,
                greatest(o.o_orderdate, ls.last_ship) AS run_end, o.o_orderdate
         FROM orders o JOIN ls ON o.o_orderkey = ls.l_orderkey)"""


@query("q13_containment_join", f"""
WITH {_RUNS_SQL},
states AS (SELECT o.o_custkey, least(o.o_orderdate, l.l_shipdate) AS state_start,
                  greatest(o.o_orderdate, l.l_shipdate) AS state_end, l.l_quantity
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT r.o_orderkey, count(*) AS n_inside, sum(s.l_quantity) AS qty_inside
FROM runs r JOIN states s
  ON r.o_custkey = s.o_custkey AND s.state_start > r.run_start AND s.state_end < r.run_end
GROUP BY r.o_orderkey
""")
def q13(spark, d):
    runs = _runs(spark, d).drop("o_orderdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    states = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "o_custkey", F.least("o_orderdate", "l_shipdate").alias("state_start"),
        F.greatest("o_orderdate", "l_shipdate").alias("state_end"), "l_quantity")
    pairs = J.containment_join(runs, states, ["o_custkey"], "run_start", "run_end", "state_start", "state_end",
                               bucket="month")
    return pairs.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_inside"),
                                           F.sum("l_quantity").alias("qty_inside"))


_OVL_SQL = f"""
WITH {_RUNS_SQL},
r AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderkey,
             epoch_ms(make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)) AS state_start,
             epoch_ms(make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0)) - 1 AS state_end,
             epoch_ms(run_start) AS s,
             least(epoch_ms(run_end), epoch_ms(make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0)) - 1) AS e
      FROM runs),
ex AS (SELECT a.o_orderkey, CAST(sum(greatest(0, least(a.e, b.e) - greatest(a.s, b.s))) AS BIGINT) AS cum_runtime_exact,
              count(*) FILTER (WHERE b.o_orderkey <> a.o_orderkey AND b.s < a.e AND b.e > a.s) AS overlapping_runs_exact
       FROM r a JOIN r b ON a.o_custkey = b.o_custkey AND a.yr = b.yr GROUP BY a.o_orderkey),
rf AS (SELECT o.o_orderkey,
              CAST(sum(CASE WHEN l.s < o.s AND l.e > o.s AND l.e < o.e THEN l.e - o.state_start
                            WHEN l.s > o.s AND l.s < o.e AND l.e > o.e THEN l.state_end - o.s
                            ELSE l.e - o.s END) AS BIGINT) AS cum_runtime_ref,
              count(*) - 1 AS overlapping_runs_ref
       FROM r o JOIN r l ON o.o_custkey = l.o_custkey AND o.yr = l.yr
        AND ((l.s < o.s AND l.e > o.s AND l.e < o.e)
          OR (l.s > o.s AND l.s < o.e AND l.e > o.e)
          OR (l.s BETWEEN o.s AND o.e AND l.e BETWEEN o.s AND o.e))
       GROUP BY o.o_orderkey)
SELECT r.o_orderkey, r.o_custkey, r.yr, r.e - r.s AS run_ms, ex.cum_runtime_exact, ex.overlapping_runs_exact,
       rf.cum_runtime_ref, rf.overlapping_runs_ref
FROM r JOIN ex ON r.o_orderkey = ex.o_orderkey JOIN rf ON r.o_orderkey = rf.o_orderkey
"""


def _overlap_runs(spark, d):
    # the run table feeds three branches (exact sweep, reference join, output): cut it
    # once into the shared checkpoint folder so lineitem is aggregated a single time
    runs = cut_lineage(_runs(spark, d))
    yr = F.year("o_orderdate")
    start_of = lambda y: epoch_ms(F.make_timestamp_ntz(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    return runs.select(
        "o_custkey", yr.alias("yr"), "o_orderkey",
        start_of(yr).alias("state_start"), (start_of(yr + 1) - 1).alias("state_end"),
        epoch_ms("run_start").alias("s"),
        F.least(epoch_ms("run_end"), start_of(yr + 1) - 1).alias("e"))


@query("q14_overlap_share", _OVL_SQL)
def q14(spark, d):
    r = _overlap_runs(spark, d)
    ex = J.overlap_runtime_exact(r, ["o_custkey", "yr"], "o_orderkey", "s", "e",
                                 bucket_width=30 * DAY_S * 1000.0).select(
        "o_orderkey", F.col("cum_runtime").alias("cum_runtime_exact"),
        F.col("overlapping_runs").alias("overlapping_runs_exact"))
    rf = J.overlap_runtime_reference(r, ["o_custkey", "yr"], "o_orderkey", "s", "e", "state_start", "state_end",
                                     bucket=30 * DAY_S * 1000.0).select(
        "o_orderkey", F.col("cum_runtime").cast("long").alias("cum_runtime_ref"),
        F.col("overlapping_runs").cast("long").alias("overlapping_runs_ref"))
    return (r.select("o_orderkey", "o_custkey", "yr", (F.col("e") - F.col("s")).alias("run_ms"))
             .join(ex, "o_orderkey").join(rf, "o_orderkey"))


# ------------------------------------------------------------------ q15-q17

_UNTIL = "2024-02-01 00:00:00"


def _state_frame(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    ev = ev.withColumn("__reset", (F.col("event_type") == "signup").cast("long"))
    # one skew-safe pass: the next start (lead) and the session number (running sum of
    # resets); state end = next start - 1 ms, open end = the until time
    nxt = W.lookaround(ev, ["user_id"], ["ts", "event_id"], _events_day_bucket(), next_row=["ts"], cumsum=["__reset"])
    end = F.coalesce(F.timestamp_add("MILLISECOND", F.lit(-1), F.col("ts__nx")),
                     F.lit(_UNTIL).cast("timestamp_ntz"))
    return (nxt.withColumn("state_end", end).withColumnRenamed("__reset__cs", "session_id")
               .drop("ts__nx", "__reset"))


@query("q15_state_durations", f"""
WITH s AS (SELECT event_id, user_id, ts,
             coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - INTERVAL 1 MILLISECOND,
                      TIMESTAMP '{_UNTIL}') AS state_end FROM events)
SELECT event_id, user_id, ts, state_end,
       date_diff('microsecond', ts, state_end) / 1000000.0 AS uptime_s,
       date_diff('microsecond', ts, state_end) / 3600000000.0 AS uptime_h,
       date_diff('day', CAST(ts AS DATE), CAST(state_end AS DATE)) + 1 AS days_in_state
FROM s
""")
def q15(spark, d):
    s = _state_frame(spark, d).drop("session_id")
    us = F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("state_end"))
    return s.select("event_id", "user_id", "ts", "state_end",
                    (us / F.lit(1_000_000.0)).alias("uptime_s"), (us / F.lit(3_600_000_000.0)).alias("uptime_h"),
                    (F.datediff(F.col("state_end").cast("date"), F.col("ts").cast("date")) + 1).cast("long")
                    .alias("days_in_state"))


@query("q16_reset_sessions", f"""
WITH s AS (SELECT event_id, user_id, ts, event_type,
             coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - INTERVAL 1 MILLISECOND,
                      TIMESTAMP '{_UNTIL}') AS state_end FROM events),
k AS (SELECT *, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS reset,
             date_diff('microsecond', ts, state_end) AS dur_us FROM s),
p AS (SELECT *, CAST(sum(reset) OVER (PARTITION BY user_id ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id FROM k)
SELECT event_id, user_id, ts, session_id, dur_us / 1000000.0 AS uptime_in_state_s,
       CASE WHEN reset = 1 THEN 0.0 ELSE
         CAST(sum(dur_us) OVER (PARTITION BY user_id, session_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) / 1000000.0 END AS uptime_since_reset_s
FROM p
""")
def q16(spark, d):
    s = _state_frame(spark, d).withColumn("dur_us", F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("state_end")))
    r = W.reset_sessions(s, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.col("dur_us"),
                         out_uptime="__up_us", bucket=_events_day_bucket(), session_col="session_id")
    return r.select("event_id", "user_id", "ts", F.col("session_id").cast("long").alias("session_id"),
                    (F.col("dur_us") / F.lit(1_000_000.0)).alias("uptime_in_state_s"),
                    (F.col("__up_us") / F.lit(1_000_000.0)).alias("uptime_since_reset_s"))


@query("q17_group_impute", """
WITH c AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN n_name END AS n_name
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
l0 AS (SELECT c_nationkey, c_mktsegment, arg_min(n_name, c_custkey) AS v FROM c WHERE n_name IS NOT NULL GROUP BY 1, 2),
l1 AS (SELECT c_nationkey, arg_min(n_name, c_custkey) AS v FROM c WHERE n_name IS NOT NULL GROUP BY 1),
l2 AS (SELECT c_mktsegment, arg_min(n_name, c_custkey) AS v FROM c WHERE n_name IS NOT NULL GROUP BY 1)
SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, c.n_name, coalesce(c.n_name, l0.v, l1.v, l2.v) AS n_name_imputed
FROM c LEFT JOIN l0 ON c.c_nationkey = l0.c_nationkey AND c.c_mktsegment = l0.c_mktsegment
       LEFT JOIN l1 ON c.c_nationkey = l1.c_nationkey
       LEFT JOIN l2 ON c.c_mktsegment = l2.c_mktsegment
""")
def q17(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    base = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("n_name"))
    out = W.impute_by_group_chain(base, "n_name", [["c_nationkey", "c_mktsegment"], ["c_nationkey"], ["c_mktsegment"]],
                                  "c_custkey", out="n_name_imputed")
    return out.select("c_custkey", "c_nationkey", "c_mktsegment", "n_name", "n_name_imputed")


# ------------------------------------------------------------------ q18-q19 costs (A1, G4 core)

@query("q18_cost_summary", f"""
SELECT l_returnflag, l_linestatus,
       greatest({_sround("sum(l_extendedprice * (1 - l_discount))", 2)}, 0) AS l_extendedprice,
       greatest({_sround("sum(l_quantity * (1 - l_discount))", 2)}, 0) AS l_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q18(spark, d):
    return cost_summary(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"],
                        ["l_returnflag", "l_linestatus"], 2, smoother=1 - F.col("l_discount"))


_Q19_SQL = f"""
WITH {_RUNS_SQL},
r AS (SELECT o.o_orderkey, o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS yr, o.o_totalprice,
             date_diff('day', CAST(runs.run_start AS DATE), CAST(runs.run_end AS DATE)) + 1 AS run_days
      FROM orders o JOIN runs ON o.o_orderkey = runs.o_orderkey),
t AS (SELECT o_custkey, yr, {_sround("sum(o_totalprice)", 2)} AS state_cost, sum(run_days) AS total_days
      FROM r GROUP BY 1, 2)
SELECT r.o_orderkey, r.o_custkey, r.yr, r.run_days, t.state_cost,
       CAST(r.run_days AS DOUBLE) / t.total_days AS run_share,
       {_sround("t.state_cost * CAST(r.run_days AS DOUBLE) / t.total_days", 6)} AS cost_share
FROM r JOIN t ON r.o_custkey = t.o_custkey AND r.yr = t.yr
"""


def cost_share_fact(spark: SparkSession, d: str) -> DataFrame:
    """G4 core: each order (run) gets the share of its customer-year (state) cost that
    its run days represent; the shares of a state sum to the state cost."""
    runs = _runs(spark, d)
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    r = runs.join(o, "o_orderkey").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), "o_totalprice",
        (F.datediff(F.col("run_end").cast("date"), F.col("run_start").cast("date")) + 1).cast("long").alias("run_days"))
    t = r.groupBy("o_custkey", "yr").agg(F.round(F.sum("o_totalprice"), 2).alias("state_cost"),
                                         F.sum("run_days").alias("total_days"))
    j = r.join(t, ["o_custkey", "yr"])
    return j.select("o_orderkey", "o_custkey", "yr", "run_days", "state_cost",
                    (F.col("run_days").cast("double") / F.col("total_days")).alias("run_share"),
                    F.round(F.col("state_cost") * F.col("run_days").cast("double") / F.col("total_days"), 6)
                    .alias("cost_share"))


QUERIES["q19_cost_share_fact"] = cost_share_fact
ORACLE_SQL["q19_cost_share_fact"] = _Q19_SQL.strip()


# ------------------------------------------------------------------ q20-q23 schema

@query("q20_struct_from_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events
""")
def q20(spark, d):
    ev = table(spark, d, "events").select("event_id", "props")
    return S.struct_from_json(ev, "props").select("event_id", F.col("props.k").alias("props_k"))


@query("q21_struct_to_map", """
SELECT c_custkey, 'c_name' AS key, c_name AS value FROM customer WHERE c_name IS NOT NULL
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL
UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey IS NOT NULL
UNION ALL SELECT c_custkey, 'balance_flag', 'negative' FROM customer WHERE c_acctbal < 0
""")
def q21(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.struct("c_name", "c_mktsegment", "c_nationkey",
                              F.when(F.col("c_acctbal") < 0, F.lit("negative")).alias("balance_flag")).alias("attrs"))
    m = c.select("c_custkey", S.struct_to_map(c, "attrs"))
    return m.select("c_custkey", F.explode("attrs").alias("key", "value"))


@query("q22_cull_null", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN c_name END AS c_note FROM customer
""")
def q22(spark, d):
    c = table(spark, d, "customer").withColumns({
        "c_comment": F.lit(None).cast("string"),
        "c_note": F.when(F.col("c_acctbal") < 0, F.col("c_name"))})
    return S.cull_null(c)


_Q23_REQ = T.StructType([
    T.StructField("l_orderkey", T.LongType(), False),
    T.StructField("l_linenumber", T.LongType(), True),
    T.StructField("l_comment", T.StringType(), True),
    T.StructField("l_shipdate", T.TimestampNTZType(), True),
])


@query("q23_verify_schema", """
SELECT CAST(NULL AS VARCHAR) AS l_comment, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate
FROM lineitem
""")
def q23(spark, d):
    return S.verify_minimum_schema(table(spark, d, "lineitem"), _Q23_REQ)


# ------------------------------------------------------------------ q24-q25 SCD-2 (Q1, Q2)

def _price_groups(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.max("c_acctbal").alias("mx"), F.min("c_acctbal").alias("mn"))


_SCD_SQL = """
g AS (SELECT c_nationkey, c_mktsegment, max(c_acctbal) AS mx, min(c_acctbal) AS mn FROM customer GROUP BY 1, 2),
dim AS (SELECT c_nationkey, c_mktsegment, mx AS contract_price, DATE '1995-01-01' AS active_from,
               CAST(NULL AS DATE) AS active_until, true AS is_active FROM g
        UNION ALL SELECT c_nationkey, c_mktsegment, mn, DATE '1990-01-01', DATE '1995-01-01', false FROM g),
np AS (SELECT c_nationkey, c_mktsegment,
              CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN mx + 100 ELSE mx END AS new_price FROM g)"""


@query("q24_scd2_apply", f"""
WITH {_SCD_SQL},
j AS (SELECT d.*, np.new_price FROM dim d JOIN np ON d.c_nationkey = np.c_nationkey AND d.c_mktsegment = np.c_mktsegment)
SELECT c_nationkey, c_mktsegment, contract_price, active_from, DATE '2001-01-01' AS active_until, false AS is_active
FROM j WHERE is_active AND new_price <> contract_price
UNION ALL
SELECT c_nationkey, c_mktsegment, new_price, DATE '2001-01-01', CAST(NULL AS DATE), true
FROM j WHERE is_active AND new_price <> contract_price
UNION ALL
SELECT c_nationkey, c_mktsegment, contract_price, active_from, active_until, is_active
FROM j WHERE NOT is_active OR new_price = contract_price
""")
def q24(spark, d):
    g = _price_groups(spark, d)
    dim = g.select("c_nationkey", "c_mktsegment", F.col("mx").alias("contract_price"),
                   F.lit("1995-01-01").cast("date").alias("active_from"), F.lit(None).cast("date").alias("active_until"),
                   F.lit(True).alias("is_active")).unionByName(
        g.select("c_nationkey", "c_mktsegment", F.col("mn").alias("contract_price"),
                 F.lit("1990-01-01").cast("date").alias("active_from"),
                 F.lit("1995-01-01").cast("date").alias("active_until"), F.lit(False).alias("is_active")))
    npx = g.select("c_nationkey", "c_mktsegment", F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
                                                         F.col("mx") + 100).otherwise(F.col("mx")).alias("contract_price"))
    return scd2_apply(dim, npx, ["c_nationkey", "c_mktsegment"], "contract_price", F.lit("2001-01-01").cast("date"))


_Q25_SQL = """
WITH yrs AS (SELECT DISTINCT c.c_mktsegment AS seg, year(o.o_orderdate) AS yr
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
mx AS (SELECT seg, max(yr) AS last_yr FROM yrs GROUP BY seg),
base AS (SELECT y.seg, make_date(y.yr, 1, 1) AS active_from,
                CASE WHEN y.yr = m.last_yr THEN NULL ELSE make_date(y.yr + 1, 1, 1) END AS active_until,
                (y.yr = m.last_yr OR (y.seg = 'MACHINERY' AND y.yr = m.last_yr - 3)) AS is_active
         FROM yrs y JOIN mx m ON y.seg = m.seg
         WHERE NOT (y.seg = 'BUILDING' AND y.yr = m.last_yr - 1)),
dmg AS (SELECT * FROM base UNION ALL
        SELECT * FROM base WHERE seg = 'HOUSEHOLD' AND active_until IS NULL),
d AS (SELECT lower(trim(seg)) AS seg, active_from, coalesce(active_until, DATE '2002-01-01') AS active_until, is_active
      FROM dmg),
w AS (SELECT *, lag(active_until) OVER (PARTITION BY seg ORDER BY active_from) AS previous_until,
             rank() OVER (PARTITION BY seg, active_from, active_until ORDER BY active_from, active_until) AS rnk,
             row_number() OVER (PARTITION BY seg, active_from, active_until ORDER BY active_from, active_until) AS rn,
             coalesce(max(CAST(is_active AS INTEGER)) OVER (PARTITION BY seg ORDER BY active_from
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS prior_active
      FROM d)
SELECT seg AS c_mktsegment, active_from, CAST(rnk AS BIGINT) AS rnk, CAST(rn AS BIGINT) AS rn, previous_until,
       date_diff('day', previous_until, active_from) AS days_between
FROM w
WHERE is_active AND (NOT (CASE WHEN previous_until IS NULL AND is_active THEN true
                               ELSE coalesce(active_from = previous_until AND prior_active = 0, false) END)
                     OR rnk > 1 OR rn > 1)
"""


@query("q25_scd2_validate", _Q25_SQL)
def q25(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    yrs = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_mktsegment").alias("seg"), F.year("o_orderdate").alias("yr")).distinct()
    mx = yrs.groupBy("seg").agg(F.max("yr").alias("last_yr"))
    base = yrs.join(mx, "seg").filter(~((F.col("seg") == "BUILDING") & (F.col("yr") == F.col("last_yr") - 1))).select(
        F.col("seg").alias("c_mktsegment"), F.make_date("yr", F.lit(1), F.lit(1)).alias("active_from"),
        F.when(F.col("yr") == F.col("last_yr"), F.lit(None).cast("date"))
         .otherwise(F.make_date(F.col("yr") + 1, F.lit(1), F.lit(1))).alias("active_until"),
        ((F.col("yr") == F.col("last_yr")) |
         ((F.col("seg") == "MACHINERY") & (F.col("yr") == F.col("last_yr") - 3))).alias("is_active"))
    dmg = base.unionByName(base.filter((F.col("c_mktsegment") == "HOUSEHOLD") & F.col("active_until").isNull()))
    return scd2_validate(dmg, ["c_mktsegment"], snap_date=F.lit("2002-01-01").cast("date"))


# ------------------------------------------------------------------ q26-q29 quality (Q3-Q5, Q7)

@query("q26_key_report", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(c) AS BIGINT) AS n_rows,
       count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) AS n_distinct_keys,
       CAST(coalesce(sum(c) FILTER (WHERE l_orderkey IS NULL), 0) AS BIGINT) AS null_l_orderkey,
       CAST(coalesce(sum(c) FILTER (WHERE l_linenumber IS NULL), 0) AS BIGINT) AS null_l_linenumber,
       CASE WHEN sum(c) = count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
             AND coalesce(sum(c) FILTER (WHERE l_orderkey IS NULL), 0) = 0
             AND coalesce(sum(c) FILTER (WHERE l_linenumber IS NULL), 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM k
""")
def q26(spark, d):
    return Q.key_report(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q27_dup_report", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2),
r AS (SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct_keys,
             count(*) FILTER (WHERE c > 1) AS n_keys_with_dups FROM k)
SELECT n_rows, n_distinct_keys, n_keys_with_dups, n_rows - n_distinct_keys AS n_dup_rows,
       100.0 * (n_rows - n_distinct_keys) / n_rows AS pct_dup_rows,
       100.0 * n_keys_with_dups / n_distinct_keys AS pct_keys_with_dups
FROM r
""")
def q27(spark, d):
    return Q.dup_report(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q28_compare", """
WITH a AS (SELECT o_orderdate, count(*) AS src_count FROM orders GROUP BY 1),
b AS (SELECT o_orderdate, count(*) AS tgt_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT coalesce(a.o_orderdate, b.o_orderdate) AS o_orderdate, coalesce(src_count, 0) AS src_count,
       coalesce(tgt_count, 0) AS tgt_count, coalesce(src_count, 0) - coalesce(tgt_count, 0) AS diff
FROM a FULL OUTER JOIN b ON a.o_orderdate = b.o_orderdate
""")
def q28(spark, d):
    o = table(spark, d, "orders")
    return Q.compare_datasets(o, o.filter(F.col("o_orderstatus") != "P"), ["o_orderdate"])


@query("q29_rules", """
SELECT 'discount_range' AS rule, count(*) FILTER (WHERE l_discount BETWEEN 0 AND 0.1) AS n_pass,
       count(*) - count(*) FILTER (WHERE l_discount BETWEEN 0 AND 0.1) AS n_fail FROM lineitem
UNION ALL SELECT 'price_non_negative', count(*) FILTER (WHERE l_extendedprice >= 0),
       count(*) - count(*) FILTER (WHERE l_extendedprice >= 0) FROM lineitem
UNION ALL SELECT 'quantity_range', count(*) FILTER (WHERE l_quantity BETWEEN 1 AND 50),
       count(*) - count(*) FILTER (WHERE l_quantity BETWEEN 1 AND 50) FROM lineitem
UNION ALL SELECT 'returnflag_allowed', count(*) FILTER (WHERE l_returnflag IN ('A', 'N', 'R')),
       count(*) - count(*) FILTER (WHERE l_returnflag IN ('A', 'N', 'R')) FROM lineitem
""")
def q29(spark, d):
    rules = [Q.bounds_rule("discount_range", "l_discount", 0, 0.1),
             Q.bounds_rule("price_non_negative", "l_extendedprice", 0, None),
             Q.bounds_rule("quantity_range", "l_quantity", 1, 50),
             Q.allowed_values_rule("returnflag_allowed", "l_returnflag", ["A", "N", "R"])]
    return Q.validate_rules(table(spark, d, "lineitem"), rules)


# ------------------------------------------------------------------ q30-q32 incremental / tables

@query("q30_incremental", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""")
def q30(spark, d):
    ev = table(spark, d, "events")
    return S.apply_filters(ev, incremental_filters(ev.schema, ["ts"], "2024-01-10 00:00:00",
                                                   "2024-01-20 00:00:00", lag_days=2))


_UPSERT_SRC = """
src AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT -o_orderkey - 1, o_custkey, 'O', o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)"""


@query("q31_upsert", f"""
WITH {_UPSERT_SRC}
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL SELECT * FROM src
""")
def q31(spark, d):
    o = table(spark, d, "orders")
    upd = o.filter(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("F"))
    new = (o.filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000))
            .withColumn("o_orderkey", -F.col("o_orderkey") - 1).withColumn("o_orderstatus", F.lit("O")))
    return upsert_frame(o, upd.unionByName(new), ["o_orderkey"])


@query("q32_new_files", """
WITH listing AS (SELECT url AS filename FROM pages),
tracker AS (SELECT url AS filename, (url LIKE '%.html') AS failed FROM pages
            WHERE url LIKE '%utm_source=%' OR url LIKE '%.html'),
bad AS (SELECT url AS filename FROM pages WHERE position('<body' IN html) = 0),
nf AS (SELECT filename FROM listing
       EXCEPT (SELECT filename FROM tracker WHERE NOT failed UNION SELECT filename FROM bad))
SELECT p.page_id, p.url AS filename, length(p.html) AS size FROM pages p JOIN nf ON p.url = nf.filename
""")
def q32(spark, d):
    pg = table(spark, d, "pages")
    listing = pg.select(F.col("url").alias("filename"), "page_id", F.length("html").cast("long").alias("size"))
    tracker = pg.filter(F.col("url").like("%utm_source=%") | F.col("url").like("%.html")).select(
        F.col("url").alias("filename"), F.col("url").like("%.html").alias("failed"))
    bad = pg.filter(F.instr("html", "<body") == 0).select(F.col("url").alias("filename"))
    return new_files(listing, tracker, bad).select("page_id", "filename", "size")


# ------------------------------------------------------------------ q33-q40

@query("q33_topk", """
SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id ORDER BY n_events DESC, user_id LIMIT 40
""")
def q33(spark, d):
    return J.top_keys(table(spark, d, "events"), ["user_id"], 40).withColumnRenamed("count", "n_events")


@query("q34_union_missing", """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'customer' AS party_type FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       'supplier' AS party_type FROM supplier
""")
def q34(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
        F.lit("customer").alias("party_type"))
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("party_type"))
    return S.union_missing_as_null(c, s)


@query("q35_batching", """
WITH r AS (SELECT doc_id, source, n_chars,
                  CAST(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_size
           FROM documents)
SELECT doc_id, source, n_chars, running_size, CAST(ceil(running_size / 50000.0) AS BIGINT) AS batch_id FROM r
""")
def q35(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return W.cumulative_batches(docs, "n_chars", 50_000, ["source"], ["doc_id"],
                                bucket=F.floor(F.col("doc_id") / F.lit(4096)).cast("long"))


@query("q36_nest_children", """
SELECT conv_id, count(*) AS n_turns, arg_min(text, turn) AS first_text, arg_max(role, turn) AS last_role
FROM conversations GROUP BY conv_id
""")
def q36(spark, d):
    from tessera.operators.aggregations import summarize_children
    return summarize_children(table(spark, d, "conversations"), ["conv_id"], "turn",
                              first={"first_text": "text"}, last={"last_role": "role"}, count_as="n_turns")


@query("q37_path_lineage", """
WITH s AS (SELECT page_id, string_split(url, '/') AS segs FROM pages)
SELECT page_id, segs[3] AS host, segs[4] AS first_segment,
       array_to_string(segs[1:3], '/') AS prefix3, array_to_string(segs[1:4], '/') AS prefix4,
       CAST(len(segs) AS BIGINT) AS n_segments
FROM s
""")
def q37(spark, d):
    from tessera.sources.files import path_lineage
    pg = table(spark, d, "pages").select("page_id", "url")
    return path_lineage(pg, "url", prefixes=(3, 4)).select(
        "page_id", F.col("segment_2").alias("host"), F.col("segment_3").alias("first_segment"),
        "prefix3", "prefix4", "n_segments")


@query("q38_token_extract", """
WITH t AS (SELECT event_id, string_split('id = ' || user_id || ' runId = ' || event_id ||
                  CASE WHEN event_type <> 'error' THEN ' batch = ' || event_type ELSE '' END, ' ') AS tk FROM events)
SELECT event_id,
       CASE WHEN list_position(tk, 'id') > 0 THEN tk[list_position(tk, 'id') + 2] END AS stream_id,
       CASE WHEN list_position(tk, 'runId') > 0 THEN tk[list_position(tk, 'runId') + 2] END AS stream_run_id,
       coalesce(CASE WHEN list_position(tk, 'batchId') > 0 THEN tk[list_position(tk, 'batchId') + 2] END,
                CASE WHEN list_position(tk, 'batch') > 0 THEN tk[list_position(tk, 'batch') + 2] END) AS stream_batch_id
FROM t
""")
def q38(spark, d):
    from tessera.functions.columns import stream_details
    ev = table(spark, d, "events")
    desc = F.concat(F.lit("id = "), F.col("user_id").cast("string"), F.lit(" runId = "), F.col("event_id").cast("string"),
                    F.when(F.col("event_type") != "error", F.concat(F.lit(" batch = "), F.col("event_type")))
                    .otherwise(F.lit("")))
    return ev.select("event_id", stream_details(F.split(desc, " ")).alias("s")).select(
        "event_id", "s.stream_id", "s.stream_run_id", "s.stream_batch_id")


@query("q39_active_ids", """
SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
UNION
SELECT user_id FROM (SELECT user_id, event_type,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type = 'view'
""")
def q39(spark, d):
    from tessera.operators.incremental import ids_with_new_activity
    ev = table(spark, d, "events")
    new_rows = S.apply_filters(ev, incremental_filters(ev.schema, ["ts"], "2024-01-29 00:00:00",
                                                       "2024-01-31 00:00:00"))
    return ids_with_new_activity(new_rows, ev, "user_id", ["ts", "event_id"], F.col("event_type") == "view")


@query("q40_unpivot", """
SELECT p_partkey, 'retail' AS sku, p_retailprice AS price FROM part
UNION ALL SELECT p_partkey, 'discounted', p_retailprice * 0.9 FROM part
""")
def q40(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("retail"),
                                       (F.col("p_retailprice") * 0.9).alias("discounted"))
    return unpivot_prices(p, ["p_partkey"], {"retail": "retail", "discounted": "discounted"}, value="price")


# ------------------------------------------------------------------ q41-q42 (W7, W2 with ties)

@query("q41_duplicate_rows", """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count FROM lineitem)
WHERE dup_count > 1
""")
def q41(spark, d):
    return W.duplicate_rows(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q42_latest_with_ties", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rk FROM orders) WHERE rk = 1
""")
def q42(spark, d):
    return W.latest_by_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"], keep_ties=True)


# ------------------------------------------------------------------ q43-q44

@query("q43_roll_metrics", f"""
SELECT l.l_orderkey, any_value(o.o_custkey) AS o_custkey, {_sround("avg(l.l_discount)", 6)} AS l_discount,
       max(l.l_quantity) AS l_quantity_max, greatest({_sround("sum(l.l_extendedprice)", 6)}, 0) AS l_extendedprice,
       count(*) AS state_rows
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY l.l_orderkey
""")
def q43(spark, d):
    from tessera.operators.aggregations import roll_metrics_to_run
    li = table(spark, d, "lineitem").select("l_orderkey", "l_discount", "l_quantity", "l_extendedprice")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey").withColumn("l_quantity_max", F.col("l_quantity"))
    return roll_metrics_to_run(j, ["l_orderkey"], firsts=["o_custkey"], avgs=["l_discount"], maxs=["l_quantity_max"],
                               sums=["l_extendedprice"], precision=6)


@query("q44_row_delta", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
       o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
         AS o_totalprice_delta
FROM orders
""")
def q44(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return W.row_delta(o, "o_totalprice", ["o_custkey"], ["o_orderdate", "o_orderkey"],
                       bucket=F.year("o_orderdate").cast("long"))


# ------------------------------------------------------------------ q45 job-run cost fact

_G4_UNTIL_MS = 1009843200000  # 2002-01-01, the "pipeline until time" of this query

_Q45_SQL = f"""
WITH ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
st0 AS (SELECT o_custkey AS cluster_id, epoch_ms(o_orderdate) + o_orderkey AS state_start,
               o_totalprice / 1000.0 AS cost FROM orders),
st AS (SELECT cluster_id, state_start,
              coalesce(lead(state_start) OVER (PARTITION BY cluster_id ORDER BY state_start) - 1,
                       {_G4_UNTIL_MS}) AS state_end, cost FROM st0),
st2 AS (SELECT *, (state_end - state_start) / 3600000.0 AS uptime_h FROM st),
runs AS (SELECT o.o_orderkey AS run_id, o.o_custkey AS cluster_id,
                epoch_ms(o.o_orderdate) + o.o_orderkey + 3600000 AS run_start,
                greatest(epoch_ms(o.o_orderdate) + o.o_orderkey + 3600000,
                         epoch_ms(ls.last_ship) + o.o_orderkey) AS run_end
         FROM orders o JOIN ls ON o.o_orderkey = ls.l_orderkey),
u1 AS (SELECT cluster_id, run_start AS ts, 0 AS side, run_id, CAST(NULL AS BIGINT) AS s_start FROM runs
       UNION ALL SELECT cluster_id, state_start, 1, NULL, state_start FROM st2),
i1 AS (SELECT *, coalesce(
          last_value(s_start IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY ts, side, run_id, s_start
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value(s_start IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY ts, side, run_id, s_start
                                                 ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)) AS pick FROM u1),
init AS (SELECT r.run_id, r.cluster_id, r.run_start, r.run_end, s.state_start, s.state_end, s.cost, s.uptime_h,
                least(s.state_end, r.run_end) - r.run_start AS tis
         FROM i1 JOIN runs r ON i1.run_id = r.run_id
         JOIN st2 s ON s.cluster_id = i1.cluster_id AND s.state_start = i1.pick WHERE i1.side = 0),
u2 AS (SELECT cluster_id, run_end AS ts, 0 AS side, run_id, CAST(NULL AS BIGINT) AS s_start FROM runs
       UNION ALL SELECT cluster_id, state_end, 1, NULL, state_start FROM st2),
t1 AS (SELECT *, first_value(s_start IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY ts, side, run_id, s_start
                                                        ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS pick FROM u2),
term AS (SELECT r.run_id, r.cluster_id, r.run_start, r.run_end, s.state_start, s.state_end, s.cost, s.uptime_h,
                r.run_end - s.state_start AS tis
         FROM t1 JOIN runs r ON t1.run_id = r.run_id
         JOIN st2 s ON s.cluster_id = t1.cluster_id AND s.state_start = t1.pick
         WHERE t1.side = 0 AND s.state_end >= r.run_end
           AND NOT EXISTS (SELECT 1 FROM init i WHERE i.run_id = r.run_id AND i.state_start = s.state_start)),
mid AS (SELECT r.run_id, r.cluster_id, r.run_start, r.run_end, s.state_start, s.state_end, s.cost, s.uptime_h,
               s.state_end - s.state_start AS tis
        FROM runs r JOIN st2 s ON r.cluster_id = s.cluster_id AND s.state_start > r.run_start AND s.state_end < r.run_end
        WHERE NOT EXISTS (SELECT 1 FROM init i WHERE i.run_id = r.run_id AND i.state_start = s.state_start)
          AND NOT EXISTS (SELECT 1 FROM term t WHERE t.run_id = r.run_id AND t.state_start = s.state_start)),
rs AS (SELECT *, greatest(run_start, state_start) AS rss, least(run_end, state_end) AS rse
       FROM (SELECT * FROM init UNION ALL SELECT * FROM term UNION ALL SELECT * FROM mid)),
ov AS (SELECT a.run_id, a.cluster_id, a.state_start, a.state_end,
              sum(greatest(0, least(a.rse, b.rse) - greatest(a.rss, b.rss))) AS cum,
              count(*) FILTER (WHERE b.run_id <> a.run_id AND b.rss < a.rse AND b.rse > a.rss) AS n_ov
       FROM rs a JOIN rs b ON a.cluster_id = b.cluster_id AND a.state_start = b.state_start
                          AND a.state_end = b.state_end
       GROUP BY a.run_id, a.cluster_id, a.state_start, a.state_end),
f AS (SELECT rs.*, ov.n_ov,
             CASE WHEN rs.uptime_h = 0 THEN NULL ELSE (rs.tis / 1000 / 3600) / rs.uptime_h END AS util,
             coalesce(CASE WHEN ov.cum IS NULL OR ov.cum = 0 THEN 1.0
                           ELSE least(CAST(rs.tis AS DOUBLE) / CAST(ov.cum AS DOUBLE), 1.0) END, 1.0) AS share
      FROM rs LEFT JOIN ov ON rs.run_id = ov.run_id AND rs.cluster_id = ov.cluster_id
                          AND rs.state_start = ov.state_start AND rs.state_end = ov.state_end)
SELECT run_id, cluster_id, run_start, run_end,
       greatest({_sround("sum(cost * util * share)", 6)}, 0) AS driver_compute_cost,
       greatest({_sround("sum(cost * util * share)", 6)}, 0) AS total_cost,
       count(*) AS cluster_states, max(coalesce(n_ov, 0)) AS max_overlapping_runs
FROM f GROUP BY run_id, cluster_id, run_start, run_end
"""


@query("q45_job_run_cost_fact", _Q45_SQL)
def q45(spark, d):
    """G4 on the test tables: customers are clusters, consecutive orders are cluster
    states (cost from the order total), each order's span up to its last shipment is a
    run on its customer's cluster; overlapping runs share a state's cost."""
    from tessera.plans.medallion.gold import job_run_cost_fact
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    start = epoch_ms("o_orderdate") + F.col("o_orderkey")
    st = o.select(F.lit("o").alias("organization_id"), F.col("o_custkey").alias("cluster_id"),
                  start.alias("unixTimeMS_state_start"), (F.col("o_totalprice") / 1000.0).alias("cost"))
    st = W.shift_one(st, ["unixTimeMS_state_start"], ["organization_id", "cluster_id"], ["unixTimeMS_state_start"],
                     "next", bucket=F.floor(F.col("unixTimeMS_state_start") / F.lit(365 * DAY_S * 1000.0)).cast("long"),
                     suffix="__next")
    end = F.coalesce(F.col("unixTimeMS_state_start__next") - 1, F.lit(_G4_UNTIL_MS))
    fact = st.select("organization_id", "cluster_id", "unixTimeMS_state_start", end.alias("unixTimeMS_state_end"),
                     F.lit("RUNNING").alias("state"),
                     ((end - F.col("unixTimeMS_state_start")) / 3600000.0).alias("uptime_in_state_H"),
                     F.lit(0.0).alias("worker_potential_core_H"), F.col("cost").alias("driver_compute_cost"),
                     F.lit(0.0).alias("driver_dbu_cost"), F.lit(0.0).alias("worker_compute_cost"),
                     F.lit(0.0).alias("worker_dbu_cost"))
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    rstart = epoch_ms("o_orderdate") + F.col("o_orderkey") + 3600000
    runs = o.join(last, o.o_orderkey == last.l_orderkey).select(
        F.lit("o").alias("organization_id"), F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("cluster_id"),
        F.lit("existing").alias("cluster_type"), rstart.alias("run_start_ms"),
        F.greatest(rstart, epoch_ms("last_ship") + F.col("o_orderkey")).alias("run_end_ms"))
    out = job_run_cost_fact(fact, runs, _G4_UNTIL_MS, overlap_mode="exact", slice_ms=365 * DAY_S * 1000.0,
                            month_bucket_ms=60 * DAY_S * 1000)
    return out.select("run_id", "cluster_id", "run_start", "run_end", "driver_compute_cost", "total_cost",
                      "cluster_states", "max_overlapping_runs")


# ------------------------------------------------------------------ q46 cluster state machine (V10: W10 + W11)

_V10_UNTIL_MS = 1706745600000  # 2024-02-01

_Q46_SQL = f"""
WITH e AS (
  SELECT user_id AS cluster_id, epoch_us(ts) // 1000 AS timestamp,
         CASE event_type WHEN 'signup' THEN 'CREATING' WHEN 'purchase' THEN 'STARTING'
              WHEN 'error' THEN 'TERMINATING' WHEN 'view' THEN 'RUNNING' ELSE 'RESIZING' END AS state,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
           AS size_workers,
         CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS cur,
         CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS tgt
  FROM events),
s1 AS (SELECT *, CASE WHEN state = 'TERMINATING' THEN false WHEN state IN ('CREATING', 'STARTING') THEN true END AS sw
       FROM e),
s2 AS (SELECT *, CASE WHEN sw IS NOT NULL THEN last_value(sw IGNORE NULLS) OVER (
         PARTITION BY cluster_id ORDER BY timestamp, state ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS prev_sw
       FROM s1),
s3 AS (SELECT *, lead(sw) OVER w AS nsw, lead(prev_sw) OVER w AS nprev
       FROM s2 WINDOW w AS (PARTITION BY cluster_id ORDER BY timestamp, state)),
x AS (SELECT cluster_id, timestamp, state, sw, size_workers, cur, tgt, false AS imputed FROM s3
      UNION ALL
      SELECT cluster_id, timestamp + 1, 'TERMINATING', NULL, size_workers, cur, tgt, true FROM s3
      WHERE nsw IS NOT NULL AND nsw = nprev),
r1 AS (SELECT *, coalesce(CASE WHEN imputed THEN false END, sw,
         last_value(sw IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         NOT first_value(sw IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS run0 FROM x),
r2 AS (SELECT *, CASE WHEN run0 IS NULL AND state IN ('STARTING', 'INIT_SCRIPTS_STARTED', 'RUNNING', 'CREATING',
                                                      'RESIZING', 'UPSIZE_COMPLETED', 'DRIVER_HEALTHY')
                      THEN true ELSE run0 END AS run1 FROM r1),
r3 AS (SELECT *, coalesce(run1,
         last_value(run1 IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         NOT first_value(run1 IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), false) AS is_running
       FROM r2),
w1 AS (SELECT *, coalesce(cur, size_workers) AS size FROM r3),
w2 AS (SELECT *, last_value(size IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS size_back FROM w1),
w3 AS (SELECT *, CASE WHEN NOT is_running THEN 0 ELSE coalesce(size, size_back, 0) END AS current_num_workers FROM w2),
w4 AS (SELECT *, CASE WHEN NOT is_running THEN 0 WHEN state = 'CREATING' THEN coalesce(size_workers, 0)
                      ELSE coalesce(tgt, current_num_workers, 0) END AS target_num_workers FROM w3),
z1 AS (SELECT *, lag(state) OVER w AS prev_state, lead(timestamp) OVER w AS next_ts
       FROM w4 WINDOW w AS (PARTITION BY cluster_id ORDER BY timestamp, imputed, state)),
z2 AS (SELECT *, CASE WHEN prev_state IN ('TERMINATING', 'RESTARTING', 'EDITED') OR NOT is_running THEN 1 ELSE 0 END
                   AS counter_reset,
              coalesce(next_ts - 1, {_V10_UNTIL_MS}) AS state_end FROM z1),
z3 AS (SELECT *, CAST(sum(counter_reset) OVER (PARTITION BY cluster_id ORDER BY timestamp, imputed, state
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
                   AS reset_partition FROM z2),
z4 AS (SELECT *, state_end - timestamp AS up_ms,
              sum(state_end - timestamp) OVER (PARTITION BY cluster_id, reset_partition
                                               ORDER BY timestamp, imputed, state
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since_ms FROM z3)
SELECT cluster_id, timestamp, state, is_running, current_num_workers, target_num_workers, counter_reset,
       reset_partition, state_end AS unixTimeMS_state_end, up_ms / 1000 AS uptime_in_state_S,
       CASE WHEN counter_reset = 1 THEN 0.0 ELSE CAST(coalesce(since_ms, 0) AS BIGINT) / 1000 END AS uptime_since_restart_S,
       is_running AS cloud_billable,
       is_running AND state NOT IN ('STARTING', 'TERMINATING', 'CREATING', 'RESTARTING') AS platform_billable,
       CAST(abs(date_diff('day', CAST(make_timestamp(CAST(floor(timestamp / 1000) AS BIGINT) * 1000000) AS DATE),
                          CAST(make_timestamp(CAST(floor(state_end / 1000) AS BIGINT) * 1000000) AS DATE))) + 1
            AS INTEGER) AS days_in_state
FROM z4
"""


@query("q46_cluster_state_machine", _Q46_SQL)
def q46(spark, d):
    """V10 on the test tables: each user is a cluster and its events are cluster events
    (signup = CREATING, purchase = STARTING, error = TERMINATING, view = RUNNING,
    click = RESIZING; worker counts from ``props.k``)."""
    from tessera.plans.medallion.silver import cluster_state_detail
    out = cluster_state_detail(_events_as_cluster_events(spark, d), _V10_UNTIL_MS, slice_ms=7 * DAY_S * 1000.0)
    return out.select("cluster_id", "timestamp", "state", "is_running", "current_num_workers", "target_num_workers",
                      "counter_reset", "reset_partition", "unixTimeMS_state_end", "uptime_in_state_S",
                      "uptime_since_restart_S", "cloud_billable", "platform_billable", "days_in_state")


def _events_as_cluster_events(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    et = F.col("event_type")
    state = (F.when(et == "signup", "CREATING").when(et == "purchase", "STARTING").when(et == "error", "TERMINATING")
             .when(et == "view", "RUNNING").otherwise("RESIZING"))
    details = F.struct(
        F.struct(F.lit(None).cast("struct<max_workers:bigint,min_workers:bigint>").alias("autoscale"),
                 F.when(et.isin("signup", "purchase"), k).alias("num_workers")).alias("cluster_size"),
        F.when(et == "view", k).alias("current_num_workers"), F.when(et == "click", k).alias("target_num_workers"))
    return ev.select(F.lit("o").alias("organization_id"), F.col("user_id").alias("cluster_id"),
                     epoch_ms("ts").alias("timestamp"), state.alias("type"), details.alias("details"))


# ------------------------------------------------------------------ q47 cluster state cost fact

# The node price list used by q47 (a small dimension, like the reference's
# instance-details CSV): node type, vCPUs, usage units per hour, compute price per hour.
_Q47_NODES = (("small", 4, 1.0, 0.2), ("medium", 8, 2.0, 0.4), ("large", 16, 4.0, 0.8))

_V10_CTES = _Q46_SQL[:_Q46_SQL.index("\nSELECT cluster_id, timestamp, state, is_running,")]

_Q47_SQL = _V10_CTES + f""",
sd AS (SELECT cluster_id, timestamp AS s_start, state, is_running, current_num_workers, target_num_workers,
              state_end AS s_end, up_ms / 1000 AS up_s, (up_ms / 1000) / 3600 AS up_h, is_running AS cloud_billable,
              is_running AND state NOT IN ('STARTING', 'TERMINATING', 'CREATING', 'RESTARTING') AS db_billable,
              CAST(make_timestamp(CAST(floor(timestamp / 1000) AS BIGINT) * 1000000) AS DATE) AS start_date
       FROM z4),
spec AS (SELECT user_id AS cluster_id, epoch_us(ts) // 1000 AS timestamp,
                CASE WHEN value > 50 THEN 'job-' || user_id || '-run-' || event_id ELSE 'user-' || user_id END
                  AS cluster_name,
                CASE WHEN value < 20 THEN 'small' WHEN value < 100 THEN 'medium' ELSE 'large' END AS node,
                CASE WHEN value > 200 THEN 'apache_spark_3.5' ELSE '13.3.x-scala2.12' END AS spark_version,
                CASE WHEN value > 150 THEN 'PHOTON' ELSE 'STANDARD' END AS runtime_engine
         FROM events WHERE event_type = 'purchase'),
spec2 AS (SELECT *, CASE WHEN cluster_name LIKE 'job-%-run-%' AND spark_version LIKE 'apache_spark_%' THEN 'jobsLight'
                         WHEN cluster_name LIKE 'job-%-run-%' THEN 'automated' ELSE 'interactive' END AS sku
          FROM spec),
spec3 AS (SELECT *, CASE sku WHEN 'interactive' THEN 0.55 WHEN 'automated' THEN 0.15 WHEN 'sqlCompute' THEN 0.22
                             WHEN 'jobsLight' THEN 0.10 END AS dbu_rate FROM spec2),
u AS (SELECT cluster_id, s_start AS ts, 0 AS side, s_start AS key_start, CAST(NULL AS VARCHAR) AS c_name,
             CAST(NULL AS VARCHAR) AS c_node, CAST(NULL AS VARCHAR) AS c_ver, CAST(NULL AS VARCHAR) AS c_eng,
             CAST(NULL AS VARCHAR) AS c_sku, CAST(NULL AS DOUBLE) AS c_rate FROM sd
      UNION ALL
      SELECT cluster_id, timestamp, 1, NULL, cluster_name, node, spark_version, runtime_engine, sku, dbu_rate FROM spec3),
la AS (SELECT cluster_id, key_start, side,
         coalesce(last_value(c_name IGNORE NULLS) OVER wb, first_value(c_name IGNORE NULLS) OVER wa) AS cluster_name,
         coalesce(last_value(c_node IGNORE NULLS) OVER wb, first_value(c_node IGNORE NULLS) OVER wa) AS node,
         coalesce(last_value(c_ver IGNORE NULLS) OVER wb, first_value(c_ver IGNORE NULLS) OVER wa) AS spark_version,
         coalesce(last_value(c_eng IGNORE NULLS) OVER wb, first_value(c_eng IGNORE NULLS) OVER wa) AS runtime_engine,
         coalesce(last_value(c_sku IGNORE NULLS) OVER wb, first_value(c_sku IGNORE NULLS) OVER wa) AS sku,
         coalesce(last_value(c_rate IGNORE NULLS) OVER wb, first_value(c_rate IGNORE NULLS) OVER wa) AS dbu_rate
       FROM u
       WINDOW wb AS (PARTITION BY cluster_id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              wa AS (PARTITION BY cluster_id ORDER BY ts, side ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)),
nodes AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {v}, {h}, {p})" for n, v, h, p in _Q47_NODES)})
          AS t(api_name, vcpus, hourly_dbus, price)),
pot AS (SELECT sd.*, la.cluster_name, la.node, la.spark_version, la.runtime_engine, la.sku, la.dbu_rate,
               dn.vcpus AS d_vcpus, dn.hourly_dbus AS d_dbus, dn.price AS d_price,
               wn.vcpus AS w_vcpus, wn.hourly_dbus AS w_dbus, wn.price AS w_price,
               dn.api_name AS d_key, wn.api_name AS w_key
        FROM sd JOIN la ON la.side = 0 AND la.cluster_id = sd.cluster_id AND la.key_start = sd.s_start
        LEFT JOIN nodes dn ON lower(trim(dn.api_name)) = lower(trim(la.node))
        LEFT JOIN nodes wn ON lower(trim(wn.api_name)) = lower(trim(la.node))),
wf AS (SELECT *, ROW_NUMBER() OVER () AS _rid FROM pot),
fm AS (SELECT *,
         coalesce(sku, last_value(sku IGNORE NULLS) OVER fb, first_value(sku IGNORE NULLS) OVER fa) AS f_sku,
         coalesce(dbu_rate, last_value(dbu_rate IGNORE NULLS) OVER fb, first_value(dbu_rate IGNORE NULLS) OVER fa) AS f_rate,
         coalesce(node, last_value(node IGNORE NULLS) OVER fb, first_value(node IGNORE NULLS) OVER fa) AS f_node,
         CASE WHEN d_key IS NOT NULL THEN d_vcpus ELSE coalesce(last_value(CASE WHEN d_key IS NOT NULL THEN d_vcpus END IGNORE NULLS) OVER fb, first_value(CASE WHEN d_key IS NOT NULL THEN d_vcpus END IGNORE NULLS) OVER fa) END AS fd_vcpus,
         CASE WHEN d_key IS NOT NULL THEN d_dbus ELSE coalesce(last_value(CASE WHEN d_key IS NOT NULL THEN d_dbus END IGNORE NULLS) OVER fb, first_value(CASE WHEN d_key IS NOT NULL THEN d_dbus END IGNORE NULLS) OVER fa) END AS fd_dbus,
         CASE WHEN d_key IS NOT NULL THEN d_price ELSE coalesce(last_value(CASE WHEN d_key IS NOT NULL THEN d_price END IGNORE NULLS) OVER fb, first_value(CASE WHEN d_key IS NOT NULL THEN d_price END IGNORE NULLS) OVER fa) END AS fd_price,
         CASE WHEN w_key IS NOT NULL THEN w_vcpus ELSE coalesce(last_value(CASE WHEN w_key IS NOT NULL THEN w_vcpus END IGNORE NULLS) OVER fb, first_value(CASE WHEN w_key IS NOT NULL THEN w_vcpus END IGNORE NULLS) OVER fa) END AS fw_vcpus,
         CASE WHEN w_key IS NOT NULL THEN w_dbus ELSE coalesce(last_value(CASE WHEN w_key IS NOT NULL THEN w_dbus END IGNORE NULLS) OVER fb, first_value(CASE WHEN w_key IS NOT NULL THEN w_dbus END IGNORE NULLS) OVER fa) END AS fw_dbus,
         CASE WHEN w_key IS NOT NULL THEN w_price ELSE coalesce(last_value(CASE WHEN w_key IS NOT NULL THEN w_price END IGNORE NULLS) OVER fb, first_value(CASE WHEN w_key IS NOT NULL THEN w_price END IGNORE NULLS) OVER fa) END AS fw_price
       FROM wf
       WINDOW fb AS (PARTITION BY cluster_id ORDER BY start_date, s_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              fa AS (PARTITION BY cluster_id ORDER BY start_date, s_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
m AS (SELECT *,
        CASE WHEN db_billable THEN fd_dbus * up_h ELSE 0 END AS driver_dbus,
        CASE WHEN db_billable THEN fw_dbus * current_num_workers * up_h ELSE 0 END AS worker_dbus,
        coalesce(CASE WHEN cloud_billable THEN fd_price * up_h * 1 * 1 ELSE 0 END, 0) AS driver_compute_cost,
        coalesce(CASE WHEN cloud_billable THEN fw_price * up_h * target_num_workers * 1 ELSE 0 END, 0)
          AS worker_compute_cost,
        coalesce(CASE WHEN db_billable AND upper(runtime_engine) = 'PHOTON' AND upper(f_sku) <> 'SQLCOMPUTE'
                      THEN fd_dbus * up_h * 1 * f_rate * 1 * 2
                      WHEN db_billable THEN fd_dbus * up_h * 1 * f_rate * 1 ELSE 0 END, 0) AS driver_dbu_cost,
        coalesce(CASE WHEN db_billable AND upper(runtime_engine) = 'PHOTON' AND upper(f_sku) <> 'SQLCOMPUTE'
                      THEN fw_dbus * up_h * current_num_workers * f_rate * 1 * 2
                      WHEN db_billable THEN fw_dbus * up_h * current_num_workers * f_rate * 1 ELSE 0 END, 0)
          AS worker_dbu_cost
      FROM fm)
SELECT cluster_id, s_start AS unixTimeMS_state_start, state, f_sku AS sku, f_rate AS dbu_rate, f_node AS node_type_id,
       driver_dbus + worker_dbus AS total_dbus, driver_compute_cost, worker_compute_cost, driver_dbu_cost,
       worker_dbu_cost, driver_compute_cost + driver_dbu_cost + worker_compute_cost + worker_dbu_cost AS total_cost
FROM m
"""


@query("q47_cluster_state_fact", _Q47_SQL)
def q47(spark, d):
    """G3 on the test tables: the q46 states, cluster specs from purchase events (node
    type, automation, runtime and engine derived from the event value), priced with a
    node price list and the four SKU contract prices."""
    import datetime as _dt

    from tessera.plans.medallion.gold import cluster_state_fact
    from tessera.plans.medallion.silver import cluster_state_detail
    from tessera.sources.files import sku_price_dimension
    sl = 7 * DAY_S * 1000.0
    states = cluster_state_detail(_events_as_cluster_events(spark, d), _V10_UNTIL_MS, slice_ms=sl)
    ev = table(spark, d, "events").filter(F.col("event_type") == "purchase")
    v = F.col("value")
    spec = ev.select(
        F.lit("o").alias("organization_id"), F.col("user_id").alias("cluster_id"),
        F.when(v > 50, F.concat(F.lit("job-"), F.col("user_id").cast("string"), F.lit("-run-"),
                                F.col("event_id").cast("string")))
         .otherwise(F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("cluster_name"),
        F.lit(None).cast("string").alias("custom_tags"), epoch_ms("ts").alias("timestamp"),
        F.when(v < 20, "small").when(v < 100, "medium").otherwise("large").alias("driver_node_type_id"),
        F.when(v < 20, "small").when(v < 100, "medium").otherwise("large").alias("node_type_id"),
        F.when(v > 200, "apache_spark_3.5").otherwise("13.3.x-scala2.12").alias("spark_version"),
        F.lit("Standard").alias("cluster_type"),
        F.when(v > 150, "PHOTON").otherwise("STANDARD").alias("runtime_engine"))
    inst = spark.createDataFrame([("o", n, c, h, p, _dt.date(2020, 1, 1), None) for n, c, h, p in _Q47_NODES],
                                 "organization_id string, API_Name string, vCPUs int, Hourly_DBUs double, "
                                 "Compute_Contract_Price double, activeFrom date, activeUntil date")
    dbu = sku_price_dimension(spark, "o", "2020-01-01")
    fact = cluster_state_fact(states, spec, None, inst, dbu, _V10_UNTIL_MS, slice_ms=sl)
    return fact.select("cluster_id", "unixTimeMS_state_start", "state", "sku", "dbu_rate", "node_type_id",
                       "total_dbus", "driver_compute_cost", "worker_compute_cost", "driver_dbu_cost",
                       "worker_dbu_cost", "total_cost")
