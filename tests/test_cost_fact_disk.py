"""The job-run cost fact (G4) moves its rows once a cluster, keeps lists of days out of shuffles and stores them small."""

import datetime as dt
import os
import random

from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import tables as K
from tessera.plans.medallion import gold

H = 3_600_000


def _input(spark):
    """Clusters of up to 12 runs; some keys and times null, some run ids and whole runs repeated."""
    rnd = random.Random(7)
    st, r = [], []
    for org in ("a", "b", None):
        for cluster in (*range(6), None):
            t = rnd.randrange(5)
            for i in range(rnd.randrange(8)):
                end = t + rnd.randrange(1, 6)
                st.append((org, cluster, t * H, end * H - 1, rnd.choice(["STARTING", "RUNNING"]), float(end - t), 1.0, *[rnd.choice([None, i + 1.0]) for _ in gold.COST_COLS]))
                t = end
            for run in range(rnd.randrange(12)):
                start = rnd.randrange(30)
                row = (org, run if run < 9 else None, cluster, rnd.choice(["new", "existing", "existing", None]), start * H, rnd.choice([None, (start + rnd.randrange(12)) * H]))
                r += [row] * rnd.choice([1, 1, 1, 2])
    states = spark.createDataFrame(st, "organization_id string, cluster_id long, unixTimeMS_state_start long, unixTimeMS_state_end long, state string, uptime_in_state_H double, "
                                       "worker_potential_core_H double, " + ", ".join(f"{c} double" for c in gold.COST_COLS))
    return states, spark.createDataFrame(r, "organization_id string, run_id long, cluster_id long, cluster_type string, run_start_ms long, run_end_ms long")


def test_small_clusters_cost_the_same_as_sliced_ones(spark, monkeypatch):
    states, runs = _input(spark)
    got = rows(gold.job_run_cost_fact(states, runs, 40 * H, slice_ms=7.0 * H).drop("run_time"))
    monkeypatch.setattr(gold, "_FEW_RUNS", 4)  # some clusters either way
    assert rows(gold.job_run_cost_fact(states, runs, 40 * H, slice_ms=7.0 * H).drop("run_time")) == got
    monkeypatch.setattr(gold, "_FEW_RUNS", -1)  # all sliced
    assert rows(gold.job_run_cost_fact(states, runs, 40 * H, slice_ms=7.0 * H).drop("run_time")) == got
    assert len(got) > 50


def test_a_cost_fact_moves_its_rows_few_times(spark):
    states, runs = _input(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.job_run_cost_fact(states, runs, 40 * H, slice_ms=7.0 * H)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 5


def test_overlap_beside_rows_equals_the_sweep(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.choice([None, *range(9)]), i, s, s + rnd.choice([0, 0, 3, 40, -2]), i % 5 > 0) for i in range(200) for s in [rnd.randrange(60)]], "g long, id long, s long, e long, shared boolean")
    want = df.join(J.overlap_runtime_exact(df.where("shared"), ["g"], "id", "s", "e"), ["g", "id"], "left")
    assert rows(J.overlap_runtime_exact(df, ["g"], "id", "s", "e", among=F.col("shared"))) == rows(want.select("g", "id", "s", "e", "shared", "cum_runtime", "overlapping_runs"))


def test_lists_of_days_are_stored_small_and_made_at_the_write(spark, tmp_path):
    spec = K.TableSpec("t", str(tmp_path / "t"), keys=("id",), tenant_col=None)
    days = lambda df: df.withColumn("days", F.sequence(F.date_from_unix_date(F.col("v").cast("int")), F.date_from_unix_date(F.col("v").cast("int") + 1500)))
    one = spark.range(400).select("id", (F.col("id") * 3).alias("v"))
    two = spark.range(300, 500).select("id", (F.col("id") * 5).alias("v"))
    K.write_upsert(one, spec, derive=days)
    K.write_upsert(two, spec, derive=days)
    got = {r["id"]: (r["v"], r["days"][0], len(r["days"])) for r in K.read_table(spark, spec).collect()}
    assert got == {i: (v, dt.date(1970, 1, 1) + dt.timedelta(v), 1501) for i in range(500) for v in [i * (5 if i >= 300 else 3)]}
    assert sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(spec.path) for f in fs if f.endswith(".parquet")) < 300_000


def test_containment_without_slices_finds_the_same_pairs(spark):
    rnd = random.Random(5)
    times = lambda n: [(rnd.choice([None, 1, 2]), i, t, t + rnd.randrange(30)) for i in range(n) for t in [rnd.randrange(100)]]
    runs = spark.createDataFrame(times(40), "k long, r long, rs long, re long")
    states = spark.createDataFrame(times(60), "k long, s long, ss long, se long")
    how = (runs, states, ["k"], "rs", "re", "ss", "se")
    assert rows(J.containment_join(*how, bucket=None)) == rows(J.containment_join(*how, bucket="7"))
