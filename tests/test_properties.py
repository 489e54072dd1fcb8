"""Property tests: as-of lookups and the overlap sweep against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.joins import overlap_runtime_exact
from tessera.operators.timeseries import TimeSeries

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

lefts = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)), min_size=1, max_size=15)
rights = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 99))),
                  min_size=0, max_size=15)


def brute_asof(left, right):
    out = []
    for i, (k, t) in enumerate(left):
        cands = sorted([(tr, -1 if v is None else v, v) for kr, tr, v in right if kr == k and tr < t])
        vals = [v for _, _, v in cands if v is not None]
        out.append((i, vals[-1] if vals else None))
    return sorted(out)


@SETTINGS
@given(left=lefts, right=rights, sliced=st.booleans())
def test_asof_matches_brute_force(spark, left, right, sliced):
    l = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(left)], "id int, k int, t int")
    r = spark.createDataFrame(right, "k int, t int, v int")
    out = TimeSeries(l, "t", ("k",)).lookup_when(TimeSeries(r, "t", ("k",)), slice_size=7 if sliced else None)
    got = sorted((row["id"], row["v"]) for row in out.collect())
    assert got == brute_asof(left, right)


runs = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50), st.integers(0, 20)), min_size=1, max_size=20)


@SETTINGS
@given(rs=runs, width=st.sampled_from([None, 5, 13]))
def test_overlap_sweep_matches_brute_force(spark, rs, width):
    data = [(g, i, s, s + d) for i, (g, s, d) in enumerate(rs)]
    df = spark.createDataFrame(data, "g int, id int, s long, e long")
    got = {r["id"]: (r["cum_runtime"], r["overlapping_runs"])
           for r in overlap_runtime_exact(df, ["g"], "id", "s", "e", bucket_width=width).collect()}
    want = {}
    for g, i, s, e in data:
        tot = sum(max(0, min(e, e2) - max(s, s2)) for g2, j, s2, e2 in data if g2 == g)
        n = sum(1 for g2, j, s2, e2 in data if g2 == g and j != i and s2 < e and e2 > s)
        want[i] = (tot, n)
    assert got == want


from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.joins import containment_join, interval_join
from tessera.operators.windows import dedup_by_key

dedup_rows = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 2)),
                      min_size=1, max_size=25)


@SETTINGS
@given(data=dedup_rows, desc=st.booleans())
def test_dedup_matches_row_number(spark, data, desc):
    df = spark.createDataFrame(data, "k int, o int, v int")
    got = sorted(map(tuple, dedup_by_key(df, ["k"], ["o"], descending=desc).collect()),
                 key=lambda r: tuple((x is None, x) for x in r))
    oc = [F.col(c).desc() if desc else F.col(c).asc() for c in ("o", "v")]
    want_df = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*oc))).filter("rn = 1").drop("rn")
    want = sorted(map(tuple, want_df.collect()), key=lambda r: tuple((x is None, x) for x in r))
    assert got == want


intervals = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.integers(0, 60)), min_size=1, max_size=15)


@SETTINGS
@given(runs=intervals, states=intervals, width=st.sampled_from(["7", "31", "400"]))
def test_containment_matches_brute_force(spark, runs, states, width):
    r = spark.createDataFrame([(k, i, s, s + d) for i, (k, s, d) in enumerate(runs)], "k int, rid int, rs int, re int")
    s = spark.createDataFrame([(k, j, a, a + d) for j, (k, a, d) in enumerate(states)], "k int, sid int, ss int, se int")
    got = sorted((x["rid"], x["sid"]) for x in containment_join(r, s, ["k"], "rs", "re", "ss", "se",
                                                                  bucket=width).collect())
    want = sorted((i, j) for i, (k, a, d) in enumerate(runs) for j, (k2, b, e) in enumerate(states)
                  if k == k2 and b > a and b + e < a + d)
    assert got == want


@SETTINGS
@given(facts=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=1, max_size=20),
       dims=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300), st.one_of(st.none(), st.integers(0, 80))),
                     min_size=1, max_size=8))
def test_interval_join_matches_brute_force(spark, facts, dims):
    f = spark.createDataFrame([(str(k), i, t) for i, (k, t) in enumerate(facts)], "key string, fid int, t int")
    d = spark.createDataFrame([(f" {k} ".upper(), j, a, None if e is None else a + e) for j, (k, a, e) in enumerate(dims)],
                              "key string, did int, af int, au int")
    out = interval_join(f, d, ["key"], "t", "af", "au", open_until=F.lit(250), bucket="50")
    got = sorted((x["fid"], x["did"]) for x in out.collect())
    want = []
    for i, (k, t) in enumerate(facts):
        hits = [j for j, (k2, a, e) in enumerate(dims) if k == k2 and a <= t <= (250 if e is None else a + e)]
        want += [(i, j) for j in hits] or [(i, None)]
    assert got == sorted(want, key=lambda x: (x[0], -1 if x[1] is None else x[1]))


from tessera.operators.joins import join_with_lag

lag_side = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), min_size=0, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=lag_side, right=lag_side, how=st.sampled_from(["inner", "left", "right"]),
       lagging=st.sampled_from(["left", "right"]), skew_safe=st.booleans())
def test_lag_join_matches_brute_force(spark, left, right, how, lagging, skew_safe):
    import datetime as dt
    d0 = dt.date(2020, 1, 1)
    L = [(k, d0 + dt.timedelta(days=t), i) for i, (k, t) in enumerate(left)]
    R = [(k, d0 + dt.timedelta(days=t), j) for j, (k, t) in enumerate(right)]
    ldf = spark.createDataFrame(L, "k int, d date, lid int")
    rdf = spark.createDataFrame(R, "k int, d date, rid int")
    out = join_with_lag(ldf, rdf, ["k"], "d", lagging_side=lagging, lag_days=10, how=how, skew_safe=skew_safe)
    got = sorted(((r["lid"], r["rid"]) for r in out.collect()), key=lambda x: tuple((v is None, v or 0) for v in x))

    def ok(ld, rd):
        return ld >= rd - dt.timedelta(days=10) if lagging == "left" else rd >= ld - dt.timedelta(days=10)
    pairs = [(i, j) for k, ld, i in L for k2, rd, j in R if k == k2 and ok(ld, rd)]
    want = list(pairs)
    if how == "left":
        want += [(i, None) for _, _, i in L if all(p[0] != i for p in pairs)]
    if how == "right":
        want += [(None, j) for _, _, j in R if all(p[1] != j for p in pairs)]
    assert got == sorted(want, key=lambda x: tuple((v is None, v or 0) for v in x))
