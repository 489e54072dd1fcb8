import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import joins as J
from conftest import rows

KEYS = ["site", "device"]
# device -> days of its start and its end: a day apart, the same day, 40 days apart, one side only
STARTS = [("hall", 1, dt.date(2021, 3, 1), "s1"), ("hall", 2, dt.date(2021, 3, 5), "s2"),
          ("yard", 1, dt.date(2021, 3, 7), "s3"), ("yard", 4, dt.date(2021, 3, 8), "s4")]
ENDS = [("hall", 1, dt.date(2021, 3, 2), "e1"), ("hall", 2, dt.date(2021, 3, 5), "e2"),
        ("yard", 1, dt.date(2021, 1, 26), "e3"), ("roof", 9, dt.date(2021, 4, 1), "e4")]


@pytest.fixture()
def sides(spark):
    cols = "site string, device int, day date, {0} string"
    return spark.createDataFrame(STARTS, cols.format("started")), spark.createDataFrame(ENDS, cols.format("ended"))


def lag_brute(left, right, lagging, days, how):
    """(left value, right value) pairs by comparing every row with every row."""
    def near(x, y):
        late, other = (x, y) if lagging == "left" else (y, x)
        return x[:2] == y[:2] and late[2] >= other[2] - dt.timedelta(days=days)
    out = [(x[3], y[3]) for x in left for y in right if near(x, y)]
    if how == "left":
        out += [(x[3], None) for x in left if not any(near(x, y) for y in right)]
    if how == "right":
        out += [(None, y[3]) for y in right if not any(near(x, y) for x in left)]
    return sorted(out, key=str)


@pytest.mark.parametrize("skew_safe", [False, True])
@pytest.mark.parametrize("lagging", ["left", "right"])
@pytest.mark.parametrize("how", ["left", "inner", "right"])
@pytest.mark.parametrize("days", [1, 30, 45])
def test_lag_join_equals_brute_force(sides, how, lagging, days, skew_safe):
    a, b = sides
    out = J.join_with_lag(a, b, KEYS, "day", lagging_side=lagging, lag_days=days, how=how, skew_safe=skew_safe)
    assert sorted(((r["started"], r["ended"]) for r in out.collect()), key=str) == lag_brute(STARTS, ENDS, lagging, days, how)
    assert sorted(out.columns) == sorted([*KEYS, "day", "started", "ended"])
    swapped = J.join_with_lag(b, a, KEYS, "day", lagging_side=lagging, lag_days=days, how=how, skew_safe=skew_safe)
    assert sorted(((r["ended"], r["started"]) for r in swapped.collect()), key=str) == lag_brute(ENDS, STARTS, lagging, days, how)


def test_lag_join_missing_column(sides):
    a, b = sides
    with pytest.raises(ValueError):
        J.join_with_lag(a.drop("day"), b, KEYS, "day")


def test_interval_join_same_for_all_buckets(spark):
    facts = spark.createDataFrame([(i, "k" + str(i % 3), dt.date(2020, 1, 1) + dt.timedelta(days=i * 7))
                                   for i in range(60)], "id int, key string, d date")
    dim = spark.createDataFrame([("K0 ", dt.date(2020, 1, 1), dt.date(2020, 6, 30), 1.0),
                                 ("k0", dt.date(2020, 7, 1), None, 2.0),
                                 ("k1", dt.date(2020, 3, 1), dt.date(2020, 12, 31), 3.0)],
                                "key string, f date, u date, rate double")
    a = J.interval_join(facts, dim, ["key"], "d", "f", "u", open_until=F.lit("2022-01-01").cast("date"))
    b = J.interval_join(facts, dim, ["key"], "d", "f", "u", open_until=F.lit("2022-01-01").cast("date"),
                        bucket="year")
    assert rows(a, "id", "rate") == rows(b, "id", "rate")
    assert a.count() == 60


def _brute_overlap(runs):
    out = {}
    for g, i, s, e in runs:
        tot, n = 0, 0
        for g2, j, s2, e2 in runs:
            if g2 != g:
                continue
            tot += max(0, min(e, e2) - max(s, s2))
            if j != i and s2 < e and e2 > s:
                n += 1
        out[i] = (tot, n)
    return out


def test_overlap_exact_matches_brute_force(spark):
    rnd = random.Random(7)
    runs = []
    for i in range(300):
        s = rnd.randint(0, 500)
        e = s + rnd.choice([0, 0, rnd.randint(0, 80)])
        runs.append((rnd.randint(0, 4), i, s, e))
    df = spark.createDataFrame(runs, "g int, id int, s long, e long")
    got = {r["id"]: (r["cum_runtime"], r["overlapping_runs"])
           for r in J.overlap_runtime_exact(df, ["g"], "id", "s", "e").collect()}
    assert got == _brute_overlap(runs)
    sliced = {r["id"]: (r["cum_runtime"], r["overlapping_runs"])
              for r in J.overlap_runtime_exact(df, ["g"], "id", "s", "e", bucket_width=37).collect()}
    assert sliced == got


def test_overlap_reference_bucketed_equals_plain(spark):
    rnd = random.Random(3)
    runs = []
    for i in range(200):
        s = rnd.randint(0, 1000)
        runs.append((rnd.randint(0, 3), i, s, s + rnd.randint(0, 300), 0, 2000))
    df = spark.createDataFrame(runs, "g int, id int, s long, e long, ss long, se long")
    a = J.overlap_runtime_reference(df, ["g"], "id", "s", "e", "ss", "se")
    b = J.overlap_runtime_reference(df, ["g"], "id", "s", "e", "ss", "se", bucket=50)
    assert rows(a) == rows(b)


def test_containment_join_bucketed(spark):
    runs = spark.createDataFrame([(1, 10, dt.datetime(2020, 1, 1), dt.datetime(2020, 5, 1))],
                                 "k int, run int, rs timestamp_ntz, re timestamp_ntz")
    states = spark.createDataFrame([(1, dt.datetime(2020, 2, 1), dt.datetime(2020, 4, 1)),
                                    (1, dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)),
                                    (1, dt.datetime(2020, 3, 1), dt.datetime(2020, 6, 1))],
                                   "k int, ss timestamp_ntz, se timestamp_ntz")
    out = J.containment_join(runs, states, ["k"], "rs", "re", "ss", "se")
    assert out.count() == 1


def test_salted_join_equals_plain(spark):
    big = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, s string")
    for how in ("inner", "left"):
        assert rows(J.salted_join(big, small, ["k"], salt=8, how=how)) == rows(big.join(small, "k", how))
    with pytest.raises(ValueError):
        J.salted_join(big, small, ["k"], how="full")


def test_previous_day_expand_join(spark):
    l = spark.createDataFrame([(1, dt.date(2020, 1, 2))], "u int, d date")
    r = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (1, dt.date(2020, 1, 2)), (1, dt.date(2020, 1, 3))],
                              "u int, rd date")
    out = J.same_or_previous_day_join(l, r, ["u"], "d", "rd", how="inner")
    assert sorted(x[0] for x in out.select("rd").collect()) == [dt.date(2020, 1, 1), dt.date(2020, 1, 2)]


@pytest.mark.parametrize("how", ["left", "right"])
@pytest.mark.parametrize("lagging", ["left", "right"])
def test_lag_join_skew_safe_equals_plain(spark, how, lagging):
    rnd = random.Random(11)
    l = spark.createDataFrame([(rnd.randint(0, 5), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)), i)
                               for i in range(120)], "k int, d date, lv int")
    r = spark.createDataFrame([(rnd.randint(0, 7), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)), i)
                               for i in range(150)], "k int, d date, rv int")
    a = J.join_with_lag(l, r, ["k"], "d", lagging_side=lagging, lag_days=10, how=how)
    b = J.join_with_lag(l, r, ["k"], "d", lagging_side=lagging, lag_days=10, how=how, skew_safe=True)
    assert a.columns == b.columns
    assert rows(a) == rows(b)
