import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import windows as W
from conftest import rows


def _series(spark, n=400, keys=3, seed=1):
    rnd = random.Random(seed)
    data = [(rnd.randint(0, keys - 1), i, rnd.randint(0, 1000), None if rnd.random() < 0.6 else rnd.random())
            for i in range(n)]
    return spark.createDataFrame(data, "k int, id int, t int, v double")


def test_dedup_by_key_equals_row_number(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = W.dedup_by_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    b = W.dedup_by_key_window(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    assert rows(a) == rows(b)
    assert a.columns == li.columns


def test_latest_by_key_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "d")], "k int, t int, v string")
    assert W.latest_by_key(df, ["k"], ["t"], keep_ties=True).count() == 3
    assert rows(W.latest_by_key(df, ["k"], ["t"]), "k", "v") == [(1, "b"), (2, "d")]


def test_carry_bucketed_equals_plain(spark):
    df = _series(spark)
    for direction in ("forward", "backward"):
        for inc in (True, False):
            a = W.carry(df, ["v"], ["k"], ["t", "id"], direction, inc)
            b = W.carry(df, ["v"], ["k"], ["t", "id"], direction, inc, bucket=F.floor(F.col("t") / 37))
            assert rows(a, "id", "v__carry") == rows(b, "id", "v__carry")


def test_fill_forward_with_lookups(spark):
    df = spark.createDataFrame([(1, 1, None, "x"), (1, 2, "a", None), (1, 3, None, None), (1, 4, None, "y")],
                               "k int, t int, v string, alt string")
    out = W.fill_forward(df, ["v"], ["k"], ["t"], lookups={"v": ["alt"]})
    assert rows(out, "t", "v") == [(1, "x"), (2, "a"), (3, "a"), (4, "a")]
    out2 = W.fill_forward(df, ["v"], ["k"], ["t"], lookups={"v": ["alt"]}, own_priority=False)
    assert rows(out2, "t", "v") == [(1, "x"), (2, "x"), (3, "x"), (4, "y")]


def test_fill_meta_and_future(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, None), (1, 4, 7.0), (1, 5, None)],
                               "k int, t int, v double")
    assert [r[0] for r in W.fill_meta(df, ["v"], ["k"], ["t"]).orderBy("t").select("v").collect()] == \
        [5.0, 5.0, 5.0, 7.0, 7.0]
    fut = W.future_fill(df, ["v"], ["k"], ["t"], out_suffix="_next").orderBy("t")
    assert [r[0] for r in fut.select("v_next").collect()] == [5.0, 5.0, 7.0, 7.0, None]
    bounded = W.future_fill(df, ["v"], ["k"], ["t"], max_rows=1, out_suffix="_next").orderBy("t")
    assert [r[0] for r in bounded.select("v_next").collect()] == [5.0, 5.0, 7.0, 7.0, None]


def test_running_sum_bucketed(spark):
    df = _series(spark).withColumn("x", F.col("t").cast("long"))
    a = W.running_sum(df, "x", ["k"], ["t", "id"])
    b = W.running_sum(df, "x", ["k"], ["t", "id"], bucket=F.floor(F.col("t") / 100))
    assert rows(a, "id", "running_sum") == rows(b, "id", "running_sum")
    c = W.running_sum(df, "x", [], ["t", "id"], bucket=F.floor(F.col("t") / 100))
    d = W.running_sum(df, "x", [], ["t", "id"])
    assert rows(c, "id", "running_sum") == rows(d, "id", "running_sum")


def test_reset_sessions(spark):
    df = spark.createDataFrame([(1, 1, True, 10), (1, 2, False, 5), (1, 3, False, 2), (1, 4, True, 1), (1, 5, False, 3)],
                               "k int, t int, r boolean, d int")
    out = W.reset_sessions(df, ["k"], ["t"], F.col("r"), F.col("d")).orderBy("t")
    got = [(r["session_id"], r["uptime_since_reset"]) for r in out.collect()]
    assert got == [(1, 0), (1, 15), (1, 17), (2, 0), (2, 4)]


def test_impute_chain_and_share(spark):
    df = spark.createDataFrame([(1, "a", "x", None), (2, "a", "x", "N1"), (3, "b", "x", None), (4, "c", "y", None)],
                               "id int, g1 string, g2 string, v string")
    out = W.impute_by_group_chain(df, "v", [["g1"], ["g2"]], "id")
    assert rows(out, "id", "v_imputed") == [(1, "N1"), (2, "N1"), (3, "N1"), (4, None)]
    sh = W.share_of_partition(spark.createDataFrame([(1, 1.0), (1, 3.0)], "k int, x double"), "x", ["k"])
    assert sorted(r["share"] for r in sh.collect()) == [0.25, 0.75]


def test_state_end_and_delta(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (1, dt.datetime(2020, 1, 2))], "k int, t timestamp_ntz")
    out = W.state_end_from_next(df, ["k"], ["t"], "t", F.lit("2020-02-01").cast("timestamp_ntz")).orderBy("t")
    ends = [r["state_end"] for r in out.collect()]
    assert ends == [dt.datetime(2020, 1, 1, 23, 59, 59, 999000), dt.datetime(2020, 2, 1)]
    dd = W.row_delta(spark.createDataFrame([(1, 1, 5), (1, 2, 8)], "k int, t int, x int"), "x", ["k"], ["t"])
    assert sorted(r["x_delta"] or 0 for r in dd.collect()) == [0, 3]


def test_shift_one_bucketed_equals_plain(spark):
    df = _series(spark, n=300, keys=4, seed=5)
    for direction in ("previous", "next"):
        a = W.shift_one(df, ["v", "t"], ["k"], ["t", "id"], direction)
        b = W.shift_one(df, ["v", "t"], ["k"], ["t", "id"], direction, bucket=F.floor(F.col("t") / 41))
        assert rows(a, "id", "v__shift", "t__shift") == rows(b, "id", "v__shift", "t__shift")


def test_bounded_carry_bucketed_equals_window(spark):
    df = _series(spark, n=400, keys=3, seed=9)
    for direction in ("forward", "backward"):
        for inc in (True, False):
            for n in (1, 3, 10):
                a = W.carry_within_rows(df, ["v"], ["k"], ["t", "id"], n, direction, inc)
                b = W.carry_within_rows(df, ["v"], ["k"], ["t", "id"], n, direction, inc,
                                        bucket=F.floor(F.col("t") / 53))
                assert rows(a, "id", "v__carry") == rows(b, "id", "v__carry"), (direction, inc, n)
    rn = W.row_numbers(df, ["k"], ["t", "id"], bucket=F.floor(F.col("t") / 53))
    assert rows(rn, "id", "__rn") == rows(W.row_numbers(df, ["k"], ["t", "id"]), "id", "__rn")


def test_carry_both_equals_two_carries(spark):
    df = _series(spark, n=300, keys=3, seed=21)
    for bucket in (None, F.floor(F.col("t") / 29)):
        both = W.carry_both(df, ["v"], ["k"], ["t", "id"], bucket)
        f = W.carry(df, ["v"], ["k"], ["t", "id"], "forward", True, None)
        b = W.carry(df, ["v"], ["k"], ["t", "id"], "backward", True, None)
        assert rows(both, "id", "v__prev") == rows(f, "id", "v__carry")
        assert rows(both, "id", "v__next") == rows(b, "id", "v__carry")


def test_lookaround_all_kinds_sliced_equals_plain(spark):
    df = _series(spark, n=300, keys=3, seed=33)
    kw = dict(last_nonnull=["v"], first_nonnull=["v"], last_nonnull_before=["v"], first_nonnull_after=["v"],
              next_row=["v", "t"], prev_row=["v", "t"], cumsum=["t"])
    a = W.lookaround(df, ["k"], ["t", "id"], None, **kw)
    b = W.lookaround(df, ["k"], ["t", "id"], F.floor(F.col("t") / 37), **kw)
    cols = ["id", "v__lnn", "v__fnn", "v__lnb", "v__fna", "v__nx", "t__nx", "v__pv", "t__pv", "t__cs"]
    assert rows(a, *cols) == rows(b, *cols)


def test_lookaround_global_series_and_null_keys(spark):
    df = _series(spark, n=200, keys=2, seed=41)
    df = df.withColumn("k", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("k")))  # some null keys
    kw = dict(last_nonnull=["v"], first_nonnull_after=["v"], next_row=["t"], prev_row=["v"])
    for keys in ([], ["k"]):
        a = W.lookaround(df, keys, ["t", "id"], None, **kw)
        b = W.lookaround(df, keys, ["t", "id"], F.floor(F.col("t") / 61), **kw)
        cols = ["id", "v__lnn", "v__fna", "t__nx", "v__pv"]
        assert rows(a, *cols) == rows(b, *cols), keys
