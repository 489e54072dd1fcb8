import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import windows as W
from tessera.operators.timeseries import TimeSeries


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_backward_fills_read_each_row_once(spark):
    """A frame to the end of its window is read anew for every row: no such frame is planned."""
    rnd = random.Random(4)
    data = [(rnd.choice([None, "a", "b"]), i, rnd.randint(0, 90), None if rnd.random() < 0.7 else i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, id int, t int, v int")
    bucket = F.floor(F.col("t") / 20)
    w = Window.partitionBy("k").orderBy("t", "id")
    at = F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    after = F.first("v", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    want_at, want_after = rows(df.select("id", at.alias("x"))), rows(df.select("id", after.alias("x")))
    for b in (None, bucket):
        made = [(W.carry(df, ["v"], ["k"], ["t", "id"], "backward", True, b), "v__carry", want_at),
                (W.carry(df, ["v"], ["k"], ["t", "id"], "backward", False, b), "v__carry", want_after),
                (W.future_fill(df, ["v"], ["k"], ["t", "id"], bucket=b, out_suffix="__f"), "v__f", want_at),
                (W.carry_both(df, ["v"], ["k"], ["t", "id"], b), "v__next", want_at),
                (W.lookaround(df, ["k"], ["t", "id"], b, first_nonnull=["v"]), "v__fnn", want_at),
                (W.lookaround(df, ["k"], ["t", "id"], b, first_nonnull_after=["v"]), "v__fna", want_after)]
        for got, c, want in made:
            assert "unboundedfollowing" not in _plan(got).lower()
            assert rows(got, "id", c) == want


def test_unbounded_lookahead_reads_each_row_once(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 6, 11), ("b", 2, 12)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 3, None), ("a", 5, "x"), ("b", 1, None)], "k string, t int, v string")
    got = TimeSeries(left, "t", ("k",)).lookup_when(TimeSeries(right, "t", ("k",)), lookback_rows=0, lookahead_rows=None)
    assert "unboundedfollowing" not in _plan(got).lower()
    assert rows(got, "id", "v") == [(10, "x"), (11, None), (12, None)]
