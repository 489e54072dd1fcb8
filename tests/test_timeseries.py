from pyspark.sql import functions as F

from tessera.operators.timeseries import TimeSeries
from conftest import rows


# (minute, sensor, ask) and (minute, sensor, state); minute 30 has an ask and a state of sensor 7
ASKS = [(10, 7), (30, 7), (31, 7), (90, 7), (5, 8), (40, 8), (12, 9)]
STATES = [(8, 7, "cold"), (30, 7, "warm"), (60, 7, "hot"), (20, 8, "dark")]


def _fixture(spark):
    left = spark.createDataFrame(ASKS, "minute int, sensor int")
    right = spark.createDataFrame(STATES, "minute int, sensor int, state string")
    return TimeSeries(left, "minute", ("sensor",)), TimeSeries(right, "minute", ("sensor",))


def expected():
    """The last state strictly before the ask: a state of the same minute does not count yet."""
    out = []
    for m, k in ASKS:
        before = [s for s in STATES if s[1] == k and s[0] < m]
        out.append((m, k, max(before)[2] if before else None))
    return out


def test_lookup_takes_the_last_state_before(spark):
    l, r = _fixture(spark)
    out = l.lookup_when(r)
    assert rows(out, "minute", "sensor", "state") == sorted(expected(), key=lambda x: x[:2])


def test_sliced_equals_unsliced(spark):
    l, r = _fixture(spark)
    a = rows(l.lookup_when(r), "minute", "sensor", "state")
    b = rows(l.lookup_when(r, slice_size=20), "minute", "sensor", "state")
    assert a == b


def test_lookahead_fills_only_nulls(spark):
    left = spark.createDataFrame([(1, 1), (5, 1)], "t int, k int")
    right = spark.createDataFrame([(3, 1, "a"), (7, 1, "b")], "t int, k int, v string")
    out = TimeSeries(left, "t", ("k",)).lookup_when(TimeSeries(right, "t", ("k",)), lookahead_rows=1)
    assert rows(out, "t", "v") == [(1, "a"), (5, "a")]


def test_keep_right_rows_and_prefix(spark):
    l, r = _fixture(spark)
    out = l.asof_join(r, right_prefix="r_", keep_right_rows=True)
    assert "r_state" in out.columns
    assert out.count() == len(ASKS) + len(STATES)


def test_refuses_double_time(spark):
    import pytest
    df = spark.createDataFrame([(1.0, 1)], "t double, k int")
    with pytest.raises(TypeError):
        TimeSeries(df, "t", ("k",))


def test_sliced_on_events_matches_unsliced(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = TimeSeries(ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id"), "ts", ("user_id",))
    v = TimeSeries(ev.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("vv")),
                   "ts", ("user_id",))
    assert rows(p.lookup_when(v)) == rows(p.lookup_when(v, slice_size=3600))


def test_sliced_lookahead_one_equals_unsliced(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = TimeSeries(ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id"), "ts", ("user_id",))
    v = TimeSeries(ev.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("vv")),
                   "ts", ("user_id",))
    a = rows(p.lookup_when(v, lookahead_rows=1))
    for sl in (600, 3600, 86400):
        assert rows(p.lookup_when(v, lookahead_rows=1, slice_size=sl)) == a
    left = spark.createDataFrame([(1, 1), (5, 1)], "t int, k int")
    right = spark.createDataFrame([(3, 1, "a"), (7, 1, "b")], "t int, k int, v string")
    out = TimeSeries(left, "t", ("k",)).lookup_when(TimeSeries(right, "t", ("k",)), lookahead_rows=1, slice_size=20)
    assert rows(out, "t", "v") == [(1, "a"), (5, "a")]


def test_sliced_lookback_zero_and_unbounded_ahead(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = TimeSeries(ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id"), "ts", ("user_id",))
    v = TimeSeries(ev.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("vv")),
                   "ts", ("user_id",))
    for lb, la in ((0, 1), (None, None), (0, None), (None, 0)):
        a = rows(p.lookup_when(v, lookback_rows=lb, lookahead_rows=la))
        b = rows(p.lookup_when(v, lookback_rows=lb, lookahead_rows=la, slice_size=7200))
        assert a == b, (lb, la)
