import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import columns as C
from tessera.functions import cost


def test_runtime_struct(spark):
    df = spark.createDataFrame([(123456789000, 223256289000)], "s long, e long")
    r = df.select(C.runtime_struct("s", "e").alias("r")).select("r.*").first()
    assert r["runTimeMS"] == 99799500000
    assert r["runTimeS"] == pytest.approx(99799500.0, abs=1e-3)
    assert r["runTimeM"] == pytest.approx(1663325.0, abs=1e-3)
    assert r["runTimeH"] == pytest.approx(27722.0833, abs=1e-3)


def test_runtime_struct_open_end(spark):
    df = spark.createDataFrame([(1000, None)], "s long, e long")
    r = df.select(C.runtime_struct("s", "e").alias("r")).select("r.*").first()
    assert r["endTS"] is None and r["runTimeMS"] is None and r["runTimeH"] is None


def test_to_ts(spark):
    df = spark.createDataFrame([(123456789,)], "v long")
    r = df.select(C.to_ts("v", ntz=True).alias("ms"), C.to_ts("v", "second", ntz=True).alias("s"),
                  C.to_ts("v", output_type="date", ntz=True).alias("dms"),
                  C.to_ts("v", "second", "date", ntz=True).alias("ds")).first()
    assert r["ms"] == dt.datetime(1970, 1, 2, 10, 17, 36)
    assert r["s"] == dt.datetime(1973, 11, 29, 21, 33, 9)
    assert r["dms"] == dt.date(1970, 1, 2) and r["ds"] == dt.date(1973, 11, 29)
    with pytest.raises(ValueError):
        C.to_ts("v", output_type="long")


def test_string_ts_to_epoch_ms(spark):
    df = spark.createDataFrame([("2020-11-06T08:10:12.123Z",), ("2020-11-06T08:10:12Z",)], "s string")
    got = [r[0] for r in df.select(C.string_ts_to_epoch_ms("s")).collect()]
    assert got == [1604650212123, None]


@pytest.mark.parametrize("dtype,val,plus,minus", [
    (T.IntegerType(), 2, 3, 1), (T.LongType(), 2, 3, 1), (T.DoubleType(), 2.0, 2.001, 1.999),
    (T.DateType(), dt.date(2020, 10, 30), dt.date(2020, 10, 31), dt.date(2020, 10, 29)),
])
def test_ticks(spark, dtype, val, plus, minus):
    df = spark.createDataFrame([(val,)], T.StructType([T.StructField("v", dtype)]))
    r = df.select(C.add_ticks("v", dtype).alias("p"), C.subtract_ticks("v", dtype).alias("m")).first()
    if isinstance(plus, float):
        assert r["p"] == pytest.approx(plus) and r["m"] == pytest.approx(minus)
    else:
        assert (r["p"], r["m"]) == (plus, minus)


def test_ticks_timestamp_and_refusal(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 10, 31, 10, 1, 11),)], "v timestamp_ntz")
    r = df.select(C.add_ticks("v", T.TimestampNTZType()).alias("p"),
                  C.subtract_ticks("v", T.TimestampNTZType()).alias("m")).first()
    assert r["p"] == dt.datetime(2011, 10, 31, 10, 1, 11, 1000)
    assert r["m"] == dt.datetime(2011, 10, 31, 10, 1, 10, 999000)
    with pytest.raises(TypeError):
        C.add_ticks("v", T.StringType())


def test_epoch_conversions(spark):
    df = spark.createDataFrame([("1660109379388",), ("bad",)], "s string")
    got = [r[0] for r in df.select(C.epoch_ms_to_ts("s").cast("timestamp_ntz")).collect()]
    # session time zone is UTC in tests
    assert got == [dt.datetime(2022, 8, 10, 5, 29, 39, 388000), None]
    df2 = spark.createDataFrame([("2021-11-12 02:12:23.8870",), ("1636663343887",)], "s string")
    got2 = [r[0] for r in df2.select(C.ts_to_epoch_ms("s")).collect()]
    assert got2 == [1636683143887.0, None]


def test_epoch_ms_ntz_is_time_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    assert df.select(C.epoch_ms("t")).first()[0] == 1704067207179


def test_token_after_and_sku(spark):
    df = spark.createDataFrame([("id = a runId = b batch = 3",), ("runId = z",)], "d string")
    r = df.select(C.stream_details(F.split("d", " ")).alias("s")).select("s.*").collect()
    assert tuple(r[0]) == ("a", "b", "3") and tuple(r[1]) == (None, "z", None)
    sk = spark.createDataFrame([(True, "apache_spark_3", "x"), (True, "11.3", "x"), (False, "x", "SQL Analytics"),
                                (False, "x", "Standard")], "a boolean, v string, t string")
    assert [x[0] for x in sk.select(C.derive_sku("a", "v", "t")).collect()] == [
        "jobsLight", "automated", "sqlCompute", "interactive"]


def test_costs(spark):
    df = spark.createDataFrame([(True, "PHOTON", "automated"), (True, "STANDARD", "automated"),
                                (True, "PHOTON", "sqlCompute"), (False, "PHOTON", "automated")],
                               "b boolean, eng string, sku string")
    got = [r[0] for r in df.select(cost.dbu_cost("b", F.lit(2.0), F.lit(0.5), F.lit(3), F.lit(1.0), "eng", "sku"))
           .collect()]
    assert got == [6.0, 3.0, 3.0, 0.0]
    c = [r[0] for r in df.select(cost.compute_cost("b", F.lit(None).cast("double"), F.lit(1), F.lit(1.0))).collect()]
    assert c == [0, 0, 0, 0]


def test_cost_summary_requires_columns(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, m double")
    with pytest.raises(ValueError):
        cost.cost_summary(df, ["nope"], ["g"], 2)
    r = cost.cost_summary(df.union(spark.createDataFrame([("a", -5.0)], "g string, m double")), ["m"], ["g"], 2)
    assert r.first()["m"] == 0
