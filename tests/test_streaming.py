import shutil

import pytest
from pyspark.sql import functions as F

from tessera.streaming.land import (exactly_once, land_stream, late_rows, raw_land_columns, read_stream,
                                    validate_checkpoint_path)
from conftest import rows

SRC = "/root/testdata/sf0.001/events.parquet"


def test_available_now_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    shutil.copy(SRC, src / "part-0.parquet")
    schema = spark.read.parquet(SRC).schema
    stream = read_stream(spark, "parquet", str(src), schema=schema, max_per_trigger=1)
    target, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    validate_checkpoint_path(spark, ckpt, target, first_run=True)
    land_stream(stream, target, ckpt, "land_events")
    landed = spark.read.parquet(target)
    assert rows(landed) == rows(spark.read.parquet(SRC))
    # a second drain with the same checkpoint lands nothing new (exactly once)
    land_stream(read_stream(spark, "parquet", str(src), schema=schema), target, ckpt, "land_events2")
    assert spark.read.parquet(target).count() == landed.count()


def test_raw_land_shape(spark):
    df = spark.read.parquet(SRC).limit(3)
    out = raw_land_columns(df, "run-1", "org-1")
    assert out.columns == ["body", "organization_id", "run_id", "landed_at"]


def test_checkpoint_path_rules(spark, tmp_path):
    with pytest.raises(ValueError):
        validate_checkpoint_path(spark, str(tmp_path / "t"), str(tmp_path / "t"), True)
    with pytest.raises(ValueError):
        validate_checkpoint_path(spark, str(tmp_path / "missing"), str(tmp_path / "t"), False)


def test_stream_dedup_equals_batch(spark, tmp_path):
    src = tmp_path / "dup"
    src.mkdir()
    ev = spark.read.parquet(SRC)
    ev.union(ev).write.parquet(str(src / "a"))
    schema = ev.schema
    stream = read_stream(spark, "parquet", str(src / "a"), schema=schema)
    with pytest.raises(ValueError):
        exactly_once(stream, ["event_id"], event_time="ts")
    d = exactly_once(stream, ["event_id"], event_time="ts", watermark="1 hour")
    out, ck = str(tmp_path / "o"), str(tmp_path / "c")
    q = land_stream(d, out, ck, "dedup")
    assert late_rows(q) == 0
    assert spark.read.parquet(out).count() == ev.count()
    assert exactly_once(ev.union(ev), ["event_id"]).count() == ev.count()


def test_close_late_stream_join(spark, tmp_path):
    import datetime as dt
    from tessera.streaming.land import close_late
    s_dir, e_dir = tmp_path / "starts", tmp_path / "ends"
    starts = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0)), (2, dt.datetime(2024, 1, 1, 1, 0))],
                                   "k int, start_ts timestamp_ntz")
    ends = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 0, 0)), (2, dt.datetime(2024, 3, 1, 0, 0))],
                                 "k int, end_ts timestamp_ntz")
    starts.write.parquet(str(s_dir))
    ends.write.parquet(str(e_dir))
    ss = read_stream(spark, "parquet", str(s_dir), schema=starts.schema)
    es = read_stream(spark, "parquet", str(e_dir), schema=ends.schema)
    joined = close_late(ss, es, ["k"], "start_ts", "end_ts", max_lag="30 days").select("s.k", "e.end_ts")
    out, ck = str(tmp_path / "o"), str(tmp_path / "c")
    land_stream(joined, out, ck, "close_late")
    got = {r["k"]: r["end_ts"] for r in spark.read.parquet(out).collect() if r["end_ts"] is not None}
    assert 1 in got and 2 not in got  # key 2 ended after the 30-day bound
