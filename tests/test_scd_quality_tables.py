import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.scd import scd2_apply, scd2_validate
from tessera.operators.tables import TableSpec, new_files, read_table, upsert_frame, write_upsert
from tessera.operators.incremental import incremental_filters, ModuleSpec, compute_window, run_status
from conftest import rows

D = dt.date


def test_scd2_apply_and_validate_roundtrip(spark):
    dim = spark.createDataFrame([("interactive", 0.55, D(2020, 1, 1), None, True),
                                 ("automated", 0.15, D(2020, 1, 1), None, True),
                                 ("automated", 0.10, D(2019, 1, 1), D(2020, 1, 1), False)],
                                "sku string, contract_price double, active_from date, active_until date, is_active boolean")
    new = spark.createDataFrame([("interactive", 0.60), ("automated", 0.15)], "sku string, contract_price double")
    out = scd2_apply(dim, new, ["sku"], "contract_price", F.lit("2021-01-01").cast("date"))
    assert out.count() == 4
    act = rows(out.filter("is_active"), "sku", "contract_price")
    assert act == [("automated", 0.15), ("interactive", 0.60)]
    assert scd2_validate(out, ["sku"], snap_date=F.lit("2022-01-01").cast("date")).count() == 0
    broken = out.filter(~((F.col("sku") == "automated") & ~F.col("is_active")))
    broken = broken.union(spark.createDataFrame([("automated", 0.2, D(2020, 6, 1), None, True)], broken.schema))
    assert scd2_validate(broken, ["sku"], snap_date=F.lit("2022-01-01").cast("date")).count() >= 1


def test_key_and_dup_reports(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "a int, b int")
    kr = Q.key_report(df, ["a", "b"]).first()
    assert (kr["n_rows"], kr["n_distinct_keys"], kr["null_b"], kr["status"]) == (3, 1, 1, "FAIL")
    dr = Q.dup_report(df, ["a", "b"]).first()
    assert (dr["n_dup_rows"], dr["n_keys_with_dups"]) == (1, 1)


def test_compare_and_rules(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    per = Q.compare_datasets(a, b, ["k"])
    assert rows(per) == [(1, 2, 1, 1), (2, 1, 0, 1), (3, 0, 1, -1)]
    s = Q.compare_summary(per, tolerance_pct=10.0, strict=True).first()
    assert s["status"] == "FAIL" and s["abs_key_diff"] == 3
    r = Q.validate_rules(spark.createDataFrame([(0.05,), (0.5,), (None,)], "d double"),
                         [Q.bounds_rule("d_range", "d", 0, 0.1)]).first()
    assert (r["n_pass"], r["n_fail"]) == (1, 2)


def test_upsert_is_idempotent(spark, tmp_path):
    tgt = spark.createDataFrame([(1, "a", D(2020, 1, 1)), (2, "b", D(2020, 1, 2))], "k int, v string, d date")
    src = spark.createDataFrame([(2, "B", D(2020, 1, 2)), (3, "c", D(2020, 1, 2))], "k int, v string, d date")
    once = upsert_frame(tgt, src, ["k"])
    twice = upsert_frame(once, src, ["k"])
    assert rows(once) == rows(twice) == [(1, "a", D(2020, 1, 1)), (2, "B", D(2020, 1, 2)), (3, "c", D(2020, 1, 2))]
    spec = TableSpec("t", str(tmp_path / "t"), keys=("k",), partition_by=("d",), tenant_col=None)
    write_upsert(tgt, spec)
    write_upsert(src, spec)
    write_upsert(src, spec)
    assert rows(read_table(spark, spec), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_new_files(spark):
    listing = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "filename string, size int")
    tracker = spark.createDataFrame([("a", False), ("b", True)], "filename string, failed boolean")
    bad = spark.createDataFrame([("c",)], "filename string")
    assert rows(new_files(listing, tracker, bad), "filename") == [("b",), ("d",)]


def test_incremental_filters_and_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    f = incremental_filters(ev.schema, ["ts"], "2024-01-10", "2024-01-20", lag_days=2)
    out = ev.filter(f[0] & f[1])
    mn, mx = out.agg(F.min("ts"), F.max("ts")).first()
    assert mn >= dt.datetime(2024, 1, 8) and mx < dt.datetime(2024, 1, 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "ts" in plan
    st = spark.createDataFrame([(1, "m", "r1", 0, 100, "SUCCESS", 1, dt.datetime(2020, 1, 1)),
                                (2, "n", "r1", 0, 50, "SUCCESS", 1, dt.datetime(2020, 1, 1))],
                               "module_id int, module_name string, run_id string, from_ts long, until_ts long, "
                               "status string, written_rows long, recorded_at timestamp")
    assert compute_window(st, ModuleSpec(1, "m", depends_on=(2,)), 10**12, 0) == (100, 100)
    assert compute_window(st, ModuleSpec(2, "n"), 10**12, 0)[0] == 50
    assert run_status(5, 5, False) .startswith("EMPTY")
