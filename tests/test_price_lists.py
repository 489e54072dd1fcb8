"""Price lists of the state fact are broadcast: no row is shuffled by its SKU or node type."""

import datetime as dt
import re

from tests.conftest import rows
from tessera.operators.timeseries import TimeSeries
from tessera.plans.medallion.gold import _value_before, cluster_state_fact
from tessera.plans.medallion.silver import cluster_state_detail


def test_value_before_equals_the_lookup(spark):
    left = spark.createDataFrame([(k, s, t, i) for i, (k, s, t) in enumerate(
        (k, s, t) for k in ("o", None) for s in ("a", "b", None) for t in (None, 0, 10, 11, 20, 25, 25, 40))], "organization_id string, sku string, timestamp long, n int")
    changes = spark.createDataFrame([("o", "a", 10, 1.0), ("o", "a", 10, 3.0), ("o", "a", 10, 2.0), ("o", "a", 20, None), ("o", "a", 25, 4.0),
                                     ("o", None, 5, 5.0), (None, "a", 5, 6.0), (None, None, None, 7.0), (None, None, 11, 8.0), ("o", "b", 99, 9.0)],
                                    "organization_id string, sku string, timestamp long, dbu_rate double")
    keys = ["organization_id", "sku"]
    want = TimeSeries(left, "timestamp", keys).lookup_when(TimeSeries(changes, "timestamp", keys))
    cols = [*keys, "timestamp", "n", "dbu_rate"]
    assert rows(_value_before(left, changes, keys, "timestamp", "dbu_rate"), *cols) == rows(want, *cols)


def test_no_row_is_shuffled_by_price_key(spark):
    events = spark.createDataFrame([("o", "c1", 10, "CREATING", (((None, None), 2), 2, 2))],
                                   "organization_id string, cluster_id string, timestamp long, type string, details struct<cluster_size:struct<autoscale:"
                                   "struct<max_workers:bigint,min_workers:bigint>,num_workers:bigint>,current_num_workers:bigint,target_num_workers:bigint>")
    spec = spark.createDataFrame([("o", "c1", "n", None, 5, "m5", "m5", "13.3", "Standard", "STANDARD")],
                                 "organization_id string, cluster_id string, cluster_name string, custom_tags string, timestamp long, driver_node_type_id string, "
                                 "node_type_id string, spark_version string, cluster_type string, runtime_engine string")
    inst = spark.createDataFrame([("o", "m5", 4, 1.0, 0.2, dt.date(1970, 1, 1), None)], "organization_id string, API_Name string, vCPUs int, Hourly_DBUs double, "
                                 "Compute_Contract_Price double, activeFrom date, activeUntil date")
    dbu = spark.createDataFrame([("o", "interactive", 0.55, dt.date(1969, 1, 1))], "organization_id string, sku string, contract_price double, activeFrom date")
    fact = cluster_state_fact(cluster_state_detail(events, 1000), spec, None, inst, dbu, 1000)
    assert [r["dbu_rate"] for r in fact.collect()] == [0.55]
    plan = fact._jdf.queryExecution().sparkPlan().toString() + fact._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)", plan)
    assert dealt and not [x for x in dealt if "__f__k" in x or "node_type" in x]
