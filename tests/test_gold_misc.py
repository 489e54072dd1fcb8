"""Small builders: audit log bronze, query history, applications, login/spark-job gold,
consumer views, pipeline report, audit helpers."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.columns import clean_description, cluster_id_from_audit
from tessera.plans.medallion.bronze import audit_log
from tessera.plans.medallion.gold import login_gold, pipeline_report, publish_consumer_views, spark_job_gold
from tessera.plans.medallion.silver import applications, sql_query_history


def test_audit_log_bronze_and_cluster_id(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        raw = spark.sql("""select 'clusters' as serviceName, 'create' as actionName,
            named_struct('cluster_id', cast(null as string), 'clusterId', cast(null as string),
                         'DataSourceId', cast(null as string), 'dataSourceId', 'ds1', 'orgId', 'x') as requestParams,
            named_struct('result', '{"cluster_id": "c9"}') as response""")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    out = audit_log(raw, {"DataSourceId": "dataSourceId"})
    fields = out.schema["requestParams"].dataType.fieldNames()
    assert "orgId" not in fields and "dataSourceId" not in fields
    assert out.first()["requestParams"]["DataSourceId"] == "ds1"
    assert out.select(cluster_id_from_audit()).first()[0] == "c9"
    d = spark.createDataFrame([("a<br/>b\nc  ",)], "d string")
    assert d.select(clean_description("d")).first()[0] == "a b c"


def test_history_apps_login_and_jobs(spark):
    qh = spark.createDataFrame([(1, (10, 20))], "id int, metrics struct<rows:int, ms:int>")
    assert sql_query_history(qh).columns == ["id", "rows", "ms"]
    ev = spark.createDataFrame([("o", "c", "ctx", "SparkListenerApplicationStart", "app-1", "nb", 1_700_000_000_000)],
                               "organization_id string, clusterId string, SparkContextID string, Event string, "
                               "AppID string, AppName string, Timestamp long")
    assert applications(ev).first()["appId"] == "app-1"
    logins = spark.createDataFrame([("u@x", "login")], "login_user string, login_type string")
    users = spark.createDataFrame([("u@x", "9"), ("u@x", "7")], "email string, user_id string")
    lg = login_gold(logins, users).collect()
    assert len(lg) == 1 and lg[0]["user_id"] == "7"  # repeated lookups never multiply logins
    jobs = spark.createDataFrame([
        ("o", "c", "iso", "g_x_job-5-run-9", "e1", None, 2), ("o", "c", "iso", "grp", "e1", "a@x", 1)],
        "organization_id string, cluster_id string, isolation_id string, job_group_id string, execution_id string, "
        "user_email string, startTimestamp long")
    sj = {r["job_group_id"]: r for r in spark_job_gold(jobs).collect()}
    assert sj["g_x_job-5-run-9"]["user_email_imputed"] == "a@x"
    assert sj["g_x_job-5-run-9"]["db_job_id"] == "5" and sj["g_x_job-5-run-9"]["db_id_in_job"] == "9"


def test_views_and_report(spark):
    fact = spark.createDataFrame([("o", "c", 1.0)], "organization_id string, cluster_id string, total_cost double")
    made = publish_consumer_views(spark, {"clusterstatefact": fact}, prefix="v_")
    assert made == ["v_clusterstatefact"]
    assert spark.table("v_clusterstatefact").columns == ["organization_id", "cluster_id", "total_cost"]
    st = spark.createDataFrame([(1, "m", "r1", 0, 1000, "SUCCESS", 3, dt.datetime(2020, 1, 1)),
                                (2, "n", "r1", 0, 1000, "EMPTY", 0, dt.datetime(2020, 1, 2))],
                               "module_id int, module_name string, run_id string, from_ts long, until_ts long, "
                               "status string, written_rows long, recorded_at timestamp")
    rep = pipeline_report(st).collect()
    assert [r["module_id"] for r in rep] == [2, 1] and rep[0]["until_time"] is not None
