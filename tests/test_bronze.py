import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.medallion.bronze import (clean_clusters_snapshot, clean_jobs_snapshot, cluster_events,
                                            spark_events)
from tessera.sources.files import list_files


def _json_df(spark, tmp_path, name, objs):
    p = tmp_path / name
    p.write_text("\n".join(json.dumps(o) for o in objs))
    return spark.read.json(str(p))


def test_jobs_snapshot_cleanup(spark, tmp_path):
    job = {"job_id": 1, "settings": {"name": "j", "tags": {"team": "x", "cost-center": None},
                                     "tasks": [{"task_key": "a", "notebook_task": {"base_parameters": {"p1": "v"}},
                                                "new_cluster": {"custom_tags": {"k": "v"}, "spark_conf": {"a.b": "1"}}}],
                                     "job_clusters": [{"job_cluster_key": "jc",
                                                       "new_cluster": {"spark_env_vars": {"E": "1"}}}]}}
    df = _json_df(spark, tmp_path, "jobs.json", [job, {"job_id": 2, "settings": {"name": "k"}}])
    out = clean_jobs_snapshot(df)
    st = out.schema["settings"].dataType
    assert isinstance(st["tags"].dataType, T.MapType)
    task = st["tasks"].dataType.elementType
    assert isinstance(task["notebook_task"].dataType["base_parameters"].dataType, T.MapType)
    assert isinstance(task["new_cluster"].dataType["spark_conf"].dataType, T.MapType)
    r = out.filter("job_id = 1").first()
    assert r["settings"]["tasks"][0]["new_cluster"]["spark_conf"] == {"a_b": "1"}
    assert r["settings"]["tags"] == {"team": "x"}
    assert out.filter("job_id = 2").first()["settings"]["tasks"] is None


def test_clusters_snapshot_maps(spark, tmp_path):
    df = _json_df(spark, tmp_path, "c.json", [{"cluster_id": "c1", "custom_tags": {"a": "1"}, "spark_conf": {}}])
    out = clean_clusters_snapshot(df)
    assert isinstance(out.schema["custom_tags"].dataType, T.MapType)
    assert isinstance(out.schema["azure_attributes"].dataType, T.MapType)
    assert out.first()["custom_tags"] == {"a": "1"}


def test_cluster_events_pages(spark, tmp_path):
    page = {"events": [{"cluster_id": "c1", "timestamp": 1, "type": "RUNNING",
                        "details": {"attributes": {"custom_tags": {"x": "1"}}, "current_num_workers": 2}}],
            "next_page": None}
    out = cluster_events(_json_df(spark, tmp_path, "ev.json", [page]), "org1")
    r = out.first()
    assert r["organization_id"] == "org1" and r["details"]["attributes"]["custom_tags"] == {"x": "1"}
    assert cluster_events(_json_df(spark, tmp_path, "none.json", [{"next_page": "x"}]), "o").count() == 0


def test_spark_events_bronze(spark, tmp_path):
    d = tmp_path / "logs" / "c1" / "eventlog" / "host1" / "ctx1"
    d.mkdir(parents=True)
    lines = [json.dumps({"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 10,
                         "Properties": {"spark.job.description": "d", "spark.executor.extraClassPath": "x"}}),
             json.dumps({"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": 20}),
             "{not json"]
    (d / "eventlog").write_text("\n".join(lines))
    schema = T.StructType([T.StructField("Event", T.StringType()), T.StructField("Job ID", T.LongType()),
                           T.StructField("Submission Time", T.LongType()), T.StructField("Completion Time", T.LongType()),
                           T.StructField("Timestamp", T.LongType()),
                           T.StructField("Properties", T.StructType([
                               T.StructField("spark.job.description", T.StringType()),
                               T.StructField("spark.executor.extraClassPath", T.StringType())]))])
    listing = list_files(spark, str(tmp_path / "logs"))
    empty = spark.createDataFrame([], "filename string, failed boolean")
    good, bad = spark_events(spark, listing, empty, spark.createDataFrame([], "filename string"), schema, "org1")
    rows = good.orderBy("Event").collect()
    assert [r["Event"] for r in rows] == ["SparkListenerJobEnd", "SparkListenerJobStart"]
    assert rows[0]["clusterId"] == "c1" and rows[0]["SparkContextId"] == "ctx1"
    assert "JobID" in good.columns and rows[1]["Properties"] == {"sparkjobdescription": "d"}
    assert bad.count() == 1
