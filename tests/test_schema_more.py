import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import schema as S


def test_names_and_requirements(spark):
    df = spark.sql("select 1 as A, named_struct('x', 1) as s")
    assert S.suffix_cols(df, "_r").columns == ["a_r", "s_r"]
    assert S.suffix_cols(df, "_r", ["A"], case_sensitive=True).columns == ["A_r", "s"]
    S.require_fields(df, ["a", "s.x"])
    with pytest.raises(ValueError):
        S.require_fields(df, ["s.y"])
    assert S.has_field_named(df, "S.X") and not S.has_field_named(df, "s.x", case_sensitive=True) is False
    assert S.col_by_name(df, "zzz").dataType == T.StringType()


def test_struct_helpers(spark):
    df = spark.sql("select named_struct('a', 1) as s, map('k1', 'v1') as m")
    out = S.append_to_struct(df, "s", {"b": F.lit(2), "a": F.lit(9)})
    assert out.first()["s"]["a"] == 1 and out.first()["s"]["b"] == 2
    out2 = S.append_to_struct(df, "s", {"a": F.lit(9)}, override=True, new_name="s2")
    assert out2.first()["s2"]["a"] == 9
    ms = df.select(S.map_to_struct(F.col("m"), ["k1", "k2"]).alias("t")).first()["t"]
    assert ms["k1"] == "v1" and ms["k2"] is None
    assert df.select(S.handle_root_null(df, "nope", F.lit(1), T.IntegerType()).alias("x")).first()["x"] is None
    assert df.select(S.handle_root_null(df, "s", F.lit(1), T.IntegerType()).alias("x")).first()["x"] == 1


def test_case_conflicts(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.sql("select named_struct('DataSourceId', cast(null as string), 'dataSourceId', 'x') as rp")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    out = S.resolve_case_conflicts(df, "rp", {"DataSourceId": "dataSourceId"})
    assert out.schema["rp"].dataType.fieldNames() == ["DataSourceId"]
    assert out.first()["rp"]["DataSourceId"] == "x"


def test_structify_and_array_cleanup(spark):
    df = spark.createDataFrame([('{"a": 1}', '[{"b": "x"}]')], "j1 string, j2 string")
    out = S.structify_json_cols(df, {"j1": "struct<a:int>", "j2": "array<struct<b:string>>"})
    assert out.first()["j1"]["a"] == 1 and out.first()["j2"][0]["b"] == "x"
    arr = spark.sql("select array(named_struct('k', 1, 'tags', named_struct('t1', 'a', 't2', cast(null as string))))"
                    " as xs")
    et = arr.schema["xs"].dataType.elementType
    cleaned = arr.select(S.clean_array_of_structs(F.col("xs"), et, ["tags"]).alias("xs")).first()["xs"][0]
    assert cleaned["tags"] == {"t1": "a"} and cleaned["k"] == 1


def test_publish_and_drop_alias(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string").alias("a")
    b = spark.createDataFrame([(1, "y")], "k int, v string").alias("b")
    j = a.join(b, F.col("a.k") == F.col("b.k"))
    assert S.drop_by_alias(j, "b", ["k", "v"]).columns == ["k", "v"]
    assert S.publish(a, {"key": "k", "upper_v": F.upper("v")}).columns == ["key", "upper_v"]
