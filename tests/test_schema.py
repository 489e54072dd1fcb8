import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import schema as S


def _ddl(df):
    return df.schema.simpleString()


def test_clean_names_of_columns(spark):
    df = spark.sql("select 1 as `unit price`, 2 as `net/gross`, 3 as `x_UNIQUESUFFIX_1`, null as `gap`")
    assert S.scrub_schema(df).columns == ["unitprice", "net_gross", "x_UNIQUESUFFIX__1", "gap"]
    assert S.scrub_schema(df, drop_void=True).columns == ["unitprice", "net_gross", "x_UNIQUESUFFIX__1"]


def test_clean_names_inside_arrays_and_structs(spark):
    df = spark.sql("select array(named_struct('speed km/h', 8, 'ok', 'y')) as `all laps`, named_struct('a.b', named_struct('c d', 5)) as best")
    out = S.scrub_schema(df)
    assert out.columns == ["alllaps", "best"]
    assert out.schema["alllaps"].dataType.elementType.fieldNames() == ["speedkm_h", "ok"]
    assert out.first()["alllaps"][0]["speedkm_h"] == 8 and out.first()["best"]["a_b"]["cd"] == 5


def test_special_rules_go_down_structs_but_not_arrays(spark):
    leaf = T.StructType([T.StructField("p.q", T.LongType()), T.StructField("p q", T.LongType()), T.StructField("PQ", T.StringType()), T.StructField("r-s", T.LongType())])
    top = T.StructType([T.StructField("in.ner", leaf), T.StructField("li.st", T.ArrayType(leaf))])
    df = spark.createDataFrame([], T.StructType([T.StructField("conf", top), T.StructField("a.b", T.StringType())]))
    no_dots = (S.NameRule(r"\.", ""), S.NameRule(r"\s", ""), S.NameRule("[^a-zA-Z0-9]", "_"))
    out = S.scrub_schema(df, [S.FieldRules(df.schema["conf"], no_dots)])
    conf = out.schema["conf"].dataType
    assert out.columns == ["conf", "a_b"] and conf.fieldNames() == ["inner", "list"]
    h = {n: S.java_string_hash(n) for n in ("p.q", "p q", "PQ")}
    # the suffix comes after the rules of this struct; rules of the struct around it come first
    assert conf["inner"].dataType.fieldNames() == [f"pq_UNIQUESUFFIX_{h['p.q']}", f"pq_UNIQUESUFFIX_{h['p q']}", f"PQ_UNIQUESUFFIX_{h['PQ']}", "r_s"]
    assert conf["list"].dataType.elementType.fieldNames() == ["p_q", f"pq_UNIQUESUFFIX_{h['p q']}", f"PQ_UNIQUESUFFIX_{h['PQ']}", "r_s"]
    kept = S.scrub_schema(df, [S.FieldRules(df.schema["conf"], no_dots)], case_sensitive=True).schema["conf"].dataType
    assert kept["inner"].dataType.fieldNames()[2] == "PQ"


def test_java_hash():
    # String.hashCode by its definition: sum of code units times powers of 31, as a signed 32-bit number
    for s in ("", "a", "unit price", "Zürich", "\U0001f600", "z" * 40):
        units = [int.from_bytes(s.encode("utf-16-be")[i:i + 2], "big") for i in range(0, 2 * len(s.encode("utf-16-be")) // 2, 2)]
        h = sum(u * 31 ** (len(units) - 1 - i) for i, u in enumerate(units)) % 2 ** 32
        assert S.java_string_hash(s) == (h - 2 ** 32 if h >= 2 ** 31 else h)


def test_flatten_and_names(spark):
    df = spark.sql("select named_struct('abc', 'x', 'c_145', 1L) as b222, 1L as i1")
    assert S.flatten(df).columns == ["b222_abc", "b222_c_145", "i1"]
    assert S.all_column_names(df.schema) == ["b222.abc", "b222.c_145", "i1"]


def test_cull_nested(spark):
    df = spark.sql("select 1L as id, named_struct('c1', 1, 'c2', 2, 'c3', named_struct('d', 1)) as value")
    out = S.cull_nested(df, "value", ["c1", "c2"])
    assert out.schema["value"].dataType.fieldNames() == ["c3"]
    with pytest.raises(ValueError):
        S.cull_nested(df, "value", ["c3.d"])
    with pytest.raises(ValueError):
        S.cull_nested(df, "value", ["c$"])


def test_struct_from_json(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2}',), ("not json",), (None,)], "j string")
    out = S.struct_from_json(df, "j")
    st = out.schema["j"].dataType
    assert set(st.fieldNames()) == {"a", "b"}
    vals = sorted([r["j"]["a"] for r in out.collect() if r["j"] is not None and r["j"]["a"] is not None])
    assert vals == [1, 2]
    with pytest.raises(TypeError):
        S.struct_from_json(spark.createDataFrame([(1,)], "j int"), "j")
    allnull = S.struct_from_json(spark.createDataFrame([(None,)], "j string"), "j")
    assert isinstance(allnull.schema["j"].dataType, T.NullType)


def test_struct_to_map(spark):
    df = spark.sql("select named_struct('k1', cast(null as string), 'k2', 'v') as s")
    m = df.select(S.struct_to_map(df, "s")).first()[0]
    assert m == {"k2": "v"}
    m2 = df.select(S.struct_to_map(df, "s", drop_empty=False)).first()[0]
    assert m2 == {"k1": None, "k2": "v"}
    absent = df.select(S.struct_to_map(df, "nope"))
    assert absent.schema.fields[0].dataType == T.MapType(T.StringType(), T.StringType(), True)


def test_modify_struct(spark):
    df = spark.sql("select named_struct('c1', 1, 'st1', named_struct('c11', 1, 'c12', 2), "
                   "'st2', named_struct('c21', 1)) as st")
    whole = S.apply_modify_struct(df, {"st": F.lit("replaced")})
    assert whole.first()["st"] == "replaced"
    child = S.apply_modify_struct(df, {"st.st1": F.lit(7)})
    r = child.first()["st"]
    assert r["st1"] == 7 and r["st2"]["c21"] == 1 and r["c1"] == 1
    nul = spark.sql("select cast(null as struct<c1:int, st1:struct<c11:int>>) as st")
    assert S.apply_modify_struct(nul, {"st.st1": F.lit(1)}).first()["st"] is None


def test_cull_null(spark):
    schema = ("myString string, myMap map<string,int>, myArray array<int>, myBoolean boolean, myDate date, "
              "myTimestamp timestamp, myStruct struct<sc1:string, sc2:bigint>")
    df = spark.createDataFrame([("a", None, None, None, None, None, None), (None, None, [1], None, None, None, None)],
                               schema)
    assert S.cull_null(df).columns == ["myString", "myArray"]


def test_move_to_front(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field1 int, field2 int, field3 int")
    assert S.move_to_front(df, ["field3", "field2"]).columns == ["field3", "field2", "field1"]


def test_verify_minimum_schema(spark):
    df = spark.createDataFrame([(1, "2", "x")], "a int, b string, extra string")
    req = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.IntegerType()),
                        T.StructField("missing", T.StringType(), True)])
    out = S.verify_minimum_schema(df, req)
    assert out.columns == ["missing", "extra", "a", "b"]
    assert out.schema["a"].dataType == T.LongType() and out.first()["b"] == 2
    with pytest.raises(S.SchemaValidationError):
        S.verify_minimum_schema(df, T.StructType([T.StructField("must", T.StringType(), False)]))
    with pytest.raises(S.SchemaValidationError):
        S.verify_minimum_schema(df, T.StructType([T.StructField("b", T.StructType([T.StructField("z", T.IntegerType())]))]))


def test_verify_minimum_schema_array_of_struct(spark):
    df = spark.sql("select array(named_struct('x', 1)) as arr")
    req = T.StructType([T.StructField("arr", T.ArrayType(T.StructType([T.StructField("x", T.LongType()),
                                                                       T.StructField("y", T.StringType())])))])
    r = S.verify_minimum_schema(df, req).first()["arr"][0]
    assert r["x"] == 1 and r["y"] is None


def test_null_type_strips_field(spark):
    df = spark.createDataFrame([(1, "o")], "a int, orgId string")
    out = S.verify_minimum_schema(df, T.StructType([T.StructField("orgId", T.NullType())]))
    assert out.columns == ["a"]


def test_promote_and_union(spark):
    df = spark.sql("select 1 as id, named_struct('x', 1, 'y', 2) as s")
    assert S.promote_struct(df, "s").columns == ["id", "x", "y"]
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(2, "z")], "a int, b string")
    assert S.union_missing_as_null(a, b).count() == 2


def test_fill_all_nas(spark):
    df = spark.createDataFrame([(None, None, None)], "i int, s string, b boolean")
    assert tuple(S.fill_all_nas(df).first()) == (0, "0", False)
