"""Literal results of the functions."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanfold import types
from fanfold.functions import exprs
from fanfold.functions import scalars as S
from fanfold.sources import typed


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_numbers(spark):
    assert one(spark, S.ceil(F.lit(1000 * 3.4 * 0.2 * 0.8))) == 544
    assert [one(spark, f(F.lit(1.2))) for f in (S.round_, S.floor, S.ceil)] == [1, 1, 2]
    assert one(spark, S.round_(F.lit(-2.5))) == -3 and one(spark, S.round_(F.lit(2.5))) == 3
    assert one(spark, S.divide_int(F.lit(-7), F.lit(2))) == -3
    assert [one(spark, S.modulo(F.lit(n), F.lit(7))) for n in (-1, 8)] == [6, 1]


def test_arrays(spark):
    a = F.array(F.lit(1), F.lit(None), F.lit(100))
    assert one(spark, S.select_all(a)) == [1, 100]
    assert one(spark, S.range_(F.lit(0))) == [] and one(spark, S.range_(F.lit(4))) == [0, 1, 2, 3]
    assert [tuple(x) for x in one(spark, S.zip_(F.array(F.lit(1), F.lit(2)), F.array(F.lit("a"), F.lit("b"))))] == [(1, "a"), (2, "b")]
    assert one(spark, S.flatten(F.expr("array(array(1), null, array(2, 3))"))) == [1, 2, 3]
    assert one(spark, S.transpose(F.expr("array(array(1, 2, 3), array(4, 5, 6))"))) == [[1, 4], [2, 5], [3, 6]]
    assert one(spark, S.transpose(F.expr("array(array(1)) "))) == [[1]]
    assert [x.left + 5 for x in one(spark, S.as_pairs(F.expr("map(1, 1.2, 10, 113.0)")))] == [6, 15]
    assert one(spark, S.item_at(F.array(F.lit("a"), F.lit("b")), 1)) == "b"


@pytest.mark.parametrize(
    "bad",
    [
        lambda: S.zip_(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))),
        lambda: S.transpose(F.expr("array(array(1, 2), array(3))")),
        lambda: S.non_empty(F.expr("array()")),
        lambda: S.item_at(F.array(F.lit(1)), 1),
        lambda: S.select_first(F.lit(None).cast("int")),
        lambda: S.memory_mib(F.lit("many")),
        lambda: S.split_url(F.lit("ftp://a/b")),
    ],
)
def test_errors(spark, bad):
    with pytest.raises(PySparkException):
        one(spark, bad())


def test_text(spark):
    assert one(spark, S.interpolate("a ~{x} ${y}", "0", x=F.lit(None).cast("string"), y=F.lit(3))) == "a 0 3"
    assert one(spark, S.join_str(F.array(F.lit(6), F.lit(7), F.lit(8)), " INPUT=")) == "6 INPUT=7 INPUT=8"
    assert one(spark, S.basename(F.lit("a/b.bam"), ".bam")) == "b" and one(spark, S.basename(F.lit("b.bam"), "x")) == "b.bam"
    assert [one(spark, S.sub(F.lit(x), "_.*$", "")) for x in ("1_ACGT_1.bam", "2_TCCT_1.bam")] == ["1", "2"]
    assert one(spark, S.unqualified(F.lit("a.b.c"))) == "c"
    assert one(spark, S.clean_text(F.lit('a"b\nc'))) == "a b c"
    assert one(spark, S.same_folder(F.lit("/a/b"), F.lit("/c/b"))) is False
    day = F.lit(datetime.datetime(2020, 3, 1, 4, 5, 6))
    assert one(spark, S.archive_name(F.lit("x"), day)) == "x Sun Mar 01 04:05:06 2020"


def test_labels(spark):
    a = F.array(F.lit(100), F.lit(200), F.lit(300))
    assert one(spark, S.limited_label(a, 10)) == "[100, 200]"
    assert one(spark, S.limited_label(F.expr("array()").cast("array<int>"), 10)) == "[]"
    assert one(spark, S.limited_label(a, 1)) == "[100]"
    assert one(spark, S.item_label(F.lit("dx://p:/f/name.txt"), T.StringType())) == "name.txt"
    assert one(spark, S.item_label(F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4)), T.ArrayType(T.IntegerType()))) == "[1, 2, 3]"


def test_requests(spark):
    sizes = [one(spark, S.memory_mib(F.lit(x))) for x in ("230MB", "230MiB", "230GB", "230GiB", "1048576")]
    assert sizes == [219, 230, 219345, 235520, 1]
    assert one(spark, S.disk_gib(F.lit("local-disk 1024 HDD"))) == 1024 and one(spark, S.cpu_count(F.lit("2.7"))) == 2
    assert tuple(one(spark, S.duration(F.lit("1D6H30M")))) == (1, 6, 30, 1830) and one(spark, S.duration(F.lit("soon"))) is None


def test_urls(spark):
    parts = tuple(one(spark, S.split_url(F.lit("dx://proj:/a/b/c.txt"))))
    assert parts == ("dx", "proj", None, "/a/b", "c.txt")
    assert tuple(one(spark, S.split_url(F.lit("dx://proj:file-1::/c.txt")))) == ("dx", "proj", "file-1", "/", "c.txt")
    assert tuple(one(spark, S.split_url(F.lit("/x/y"))))[0] == "file"


def test_digest_ignores_column_order(spark):
    df = spark.range(1).select(F.lit(1).alias("b"), F.lit("x").alias("a"))
    assert df.select(S.row_digest("a", "b")).first() == df.select(S.row_digest("b", "a")).first()


def test_with_exprs_and_binding(spark):
    df = spark.createDataFrame([({"a": "1"},), ({"a": "2", "b": "7", "c": None},)], "m map<string,string>")
    out = exprs.bind_inputs(df, "m", [("a", "int", "required", None), ("b", "int", "default", "a + 1"), ("c", "string", "optional", None), ("d", "int", "fixed", "5")])
    assert [tuple(r)[1:] for r in out.orderBy("a").collect()] == [(1, 2, None, 5), (2, 7, None, 5)]
    with pytest.raises(PySparkException):
        exprs.bind_inputs(df, "m", [("z", "int", "required", None)]).collect()
    with pytest.raises(PySparkException):
        exprs.bind_inputs(df, "m", [("a", "int", "fixed", "1")]).collect()
    spec = [("a", "array<struct<left:int,right:string>>", "required", None), ("b", "map<int,array<int>>", "optional", None), ("c", "array<int>", "default", "array(size(a))")]
    rows = [({"a": '[[1,"x"],{"left":2,"right":"y"}]', "b": '{"7":[1,null]}'},), ({"a": "[]", "b": "null", "c": "[3]"},), ({"a": "[null]", "c": "null"},)]
    nested = exprs.bind_inputs(spark.createDataFrame(rows, "m map<string,string>"), "m", spec).select("a", "b", "c")
    assert sorted(map(repr, (r.asDict(recursive=True) for r in nested.collect()))) == sorted(map(repr, [
        {"a": [{"left": 1, "right": "x"}, {"left": 2, "right": "y"}], "b": {7: [1, None]}, "c": [2]}, {"a": [], "b": None, "c": [3]}, {"a": [None], "b": None, "c": None}]))
    for bad in ("[1", "{}", "7", "", "[x]"):
        with pytest.raises(PySparkException):
            exprs.bind_inputs(spark.createDataFrame([({"b": bad},)], "m map<string,string>"), "m", [("b", "array<int>", "optional", None)]).collect()
    with pytest.raises(ValueError):
        exprs.with_exprs(df, [("x", "y + 1", "int"), ("y", "x + 1", "int")])
    assert one(spark, exprs.coerce(F.lit("4.2"), "int")) == 4 and one(spark, exprs.coerce(F.lit(3.9), "int")) == 3
    assert exprs.unrename(exprs.rename_flat(spark.range(1).toDF("a.b"))).columns == ["a.b"]


@pytest.mark.parametrize("style", ["internal", "platform"])
@pytest.mark.parametrize(
    "kind,value",
    [
        (T.MapType(T.StringType(), T.IntegerType()), {"a": 1, "b": None}),
        (T.MapType(T.IntegerType(), T.ArrayType(T.StringType())), {3: ["x", None], 4: []}),
        (T.ArrayType(types.pair(T.IntegerType(), T.StringType())), [(1, "x"), (2, None)]),
        (T.IntegerType(), 5),
        (T.ArrayType(T.DoubleType()), None),
    ],
)
def test_typed_json_round_trip(spark, style, kind, value):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", kind)]))
    back = df.select(typed.decode_typed(typed.encode_typed("x", kind, style), kind, style).alias("x")).first().x
    assert back == df.first().x


def test_read_inputs(spark):
    schema = T.StructType([T.StructField("p", T.ArrayType(types.pair(T.StringType(), T.IntegerType()))), T.StructField("m", T.MapType(T.IntegerType(), T.StringType())), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([('{"p": [["a", 1], {"left": "b", "right": 2}], "m": {"1": "x", "##c": "y"}, "n": 3, "##": 1}',)], "j string")
    r = typed.read_inputs(df, "j", schema).first()
    assert [tuple(x) for x in r.p] == [("a", 1), ("b", 2)] and r.m == {1: "x"} and r.n == 3


def test_type_names():
    for name in ("Boolean", "Map[Integer, MaybeEmptyArray[String]]", "Pair[Float, Long]"):
        assert types.to_name(types.from_name(name)) == name
    assert isinstance(types.from_name("Map[Map[Integer, Integer], String]"), T.ArrayType)
    for bad in ("Nope", "Option[Option[Integer]]"):
        with pytest.raises(ValueError):
            types.from_name(bad)
