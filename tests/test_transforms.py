from __future__ import annotations

import re

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import TransformFailure, UnificationError
from lakegate.operators.transforms import (
    CastSchema,
    Filter,
    Flatten,
    NormalizeTimestamps,
    RenameColumns,
    SelectColumns,
    advisory_schema,
    cast_rejects,
    compose,
    zone_irregularities,
)
from lakegate.operators.unify import concat_shards, unify


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (3, None, 3.5)], "id bigint, name string, value double")


def cast(df, **types):
    return CastSchema(T.StructType([T.StructField(n, t) for n, t in types.items()]))(df)


def test_null_predicate_drops_the_row(people):
    assert [r.id for r in Filter(F.col("name") != "a")(people).collect()] == [2]


def test_select_needs_columns_and_names_what_is_missing(people):
    with pytest.raises(ValueError):
        SelectColumns([])
    with pytest.raises(TransformFailure, match="nope.*id, name, value"):
        SelectColumns(["id", "nope"])(people)


def test_rename_checks_sources_and_targets(people):
    with pytest.raises(TransformFailure, match="nope"):
        RenameColumns({"nope": "x"})(people)
    with pytest.raises(TransformFailure, match="duplicated"):
        RenameColumns({"name": "id"})(people)


def test_steps_see_the_live_schema(people):
    steps = compose([RenameColumns({"value": "amount"}), SelectColumns(["amount"])])
    assert steps(people).columns == ["amount"]
    assert steps.names == ["RenameColumns", "SelectColumns"]
    with pytest.raises(TransformFailure):
        compose([SelectColumns(["id"]), RenameColumns({"value": "x"})])(people)
    assert compose([])(people) is people


@pytest.mark.parametrize(
    "value, source, target",
    [
        (99999999999, T.LongType(), T.IntegerType()),
        (1.5, T.DoubleType(), T.LongType()),
        (float("nan"), T.DoubleType(), T.LongType()),
        (2**53 + 1, T.LongType(), T.DoubleType()),
        (0.1, T.DoubleType(), T.FloatType()),
        ("x1", T.StringType(), T.LongType()),
        (1.239, T.DoubleType(), T.DecimalType(6, 2)),
        (1e9, T.DoubleType(), T.DecimalType(6, 2)),
        (datetime(2024, 1, 1, 5), T.TimestampNTZType(), T.DateType()),
        ("2024-01-01 10:30:00", T.StringType(), T.DateType()),
        ("2024-01-01T00:00:00", T.StringType(), T.DateType()),
        ("2024-01-01 10:30:00 +05:00", T.StringType(), T.TimestampNTZType()),
        ("2024-01-01T10:30:00Z", T.StringType(), T.TimestampNTZType()),
        ("2024-01-01 10:30:00 Europe/Paris", T.StringType(), T.TimestampNTZType()),
        ("10:30", T.StringType(), T.TimestampType()),
        ("2024-01-01 10:30:00.1234567", T.StringType(), T.TimestampType()),
        (bytearray(b"\xffA"), T.BinaryType(), T.StringType()),
        ("1.239", T.StringType(), T.DecimalType(5, 2)),
        ("1239e-3", T.StringType(), T.DecimalType(5, 2)),
        ("123456789012345678901", T.StringType(), T.DoubleType()),
        ("1.23456789", T.StringType(), T.FloatType()),
        ("1e400", T.StringType(), T.DoubleType()),
        ("1e-400", T.StringType(), T.DoubleType()),
        ("12.5", T.StringType(), T.LongType()),
        ("maybe", T.StringType(), T.BooleanType()),
        (2**63 - 1, T.LongType(), T.TimestampType()),
        (float("inf"), T.DoubleType(), T.TimestampType()),
    ],
)
def test_lossy_casts_raise(spark, value, source, target):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", source)]))
    with pytest.raises(PySparkException):
        cast(df, v=target).collect()


@pytest.mark.parametrize(
    "value, source, target, want",
    [
        (7, T.IntegerType(), T.LongType(), 7),
        (2.0, T.DoubleType(), T.LongType(), 2),
        (2**53, T.LongType(), T.DoubleType(), float(2**53)),
        (None, T.LongType(), T.IntegerType(), None),
        ("42", T.StringType(), T.LongType(), 42),
        (float("nan"), T.DoubleType(), T.FloatType(), "nan"),
        (" 2024-01-02 ", T.StringType(), T.DateType(), date(2024, 1, 2)),
        ("2024-01-02 10:30:00.120000000", T.StringType(), T.TimestampNTZType(), datetime(2024, 1, 2, 10, 30, 0, 120000)),
        (None, T.StringType(), T.DateType(), None),
        (bytearray("é".encode()), T.BinaryType(), T.StringType(), "é"),
        ("1.2300", T.StringType(), T.DecimalType(5, 2), Decimal("1.23")),
        ("123e-2", T.StringType(), T.DecimalType(5, 2), Decimal("1.23")),
        ("0.1", T.StringType(), T.DoubleType(), 0.1),
        ("1200000000000000000000", T.StringType(), T.DoubleType(), 1.2e21),
        ("0.30000000000000004", T.StringType(), T.DoubleType(), 0.1 + 0.2),
        ("-0.0", T.StringType(), T.DoubleType(), 0.0),
        ("Infinity", T.StringType(), T.DoubleType(), float("inf")),
        ("NaN", T.StringType(), T.DoubleType(), "nan"),
        ("yes", T.StringType(), T.BooleanType(), True),
    ],
)
def test_exact_casts_pass(spark, value, source, target, want):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", source)]))
    got = cast(df, v=target).first().v
    assert str(got) == "nan" if want == "nan" else got == want


def test_rejects_are_the_cells_that_raise(spark):
    df = spark.createDataFrame([(1, "7", "2024-01-01"), (2, "x", None), (3, None, "2024-01-01 05:00")], "id int, n string, d string")
    target = T.StructType.fromDDL("n int, d date")
    found = sorted(map(tuple, cast_rejects(df, target, ["id"]).collect()))
    assert found == [(2, "n", "int", "loss", "x"), (3, "d", "date", "loss", "2024-01-01 05:00")]
    assert cast_rejects(df, T.StructType.fromDDL("n string"), ["id"]).collect() == []
    with pytest.raises(TransformFailure, match="nested"):
        cast_rejects(df.withColumn("a", F.array("n")), T.StructType.fromDDL("a array<int>"), ["id"])


def test_cast_needs_the_same_names(people):
    with pytest.raises(TransformFailure):
        cast(people, id=T.LongType())


def ntz(spark, *values):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("ts", T.TimestampNTZType())]))


def test_naive_timestamps_become_instants(spark):
    df = NormalizeTimestamps("America/New_York")(ntz(spark, datetime(2024, 1, 1, 12), datetime(2024, 7, 1, 12), None))
    assert df.schema["ts"].dataType == T.TimestampType()
    micros = [r.m for r in df.select(F.unix_micros("ts").alias("m")).collect()]
    assert micros == [1704128400000000, 1719849600000000, None]


@pytest.mark.parametrize("local", [datetime(2020, 11, 1, 1, 30), datetime(2021, 3, 14, 2, 30), datetime(2099, 11, 1, 1, 30)])
def test_ambiguous_and_missing_local_times_raise(spark, local):
    with pytest.raises(PySparkException):
        NormalizeTimestamps("America/New_York")(ntz(spark, local)).collect()


def test_session_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = NormalizeTimestamps("Asia/Kolkata")(ntz(spark, datetime(2024, 1, 1, 5, 30)))
        assert df.select(F.unix_micros("ts").alias("m")).first().m == 1704067200000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_zone_table_is_known():
    changes = zone_irregularities("Europe/Berlin", 2020, 2020)
    assert changes == (
        (datetime(2020, 3, 29, 2), datetime(2020, 3, 29, 3)),
        (datetime(2020, 10, 25, 2), datetime(2020, 10, 25, 3)),
    )


def test_flatten_depth_lists_nulls_and_collisions(spark):
    df = spark.createDataFrame(
        [((("x",),), [1])], "outer struct<inner:struct<deep:string>>, tags array<bigint>"
    )
    assert Flatten()(df).columns == ["outer.inner", "tags"]
    assert Flatten(2, "_")(df).columns == ["outer_inner_deep", "tags"]
    empty = spark.createDataFrame([(None,)], "a struct<b:string>")
    assert Flatten()(empty).first()[0] is None
    clash = spark.createDataFrame([(("x",), "y")], "a struct<b:string>, `a.b` string")
    with pytest.raises(TransformFailure):
        Flatten()(clash)
    with pytest.raises(ValueError):
        Flatten(0)


def test_advisory_types():
    schema = advisory_schema(
        [{"name": "a", "type": "Integer"}, {"name": "b", "type": "datetime", "nullable": False}, {"name": "c", "type": "?"}]
    )
    assert [f.dataType for f in schema] == [T.LongType(), T.TimestampNTZType(), T.StringType()]
    assert [f.nullable for f in schema] == [True, False, True]


def frame(spark, ddl):
    return spark.createDataFrame([], ddl)


@pytest.mark.parametrize(
    "left, right, want",
    [
        ("v bigint", "v double", "v double"),
        ("v int", "v bigint", "v bigint"),
        ("s string", "s binary", "s binary"),
        ("x int, y int", "x int, z string", "x int, y int, z string"),
        ("s struct<a:int>", "s struct<a:int>", "s struct<a:int>"),
        ("a array<int>", "a array<double>", "a array<double>"),
    ],
)
def test_unify_widens(spark, left, right, want):
    got = unify([frame(spark, left), frame(spark, right)])
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        (f.name, f.dataType.simpleString()) for f in frame(spark, want).schema
    ]


@pytest.mark.parametrize(
    "left, right",
    [
        ("t timestamp", "t timestamp_ntz"),
        ("s struct<a:int>", "s struct<a:int,b:int>"),
        ("v string", "v int"),
        ("v boolean", "v int"),
        ("v date", "v timestamp"),
    ],
)
def test_unify_refuses_mixed_meanings(spark, left, right):
    with pytest.raises(UnificationError):
        unify([frame(spark, left), frame(spark, right)])


def test_shards_need_one_schema(spark):
    with pytest.raises(UnificationError):
        concat_shards([frame(spark, "a int"), frame(spark, "a bigint")])


def test_nested_casts_lose_nothing(spark):
    df = spark.sql("SELECT array(1.0D, 2.0D) AS a, named_struct('x', 3.0D) AS s, map('k', 4L) AS m, TIMESTAMP'2024-01-01 00:00:01Z' AS t")
    good = T.StructType.fromDDL("a array<int>, s struct<y:int>, m map<string,int>, t bigint")
    assert CastSchema(good)(df).first().asDict(True) == {"a": [1, 2], "s": {"y": 3}, "m": {"k": 4}, "t": 1704067201}
    nothing = df.selectExpr("nullif(a, a) AS a", "nullif(s, s) AS s", "m", "t")
    assert CastSchema(good)(nothing).first()[:2] == (None, None)
    for bad in ("array(1.5D) AS a, s, m, t", "a, named_struct('x', 2.7D) AS s, m, t", "a, s, map('k', 99999999999L) AS m, t",
                "a, s, m, TIMESTAMP'2024-01-01 00:00:00.75Z' AS t"):
        with pytest.raises(Exception, match="unsafe cast"):
            CastSchema(good)(df.selectExpr(*[b.strip() for b in re.split(r", (?=a\b|s\b|m\b|t\b|array|named|map|TIME)", bad)])).collect()


def test_target_zone_and_unit(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00.5' AS n, TIMESTAMP'2024-01-01 00:00:00Z' AS i")
    there = NormalizeTimestamps("Europe/Berlin", target_tz="America/New_York", target_unit="ms")(df)
    assert [t for _, t in there.dtypes] == ["timestamp_ntz"] * 2
    assert [str(v) for v in there.first()] == ["2024-07-01 06:00:00.500000", "2023-12-31 19:00:00"]
    with pytest.raises(Exception, match="finer than s"):
        NormalizeTimestamps(target_unit="s")(df).collect()
    late = spark.sql("SELECT TIMESTAMP_NTZ'2250-11-01 01:30:00' AS n")
    with pytest.raises(Exception, match="ambiguous or missing"):
        NormalizeTimestamps("America/New_York")(late).collect()
