import datetime as dt
import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdelta import functions as S
from snapdelta.functions.types import catalog_type


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_row_hash_joins_columns(spark, rows):
    df = spark.createDataFrame([("x", None, "y"), ("x", "y", None)], "a STRING, b STRING, c STRING")
    assert rows(df.select(S.row_hash(["a", "b", "c"]))) == [(sha("x|||y"),)] * 2
    safe = {r[0] for r in df.select(S.row_hash(["a", "b", "c"], null_safe=True)).collect()}
    assert safe == {sha("010|||x|||y"), sha("001|||x|||y")}
    assert rows(df.limit(1).select(S.row_hash(["a", "b", "c"], sep="||"))) == [(sha("x||y"),)]


def test_row_hash_accepts_nested_columns(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', array(1, 2)) AS s, map('k', 1) AS m")
    got = df.select(S.row_hash(S.text_columns(df))).first()[0]
    assert got == sha('1|||{"x":1,"y":[1,2]}|||{"k":1}')


def test_add_row_hash_sorts_and_excludes(spark):
    df = spark.createDataFrame([(2, "x", None)], "b INT, a STRING, c STRING")
    assert S.add_row_hash(df).first()["row_hash"] == sha('{"a":"x","b":2}')
    assert S.add_row_hash(df, exclude=["b"], hash_col="h").first()["h"] == sha('{"a":"x"}')
    assert S.add_row_hash(df.select("c", "b", "a")).first()["row_hash"] == S.add_row_hash(df).first()["row_hash"]


def test_key_and_json(spark):
    df = spark.createDataFrame([("A", 1, None)], "k STRING, v INT, n STRING")
    assert df.select(S.primary_key(["k", "v"])).first()[0] == "A|||1"
    assert df.select(S.primary_key(["k", "n", "v"])).first()[0] == "A|||1"
    assert json.loads(df.select(S.row_json(["k", "v", "n"])).first()[0]) == {"k": "A", "v": 1}


def test_strings(spark, rows):
    df = spark.createDataFrame([(" a ", "Preço Médio-Ã", None)], "x STRING, n STRING, e STRING")
    assert S.clean_strings(df, ["x"]).first()["x"] == "a"
    assert S.clean_strings(df, ["x"], trim=False, upper=True).first()["x"] == " A "
    assert df.select(S.sanitize_name("n")).first()[0] == "preco_medio_ã"
    assert df.select(S.normalize_case("x"), S.normalize_case("n", upper=False)).first()[0] == " A "
    blank = spark.createDataFrame([("",), (None,), ("x",)], "c STRING")
    assert rows(blank.select(S.is_blank("c"))) == [(False,), (True,), (True,)]


def test_hash_changed_is_null_safe(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x STRING, y STRING")
    assert [r[0] for r in df.select(S.hash_changed("x", "y")).collect()] == [False, True, True, False]


def test_dates(spark):
    df = spark.range(1)
    assert df.select(S.as_date("2024-02-29")).first()[0] == dt.date(2024, 2, 29)
    assert df.select(S.year_month(F.lit("2024-02-29").cast("date"))).first()[0] == 202402
    assert S.with_year_month(df.withColumn("d", S.as_date("1999-12-01")), "d").first()["year_month"] == 199912
    assert df.select(S.load_timestamp()).first()[0] is not None


def test_score_and_enum(spark):
    df = spark.createDataFrame([(2, 1, 3), (0, 0, 0), (1, 0, 4)], "n BIGINT, d BIGINT, t BIGINT")
    assert [r[0] for r in df.select(S.quality_score("n", "d", "t")).collect()] == [0.0, None, 75.0]
    ops = spark.createDataFrame([("INSERT",), ("MERGE",)], "op STRING")
    assert [r[0] for r in ops.select(S.valid_operation("op")).collect()] == [True, False]


def test_resolve_ref_date():
    as_of = dt.date(2024, 3, 1)
    assert S.resolve_ref_date(None, as_of) == dt.date(2024, 2, 29)
    assert S.resolve_ref_date("D-1", "2024-03-01") == dt.date(2024, 2, 29)
    assert S.resolve_ref_date("D", as_of) == as_of
    assert S.resolve_ref_date("2023-12-31", as_of) == dt.date(2023, 12, 31)
    with pytest.raises(ValueError):
        S.resolve_ref_date("yesterday", as_of)


@given(st.integers(0, 3000))
def test_resolve_ref_date_counts_back(n):
    base = dt.date(2024, 3, 1)
    assert base - S.resolve_ref_date(f"D-{n}", base) == dt.timedelta(days=n)


def test_build_schema(spark):
    names = ["string", "int", "long", "double", "decimal", "Decimal(18, 4)", "date", "timestamp", "boolean"]
    schema = S.build_schema([{"name": f"c{i}", "type": n, "nullable": i == 0} for i, n in enumerate(names)])
    assert [f.dataType.simpleString() for f in schema] == [
        "string", "int", "bigint", "double", "decimal(38,12)", "decimal(18,4)", "date", "timestamp", "boolean",
    ]
    assert [f.nullable for f in schema] == [True] + [False] * 8
    with pytest.raises(KeyError):
        S.build_schema([{"name": "x", "type": "blob"}])
    df = spark.createDataFrame([("1", "2024-01-01", "z")], "a STRING, b STRING, c STRING")
    cast = S.cast_to(df, S.build_schema([{"name": "b", "type": "date"}, {"name": "a", "type": "long"}]))
    assert cast.dtypes == [("b", "date"), ("a", "bigint")]


def test_warehouse_types():
    kinds = [T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(),
             T.BooleanType(), T.DecimalType(10, 3)]
    assert [S.warehouse_type(k) for k in kinds] == [
        "String", "Int32", "Int64", "Float64", "Date", "DateTime64(3)", "UInt8", "Decimal(10,3)",
    ]
    with pytest.raises(TypeError):
        S.warehouse_type(T.BinaryType())


def test_catalog_types(spark):
    df = spark.createDataFrame([("NUMBER",), ("varchar2",), ("DATE",), ("TIMESTAMP",), ("TIMESTAMP(6)",), ("RAW",)],
                               "t STRING")
    assert [r[0] for r in df.select(catalog_type("t")).collect()] == [
        "Decimal64(2)", "String", "DateTime", "DateTime64(3)", "String", "String",
    ]
    assert df.select(catalog_type("t", sized=True)).collect()[4][0] == "DateTime64(3)"
