import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta import TableSpec
from sedimenta.functions import columns as C
from sedimenta.functions import scalars as S
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "seconds, text",
    [
        (0.5, "500ms"), (1.5, "1.5s"), (90.0, "1.5m"), (3600.0, "1.0h"),
        # Ties and near-ties: exact binary value, half to even.
        (6.55, "6.5s"), (1.25, "1.2s"), (1.75, "1.8s"), (0.0025, "2ms"), (0.0, "0ms"),
        (59.96, "60.0s"), (3599.9, "60.0m"), (360000.0, "100.0h"), (1e10, "2777777.8h"),
    ],
)
def test_format_duration(spark, seconds, text):
    assert one(spark, S.format_duration(F.lit(seconds))) == text


def test_format_duration_matches_exact_rounding(spark):
    values = [i / 100 for i in range(100, 6000, 7)] + [i * 61.37 for i in range(1, 400)]

    def expected(s):
        if s < 60:
            return f"{s:.1f}s"
        return f"{s / 60:.1f}m" if s < 3600 else f"{s / 3600:.1f}h"

    got = spark.createDataFrame([(v,) for v in values], "s double").select(
        "s", S.format_duration("s").alias("t")
    )
    assert {r["s"]: r["t"] for r in got.collect()} == {v: expected(v) for v in values}


@pytest.mark.parametrize("n, d, result", [(10, 2, 5.0), (10, 0, 0.0), (0, 5, 0.0)])
def test_safe_divide(spark, n, d, result):
    assert one(spark, S.safe_divide(F.lit(n), F.lit(d))) == result


@pytest.mark.parametrize("ok, total, result", [(8, 10, 80.0), (0, 10, 0.0), (10, 0, 0.0)])
def test_success_rate(spark, ok, total, result):
    assert one(spark, S.success_rate(F.lit(ok), F.lit(total))) == result


def test_paths(spark):
    stamp = datetime(2024, 1, 15, 10, 30, 45)
    assert one(spark, S.batch_id(F.lit("/data/test_file.parquet"), stamp)) == "test_file_20240115_103045"
    for name, stem, ext in [
        ("a.tar.gz", "a.tar", ".gz"), (".hidden", ".hidden", ""), ("plain", "plain", ""),
    ]:
        path = F.lit(f"/x/{name}")
        assert one(spark, S.file_stem(path)) == stem
        assert one(spark, S.file_extension(path)) == ext
    assert one(spark, S.table_from_path(F.lit("/raw/orders/f.csv"))) == "orders"
    assert one(spark, S.table_from_path(F.lit("f.csv"))) == ""
    assert one(spark, S.table_from_path(F.lit("/raw/o_1.csv"), r"/(\w)_")) == "o"
    assert one(spark, S.table_from_path(F.lit("/raw/x.csv"), r"/(\w)_")) is None


def test_flatten(spark):
    df = spark.range(1).select(
        F.struct(
            F.struct(F.lit(42).alias("value")).alias("level2"), F.lit("test").alias("other")
        ).alias("level1"),
        F.lit("value").alias("simple"),
    )
    flat = C.flatten_struct(df)
    assert flat.columns == ["level1.level2.value", "level1.other", "simple"]
    assert tuple(flat.first()) == (42, "test", "value")
    assert C.flatten_struct(df, "_").columns[0] == "level1_level2_value"


def test_renaming(spark):
    df = spark.range(1).toDF("customerID")
    assert C.sanitize_columns(df, "snake_case").columns == ["customer_id"]
    assert C.sanitize_columns(df).columns == ["customerid"]
    assert C.sanitize_columns(df.toDF("Customer_first_NAME"), "camel_case").columns == [
        "customerFirstName"
    ]
    with pytest.raises(ValueError, match="kebab"):
        C.sanitize_columns(df, "kebab")
    with pytest.raises(ValueError, match="collide"):
        C.sanitize_columns(spark.range(1).select(F.lit(1).alias("a_b"), F.lit(2).alias("aB")), "snake_case")


def test_transformations(spark):
    df = spark.range(4)
    out = C.apply_transformations(
        df,
        {"add_columns": {"x": "id * 2", "y": F.col("x") + 1}, "filter": "y > 3", "select": ["y"]},
    )
    assert rows(out) == [(5,), (7,)]
    assert C.apply_transformations(df, None) is df
    with pytest.raises(ValueError, match="explode"):
        C.apply_transformations(df, {"explode": "x"})


def test_row_hash(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', NULL), (NULL, 'a') AS t(x, y)")
    plain = C.with_row_hash(df)
    assert plain.select("row_hash").distinct().count() == 1
    assert plain.first()["row_hash"] == df.select(F.hash(F.concat_ws("|", "x", "y"))).first()[0]
    marked = C.with_row_hash(df, null_token="~", hash_column="h", method="xxhash64")
    assert marked.select("h").distinct().count() == 2
    nested = df.select(F.struct("x", "y").alias("s"), F.create_map(F.lit("k"), F.col("y")).alias("m"))
    assert len(C.with_row_hash(nested, method="sha2").first()["row_hash"]) == 64
    with pytest.raises(ValueError):
        C.with_row_hash(df, method="crc")


def test_required_columns(spark):
    df = spark.range(1)
    assert C.require_columns(df, ["id"])
    assert not C.require_columns(df, ["id", "z", "a"])
    assert C.missing_columns(df, ["id", "z", "a"]) == ["a", "z"]


@pytest.mark.parametrize(
    "left, right, wide",
    [
        ("int", "bigint", "bigint"), ("int", "float", "double"), ("smallint", "float", "float"),
        ("decimal(5,2)", "decimal(6,1)", "decimal(7,2)"), ("date", "timestamp", "timestamp"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ],
)
def test_widening(left, right, wide):
    def parse(text):
        return T.DataType.fromDDL(f"c {text}").fields[0].dataType

    assert C.wider_type(parse(left), parse(right)).simpleString() == wide
    assert C.wider_type(parse(right), parse(left)).simpleString() == wide


def test_no_silent_reinterpretation():
    with pytest.raises(ValueError):
        C.wider_type(T.StringType(), T.LongType())


def test_spec_validation():
    base = {"table_name": "t", "database_name": "d"}
    for bad in [
        {"table_name": ""}, {"database_name": ""}, {"loading_strategy": "replace"},
        {"file_format": "orc"}, {"loading_strategy": "merge"}, {"loading_strategy": "scd2"},
        {"loading_strategy": "scd2", "primary_keys": ["k"]},
        {"loading_strategy": "scd2", "primary_keys": ["k"], "tracking_columns": ["v"],
         "scd2_end_date_column": ""},
        {"duplicates": "first"}, {"null_keys": "drop"},
    ]:
        with pytest.raises(ValueError):
            TableSpec(**{**base, **bad})
    spec = TableSpec.from_dict(
        {**base, "loading_strategy": "scd2", "primary_keys": ["k"], "tracking_columns": "v",
         "batch_size": 10, "partition_columns": None, "file_format": "CSV"}
    )
    assert (spec.full_name, spec.tracking_columns, spec.file_format) == ("d.t", ("v",), "csv")


def test_one_decimal_is_exact_at_all_sizes(spark):
    """Ties on the exact binary value go to the even tenth, as Python's formatting does."""
    values = [2097152.25, 2097151.75, 2.0**28 + 0.25, 2.0**35 - 0.75, 2.0**42 + 0.125, 2.0**49 - 0.25, 2.0**49 + 0.25, 2.0**52 + 0.5, 2.0**53]
    rng = random.Random(1)
    values += [rng.uniform(1, 2.0 ** rng.randrange(1, 56)) for _ in range(500)] + [2.0**k + d for k in range(1, 54) for d in (0, 0.25, 0.5)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.one_decimal("v").alias("t"))
    assert [(r.v, r.t) for r in df.collect() if r.t != f"{r.v:.1f}"] == []
