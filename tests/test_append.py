from datetime import date

import pytest
from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import append, dedup, lineage
from tests.conftest import rows

SPEC = TableSpec(
    table_name="t", database_name="d", primary_keys="k", loading_strategy="merge"
)


def test_audit_columns(spark):
    out = append.append_load(None, spark.range(1), SPEC, "2024-01-01", "/raw/it's/a b.parquet")
    row = out.first()
    assert (row["_source_file"], row["_batch_id"]) == ("/raw/it's/a b.parquet", "a b.parquet")
    assert row["_load_timestamp"].year == 2024


def test_strict_append_refuses_other_columns(spark):
    strict = TableSpec(**{**SPEC.__dict__, "schema_evolution": False})
    state = append.append_load(None, spark.range(1), strict, "2024-01-01", "f")
    with pytest.raises(ValueError, match="evolution"):
        append.append_load(state, spark.range(1).withColumn("x", F.lit(1)), strict, None, "g")


def test_evolving_append(spark):
    state = append.append_load(None, spark.range(1), SPEC, "2024-01-01", "f")
    batch = spark.range(1).select(F.lit("v").alias("x"))
    grown = append.append_load(state, batch, SPEC, "2024-01-02", "g")
    assert rows(grown, "id", "x") == [(0, None), (None, "v")]
    with pytest.raises(ValueError, match="id"):
        append.append_load(state, spark.range(1).select(F.lit("v").alias("id")), SPEC, None, "g")


def test_undo_keeps_rows_without_file(spark):
    state = spark.sql("SELECT * FROM VALUES (1, 'f'), (2, NULL), (3, 'g') AS t(k, _source_file)")
    assert rows(append.undo_load(state, "f"), "k") == [(2,), (3,)]
    assert rows(append.undo_load(state, ["f", "g"]), "k") == [(2,)]
    assert rows(lineage.already_loaded(state, ["g", "h"])) == [("g",)]
    assert append.undo_metrics(state, "f").first()[0] == 1


def test_merge_load(spark):
    state = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'n') AS t(k, v)")
    batch = spark.sql(
        "SELECT * FROM VALUES (2, 'z'), (2, 'y'), (3, 'c'), (NULL, 'm') AS t(k, v)"
    )
    merged = append.merge_load(state, batch, SPEC)
    assert rows(merged, "k", "v") == sorted(
        [(1, "a"), (2, "y"), (3, "c"), (None, "n"), (None, "m")], key=repr
    )
    again = append.merge_load(merged, batch.filter("k IS NOT NULL"), SPEC)
    assert rows(again, "k", "v") == rows(merged, "k", "v")


def test_overwrite_partitions_including_null(spark):
    spec = TableSpec(
        table_name="t", database_name="d", loading_strategy="overwrite", partition_columns="p"
    )
    state = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL), (3, 'b') AS t(k, p)")
    batch = spark.sql("SELECT * FROM VALUES (9, CAST(NULL AS STRING)), (8, 'c') AS t(k, p)")
    assert rows(append.overwrite_load(state, batch, spec), "k") == [(1,), (3,), (8,), (9,)]


def test_late_rows(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 24)), (2, date(2024, 1, 23)), (3, None), (4, date(2024, 2, 9))],
        "k int, d date",
    )
    kept = append.filter_late(df, "d", 7, "2024-01-31")
    assert rows(kept, "k") == [(1,), (4,)]
    summary = append.late_summary(df, "d", 7, "2024-01-31").first()
    assert tuple(summary) == (4, 2, 2)


def test_deduplicate(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'b', 1), (1, 'a', 2), (1, 'a', 2), (NULL, 'n', 1), (NULL, 'o', 1)"
        " AS t(k, v, w)"
    )
    assert rows(dedup.deduplicate(df), "v") == [("a",), ("b",), ("n",), ("o",)]
    assert rows(dedup.deduplicate(df, ["k"]), "v") == [("a",), ("n",)]
    assert rows(dedup.deduplicate(df, ["k"], ["v DESC"]), "v") == [("b",), ("o",)]
    assert tuple(dedup.duplicate_summary(df).first()) == (5, 4, 1)
    assert tuple(dedup.duplicate_summary(df.limit(0)).first()) == (0, 0, 0)


def test_hot_key_is_cut_before_the_shuffle(spark):
    """Two thirds of the rows share a key; one row per map task may leave it."""
    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = dedup.deduplicate(df, ["k"], ["v DESC"])
    assert out.count() == 10_001
    assert rows(out.filter("k = 0"), "v") == [(29_998,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
