"""Data-quality checks, readiness and size estimates."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.scalars import as_timestamp

# Fixed value: bytes assumed per row where the rows themselves are not measured.
ASSUMED_ROW_BYTES = 100


def check_quality(df: DataFrame, checks: Mapping[str, Any]) -> DataFrame:
    """Run checks and return rows ``(check, column, passed, observed)``.

    Known checks: ``not_empty``, ``no_nulls`` (a column or list), ``no_duplicates``,
    ``min_rows``, ``max_rows``. All of them come out of one aggregate; only the
    duplicate check adds a shuffle, of per-row counts. Nulls in an unknown column
    cannot be ruled out, so that row fails.
    """
    unknown = set(checks) - {"not_empty", "no_nulls", "no_duplicates", "min_rows", "max_rows"}
    if unknown:
        raise ValueError(f"Unknown checks: {sorted(unknown)}")
    null_columns = checks.get("no_nulls", [])
    null_columns = [null_columns] if isinstance(null_columns, str) else list(null_columns)
    present = [c for c in null_columns if c in df.columns]

    if "no_duplicates" in checks:
        source = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(
            F.count(F.lit(1)).alias("__copies")
        )
        copies = F.col("__copies")
        measures = [
            F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct"),
        ]
    else:
        source, copies = df, F.lit(1)
        measures = [F.count(F.lit(1)).alias("rows")]
    measures += [
        F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), copies)), F.lit(0)).alias(f"nulls_{i}")
        for i, c in enumerate(present)
    ]

    rows = F.col("rows")
    results = []

    def add(check, column, passed, observed):
        results.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).cast("string").alias("column"),
                passed.alias("passed"),
                observed.cast("long").alias("observed"),
            )
        )

    if "not_empty" in checks:
        add("not_empty", None, rows > 0, rows)
    for name in null_columns:
        if name in present:
            nulls = F.col(f"nulls_{present.index(name)}")
            add("no_nulls", name, nulls == 0, nulls)
        else:
            add("no_nulls", name, F.lit(False), F.lit(None))
    if "no_duplicates" in checks:
        extra = rows - F.col("distinct")
        add("no_duplicates", None, extra == 0, extra)
    if "min_rows" in checks:
        add("min_rows", None, rows >= checks["min_rows"], rows)
    if "max_rows" in checks:
        add("max_rows", None, rows <= checks["max_rows"], rows)
    if not results:
        raise ValueError("no checks given")
    return source.agg(*measures).select(F.inline(F.array(*results)))


def estimate_size(
    df: DataFrame, sample_fraction: float = 0.01, sample_rows: int = 1000, measure: bool = False
) -> DataFrame:
    """One row: rows, columns, estimated bytes and MB, and rows sampled.

    Bytes are rows x 100, or 0 if there are no rows. With ``measure`` the mean JSON
    length of the sampled rows replaces the constant. The sample is that share of the
    rows, wherever they lie, or ``sample_rows`` rows if the table has no more.
    """
    drawn = df.sample(fraction=sample_fraction, seed=42)
    few = df.limit(sample_rows + 1).count() <= sample_rows
    sample = df if few else drawn
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    both = df.select(F.lit(1).alias("whole"), F.lit(None).cast("int").alias("width")).unionAll(
        sample.select(F.lit(0).alias("whole"), (width if measure else F.lit(0)).alias("width"))
    )
    row_bytes = F.col("mean_width") if measure else F.lit(ASSUMED_ROW_BYTES)
    size = F.when(F.col("row_count") > 0, F.col("row_count") * F.coalesce(row_bytes, F.lit(ASSUMED_ROW_BYTES))).otherwise(0)
    return (
        both.agg(
            F.count_if(F.col("whole") == 1).alias("row_count"),
            F.count_if(F.col("whole") == 0).alias("sample_count"),
            F.avg("width").alias("mean_width"),
        )
        .withColumn("column_count", F.lit(len(df.columns)))
        .withColumn("estimated_size_bytes", F.ceil(size).cast("long"))
        .withColumn(
            "estimated_size_mb", F.round(F.col("estimated_size_bytes") / (1024 * 1024), 2)
        )
        .select(
            "row_count",
            "column_count",
            "estimated_size_bytes",
            "estimated_size_mb",
            "sample_count",
        )
    )


def readiness(
    df: DataFrame, table_name: str, timestamp_column: str | None = None, as_of=None,
    max_age_hours: int | None = None,
) -> DataFrame:
    """One row: the table exists, its row count, and whether its data is fresh
    enough if a timestamp column and an age are given."""
    latest = F.max(timestamp_column) if timestamp_column else F.max(F.lit(None).cast("timestamp"))
    fresh = F.lit(True)
    if timestamp_column and max_age_hours is not None:
        cutoff = as_timestamp(as_of) - F.expr(f"INTERVAL {int(max_age_hours)} HOURS")
        fresh = F.coalesce(F.col("latest") >= cutoff, F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("row_count"), latest.alias("latest")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(True).alias("table_exists"),
        "row_count",
        "latest",
        fresh.alias("satisfied"),
    )


def table_ready(spark: SparkSession, tables, **freshness) -> DataFrame:
    """Readiness of one or more tables by name; absent ones are not satisfied."""
    names = [tables] if isinstance(tables, str) else list(tables)
    if not names:
        raise ValueError("no tables given")
    out = None
    for name in names:
        if spark.catalog.tableExists(name):
            row = readiness(spark.table(name), name, **freshness)
        else:
            row = spark.createDataFrame(
                [(name, False, 0, None, False)],
                "table_name string, table_exists boolean, row_count long, latest timestamp,"
                " satisfied boolean",
            )
        out = row if out is None else out.unionByName(row)
    return out
