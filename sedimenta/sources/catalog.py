"""Databases and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is missing, at a location if one is given."""
    where = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """True for an existing table or view."""
    return spark.catalog.tableExists(name)


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """Columns and details of a table as ``(key, value)`` rows."""
    return (
        spark.sql(f"DESCRIBE EXTENDED {quoted(name)}")
        .filter((F.col("col_name") != "") & (F.col("data_type") != ""))
        .select(F.col("col_name").alias("key"), F.col("data_type").alias("value"))
    )


def table_statistics(spark: SparkSession, name: str) -> DataFrame:
    """One row: whether the table exists, its rows, size text and location."""
    schema = (
        "table_name string, table_exists boolean, row_count long, size_info string,"
        " location string"
    )
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([(name, False, None, None, None)], schema)
    details = {
        r["key"]: r["value"]
        for r in table_properties(spark, name)
        .filter(F.col("key").isin("Statistics", "Location"))
        .collect()
    }
    return spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        F.lit(True).alias("table_exists"),
        "row_count",
        F.lit(details.get("Statistics")).cast("string").alias("size_info"),
        F.lit(details.get("Location")).cast("string").alias("location"),
    )
