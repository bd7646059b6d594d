"""Summaries of load results: rows of ``(file_path, table_name, success,
execution_time, error_message, total_records_processed)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.scalars import safe_divide, success_rate

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("total_records_processed", T.LongType()),
    ]
)


def _succeeded():
    return F.coalesce(F.col("success"), F.lit(False))


def load_summary(results: DataFrame) -> DataFrame:
    """One row: files, successes, failures, success %, and avg/min/max of the
    execution times above 0."""
    timed = F.when(F.col("execution_time") > 0, F.col("execution_time"))
    total, ok = F.count(F.lit(1)), F.count_if(_succeeded())

    def zero_safe(agg):
        return F.coalesce(agg, F.lit(0.0))

    return results.agg(
        total.alias("total_files_processed"),
        ok.alias("successful_files"),
        (total - ok).alias("failed_files"),
        zero_safe(F.avg(timed)).alias("average_execution_time"),
        zero_safe(F.min(timed)).alias("min_execution_time"),
        zero_safe(F.max(timed)).alias("max_execution_time"),
    ).withColumn("success_rate", success_rate("successful_files", "total_files_processed"))


def load_summary_by_table(results: DataFrame) -> DataFrame:
    """Successful, failed and total files per table."""
    total, ok = F.count(F.lit(1)), F.count_if(_succeeded())
    return results.groupBy("table_name").agg(
        ok.alias("successful"), (total - ok).alias("failed"), total.alias("total")
    )


def run_summary(results: DataFrame) -> DataFrame:
    """One row for a whole run: tables, files, success rate, records, times, speed."""
    total, ok = F.count(F.lit(1)), F.count_if(_succeeded())
    return results.agg(
        F.count_distinct("table_name").alias("tables"),
        total.alias("total_files"),
        ok.alias("successful_files"),
        (total - ok).alias("failed_files"),
        F.coalesce(F.sum("total_records_processed"), F.lit(0)).alias("total_records_processed"),
        F.coalesce(F.sum("execution_time"), F.lit(0.0)).alias("total_execution_time"),
    ).withColumns(
        {
            "success_rate": success_rate("successful_files", "total_files"),
            "average_execution_time": safe_divide("total_execution_time", "total_files"),
            "records_per_second": F.when(
                F.col("total_execution_time") > 0,
                safe_divide("total_records_processed", "total_execution_time"),
            ).otherwise(0.0),
        }
    )
