"""Quality checks, readiness, size estimates and load summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import quality, summaries
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import scratch_path


@query("check_quality", """
WITH d AS (SELECT d.text, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT count(*) AS n, count(*) FILTER (text IS NULL) AS no_text,
  count(*) FILTER (quality IS NULL) AS no_quality FROM d),
u AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM d))
SELECT 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS "column", n > 0 AS passed, n AS observed FROM c
UNION ALL SELECT 'no_nulls', 'text', no_text = 0, no_text FROM c
UNION ALL SELECT 'no_nulls', 'quality', no_quality = 0, no_quality FROM c
UNION ALL SELECT 'no_nulls', 'author', FALSE, NULL
UNION ALL SELECT 'no_duplicates', NULL, c.n = u.n, c.n - u.n FROM c, u
UNION ALL SELECT 'min_rows', NULL, n >= 100, n FROM c
UNION ALL SELECT 'max_rows', NULL, n <= 100, n FROM c""")
def q_check_quality(spark, sf_dir):
    labelled = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("text", "quality")
    )
    return quality.check_quality(
        labelled,
        {
            "not_empty": True,
            "no_nulls": ["text", "quality", "author"],
            "no_duplicates": True,
            "min_rows": 100,
            "max_rows": 100,
        },
    )


@query("check_quality_scan", """
SELECT 'no_nulls' AS "check", 'l_shipdate' AS "column", count(*) FILTER (l_shipdate IS NULL) = 0
  AS passed, count(*) FILTER (l_shipdate IS NULL) AS observed FROM lineitem
UNION ALL SELECT 'min_rows', NULL, count(*) >= 1000, count(*) FROM lineitem""")
def q_check_scan(spark, sf_dir):
    """Without the duplicate check a single aggregate, no shuffle of rows."""
    return quality.check_quality(
        table(spark, sf_dir, "lineitem"), {"no_nulls": "l_shipdate", "min_rows": 1000}
    )


@query("table_ready", """SELECT 'there' AS which, TRUE AS table_exists,
  count(*) AS row_count, max(o_orderdate) AS latest,
  max(o_orderdate) >= TIMESTAMP '2001-08-02' - INTERVAL 48 HOUR AS satisfied FROM orders
UNION ALL SELECT 'absent', FALSE, 0, NULL, FALSE""")
def q_table_ready(spark, sf_dir):
    """A catalog table and one that is not there."""
    path = scratch_path(spark, "orders")
    name = path.rpartition("/")[2].replace("-", "_")
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    orders.write.option("path", path).saveAsTable(name)
    ready = quality.table_ready(
        spark,
        [name, f"no_{name}"],
        timestamp_column="o_orderdate",
        as_of="2001-08-02",
        max_age_hours=48,
    )
    which = F.when(F.col("table_name") == name, "there").otherwise("absent")
    return ready.select(which.alias("which"), "table_exists", "row_count", "latest", "satisfied")


@query("estimate_size", """SELECT count(*) AS row_count, 11 AS column_count,
  count(*) * 100 AS estimated_size_bytes,
  round(count(*) * 100 / 1048576.0::DOUBLE, 2) AS estimated_size_mb, TRUE AS sampled FROM lineitem
UNION ALL SELECT count(*), 2, count(*) * 100, round(count(*) * 100 / 1048576.0::DOUBLE, 2), TRUE
FROM region""")
def q_estimate_size(spark, sf_dir):
    """Which rows are sampled depends on the files, so their number is checked for bounds:
    half to twice the share of a large table, all rows of a small one."""
    large = quality.estimate_size(table(spark, sf_dir, "lineitem"))
    small = quality.estimate_size(table(spark, sf_dir, "region"))
    n, rows = F.col("sample_count"), F.col("row_count")
    large = large.withColumn("sampled", (n >= rows * 0.005) & (n <= rows * 0.02))
    small = small.withColumn("sampled", n == rows)
    return large.unionByName(small).drop("sample_count")


@query("estimate_size_measured", """SELECT count(*) AS row_count, 5 AS column_count, TRUE AS near
FROM documents""")
def q_estimate_measured(spark, sf_dir):
    """Within a factor of two of the mean JSON length of all rows."""
    docs = table(spark, sf_dir, "documents")
    found = quality.estimate_size(docs, sample_fraction=0.5, measure=True)
    true = docs.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes"))
    both = found.unionByName(true, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in (*found.columns, "bytes")]
    )
    near = F.col("estimated_size_bytes").between(F.col("bytes") / 2, F.col("bytes") * 2)
    return both.select("row_count", "column_count", near.alias("near"))


def load_results(spark, sf_dir):
    """One load result per event, failed for errors."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("/raw/"), "event_id", F.lit(".json")).alias("file_path"),
        F.col("event_type").alias("table_name"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("value") > 1, F.col("value")).otherwise(0.0).alias("execution_time"),
        F.when(F.col("event_type") == "error", "boom").alias("error_message"),
        F.col("user_id").alias("total_records_processed"),
    )


RESULTS_SQL = """WITH r AS (SELECT event_type AS table_name, event_type <> 'error' AS success,
  CASE WHEN value > 1 THEN value ELSE 0 END AS execution_time, user_id AS records FROM events)"""


@query("load_summary", f"""{RESULTS_SQL}
SELECT count(*) AS total_files_processed, count(*) FILTER (success) AS successful_files,
  count(*) FILTER (NOT success) AS failed_files,
  round(avg(execution_time) FILTER (execution_time > 0), 6) AS average_execution_time,
  min(execution_time) FILTER (execution_time > 0) AS min_execution_time,
  max(execution_time) FILTER (execution_time > 0) AS max_execution_time,
  CAST(count(*) FILTER (success) AS DOUBLE) / count(*) * 100 AS success_rate FROM r""")
def q_load_summary(spark, sf_dir):
    return summaries.load_summary(load_results(spark, sf_dir)).withColumn(
        "average_execution_time", F.round("average_execution_time", 6)
    )


@query("load_summary_by_table", f"""{RESULTS_SQL}
SELECT table_name, count(*) FILTER (success) AS successful,
  count(*) FILTER (NOT success) AS failed, count(*) AS total FROM r GROUP BY table_name""")
def q_load_summary_by_table(spark, sf_dir):
    return summaries.load_summary_by_table(load_results(spark, sf_dir))


@query("run_summary", f"""{RESULTS_SQL}
SELECT count(DISTINCT table_name) AS tables, count(*) AS total_files,
  count(*) FILTER (success) AS successful_files, count(*) FILTER (NOT success) AS failed_files,
  CAST(sum(records) AS BIGINT) AS total_records_processed,
  round(sum(execution_time), 4) AS total_execution_time,
  CAST(count(*) FILTER (success) AS DOUBLE) / count(*) * 100 AS success_rate,
  round(sum(execution_time) / count(*), 6) AS average_execution_time,
  round(sum(records) / sum(execution_time), 6) AS records_per_second FROM r""")
def q_run_summary(spark, sf_dir):
    return summaries.run_summary(load_results(spark, sf_dir)).withColumns(
        {
            "total_execution_time": F.round("total_execution_time", 4),
            "average_execution_time": F.round("average_execution_time", 6),
            "records_per_second": F.round("records_per_second", 6),
        }
    )
