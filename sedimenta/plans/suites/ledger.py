"""File-ledger queries: every order stands for one source file."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import ledger as led
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import scratch_path
from sedimenta.sources.events import EventLedger

AS_OF = "1998-06-01 00:00:00"
TABLES = {"urgent": "/raw/1-URGENT/*.parquet", "rest": "/raw/*/*.parquet"}
SPECS = [
    TableSpec(table_name=n, database_name="raw", source_path_pattern=p) for n, p in TABLES.items()
]


def ledger_rows(spark, sf_dir):
    """Ledger with statuses from the order's state and priority; no file is skipped."""
    day = F.col("o_orderdate").cast("timestamp")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "P", "failed")
        .when(F.col("o_orderpriority") < "3", "processing")
        .otherwise("pending")
    )
    hour = F.expr("INTERVAL 1 HOUR")
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("/raw/"), "o_orderpriority", F.lit("/"), "o_orderkey", F.lit(".parquet")
        ).alias("file_path"),
        F.floor("o_totalprice").cast("long").alias("file_size"),
        day.alias("file_modified_time"),
        F.col("o_orderpriority").alias("table_name"),
        status.alias("status"),
        F.when(status != "pending", day + hour).alias("processing_start_time"),
        F.when(status.isin("completed", "failed"), day + hour * 3).alias("processing_end_time"),
        F.when(status == "failed", F.lit("it's bad")).alias("error_message"),
        F.when(status == "failed", F.pmod("o_custkey", F.lit(5)))
        .otherwise(0)
        .cast("int")
        .alias("retry_count"),
        day.alias("created_at"),
        F.when(status == "pending", day).otherwise(day + hour * 3).alias("updated_at"),
    )


def listing_rows(spark, sf_dir):
    """Files found now: those of all orders but one priority's, and one per part."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority <> '3-MEDIUM'")
        .select(
            F.concat(
                F.lit("/raw/"), "o_orderpriority", F.lit("/"), "o_orderkey", F.lit(".parquet")
            ).alias("path"),
            F.floor("o_totalprice").cast("long").alias("length"),
            F.col("o_orderdate").cast("timestamp").alias("modificationTime"),
        )
        .unionByName(
            table(spark, sf_dir, "part").select(
                F.concat(F.lit("/raw/parts/"), "p_partkey", F.lit(".parquet")).alias("path"),
                F.col("p_size").cast("long").alias("length"),
                F.lit("2002-01-01").cast("timestamp").alias("modificationTime"),
            )
        )
    )


LEDGER_SQL = """
SELECT '/raw/' || o_orderpriority || '/' || o_orderkey || '.parquet' AS file_path,
  CAST(floor(o_totalprice) AS BIGINT) AS file_size, o_orderdate AS file_modified_time,
  o_orderpriority AS table_name, status,
  CASE WHEN status <> 'pending' THEN o_orderdate + INTERVAL 1 HOUR END AS processing_start_time,
  CASE WHEN status IN ('completed', 'failed') THEN o_orderdate + INTERVAL 3 HOUR END
    AS processing_end_time,
  CASE WHEN status = 'failed' THEN 'it''s bad' END AS error_message,
  CAST(CASE WHEN status = 'failed' THEN o_custkey % 5 ELSE 0 END AS INTEGER) AS retry_count,
  o_orderdate AS created_at,
  CASE WHEN status = 'pending' THEN o_orderdate ELSE o_orderdate + INTERVAL 3 HOUR END AS updated_at
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'failed'
  WHEN o_orderpriority < '3' THEN 'processing' ELSE 'pending' END AS status FROM orders)
"""
LISTING_SQL = """
SELECT '/raw/' || o_orderpriority || '/' || o_orderkey || '.parquet' AS path,
  CAST(floor(o_totalprice) AS BIGINT) AS length, o_orderdate AS "modificationTime"
FROM orders WHERE o_orderpriority <> '3-MEDIUM'
UNION ALL
SELECT '/raw/parts/' || p_partkey || '.parquet', CAST(p_size AS BIGINT), TIMESTAMP '2002-01-01'
FROM part
"""
BASE = f"WITH l AS ({LEDGER_SQL}), f AS ({LISTING_SQL})"
ZEROES = ", ".join(
    f"count(*) FILTER (status = '{s}') AS {s}"
    for s in ("pending", "processing", "completed", "failed", "skipped")
)


@query("ledger_empty", f"{BASE} SELECT * FROM l")
def q_empty(spark, sf_dir):
    """An empty ledger takes rows in the fixed schema."""
    return led.empty_ledger(spark).unionByName(ledger_rows(spark, sf_dir))


@query("new_files", f"{BASE} SELECT * FROM f WHERE path NOT IN (SELECT file_path FROM l)")
def q_new_files(spark, sf_dir):
    return led.new_files(listing_rows(spark, sf_dir), ledger_rows(spark, sf_dir))


@query("ledger_register", f"""{BASE} SELECT * FROM l UNION ALL
SELECT path, length, "modificationTime", 'parts', 'pending', NULL, NULL, NULL, 0,
  TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}' FROM f WHERE path NOT IN (SELECT file_path FROM l)""")
def q_register(spark, sf_dir):
    """Files are registered for the table their folder names: orders' are known there."""
    folder = F.regexp_extract("path", "^/raw/([^/]*)/", 1)
    return led.register_files(ledger_rows(spark, sf_dir), listing_rows(spark, sf_dir), folder, AS_OF)


@query("ledger_shared", f"""WITH f AS ({LISTING_SQL})
SELECT path AS file_path, length AS file_size, "modificationTime" AS file_modified_time, name AS table_name,
  CASE WHEN ends THEN 'failed' ELSE 'pending' END AS status, CAST(NULL AS TIMESTAMP) AS processing_start_time,
  CASE WHEN ends THEN TIMESTAMP '{AS_OF}' END AS processing_end_time, CAST(NULL AS VARCHAR) AS error_message,
  CAST(CASE WHEN ends THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
  TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
FROM (SELECT *, name = 'two' AND length % 2 = 0 AS ends FROM f, (VALUES ('one'), ('two')) AS t(name))""")
def q_shared(spark, sf_dir):
    """Two tables over the same files: each registers them all, a change of one is its own."""
    files = listing_rows(spark, sf_dir)
    book = led.register_files(led.empty_ledger(spark), files, "one", AS_OF)
    book = led.register_files(led.register_files(book, files, "two", AS_OF), files, "one", AS_OF)
    steps = files.filter("length % 2 = 0").select(
        F.lit("two").alias("table_name"), F.col("path").alias("file_path"), F.lit("failed").alias("status")
    )
    return led.apply_transitions(book, steps, AS_OF)


TRANSITION_SQL = f"""{BASE}, t AS (SELECT *, CASE
    WHEN status = 'pending' THEN 'processing'
    WHEN status = 'processing' AND table_name = '1-URGENT' THEN 'failed'
    WHEN status = 'processing' THEN 'completed' END AS target FROM l)
SELECT file_path, file_size, file_modified_time, table_name, coalesce(target, status) AS status,
  CASE WHEN target = 'processing' THEN TIMESTAMP '{AS_OF}' ELSE processing_start_time END
    AS processing_start_time,
  CASE WHEN target IN ('completed', 'failed') THEN TIMESTAMP '{AS_OF}' ELSE processing_end_time END
    AS processing_end_time,
  CASE WHEN target = 'failed' THEN 'can''t read ' || file_path ELSE error_message END
    AS error_message,
  CAST(retry_count + CASE WHEN target = 'failed' THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
  created_at, CASE WHEN target IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at
FROM t"""


@query("ledger_transition", TRANSITION_SQL)
def q_transition(spark, sf_dir):
    """Pending files start; processing ones end, the urgent ones badly."""
    rows = ledger_rows(spark, sf_dir)
    return led.apply_transitions(rows, changes(rows).drop("table_name"), AS_OF)


@query("ledger_transition_events", TRANSITION_SQL)
def q_transition_events(spark, sf_dir):
    """The same changes to a ledger of events, whose files are registered once more later."""
    rows, book = ledger_rows(spark, sf_dir), EventLedger(spark, scratch_path(spark, "ledger"))
    book.record(led.row_events(rows))
    book.record(led.transition_events(changes(rows), AS_OF))
    again = rows.select(F.col("file_path").alias("path"), F.col("file_size").alias("length"),
                        F.col("file_modified_time").alias("modificationTime"), "table_name")
    book.record(led.register_events(again, F.col("table_name"), AS_OF))
    return book.read()


def changes(rows):
    return rows.filter(F.col("status").isin("pending", "processing")).select(
        "table_name",
        "file_path",
        F.when(F.col("status") == "pending", "processing")
        .when(F.col("table_name") == "1-URGENT", "failed")
        .otherwise("completed")
        .alias("status"),
        F.when(
            (F.col("status") == "processing") & (F.col("table_name") == "1-URGENT"),
            F.concat(F.lit("can't read "), "file_path"),
        ).alias("error_message"),
    )


@query("pending_files", f"{BASE} SELECT * FROM l WHERE status = 'pending'")
def q_pending(spark, sf_dir):
    return led.pending_files(ledger_rows(spark, sf_dir))


@query("pending_files_limit", f"""{BASE} SELECT file_path, created_at FROM l
WHERE status = 'pending' AND table_name = '5-LOW' ORDER BY created_at, file_path LIMIT 20""")
def q_pending_limit(spark, sf_dir):
    """The feature's own limit: the oldest pending files of one table."""
    return led.pending_files(ledger_rows(spark, sf_dir), "5-LOW", 20).select(
        "file_path", "created_at"
    )


@query("retryable_files", f"{BASE} SELECT * FROM l WHERE status = 'failed' AND retry_count < 3")
def q_retryable(spark, sf_dir):
    return led.retryable_files(ledger_rows(spark, sf_dir))


@query("unprocessed_files", f"""{BASE} SELECT * FROM f
WHERE path NOT IN (SELECT file_path FROM l WHERE status = 'completed')""")
def q_unprocessed(spark, sf_dir):
    return led.unprocessed_files(listing_rows(spark, sf_dir), ledger_rows(spark, sf_dir))


@query("unprocessed_files_in_limits", f"""{BASE} SELECT * FROM f
WHERE path NOT IN (SELECT file_path FROM l WHERE status IN ('completed', 'skipped')
  OR (status = 'failed' AND retry_count >= 3))""")
def q_unprocessed_limits(spark, sf_dir):
    return led.unprocessed_files(
        listing_rows(spark, sf_dir), ledger_rows(spark, sf_dir), True, 3
    )


@query("missing_sources", f"""{BASE} SELECT * FROM l
WHERE status = 'completed' AND file_path NOT IN (SELECT path FROM f)""")
def q_missing(spark, sf_dir):
    return led.missing_sources(ledger_rows(spark, sf_dir), listing_rows(spark, sf_dir))


@query("ledger_stats", f"""{BASE}
SELECT s.status, count(l.status) AS files
FROM (VALUES ('pending'), ('processing'), ('completed'), ('failed'), ('skipped')) s(status)
LEFT JOIN l ON l.status = s.status GROUP BY s.status""")
def q_stats(spark, sf_dir):
    return led.ledger_stats(ledger_rows(spark, sf_dir))


@query("ledger_stats_by_table", f"{BASE} SELECT table_name, {ZEROES} FROM l GROUP BY table_name")
def q_stats_by_table(spark, sf_dir):
    return led.ledger_stats_by_table(ledger_rows(spark, sf_dir))


@query("ledger_checked", f"""{BASE} SELECT table_name, count(*) AS files_checked FROM l
WHERE status = 'completed' GROUP BY table_name""")
def q_checked(spark, sf_dir):
    return led.ledger_checked(ledger_rows(spark, sf_dir))


@query("orphaned_files", f"""{BASE} SELECT * FROM l WHERE status = 'processing'
AND processing_start_time < TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR""")
def q_orphaned(spark, sf_dir):
    return led.orphaned_files(ledger_rows(spark, sf_dir), AS_OF)


@query("fix_orphans", f"""{BASE}, t AS (SELECT *, status = 'processing'
  AND processing_start_time < TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR AS orphan FROM l)
SELECT file_path, file_size, file_modified_time, table_name,
  CASE WHEN orphan THEN 'failed' ELSE status END AS status, processing_start_time,
  CASE WHEN orphan THEN TIMESTAMP '{AS_OF}' ELSE processing_end_time END AS processing_end_time,
  CASE WHEN orphan THEN 'Orphaned processing record - marked as failed for retry'
    ELSE error_message END AS error_message, retry_count, created_at,
  CASE WHEN orphan THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at FROM t""")
def q_fix_orphans(spark, sf_dir):
    return led.fix_orphans(ledger_rows(spark, sf_dir), AS_OF)


@query("purge_ledger", f"""{BASE} SELECT * FROM l WHERE NOT (status IN ('completed', 'failed')
AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY)""")
def q_purge(spark, sf_dir):
    return led.purge_ledger(ledger_rows(spark, sf_dir), AS_OF)


def table_status(spark, sf_dir):
    """One status row per priority, from its orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("table_name"))
        .agg(F.max("o_orderdate").cast("timestamp").alias("last_updated"))
        .select(
            "table_name",
            F.when(F.col("table_name") < "2", "in_progress")
            .when(F.col("table_name") < "5", "completed")
            .otherwise("not_started")
            .alias("status"),
            "last_updated",
        )
    )


STATUS_SQL = """
SELECT o_orderpriority AS table_name, CASE WHEN o_orderpriority < '2' THEN 'in_progress'
  WHEN o_orderpriority < '5' THEN 'completed' ELSE 'not_started' END AS status,
  max(o_orderdate) AS last_updated FROM orders GROUP BY o_orderpriority
"""


@query("consistency_report", f"""{BASE}, s AS ({STATUS_SQL}),
c AS (SELECT table_name, {ZEROES} FROM l GROUP BY table_name)
SELECT s.table_name, s.status AS table_status, c.pending, c.processing, c.completed, c.failed,
  c.skipped, NOT (s.status = 'completed' AND c.failed > 0) AS consistent,
  CASE WHEN s.status = 'completed' AND c.failed > 0
    THEN 'failed_files:' || c.failed
  WHEN s.status = 'in_progress' AND c.processing > 0
    THEN 'processing_files:' || c.processing
  ELSE '' END AS issues
FROM s LEFT JOIN c ON s.table_name = c.table_name""")
def q_consistency(spark, sf_dir):
    report = led.consistency_report(ledger_rows(spark, sf_dir), table_status(spark, sf_dir))
    return report.withColumn("issues", F.array_join("issues", "; "))


@query("ledger_validation", f"""{BASE}
SELECT (SELECT count(*) FROM l WHERE status = 'completed') AS total_files_checked,
  (SELECT count(*) FROM l WHERE status = 'processing'
    AND processing_start_time < TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR) AS orphaned,
  (SELECT count(*) FROM l WHERE status = 'completed'
    AND file_path NOT IN (SELECT path FROM f)) AS missing_sources,
  'inconsistent' AS overall_status""")
def q_validation(spark, sf_dir):
    return led.ledger_validation(
        ledger_rows(spark, sf_dir), listing_rows(spark, sf_dir), AS_OF
    )


@query("fix_table_status", f"""{BASE}, s AS ({STATUS_SQL}),
t AS (SELECT s.*, s.status = 'completed' AND s.table_name IN
  (SELECT table_name FROM l WHERE status = 'failed') AS reset FROM s)
SELECT table_name, CASE WHEN reset THEN 'failed' ELSE status END AS status,
  CASE WHEN reset THEN TIMESTAMP '{AS_OF}' ELSE last_updated END AS last_updated FROM t""")
def q_fix_table_status(spark, sf_dir):
    return led.fix_table_status(
        table_status(spark, sf_dir), ledger_rows(spark, sf_dir), AS_OF
    )


@query("tables_to_run", f"""WITH s AS ({STATUS_SQL})
SELECT DISTINCT o_orderpriority AS table_name FROM orders WHERE o_orderpriority NOT IN
  (SELECT table_name FROM s WHERE status = 'completed') AND o_orderpriority <> '5-LOW'""")
def q_tables_to_run(spark, sf_dir):
    status = table_status(spark, sf_dir)
    return led.tables_to_run(
        status.select("table_name"), status, only=["1-URGENT", "2-HIGH", "3-MEDIUM"]
    )


@query("retry_plan", f"""{BASE} SELECT file_path, retry_count, updated_at,
  CASE WHEN table_name = '1-URGENT' THEN 'urgent' ELSE 'rest' END AS table_name
FROM l WHERE status = 'failed' AND retry_count < 3""")
def q_retry_plan(spark, sf_dir):
    return led.retry_plan(ledger_rows(spark, sf_dir), SPECS, 3)
