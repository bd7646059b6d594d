"""Append, deduplication, late rows, upsert and overwrite."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import append, dedup, lineage
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import materialize

T0, T1 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
ORDERS = TableSpec(table_name="orders", database_name="facts")
PART = TableSpec(
    table_name="part",
    database_name="dims",
    loading_strategy="merge",
    primary_keys=("p_partkey",),
    partition_columns=("p_type",),
)
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
    " l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
ORDER_FILE = "/raw/orders/{}.parquet"


def order_file():
    return F.concat(F.lit("/raw/orders/"), F.col("o_orderpriority"), F.lit(".parquet"))


def finished_orders(spark, sf_dir):
    """Table so far: finished orders, one source file per priority."""
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return append.append_load(None, rows, ORDERS, T0, order_file())


def other_orders(spark, sf_dir):
    """Later files, one per status."""
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    name = F.concat(F.lit("/raw/orders/late/"), F.col("o_orderstatus"), F.lit(".parquet"))
    return rows.withColumn("_source_file", name)


FINISHED_SQL = f"""SELECT *, TIMESTAMP '{T0}' AS _load_timestamp,
  '/raw/orders/' || o_orderpriority || '.parquet' AS _source_file,
  o_orderpriority || '.parquet' AS _batch_id FROM orders WHERE o_orderstatus = 'F'"""
OTHER_SQL = f"""SELECT *, TIMESTAMP '{T1}' AS _load_timestamp,
  '/raw/orders/late/' || o_orderstatus || '.parquet' AS _source_file,
  o_orderstatus || '.parquet' AS _batch_id
FROM orders WHERE o_orderstatus <> 'F'"""


@query("append_audit", f"{FINISHED_SQL} UNION ALL {OTHER_SQL}")
def q_append(spark, sf_dir):
    return append.append_load(
        finished_orders(spark, sf_dir), other_orders(spark, sf_dir), ORDERS, T1
    )


@query("append_metrics", """
SELECT count(*) FILTER (o_orderstatus <> 'F') AS records_inserted,
       CAST(0 AS BIGINT) AS records_updated, CAST(0 AS BIGINT) AS records_deleted,
       count(*) FILTER (o_orderstatus <> 'F') AS total_records_processed,
       count(*) FILTER (o_orderstatus = 'F') AS initial_table_count,
       count(*) AS final_table_count
FROM orders""")
def q_append_metrics(spark, sf_dir):
    return append.append_metrics(
        finished_orders(spark, sf_dir), other_orders(spark, sf_dir)
    )


@query("append_evolve", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS channel
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL, o_orderpriority, 'web'
FROM orders WHERE o_orderstatus <> 'F'""")
def q_append_evolve(spark, sf_dir):
    """A later batch adds a column, lacks one and is wider in another."""
    orders = table(spark, sf_dir, "orders")
    early = orders.filter("o_orderstatus = 'F'").withColumn(
        "o_custkey", F.col("o_custkey").cast("int")
    )
    late = (
        orders.filter("o_orderstatus <> 'F'")
        .drop("o_orderdate")
        .withColumn("channel", F.lit("web"))
    )
    return append.union_evolved(early, late)


@query("already_loaded", """
SELECT DISTINCT '/raw/orders/' || o_orderpriority || '.parquet' AS _source_file
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority < '3'""")
def q_already_loaded(spark, sf_dir):
    wanted = (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority < '3'")
        .select(order_file().alias("path"))
        .unionByName(other_orders(spark, sf_dir).select(F.col("_source_file").alias("path")))
    )
    return lineage.already_loaded(finished_orders(spark, sf_dir), wanted)


@query("append_undo", f"SELECT * FROM ({FINISHED_SQL}) WHERE o_orderpriority <> '1-URGENT'")
def q_undo(spark, sf_dir):
    return append.undo_load(
        finished_orders(spark, sf_dir), ORDER_FILE.format("1-URGENT")
    )


@query("append_undo_metrics", """SELECT count(*) AS records_removed FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def q_undo_metrics(spark, sf_dir):
    return append.undo_metrics(
        finished_orders(spark, sf_dir), ORDER_FILE.format("1-URGENT")
    )


@query("append_idempotent", f"{FINISHED_SQL} UNION ALL {OTHER_SQL}")
def q_idempotent(spark, sf_dir):
    """The later files loaded twice."""
    once = materialize(q_append(spark, sf_dir), "state")
    return append.append_idempotent_load(once, other_orders(spark, sf_dir), ORDERS, T1)


@query("dedup_keys", f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) = 1""")
def q_dedup_keys(spark, sf_dir):
    return dedup.deduplicate(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query("dedup_keys_latest", f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate DESC, {LINE_COLUMNS}) = 1""")
def q_dedup_latest(spark, sf_dir):
    """The latest shipment of every part."""
    order = ["l_shipdate DESC", *LINE_COLUMNS.split(", ")]
    return dedup.deduplicate(table(spark, sf_dir, "lineitem"), ["l_partkey"], order)


@query("dedup_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def q_dedup_rows(spark, sf_dir):
    return dedup.deduplicate(
        table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    )


@query("duplicate_summary", """SELECT count(*) AS total_rows,
  count(DISTINCT text) AS distinct_rows, count(*) - count(DISTINCT text) AS removed_rows
FROM documents""")
def q_duplicate_summary(spark, sf_dir):
    return dedup.duplicate_summary(table(spark, sf_dir, "documents"), ["text"])


@query("late_filter", """SELECT * FROM events
WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') <= 7""")
def q_late_filter(spark, sf_dir):
    return append.filter_late(table(spark, sf_dir, "events"), "ts", 7, "2024-01-31")


@query("late_summary", """SELECT event_type, count(*) AS total_rows,
  count(*) FILTER (date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') <= 7) AS kept_rows,
  count(*) FILTER (date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') > 7) AS late_rows
FROM events GROUP BY event_type""")
def q_late_summary(spark, sf_dir):
    return append.late_summary(
        table(spark, sf_dir, "events"), "ts", 7, "2024-01-20", ["event_type"]
    )


def part_batch(spark, sf_dir):
    """Big parts repriced, and every supplier's catalogue entry as a new part."""
    big = table(spark, sf_dir, "part").filter("p_size > 40")
    new = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("p_partkey"),
        F.col("s_name").alias("p_name"),
        F.lit("Brand#0").alias("p_brand"),
        F.lit("CATALOGUE").alias("p_type"),
        F.lit(1).alias("p_size"),
        F.col("s_acctbal").alias("p_retailprice"),
    )
    return big.withColumn("p_retailprice", F.col("p_retailprice") * 2).unionByName(new)


@query("merge_upsert", """
SELECT * REPLACE (CASE WHEN p_size > 40 THEN p_retailprice * 2 ELSE p_retailprice END
  AS p_retailprice) FROM part
UNION ALL
SELECT s_suppkey + 1000000000, s_name, 'Brand#0', 'CATALOGUE', 1, s_acctbal FROM supplier""")
def q_merge_upsert(spark, sf_dir):
    return append.merge_load(table(spark, sf_dir, "part"), part_batch(spark, sf_dir), PART)


@query("overwrite_table", """
SELECT * REPLACE (p_retailprice * 2 AS p_retailprice) FROM part WHERE p_size > 40
UNION ALL
SELECT s_suppkey + 1000000000, s_name, 'Brand#0', 'CATALOGUE', 1, s_acctbal FROM supplier""")
def q_overwrite_table(spark, sf_dir):
    spec = TableSpec(table_name="part", database_name="dims", loading_strategy="overwrite")
    return append.overwrite_load(
        table(spark, sf_dir, "part"), part_batch(spark, sf_dir), spec
    )


@query("overwrite_partition", """
WITH b AS (SELECT * REPLACE (p_retailprice / 2 AS p_retailprice) FROM part
           WHERE p_type IN ('ECONOMY', 'PROMO') AND p_size > 40)
SELECT * FROM part WHERE p_type NOT IN (SELECT p_type FROM b) UNION ALL SELECT * FROM b""")
def q_overwrite_partition(spark, sf_dir):
    """Only the partitions the batch has rows for are replaced."""
    part = table(spark, sf_dir, "part")
    batch = part.filter("p_type IN ('ECONOMY', 'PROMO') AND p_size > 40").withColumn(
        "p_retailprice", F.col("p_retailprice") / 2
    )
    return append.overwrite_load(part, batch, PART)
