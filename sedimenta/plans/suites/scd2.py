"""SCD2 queries: customer with a snapshot batch, lineitem with a composite key."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import scd2
from sedimenta.operators.dedup import deduplicate
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import materialize

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"

CUSTOMER = TableSpec(
    table_name="customer",
    database_name="dims",
    loading_strategy="scd2",
    primary_keys=("c_custkey",),
    tracking_columns=("c_name", "c_acctbal", "c_mktsegment"),
)
LINEITEM = TableSpec(
    table_name="lineitem",
    database_name="dims",
    loading_strategy="scd2",
    primary_keys=("l_orderkey", "l_linenumber"),
    tracking_columns=("l_returnflag", "l_linestatus", "l_quantity"),
)


def initial_state(spark, sf_dir):
    return scd2.scd2_initial(table(spark, sf_dir, "customer"), CUSTOMER, T0, "initial")


def first_batch(spark, sf_dir):
    """A snapshot of the customers outside one segment, with debts relieved by 100
    (tracked), large balances losing their segment (tracked, to NULL), rich
    customers moved (untracked), and suppliers as new customers, some without key."""
    c = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'FURNITURE'")
    s = table(spark, sf_dir, "supplier")
    bal = F.col("c_acctbal")
    kept = c.select(
        "c_custkey",
        "c_name",
        F.when(bal > 9000, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(bal < 0, bal + 100).otherwise(bal).alias("c_acctbal"),
        F.when(bal > 9500, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    new = s.select(
        F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return kept.unionByName(new)


def second_batch(spark, sf_dir):
    """A later snapshot: the first one with one segment renamed and its keyless rows
    gone."""
    return (
        first_batch(spark, sf_dir)
        .filter("c_custkey IS NOT NULL")
        .withColumn(
            "c_mktsegment",
            F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(
                F.col("c_mktsegment")
            ),
        )
    )


def merged_state(spark, sf_dir):
    """State after the first merge, stored as a table between two loads is."""
    return materialize(q_merge(spark, sf_dir), "state")


# One row per complete key, the first by all columns.
FIRST_PER_KEY = """QUALIFY c_custkey IS NULL OR row_number() OVER (PARTITION BY c_custkey
  ORDER BY c_name NULLS FIRST, c_nationkey NULLS FIRST, c_acctbal NULLS FIRST,
  c_mktsegment NULLS FIRST) = 1"""
INITIAL_SQL = f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       TIMESTAMP '{T0}' AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date,
       TRUE AS is_current, 'initial' AS _source_file, TIMESTAMP '{T0}' AS _load_timestamp
FROM customer {FIRST_PER_KEY}
"""
FIRST_SQL = """
SELECT c_custkey, c_name,
       CASE WHEN c_acctbal > 9000 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_mktsegment <> 'FURNITURE'
UNION ALL
SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey + 1000000000 END, s_name, s_nationkey,
       s_acctbal, 'SUPPLIER'
FROM supplier
"""
SECOND_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END
       AS c_mktsegment
FROM b1 WHERE c_custkey IS NOT NULL
"""
BASE_SQL = f"""WITH s0 AS ({INITIAL_SQL}),
b1 AS (SELECT * FROM ({FIRST_SQL}) {FIRST_PER_KEY}), b2 AS ({SECOND_SQL})"""
TUPLE = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def classify_sql(state, batch):
    return f"""
SELECT b.*, CASE WHEN s.effective_date IS NULL THEN 'new'
                 WHEN b.c_name IS DISTINCT FROM s.c_name
                   OR b.c_acctbal IS DISTINCT FROM s.c_acctbal
                   OR b.c_mktsegment IS DISTINCT FROM s.c_mktsegment THEN 'changed'
                 ELSE 'unchanged' END AS change_type
FROM {batch} b LEFT JOIN (SELECT * FROM {state} WHERE is_current) s
  ON b.c_custkey = s.c_custkey
"""


def merge_sql(state, classified, at, file):
    """SQL for the state after merging classified rows."""
    opened = f"""SELECT {TUPLE}, TIMESTAMP '{at}', CAST(NULL AS TIMESTAMP), TRUE, '{file}',
       TIMESTAMP '{at}' FROM {classified} WHERE change_type <> 'unchanged'"""
    hit = f"""(is_current AND c_custkey IN
       (SELECT c_custkey FROM {classified} WHERE change_type = 'changed'))"""
    return f"""
SELECT {TUPLE}, effective_date,
       CASE WHEN {hit} THEN TIMESTAMP '{at}' ELSE end_date END AS end_date,
       CASE WHEN {hit} THEN FALSE ELSE is_current END AS is_current,
       _source_file, _load_timestamp
FROM {state}
UNION ALL {opened}
"""


ONE_MERGE = f"""{BASE_SQL}, k1 AS ({classify_sql('s0', 'b1')}),
s1 AS ({merge_sql('s0', 'k1', T1, 'first')})"""
TWO_MERGES = f"""{ONE_MERGE}, k2 AS ({classify_sql('s1', 'b2')}),
s2 AS ({merge_sql('s1', 'k2', T2, 'second')})"""


@query("scd2_initial", INITIAL_SQL)
def q_initial(spark, sf_dir):
    return initial_state(spark, sf_dir)


@query("scd2_current", f"{ONE_MERGE} SELECT * FROM s1 WHERE is_current")
def q_current(spark, sf_dir):
    return scd2.scd2_current(merged_state(spark, sf_dir), CUSTOMER)


@query("scd2_classify", f"{BASE_SQL} {classify_sql('s0', 'b1')}")
def q_classify(spark, sf_dir):
    return scd2.scd2_classify(
        first_batch(spark, sf_dir), initial_state(spark, sf_dir), CUSTOMER
    )


@query("scd2_new_rows", f"{BASE_SQL}, k1 AS ({classify_sql('s0', 'b1')}) "
       f"SELECT {TUPLE} FROM k1 WHERE change_type = 'new'")
def q_new(spark, sf_dir):
    return scd2.scd2_new(first_batch(spark, sf_dir), initial_state(spark, sf_dir), CUSTOMER)


@query("scd2_changed_rows", f"{BASE_SQL}, k1 AS ({classify_sql('s0', 'b1')}) "
       f"SELECT {TUPLE} FROM k1 WHERE change_type = 'changed'")
def q_changed(spark, sf_dir):
    return scd2.scd2_changed(
        first_batch(spark, sf_dir), initial_state(spark, sf_dir), CUSTOMER
    )


@query("scd2_merge_state", f"{ONE_MERGE} SELECT * FROM s1")
def q_merge(spark, sf_dir):
    return scd2.scd2_merge(
        initial_state(spark, sf_dir), first_batch(spark, sf_dir), CUSTOMER, T1, "first"
    )


@query("scd2_merge_small_batch", f"{ONE_MERGE} SELECT * FROM s1")
def q_merge_small(spark, sf_dir):
    """The same merge by key lookups, for a batch that can be broadcast."""
    return scd2.scd2_merge(
        materialize(initial_state(spark, sf_dir), "state"),
        first_batch(spark, sf_dir),
        CUSTOMER,
        T1,
        "first",
        small_batch=True,
    )


@query("scd2_merge_twice", f"{TWO_MERGES} SELECT * FROM s2")
def q_merge_twice(spark, sf_dir):
    return scd2.scd2_merge(
        merged_state(spark, sf_dir), second_batch(spark, sf_dir), CUSTOMER, T2, "second"
    )


@query("scd2_merge_versions", f"{TWO_MERGES} SELECT * FROM s2")
def q_merge_versions(spark, sf_dir):
    """Both batches in one pass; the SQL merges them one after the other."""

    def stamped(batch, at, file):
        return batch.withColumns(
            {"snapshot_at": F.lit(at).cast("timestamp"), "_source_file": F.lit(file)}
        )

    both = stamped(first_batch(spark, sf_dir), T1, "first").unionByName(
        stamped(second_batch(spark, sf_dir), T2, "second")
    )
    state = materialize(initial_state(spark, sf_dir), "state")
    return scd2.scd2_merge_versions(state, both, CUSTOMER, "snapshot_at")


@query("scd2_metrics", f"""{BASE_SQL}, k1 AS ({classify_sql('s0', 'b1')})
SELECT count(*) FILTER (change_type = 'new') AS records_inserted,
       count(*) FILTER (change_type = 'changed') AS records_updated,
       CAST(0 AS BIGINT) AS records_deleted, count(*) AS total_records_processed FROM k1""")
def q_metrics(spark, sf_dir):
    return scd2.scd2_metrics(q_classify(spark, sf_dir))


@query("scd2_undo", INITIAL_SQL)
def q_undo(spark, sf_dir):
    return scd2.scd2_undo_load(merged_state(spark, sf_dir), "first", CUSTOMER)


@query("scd2_undo_middle", f"""{TWO_MERGES}, undone AS (
  SELECT c_custkey, effective_date, end_date, is_current FROM s2 WHERE _source_file = 'first'
    AND c_custkey IS NOT NULL)
SELECT {', '.join('s.' + c for c in TUPLE.split(', '))}, s.effective_date,
       CASE WHEN u.c_custkey IS NULL THEN s.end_date ELSE u.end_date END AS end_date,
       CASE WHEN u.c_custkey IS NULL THEN s.is_current ELSE u.is_current END AS is_current,
       s._source_file, s._load_timestamp
FROM s2 s LEFT JOIN undone u ON s.c_custkey = u.c_custkey AND s.end_date = u.effective_date
WHERE s._source_file <> 'first'""")
def q_undo_middle(spark, sf_dir):
    """Undo a load that a later one has built on: versions it had closed last until
    the later load closed its own, or are current again."""
    state = scd2.scd2_merge(
        merged_state(spark, sf_dir), second_batch(spark, sf_dir), CUSTOMER, T2, "second"
    )
    return scd2.scd2_undo_load(materialize(state, "state"), ["first"], CUSTOMER)


@query("scd2_idempotent", f"{ONE_MERGE} SELECT * FROM s1")
def q_idempotent(spark, sf_dir):
    """The same file merged a second time, its first load being undone."""
    return scd2.scd2_idempotent_load(
        merged_state(spark, sf_dir), first_batch(spark, sf_dir), CUSTOMER, T1, "first"
    )


LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
    " l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


@query("scd2_composite_close", f"""
WITH s AS (
  SELECT {LINE_COLUMNS} FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) = 1
), returned AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
c AS (SELECT s.*, EXISTS (SELECT 1 FROM returned r WHERE r.l_orderkey = s.l_orderkey
      AND r.l_linenumber = s.l_linenumber) AS hit FROM s)
SELECT {LINE_COLUMNS}, TIMESTAMP '{T0}' AS effective_date,
       CASE WHEN hit THEN TIMESTAMP '{T1}' END AS end_date, NOT hit AS is_current FROM c
""")
def q_composite_close(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    state = scd2.scd2_initial(lines, LINEITEM, T0)
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return scd2.scd2_close(state, returned, LINEITEM, T1)


@query("scd2_composite_merge", f"""
WITH s AS (
  SELECT {LINE_COLUMNS} FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) = 1
), b AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus) = 1
), k AS (
  SELECT b.* FROM b JOIN s ON b.l_orderkey = s.l_orderkey AND b.l_linenumber = s.l_linenumber
  WHERE b.l_returnflag IS DISTINCT FROM s.l_returnflag
     OR b.l_linestatus IS DISTINCT FROM s.l_linestatus
     OR b.l_quantity IS DISTINCT FROM s.l_quantity
)
SELECT {LINE_COLUMNS}, TIMESTAMP '{T0}' AS effective_date,
       CASE WHEN hit THEN TIMESTAMP '{T1}' END AS end_date, NOT hit AS is_current
FROM (SELECT s.*, EXISTS (SELECT 1 FROM k WHERE k.l_orderkey = s.l_orderkey
      AND k.l_linenumber = s.l_linenumber) AS hit FROM s)
UNION ALL
SELECT {LINE_COLUMNS}, TIMESTAMP '{T1}', CAST(NULL AS TIMESTAMP), TRUE FROM k
""")
def q_composite_merge(spark, sf_dir):
    """A composite-key batch with several rows per key, the latest shipment winning."""
    lines = table(spark, sf_dir, "lineitem")
    state = scd2.scd2_initial(lines, LINEITEM, T0)
    latest = deduplicate(
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate DESC", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    )
    unique = TableSpec(**{**LINEITEM.__dict__, "duplicates": "keep"})
    return scd2.scd2_merge(state, latest, unique, T1)
