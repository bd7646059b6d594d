"""Transforms, renaming, hashing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import columns as C
from sedimenta.functions import scalars as S
from sedimenta.plans.suites.registry import query, table


@query("transform_chain", """
SELECT o_orderkey, o_totalprice * 1.1 AS gross, year(o_orderdate) AS order_year,
       upper(o_orderpriority) AS priority
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice * CAST(1.1 AS DOUBLE) > 1000""")
def q_transform(spark, sf_dir):
    return C.apply_transformations(
        table(spark, sf_dir, "orders"),
        {
            "add_columns": {
                "gross": "o_totalprice * 1.1D",
                "order_year": F.year("o_orderdate").cast("bigint"),
            },
            "filter": "o_orderstatus = 'O' AND gross > 1000",
            "select": ["o_orderkey", "gross", "order_year", "upper(o_orderpriority) AS priority"],
        },
    )


@query("transform_functions", """SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderstatus = 'P'""")
def q_transform_functions(spark, sf_dir):
    return C.apply_transformations(
        table(spark, sf_dir, "orders"),
        [lambda d: d.filter("o_orderstatus = 'P'"), lambda d: d.select("o_orderkey", "o_custkey")],
    )


@query("rename_camel", """SELECT c_custkey AS "cCustkey", c_name AS "cName",
  c_nationkey AS "cNationkey", c_acctbal AS "cAcctbal", c_mktsegment AS "cMktsegment"
FROM customer""")
def q_camel(spark, sf_dir):
    return C.sanitize_columns(table(spark, sf_dir, "customer"), "camel_case")


@query("rename_snake", "SELECT * FROM customer")
def q_snake(spark, sf_dir):
    """camelCase names back to snake_case."""
    return C.sanitize_columns(q_camel(spark, sf_dir), "snake_case")


@query("rename_lower", "SELECT * FROM nation")
def q_lower(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    return C.sanitize_columns(nation.toDF(*[c.upper() for c in nation.columns]))


@query("row_hash_md5", """SELECT *,
  md5(concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment)) AS row_hash FROM customer""")
def q_hash_md5(spark, sf_dir):
    return C.with_row_hash(
        table(spark, sf_dir, "customer"),
        ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
        method="md5",
    )


@query("row_hash_nulls", """
SELECT doc_id, quality, md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), '~'),
  coalesce(CAST(quality AS VARCHAR), '~'))) AS row_hash
FROM (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def q_hash_nulls(spark, sf_dir):
    """NULLs stand in the hash as a token."""
    labelled = (
        table(spark, sf_dir, "documents")
        .select("doc_id")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    )
    return C.with_row_hash(labelled, method="md5", null_token="~")


@query("row_hash_murmur")
def q_hash_murmur(spark, sf_dir):
    """The default 32-bit hash over all columns."""
    return C.with_row_hash(table(spark, sf_dir, "customer"))


@query("safe_divide", """SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_tax / l_discount END AS tax_per_discount
FROM lineitem""")
def q_safe_divide(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        S.safe_divide("l_tax", "l_discount").alias("tax_per_discount"),
    )


@query("success_rate", """SELECT user_id,
  CAST(count(*) FILTER (event_type <> 'error') AS DOUBLE) / count(*) * 100 AS success_rate
FROM events GROUP BY user_id""")
def q_success_rate(spark, sf_dir):
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "error").alias("ok"), F.count("*").alias("total")
    )
    return per_user.select("user_id", S.success_rate("ok", "total").alias("success_rate"))


@query("format_duration", """SELECT event_id, CASE
  WHEN s < 1 THEN printf('%.0fms', s * 1000) WHEN s < 60 THEN printf('%.1fs', s)
  WHEN s < 3600 THEN printf('%.1fm', s / 60) ELSE printf('%.1fh', s / 3600) END AS duration
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN value * 100 WHEN 'click' THEN value / 100
  ELSE value END AS s FROM events)""")
def q_format_duration(spark, sf_dir):
    seconds = (
        F.when(F.col("event_type") == "view", F.col("value") * 100)
        .when(F.col("event_type") == "click", F.col("value") / 100)
        .otherwise(F.col("value"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", S.format_duration(seconds).alias("duration")
    )


def order_path():
    return F.concat(
        F.lit("/raw/"), F.col("o_orderpriority"), F.lit("/order.v"), F.col("o_orderkey"), F.lit(".parquet")
    )


@query("batch_id", """SELECT o_orderkey,
  'order.v' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS batch_id
FROM orders""")
def q_batch_id(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.batch_id(order_path(), F.col("o_orderdate")).alias("batch_id")
    )


@query("table_from_path", """SELECT o_orderkey, o_orderpriority AS by_folder,
  substr(o_orderpriority, 3) AS by_pattern, CAST(NULL AS VARCHAR) AS unmatched FROM orders""")
def q_table_from_path(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        S.table_from_path(order_path()).alias("by_folder"),
        S.table_from_path(order_path(), "/raw/[0-9]-([^/]+)/").alias("by_pattern"),
        S.table_from_path(order_path(), "/archive/([^/]+)/").alias("unmatched"),
    )


@query("flatten_json", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT)
  AS "payload.k", event_type AS "payload.about.kind" FROM events""")
def q_flatten(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.from_json("props", "k long").getField("k").alias("k"),
            F.struct(F.col("event_type").alias("kind")).alias("about"),
        ).alias("payload"),
    )
    return C.flatten_struct(nested)


@query("scd2_columns_only", """SELECT s_suppkey, TIMESTAMP '2024-01-01' AS valid_from,
  CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS live FROM supplier""")
def q_scd2_columns(spark, sf_dir):
    """Other names for the version columns."""
    from sedimenta import TableSpec

    spec = TableSpec(
        table_name="supplier",
        database_name="dims",
        loading_strategy="scd2",
        primary_keys="s_suppkey",
        tracking_columns="s_acctbal",
        scd2_effective_date_column="valid_from",
        scd2_end_date_column="valid_to",
        scd2_current_flag_column="live",
    )
    return C.with_scd2_columns(
        table(spark, sf_dir, "supplier").select("s_suppkey"), spec, "2024-01-01"
    )
