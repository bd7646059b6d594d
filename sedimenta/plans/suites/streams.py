"""The streaming loads, run to completion over the test tables' files."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.plans.loading import store_for
from sedimenta.plans.suites import scd2
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import scratch_path
from sedimenta.streaming import loaders


def one_table(sf_dir, name):
    """Glob that matches one file, which a stream needs instead of its plain path."""
    return f"{sf_dir}/{{{name}}}.parquet"


@query("stream_append", """SELECT *, TIMESTAMP '2024-01-01' AS _load_timestamp,
  'orders.parquet' AS _batch_id FROM orders""")
def q_stream_append(spark, sf_dir):
    """Started twice; the second run has no new file."""
    spec = TableSpec(
        table_name="orders",
        database_name="facts",
        source_path_pattern=one_table(sf_dir, "orders"),
    )
    root = scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "orders").schema
    for _ in range(2):
        source = loaders.stream_source(spark, spec, schema)
        loaders.stream_append(
            source, spec, f"{root}/out", f"{root}/checkpoint", "2024-01-01"
        ).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("_source_file")


@query("stream_scd2", f"""{scd2.ONE_MERGE}
SELECT * EXCLUDE (_source_file, _load_timestamp) FROM s1""")
def q_stream_scd2(spark, sf_dir):
    """A snapshot and then a batch arrive as folders of files; each is one micro-batch."""
    root = scratch_path(spark, "stream")
    spec = TableSpec(
        **{**scd2.CUSTOMER.__dict__, "source_path_pattern": f"{root}/raw/*", "snapshot_by": "folder"}
    )
    store = store_for(spark, root, spec)
    schema = table(spark, sf_dir, "customer").schema
    snapshots = (
        (table(spark, sf_dir, "customer"), scd2.T0),
        (scd2.first_batch(spark, sf_dir), scd2.T1),
    )
    for n, (rows, at) in enumerate(snapshots):
        rows.write.parquet(f"{root}/raw/{n}")
        source = loaders.stream_source(spark, spec, schema)
        loaders.stream_scd2(
            source, spec, store, f"{root}/checkpoint", at
        ).awaitTermination()
    return store.read().drop("_source_file", "_load_timestamp")


@query("stream_deduplicate", "SELECT user_id, event_type, count(*) > 0 AS seen FROM events"
       " GROUP BY user_id, event_type")
def q_stream_deduplicate(spark, sf_dir):
    """One event per user and type within a delay longer than the data."""
    root = scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .parquet(one_table(sf_dir, "events"))
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    kept = loaders.stream_deduplicate(events, ["user_id", "event_type"], "ts", 60)
    (
        kept.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out").select(
        "user_id", "event_type", F.lit(True).alias("seen")
    )
