"""The same loads as Structured Streaming queries.

Each returns a started query. The file source's checkpoint remembers which files
were read; with the default ``availableNow`` trigger a query loads what is new and
stops, so running it again is an incremental load.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimenta.functions.columns import apply_transformations, with_audit_columns
from sedimenta.plans.loading import MAX_FILES, commit_batch, next_offset, prepare_batch
from sedimenta.scratch import local_frame
from sedimenta.sources.files import source_path
from sedimenta.sources.store import TableStore
from sedimenta.spec import TableSpec


# When a row's file was last changed; the loads drop it.
_MODIFIED = "__modified"


def stream_source(
    spark: SparkSession, spec: TableSpec, schema, max_files: int = MAX_FILES
) -> DataFrame:
    """Stream of a table's source files, each row with its ``_source_file``; at most
    ``max_files`` make up one micro-batch."""
    reader = spark.readStream.format(spec.file_format).schema(schema)
    if spec.file_format == "csv":
        reader = reader.option("header", True)
    reader = reader.option("maxFilesPerTrigger", max_files)
    for key, value in spec.reader_options.items():
        reader = reader.option(key, value)
    rows = reader.load(spec.source_path_pattern)
    return rows.select(
        "*",
        source_path(spec.source_path_pattern).alias("_source_file"),
        F.col("_metadata.file_modification_time").alias(_MODIFIED),
    )


def stream_append(
    source: DataFrame, spec: TableSpec, output: str, checkpoint: str, as_of=None
) -> StreamingQuery:
    """Append new files with lineage columns; the file sink commits each batch
    exactly once."""
    rows = apply_transformations(source.drop(_MODIFIED), spec.transformations)
    rows = with_audit_columns(rows, as_of)
    writer = rows.writeStream.format("parquet").outputMode("append")
    if spec.partition_columns:
        writer = writer.partitionBy(*spec.partition_columns)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )


def stream_load(
    source: DataFrame,
    spec: TableSpec,
    store: TableStore,
    checkpoint: str,
    as_of: str | None = None,
    stream_name: str = "stream",
) -> StreamingQuery:
    """Run a table's strategy on every micro-batch.

    A micro-batch may be delivered again after a failure, so the id of the last one
    is part of the table version it made and a repeated one is skipped. Its files go in
    order of modification time and path, as in a load, ``MAX_FILES`` to a commit; rows of
    a commit that came before the failure are replaced.
    """
    tag = f"{stream_name}.batch"

    def load(batch: DataFrame, batch_id: int) -> None:
        version = store.version()
        if version is not None and int(version.tags.get(tag, -1)) >= batch_id:
            return
        if batch.isEmpty():
            return
        at = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
        order = [c for c in (_MODIFIED, "_source_file") if c in batch.columns]
        names = batch.select(*order).distinct().orderBy(*order)
        files = [r["_source_file"] for r in names.collect()]
        for start in range(0, len(files), MAX_FILES):
            some = files[start : start + MAX_FILES]
            rows = batch.drop(_MODIFIED)
            if len(some) < len(files):
                chosen = local_frame(batch.sparkSession, {"_source_file": some})
                rows = rows.join(F.broadcast(chosen), "_source_file", "left_semi")
            offset = next_offset(store, spec, at)
            last = start + MAX_FILES >= len(files)
            rows = prepare_batch(rows, spec, at, some, offset)
            commit_batch(store, rows, spec, at, some, offset, {tag: batch_id} if last else None)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_scd2(source, spec, store, checkpoint, as_of=None, stream_name="stream"):
    """SCD2 merge of every micro-batch."""
    if spec.loading_strategy != "scd2":
        raise ValueError("stream_scd2 needs an scd2 table")
    return stream_load(source, spec, store, checkpoint, as_of, stream_name)


def stream_deduplicate(
    source: DataFrame,
    keys: Sequence[str],
    event_time: str,
    max_delay_days: int = 7,
) -> DataFrame:
    """Stream without repeated keys within the allowed delay.

    The watermark bounds the state to keys of the last ``max_delay_days`` and drops
    rows that come later than that, measured by the newest event seen.
    """
    return source.withWatermark(event_time, f"{int(max_delay_days)} days").dropDuplicatesWithinWatermark(
        list(keys)
    )
