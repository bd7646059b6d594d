"""The file ledger: one row per table and source file, queried and changed as a table.

Functions named after a change take a ledger and return the next ledger. Those ending in
``_events`` give the rows that say the same to a ledger kept as appended events, and
:func:`fold_events` makes the ledger of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.scalars import as_timestamp
from sedimenta.sources.files import route_column

# File statuses, table statuses, and the message put on orphans.
PENDING, PROCESSING, COMPLETED, FAILED, SKIPPED = STATUSES = (
    "pending",
    "processing",
    "completed",
    "failed",
    "skipped",
)
TABLE_STATUSES = ("not_started", "in_progress", "completed", "failed")
# The order of a file's steps, which decides between changes at one instant.
LIFE_CYCLE = (PENDING, PROCESSING, FAILED, SKIPPED, COMPLETED)
ORPHAN_MESSAGE = "Orphaned processing record - marked as failed for retry"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_size", T.LongType(), True),
        T.StructField("file_modified_time", T.TimestampType(), True),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("processing_start_time", T.TimestampType(), True),
        T.StructField("processing_end_time", T.TimestampType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("retry_count", T.IntegerType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)


def empty_ledger(spark: SparkSession) -> DataFrame:
    """A ledger without rows."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields]
    )


def _known(ledger: DataFrame, table_name: str | Column | None) -> DataFrame:
    """Paths a table's rows of the ledger name; those of all tables without a name."""
    known = ledger.select(F.col("file_path").alias("path"), F.col("table_name").alias("__table"))
    if table_name is None:
        return known.drop("__table")
    return known if isinstance(table_name, Column) else known.filter(F.col("__table") == table_name).drop("__table")


def new_files(listing: DataFrame, ledger: DataFrame, table_name: str | None = None) -> DataFrame:
    """Listed files the ledger does not know, of one table if it is named."""
    return listing.join(_known(ledger, table_name), "path", "left_anti")


def register_files(
    ledger: DataFrame, listing: DataFrame, table_name: str | Column, as_of=None
) -> DataFrame:
    """Ledger plus a ``pending`` row for every listed file it does not know of the table.

    ``listing`` has ``path`` and, if known, ``length`` and ``modificationTime``. A table
    name that is a column of the listing registers files for several tables.
    """
    table = table_name if isinstance(table_name, Column) else F.lit(table_name)
    wanted = listing.withColumn("__table", table).dropDuplicates(["path", "__table"])
    fresh = wanted.join(_known(ledger, F.col("__table")), ["path", "__table"], "left_anti")
    return ledger.unionByName(_registered(fresh, F.col("__table"), as_of))


def _registered(listing: DataFrame, table: Column, as_of) -> DataFrame:
    now = as_timestamp(as_of)
    optional = {
        name: F.col(name) if name in listing.columns else F.lit(None)
        for name in ("length", "modificationTime")
    }
    values = {
        "file_path": F.col("path"),
        "file_size": optional["length"],
        "file_modified_time": optional["modificationTime"],
        "table_name": table,
        "status": F.lit(PENDING),
        "processing_start_time": F.lit(None),
        "processing_end_time": F.lit(None),
        "error_message": F.lit(None),
        "retry_count": F.lit(0),
        "created_at": now,
        "updated_at": now,
    }
    return listing.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields])


def _last_steps(transitions: DataFrame, as_of) -> tuple[DataFrame, list[str]]:
    """One ``__step`` per file (and table, if the changes name it): the last one."""
    at = F.col("changed_at") if "changed_at" in transitions.columns else as_timestamp(as_of)
    message = (
        F.col("error_message") if "error_message" in transitions.columns else F.lit(None)
    )
    keys = [c for c in ("table_name", "file_path") if c in transitions.columns]
    steps = transitions.select(
        *keys,
        # Of changes at one instant the later step of a file's life counts.
        F.struct(
            at.alias("at"),
            F.array_position(F.lit(list(LIFE_CYCLE)), F.col("status")).alias("rank"),
            F.col("status"),
            message.cast("string").alias("message"),
        ).alias("step"),
    )
    return steps.groupBy(*keys).agg(F.max("step").alias("__step")), keys


def apply_transitions(ledger: DataFrame, transitions: DataFrame, as_of=None) -> DataFrame:
    """Ledger after a batch of status changes.

    ``transitions`` has ``file_path``, ``status`` and, if wanted, ``table_name``,
    ``error_message`` and ``changed_at`` (default ``as_of``). Without ``table_name`` a change
    is one of the file in every table. Of several rows for one file the last by
    ``changed_at`` counts, at one instant the later step of the life cycle. A start sets the
    start time, an end the end time, a failure also counts a retry and takes the message
    even if it is NULL.
    """
    last, keys = _last_steps(transitions, as_of)
    to, when = F.col("__step.status"), F.col("__step.at")
    text = F.col("__step.message")
    hit = F.col("__step").isNotNull()
    failed = F.coalesce(to == FAILED, F.lit(False))
    start = F.coalesce(to == PROCESSING, F.lit(False))
    done = F.coalesce(to.isin(COMPLETED, FAILED), F.lit(False))
    has_text = F.coalesce(F.length(text) > 0, F.lit(False))
    return (
        ledger.join(last, keys, "left")
        .withColumns(
            {
                "status": F.coalesce(to, F.col("status")),
                "processing_start_time": F.when(start, when).otherwise(
                    F.col("processing_start_time")
                ),
                "processing_end_time": F.when(done, when).otherwise(
                    F.col("processing_end_time")
                ),
                "error_message": F.when(has_text, text)
                .when(failed, F.lit(None))
                .otherwise(F.col("error_message")),
                "retry_count": F.col("retry_count") + failed.cast("int"),
                "updated_at": F.when(hit, when).otherwise(F.col("updated_at")),
            }
        )
        .select(*ledger.columns)
    )


# What an event says beside a ledger row's columns: its commit, whether it is a ledger row
# (a registration, or a file's whole state), and whether it sets the message.
EVENT_COLUMNS = ("event_commit", "event_is_row", "event_sets_message")


def register_events(listing: DataFrame, table_name: str | Column, as_of=None) -> DataFrame:
    """Events that register listed files. What the ledger knows already stays as it is,
    so nothing needs to be looked up."""
    table = table_name if isinstance(table_name, Column) else F.lit(table_name)
    return row_events(_registered(listing, table, as_of))


def row_events(rows: DataFrame) -> DataFrame:
    """Events that state whole ledger rows."""
    return rows.select(
        *LEDGER_SCHEMA.names,
        F.lit(None).cast("long").alias("event_commit"),
        F.lit(True).alias("event_is_row"),
        F.lit(True).alias("event_sets_message"),
    )


def transition_events(transitions: DataFrame, as_of=None, counts_retry: bool = True) -> DataFrame:
    """Events for status changes as :func:`apply_transitions` takes them; ``table_name`` is
    needed. Without ``counts_retry`` a failure costs the file no retry."""
    last, _ = _last_steps(transitions, as_of)
    step = last.select("table_name", "file_path", "__step.*")
    failed = F.col("status") == FAILED
    ends = F.col("status").isin(COMPLETED, FAILED)
    values = {
        "status": F.col("status"),
        "processing_start_time": F.when(F.col("status") == PROCESSING, F.col("at")),
        "processing_end_time": F.when(ends, F.col("at")),
        "error_message": F.when(F.length("message") > 0, F.col("message")),
        "retry_count": (failed & F.lit(counts_retry)).cast("int"),
        "updated_at": F.col("at"),
        "table_name": F.col("table_name"),
        "file_path": F.col("file_path"),
    }
    return step.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields],
        F.lit(None).cast("long").alias("event_commit"),
        F.lit(False).alias("event_is_row"),
        (failed | F.coalesce(F.length("message") > 0, F.lit(False))).alias("event_sets_message"),
    )


def orphan_events(ledger: DataFrame, as_of=None, hours: int = 2) -> DataFrame:
    """Events that fail orphans, ready for a retry that costs them none."""
    orphans = orphaned_files(ledger, as_of, hours)
    steps = orphans.select("table_name", "file_path", F.lit(FAILED).alias("status"), F.lit(ORPHAN_MESSAGE).alias("error_message"))
    return transition_events(steps, as_of, counts_retry=False)


def fold_events(events: DataFrame) -> DataFrame:
    """The ledger that events amount to: one row per table and file that was registered.

    Events of a file count in the order of their commits, within one in that of the life
    cycle, after the file's first registration however often that is repeated. Everything is a
    sum, least or latest value, so map tasks reduce a file's events before the exchange.
    """
    is_row = F.coalesce("event_is_row", F.lit(True))
    commit = F.coalesce("event_commit", F.lit(0))
    order = F.struct(
        (~is_row).alias("later"),
        F.when(is_row, -commit).otherwise(commit).alias("commit"),
        F.array_position(F.lit(list(LIFE_CYCLE)), F.col("status")).alias("rank"),
    )
    ordered = events.withColumns({"__order": order, "__row": is_row})

    def latest(column: str, where: Column) -> Column:
        return F.max_by(column, F.when(where, F.col("__order"))).alias(column)

    folded = ordered.groupBy("table_name", "file_path").agg(
        F.max("__row").alias("__row"),
        latest("file_size", F.col("__row")),
        latest("file_modified_time", F.col("__row")),
        latest("status", F.lit(True)),
        latest("processing_start_time", F.col("processing_start_time").isNotNull()),
        latest("processing_end_time", F.col("processing_end_time").isNotNull()),
        latest("error_message", F.coalesce("event_sets_message", F.lit(True))),
        (F.sum(F.when(~F.col("__row"), F.col("retry_count")).otherwise(0))
         + F.coalesce(F.max(F.when(F.col("__row"), F.col("retry_count"))), F.lit(0))).cast("int").alias("retry_count"),
        latest("created_at", F.col("__row")),
        latest("updated_at", F.lit(True)),
    )
    return folded.filter("__row").select(*LEDGER_SCHEMA.names)


def _of_table(ledger: DataFrame, table_name: str | None) -> DataFrame:
    return ledger if table_name is None else ledger.filter(F.col("table_name") == table_name)


def pending_files(
    ledger: DataFrame, table_name: str | None = None, limit: int | None = None
) -> DataFrame:
    """Pending files, oldest registration first."""
    rows = (
        _of_table(ledger, table_name)
        .filter(F.col("status") == PENDING)
        .orderBy("created_at", "file_path")
    )
    return rows if limit is None else rows.limit(limit)


def retryable_files(ledger: DataFrame, max_retries: int = 3) -> DataFrame:
    """Failed files with retries left, longest untouched first."""
    return ledger.filter(
        (F.col("status") == FAILED) & (F.col("retry_count") < max_retries)
    ).orderBy("updated_at", "file_path")


def unprocessed_files(
    listing: DataFrame,
    ledger: DataFrame,
    skip_skipped: bool = False,
    max_retries: int | None = None,
    table_name: str | None = None,
) -> DataFrame:
    """Listed files that are not completed, in the named table if one is named.

    Skipped files and files out of retries count as unprocessed unless the options
    exclude them.
    """
    settled = F.col("status") == COMPLETED
    if skip_skipped:
        settled = settled | (F.col("status") == SKIPPED)
    if max_retries is not None:
        settled = settled | ((F.col("status") == FAILED) & (F.col("retry_count") >= max_retries))
    done = _known(ledger.filter(settled), table_name)
    return listing.join(done, "path", "left_anti")


def missing_sources(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Completed files whose source is no longer listed."""
    present = listing.select(F.col("path").alias("file_path"))
    return ledger.filter(F.col("status") == COMPLETED).join(present, "file_path", "left_anti")


def _status_counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]


def ledger_stats(ledger: DataFrame, table_name: str | None = None) -> DataFrame:
    """One row per status with its file count, 0 for statuses without files."""
    counts = _of_table(ledger, table_name).agg(*_status_counts())
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(s).alias("status"), F.col(s).alias("files")) for s in STATUSES]
            )
        )
    )


def ledger_stats_by_table(ledger: DataFrame) -> DataFrame:
    """One row per table, one count column per status."""
    return ledger.groupBy("table_name").agg(*_status_counts())


def ledger_checked(ledger: DataFrame) -> DataFrame:
    """Completed files per table."""
    return (
        ledger.filter(F.col("status") == COMPLETED)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("files_checked"))
    )


def _orphaned(as_of, hours: int) -> Column:
    cutoff = as_timestamp(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return (F.col("status") == PROCESSING) & (F.col("processing_start_time") < cutoff)


def orphaned_files(ledger: DataFrame, as_of=None, hours: int = 2) -> DataFrame:
    """Files still processing although they started over ``hours`` ago."""
    return ledger.filter(_orphaned(as_of, hours))


def fix_orphans(ledger: DataFrame, as_of=None, hours: int = 2) -> DataFrame:
    """Ledger with orphans failed, ready for a retry that costs them none."""
    orphan, now = F.coalesce(_orphaned(as_of, hours), F.lit(False)), as_timestamp(as_of)
    fixed = {
        "status": F.lit(FAILED),
        "error_message": F.lit(ORPHAN_MESSAGE),
        "processing_end_time": now,
        "updated_at": now,
    }
    # One projection: the condition must see the old status in every column.
    return ledger.withColumns(
        {name: F.when(orphan, value).otherwise(F.col(name)) for name, value in fixed.items()}
    )


def purge_ledger(ledger: DataFrame, as_of=None, days_to_keep: int = 30) -> DataFrame:
    """Ledger without completed and failed rows untouched for over ``days_to_keep``
    days. A purged file that is still listed looks new again."""
    cutoff = as_timestamp(as_of) - F.expr(f"INTERVAL {int(days_to_keep)} DAYS")
    old = F.col("status").isin(COMPLETED, FAILED) & (F.col("updated_at") < cutoff)
    return ledger.filter(~F.coalesce(old, F.lit(False)))


def consistency_report(ledger: DataFrame, table_status: DataFrame) -> DataFrame:
    """Per known table: its status, file counts, whether both agree, and issues."""
    stats = ledger_stats_by_table(ledger)
    failed = F.coalesce(F.col("failed"), F.lit(0))
    processing = F.coalesce(F.col("processing"), F.lit(0))
    broken = (F.col("table_status") == "completed") & (failed > 0)
    stuck = (F.col("table_status") == "in_progress") & (processing > 0)
    issue = F.when(broken, F.format_string("failed_files:%d", failed)).when(
        stuck, F.format_string("processing_files:%d", processing)
    )
    return (
        table_status.select("table_name", F.col("status").alias("table_status"))
        .join(stats, "table_name", "left")
        .select(
            "table_name",
            "table_status",
            *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in STATUSES],
            (~F.coalesce(broken, F.lit(False))).alias("consistent"),
            F.array_compact(F.array(issue)).alias("issues"),
        )
    )


def ledger_validation(
    ledger: DataFrame, listing: DataFrame | None = None, as_of=None, hours: int = 2
) -> DataFrame:
    """One row: files checked, orphans, vanished sources and the overall status."""
    flags = ledger.select(
        F.lit(1).alias("row"),
        (F.col("status") == COMPLETED).alias("checked"),
        F.coalesce(_orphaned(as_of, hours), F.lit(False)).alias("orphan"),
        F.lit(False).alias("gone"),
    )
    if listing is not None:
        gone = missing_sources(ledger, listing)
        flags = flags.unionByName(
            gone.select(
                F.lit(0).alias("row"),
                F.lit(False).alias("checked"),
                F.lit(False).alias("orphan"),
                F.lit(True).alias("gone"),
            )
        )
    return flags.agg(
        F.count_if("checked").alias("total_files_checked"),
        F.count_if("orphan").alias("orphaned"),
        F.count_if("gone").alias("missing_sources"),
    ).withColumn(
        "overall_status", F.when(F.col("orphaned") > 0, "inconsistent").otherwise("valid")
    )


def fix_table_status(table_status: DataFrame, ledger: DataFrame, as_of=None) -> DataFrame:
    """Table statuses with completed tables that have failed files set to failed."""
    failing = (
        ledger.filter(F.col("status") == FAILED)
        .select("table_name")
        .distinct()
        .withColumn("__failing", F.lit(True))
    )
    reset = (F.col("status") == "completed") & F.coalesce(F.col("__failing"), F.lit(False))
    fixed = {"status": F.when(reset, FAILED).otherwise(F.col("status"))}
    if "last_updated" in table_status.columns:
        fixed["last_updated"] = F.when(reset, as_timestamp(as_of)).otherwise(F.col("last_updated"))
    return (
        table_status.join(failing, "table_name", "left")
        .withColumns(fixed)
        .select(*table_status.columns)
    )


def tables_to_run(
    tables: DataFrame, table_status: DataFrame, only: Sequence[str] | None = None
) -> DataFrame:
    """Tables whose status is not completed, optionally restricted by name."""
    done = table_status.filter(F.col("status") == "completed").select("table_name")
    rows = tables.join(done, "table_name", "left_anti")
    return rows if only is None else rows.filter(F.col("table_name").isin(list(only)))


def retry_plan(ledger: DataFrame, specs, max_retries: int = 3) -> DataFrame:
    """Retryable files with the table their path belongs to; unmatched files drop."""
    return (
        retryable_files(ledger, max_retries)
        .select("file_path", "retry_count", "updated_at")
        .withColumn("table_name", route_column("file_path", specs))
        .filter(F.col("table_name").isNotNull())
    )
