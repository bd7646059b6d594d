"""Append, overwrite and upsert loads, and late-row handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.columns import (
    apply_transformations,
    missing_columns,
    union_evolved,
    with_audit_columns,
)
from sedimenta.functions.scalars import as_date
from sedimenta.operators.dedup import deduplicate
from sedimenta.operators.lineage import files_frame
from sedimenta.spec import TableSpec


def append_rows(batch: DataFrame, spec: TableSpec, as_of=None, source_file=None) -> DataFrame:
    """Rows an append load adds: transformed batch plus lineage columns."""
    return with_audit_columns(
        apply_transformations(batch, spec.transformations), as_of, source_file
    )


def append_load(
    state: DataFrame | None, batch: DataFrame, spec: TableSpec, as_of=None, source_file=None
) -> DataFrame:
    """State after appending a batch; the schema grows if the table allows it."""
    rows = append_rows(batch, spec, as_of, source_file)
    if state is None:
        return rows
    if not spec.schema_evolution and (
        missing_columns(rows, state.columns) or missing_columns(state, rows.columns)
    ):
        raise ValueError(f"{spec.full_name}: batch columns differ and evolution is off")
    return union_evolved(state, rows)


def append_metrics(state: DataFrame | None, rows: DataFrame) -> DataFrame:
    """One row of counts, both inputs counted in one aggregate."""
    added = rows.select(F.lit(1).alias("added"))
    both = added if state is None else added.unionAll(state.select(F.lit(0).alias("added")))
    inserted = F.count_if(F.col("added") == 1)
    return both.agg(
        inserted.alias("records_inserted"),
        F.lit(0).cast("long").alias("records_updated"),
        F.lit(0).cast("long").alias("records_deleted"),
        inserted.alias("total_records_processed"),
        F.count_if(F.col("added") == 0).alias("initial_table_count"),
        F.count(F.lit(1)).alias("final_table_count"),
    )


def undo_load(state: DataFrame, files) -> DataFrame:
    """State without the rows of the given source files."""
    return state.join(files_frame(state, files), "_source_file", "left_anti").select(
        *state.columns
    )


def undo_metrics(state: DataFrame, files) -> DataFrame:
    """One row: how many rows undoing the given files removes."""
    return state.join(files_frame(state, files), "_source_file", "left_semi").agg(
        F.count(F.lit(1)).alias("records_removed")
    )


def append_idempotent_load(
    state: DataFrame, batch: DataFrame, spec: TableSpec, as_of=None, source_file=None
) -> DataFrame:
    """Append a file's rows, removing those of an earlier load of it first."""
    undone = undo_load(state, source_file or batch.select("_source_file"))
    return append_load(undone, batch, spec, as_of, source_file)


def merge_load(state: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Upsert: batch rows replace state rows of equal key; the rest stays.

    Rows whose key has a NULL part match nothing: they are inserted or rejected as the
    table says.
    """
    keys = list(spec.primary_keys)
    # Distinct keys of all batch rows: copies collapse per task, and which of several
    # rows of a key is used does not matter here.
    replaced = batch.select(*keys).distinct()
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(f"`{k}`").isNotNull()
    unmatched, batch = batch.filter(~complete), batch.filter(complete)
    if spec.duplicates == "dedupe":
        batch = deduplicate(batch, keys, spec.order_by)
    if spec.null_keys == "insert":
        batch = batch.unionByName(unmatched)
    kept = state.join(replaced, keys, "left_anti").select(*state.columns)
    return union_evolved(kept, batch)


def overwrite_load(state: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Replace the table, or only the partitions the batch has rows for."""
    if not spec.partition_columns:
        return batch
    # An equal-or-both-NULL match, so that a NULL partition is replaced as well.
    parts = batch.select(*spec.partition_columns).distinct().alias("b")
    on = [F.col(f"s.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in spec.partition_columns]
    kept = state.alias("s").join(parts, on, "left_anti").select(*state.columns)
    return union_evolved(kept, batch)


def _on_time(date_column: str, max_delay_days: int, ref_date):
    # The bare column on one side lets the scan skip what is late.
    return F.col(date_column) >= F.date_sub(as_date(ref_date), max_delay_days)


def filter_late(
    df: DataFrame, date_column: str, max_delay_days: int = 7, ref_date=None
) -> DataFrame:
    """Rows at most ``max_delay_days`` older than the reference day; future dates
    stay, NULL dates go."""
    return df.filter(_on_time(date_column, max_delay_days, ref_date))


def late_summary(
    df: DataFrame,
    date_column: str,
    max_delay_days: int = 7,
    ref_date=None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Total, kept and filtered row counts in one pass."""
    kept = F.count_if(_on_time(date_column, max_delay_days, ref_date))
    total = F.count(F.lit(1))
    return df.groupBy(*group_by).agg(
        total.alias("total_rows"), kept.alias("kept_rows"), (total - kept).alias("late_rows")
    )
