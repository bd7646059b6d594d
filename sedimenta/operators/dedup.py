"""Duplicate removal and accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort_keys(
    df: DataFrame, order_by: Sequence[str | Column] = (), skip: Sequence[str] = ()
) -> list[Column]:
    """Sort columns from ``"col"`` / ``"col DESC"`` texts or Columns.

    Empty means every column of the frame but the skipped ones, in schema order: rows
    that still tie are then identical, so any of them may win.
    """
    if order_by:
        out = []
        for item in order_by:
            if isinstance(item, Column):
                out.append(item)
                continue
            name, _, direction = item.strip().rpartition(" ")
            if name and direction.lower() in ("asc", "desc"):
                col = F.col(f"`{name.strip()}`")
                out.append(col.desc() if direction.lower() == "desc" else col.asc())
            else:
                out.append(F.col(f"`{item.strip()}`").asc())
        return out
    return [
        F.to_json(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in skip
    ] or [F.lit(0)]


def top_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], n: int = 1
) -> DataFrame:
    """First ``n`` rows of every group.

    A ``row_number() <= n`` filter lets Spark cut each group to ``n`` rows per map
    task before the shuffle, so a hot key never reaches one task whole.
    """
    rank = "__rank"
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *sort_keys(df, order_by, skip=keys)
    )
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key (first by ``order_by``), or distinct rows without keys."""
    if not keys:
        return df.dropDuplicates()
    return top_per_group(df, keys, order_by, 1)


def duplicate_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: total, distinct and removed row counts.

    Counting copies per row first keeps the work in partial aggregation, so copies
    of one row collapse before the shuffle.
    """
    copies = df.groupBy(*[F.col(f"`{c}`") for c in columns or df.columns]).agg(
        F.count(F.lit(1)).alias("copies")
    )
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("removed_rows", F.col("total_rows") - F.col("distinct_rows"))
