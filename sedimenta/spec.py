"""Declarative description of one target table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# Strategy names and file formats a table description may use.
STRATEGIES = ["scd2", "append", "overwrite", "merge"]
FILE_FORMATS = ("parquet", "csv", "json", "delta")


def _as_tuple(value) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


@dataclass(frozen=True)
class TableSpec:
    """What to load, where it goes and how rows are merged.

    ``primary_keys``/``tracking_columns`` drive the SCD2 and merge strategies.
    ``order_by`` decides which of several rows with one key wins inside a batch
    (``"col"`` or ``"col DESC"``); without it every batch column takes part, in
    schema order, so the choice never depends on partitioning.
    ``duplicates="keep"`` skips that step for sources known to have unique keys;
    ``null_keys="reject"`` drops rows whose key has a NULL part instead of inserting
    them. A ``source_schema`` spares text files the pass that infers types; CSV files
    must then have their columns in its order. ``key_buckets`` splits an SCD2 table by a
    hash of its keys, so that a merge rewrites only buckets that hold a version it closes;
    choose them so that a bucket's current rows are some hundred MB.

    ``snapshot_by="folder"`` makes the files of one folder one snapshot, with one instant,
    instead of each file. ``effective_from="file"`` lets an SCD2 snapshot take effect at its
    files' modification time instead of the load's, so that one that comes late is merged
    where it belongs in the history.
    """

    table_name: str
    database_name: str
    source_path_pattern: str = ""
    loading_strategy: str = "append"
    primary_keys: tuple[str, ...] = ()
    tracking_columns: tuple[str, ...] = ()
    scd2_effective_date_column: str = "effective_date"
    scd2_end_date_column: str = "end_date"
    scd2_current_flag_column: str = "is_current"
    file_format: str = "parquet"
    schema_evolution: bool = True
    partition_columns: tuple[str, ...] = ()
    transformations: Any = None
    order_by: tuple[str, ...] = ()
    duplicates: str = "dedupe"
    null_keys: str = "insert"
    reader_options: Mapping[str, str] = field(default_factory=dict)
    source_schema: Any = None
    key_buckets: int = 0
    snapshot_by: str = "file"
    effective_from: str = "load"

    def __post_init__(self):
        for name in ("primary_keys", "tracking_columns", "partition_columns", "order_by"):
            object.__setattr__(self, name, _as_tuple(getattr(self, name)))
        strategy = getattr(self.loading_strategy, "value", self.loading_strategy)
        object.__setattr__(self, "loading_strategy", strategy)
        object.__setattr__(self, "file_format", self.file_format.lower())

        if not self.table_name:
            raise ValueError("table_name is required")
        if not self.database_name:
            raise ValueError("database_name is required")
        if strategy not in STRATEGIES:
            raise ValueError(f"Unsupported loading strategy: {strategy}")
        if self.file_format not in FILE_FORMATS:
            raise ValueError(f"Unsupported file format: {self.file_format}")
        if self.duplicates not in ("dedupe", "keep"):
            raise ValueError("duplicates must be 'dedupe' or 'keep'")
        if self.null_keys not in ("insert", "reject"):
            raise ValueError("null_keys must be 'insert' or 'reject'")
        if strategy in ("scd2", "merge") and not self.primary_keys:
            raise ValueError(f"{strategy} strategy requires primary_keys")
        if self.snapshot_by not in ("file", "folder"):
            raise ValueError("snapshot_by must be 'file' or 'folder'")
        if self.effective_from not in ("load", "file"):
            raise ValueError("effective_from must be 'load' or 'file'")
        if self.key_buckets < 0:
            raise ValueError("key_buckets must not be negative")
        if strategy == "scd2":
            if not self.tracking_columns:
                raise ValueError("scd2 strategy requires tracking_columns")
            if not all(self.scd2_columns):
                raise ValueError("scd2 strategy requires the three SCD2 column names")
            if len(set(self.scd2_columns)) != 3:
                raise ValueError("SCD2 column names must differ")

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> TableSpec:
        """Build from a plain mapping; settings that Spark itself decides are ignored."""
        known = {f.name for f in fields(cls)}
        optional = {k: v for k, v in config.items() if k in known and v is not None}
        return cls(**optional)

    def snapshot(self, path: str) -> str:
        """What a file is a snapshot with: its folder, or itself."""
        return path.rpartition("/")[0] if self.snapshot_by == "folder" else path

    @property
    def full_name(self) -> str:
        return f"{self.database_name}.{self.table_name}"

    @property
    def scd2_columns(self) -> tuple[str, str, str]:
        """(effective, end, current) column names."""
        return (
            self.scd2_effective_date_column,
            self.scd2_end_date_column,
            self.scd2_current_flag_column,
        )
