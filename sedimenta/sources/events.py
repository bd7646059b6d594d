"""A file ledger kept as appended events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators import ledger as led
from sedimenta.sources.store import TableStore

# Commits after which the events are folded to one row per file.
FOLD_EVERY = 64


class EventLedger(TableStore):
    """A ledger whose changes are appended, so that a load writes as many rows as it has
    files, however many the ledger knows.

    :meth:`read` folds the events to the ledger's rows. After ``fold_every`` commits they are
    rewritten as such, which keeps a read near the size of the ledger. ``create`` replaces
    the ledger by rows, and a ledger that was written as rows is read and continued.
    """

    def __init__(self, spark, root: str, fold_every: int = FOLD_EVERY):
        super().__init__(spark, root)
        self.fold_every = fold_every

    def events(self) -> DataFrame:
        """The events since the last fold."""
        rows = super().read()
        kinds = {"event_commit": "long", "event_is_row": "boolean", "event_sets_message": "boolean"}
        missing = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in rows.columns}
        return rows.withColumns(missing) if missing else rows

    def read(self, version: int | None = None) -> DataFrame:
        """The ledger, one row per table and file."""
        if version is None:
            return led.fold_events(self.events())
        rows = super().read(version)
        return led.fold_events(rows) if "event_is_row" in rows.columns else rows

    def record(self, events: DataFrame) -> None:
        """Append events; they follow all that were recorded before."""
        base = self.version()
        commit = base.number + 1 if base else 1
        stamped = events.withColumn("event_commit", F.lit(commit).cast("long"))
        if base is not None and len(base.parts) >= self.fold_every:
            self.create(led.row_events(self.read()).select(*led.LEDGER_SCHEMA.names))
        self.append(stamped)
