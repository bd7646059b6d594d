"""Loads: list new files, read them as one batch, merge, commit, keep the ledger.

All files of a batch go through one read and one commit; parallelism is the Spark
scan's. The driver handles file paths only, at most ``max_files`` at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions.columns import (
    apply_transformations,
    merge_schemas,
    missing_columns,
    with_audit_columns,
)
from sedimenta.functions.scalars import as_timestamp
from sedimenta.operators import append, lineage, scd2
from sedimenta.operators import ledger as led
from sedimenta.operators.summaries import RESULT_SCHEMA
from sedimenta.scratch import local_frame, materialize, temporary_tables
from sedimenta.sources.events import EventLedger
from sedimenta.sources.files import list_files, read_for
from sedimenta.sources.store import CommitConflict, TableStore
from sedimenta.spec import STRATEGIES, TableSpec

_EFFECTIVE = "__effective"
# Tag of an SCD2 version: the latest instant in the table, in microseconds.
_INSTANT = "latest_instant"
# Groups that a failing group of files is cut in, and groups probed at once.
PROBE_FAN, PROBES = 16, 8
# Files of one batch; their paths are the only thing the driver handles.
MAX_FILES = 10_000


def store_for(spark: SparkSession, root: str, spec: TableSpec) -> TableStore:
    """The store a table is kept in; SCD2 tables are split by the current flag, so
    that a merge rewrites current rows and only adds to history."""
    if spec.loading_strategy == "scd2":
        parts = (spec.scd2_current_flag_column, *spec.partition_columns)
    else:
        parts = spec.partition_columns
    return TableStore(
        spark,
        f"{root.rstrip('/')}/{spec.database_name}/{spec.table_name}",
        parts,
        cluster_writes=bool(spec.partition_columns),
        bucket_keys=spec.primary_keys,
        buckets=spec.key_buckets if spec.loading_strategy == "scd2" else 0,
    )


def _file_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("records"))


# -- strategies: (store, batch rows, spec, as_of, files, tags) -> version ------------
# ``files`` are the paths of the batch, as a list. Rows that an earlier load left of one
# of them are removed first. The store notes the paths of every load, with the commit that
# will hold them, before it commits; so only parts that may have their rows are searched.


def _held(store: TableStore, files: Sequence[str]) -> list[dict]:
    """The parts of a table that may have rows of the files, none if no row is found there."""
    parts = store.parts_holding(files)
    if parts and lineage.already_loaded(store.read_parts(parts), files).isEmpty():
        return []
    return parts


def _reloads(store: TableStore, files: Sequence[str]) -> list[dict]:
    """Like :func:`_held`; also notes the files as about to be loaded."""
    held = _held(store, files)
    store.note_files(files)
    return held


def undo_files(store: TableStore, spec: TableSpec, files: Sequence[str], tags=None) -> bool:
    """Remove the rows of source files from a table; whether there were any.

    Of an append table only the folders that hold them are read and written anew. An SCD2
    table gives the ends of removed versions back to those before, over all of its history.
    """
    held = _held(store, files)
    if not held:
        return False
    if spec.loading_strategy == "scd2":
        store.create(scd2.scd2_undo_load(store.read(), list(files), spec), tags)
    else:
        store.replace_parts(append.undo_load(store.read_parts(held), list(files)), held, tags)
    return True


def _buckets(store: TableStore, rows: DataFrame) -> list[int]:
    """Buckets that rows fall in, at most as many as the table has."""
    return sorted(r[0] for r in rows.select(store.bucket()).distinct().collect())


def _load_scd2(store, batch, spec, as_of, files, tags=None):
    """Merge a batch whose files carry ``__effective`` instants."""
    rewrite, reloads = True, _reloads(store, files)
    if not store.exists():
        state = scd2.with_scd2_columns(
            batch.drop(_EFFECTIVE).limit(0), spec, as_of, F.col("_source_file")
        )
    elif reloads:
        state = materialize(scd2.scd2_undo_load(store.read(), list(files), spec), "undo")
    else:
        state, rewrite = store.read(), False
    split = not rewrite and store.splits_like(batch)
    if split:
        # Only buckets of the batch's keys can hold what it is compared with.
        state = store.read_buckets(_buckets(store, batch))
    # Classified once and kept: what is closed and what is opened must agree.
    versions = materialize(scd2.scd2_versions(batch, state, spec, _EFFECTIVE), "versions")
    if split and store.splits_like(versions):
        closing = _buckets(store, versions.filter("__closes_current"))
        delta = scd2.scd2_versions_delta(store.read_buckets(closing), versions, spec, _EFFECTIVE)
        return store.replace_buckets(delta, spec.scd2_current_flag_column, "true", closing, tags)
    delta = scd2.scd2_versions_delta(state, versions, spec, _EFFECTIVE)
    if rewrite:
        whole = scd2.union_evolved(scd2.scd2_history(state, spec), delta)
        return store.create(whole, tags)
    return store.replace_except(delta, {spec.scd2_current_flag_column: "false"}, tags)


def _load_append(store, batch, spec, as_of, files, tags=None):
    rows = with_audit_columns(batch.drop(_EFFECTIVE), as_of)
    if held := _reloads(store, files):
        cleared = append.undo_load(store.read_parts(held), list(files))
        return store.replace_parts(append.union_evolved(cleared, rows), held, tags)
    return store.append(rows, spec.schema_evolution, tags)


def _load_overwrite(store, batch, spec, as_of, files, tags=None):
    rows = with_audit_columns(batch.drop(_EFFECTIVE), as_of)
    if store.exists():
        rows = append.overwrite_load(store.read(), rows, spec)
    store.note_files(files)
    return store.create(rows, tags)


def _load_merge(store, batch, spec, as_of, files, tags=None):
    # Within a batch the row of the latest file wins.
    ties = spec.order_by or tuple(c for c in batch.columns if c != _EFFECTIVE)
    newest = replace(spec, order_by=(f"{_EFFECTIVE} DESC", *ties))
    rows = with_audit_columns(batch, as_of)
    reloads = _reloads(store, files)
    state = store.read() if store.exists() else rows.drop(_EFFECTIVE).limit(0)
    if reloads:
        state = append.undo_load(state, list(files))
    return store.create(append.merge_load(state, rows, newest).drop(_EFFECTIVE), tags)


LOADERS: dict[str, Callable] = {
    "scd2": _load_scd2,
    "append": _load_append,
    "overwrite": _load_overwrite,
    "merge": _load_merge,
}


def register_strategy(
    name: str,
    transition: Callable[[DataFrame | None, DataFrame, TableSpec, str], DataFrame],
) -> None:
    """Add a loading strategy: ``(state or None, batch rows, spec, as_of) -> state``.

    The batch comes transformed and with lineage columns; rows of a file that is
    loaded again are removed from the state first.
    """

    def load(store, batch, spec, as_of, files, tags=None):
        rows = with_audit_columns(batch.drop(_EFFECTIVE), as_of)
        reloads = _reloads(store, files)
        state = store.read() if store.exists() else None
        if reloads:
            state = append.undo_load(state, list(files))
        return store.create(transition(state, rows, spec, as_of), tags)

    if name not in STRATEGIES:
        STRATEGIES.append(name)
    LOADERS[name] = load


def prepare_batch(
    batch: DataFrame,
    spec: TableSpec,
    as_of: str,
    files: Sequence[str],
    offset: int = 0,
    instants: Mapping[str, int] | None = None,
) -> DataFrame:
    """Transformed batch whose rows know their file and that file's instant: the load
    instant plus one microsecond per snapshot before it in this load, or its own one of
    ``instants``, in microseconds."""
    steps = spec.transformations
    if isinstance(steps, Mapping) and "select" in steps:
        # A configured column list does not know of the lineage column.
        if not {"*", "_source_file"} & {c for c in steps["select"] if isinstance(c, str)}:
            steps = {**steps, "select": [*steps["select"], "_source_file"]}
    rows = apply_transformations(batch, steps)
    if "_source_file" not in rows.columns:
        raise ValueError("a transform must keep the _source_file column")
    if instants is None:
        base = F.unix_micros(F.lit(as_of).cast("timestamp")) + offset
        places = {s: n for n, s in enumerate(dict.fromkeys(map(spec.snapshot, files)))}
        ranks = [places[spec.snapshot(f)] for f in files]
    else:
        base, ranks = F.lit(0).cast("long"), [instants[f] for f in files]
    if len(files) == 1:
        return rows.withColumn(_EFFECTIVE, F.timestamp_micros(base + ranks[0]))
    ranks = local_frame(batch.sparkSession, {"_source_file": list(files), "__rank": ranks})
    # One short row per file of the batch, whose number the caller bounds. A row of
    # some other file must not get lost.
    stray = F.raise_error(F.concat(F.lit("row of an unlisted file: "), "_source_file"))
    return (
        rows.join(F.broadcast(ranks), "_source_file", "left")
        .withColumn(
            _EFFECTIVE,
            F.timestamp_micros(base + F.coalesce(F.col("__rank"), stray.cast("long"))),
        )
        .select(*rows.columns, _EFFECTIVE)
    )


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")


def next_offset(store: TableStore, spec: TableSpec, as_of: str, done: int = 0) -> int:
    """Microseconds after ``as_of`` at which the next file of a load takes effect.

    Instants of an SCD2 table only go forward: a file that comes late, or again, follows
    what is in the table, so no version ends before it starts.
    """
    if spec.loading_strategy != "scd2" or not store.exists():
        return done
    latest = store.version().tags.get(_INSTANT)
    if latest is None:
        started = F.unix_micros(F.col(f"`{spec.scd2_effective_date_column}`").cast("timestamp"))
        latest = store.read().agg(F.max(started)).first()[0]
    start = F.unix_micros(F.lit(as_of).cast("timestamp"))
    micros = store.spark.range(1).select(start).first()[0]
    return done if latest is None else max(done, int(latest) + 1 - micros)


def commit_batch(store, batch, spec, as_of, files, offset, tags=None, instants=None) -> None:
    """Run the table's strategy on prepared rows; an SCD2 commit records its last instant."""
    if instants is not None:
        latest = store.version().tags.get(_INSTANT) if store.exists() else None
        known = [instants[f] for f in files] + ([int(latest)] if latest is not None else [])
        tags = {**(tags or {}), _INSTANT: max(known)}
    elif spec.loading_strategy == "scd2":
        start = F.unix_micros(F.lit(as_of).cast("timestamp"))
        micros = store.spark.range(1).select(start).first()[0]
        tags = {**(tags or {}), _INSTANT: micros + offset + len(files) - 1}
    LOADERS[spec.loading_strategy](store, batch, spec, as_of, list(files), tags)


def _refuse_unlike(spec: TableSpec, store: TableStore, batch: DataFrame) -> None:
    """Without schema evolution rows must have the columns the table has."""
    if spec.schema_evolution or not store.exists():
        return
    own = {"_source_file", "_load_timestamp", "_batch_id", *spec.scd2_columns}
    known, got = (set(x) - own for x in (store.schema().names, batch.columns))
    if known != got - {_EFFECTIVE}:
        raise ValueError(f"{spec.full_name}: columns differ by {sorted(known ^ got - {_EFFECTIVE})}")


def _read_batch(spark, spec, store, files, as_of, offset, instants=None) -> DataFrame:
    rows = read_for(spark, spec, files)
    if not spec.schema_evolution and len(files) > 1:
        # One file's columns are read of all; they must be those of all.
        merged = read_for(spark, replace(spec, schema_evolution=True), files)
        if set(merged.columns) != set(rows.columns):
            raise ValueError(f"{spec.full_name}: files differ in columns and evolution is off")
    batch = prepare_batch(rows, spec, as_of, files, offset, instants)
    _refuse_unlike(spec, store, batch)
    return batch


class FileInstants:
    """Instants of the snapshots a table's files belong to, where files give them.

    A snapshot takes effect at the earliest modification time of its files; of several at
    one time each follows the one before it, by path, a microsecond later.
    """

    def __init__(self, listing: DataFrame, completed: DataFrame):
        self.listing, self.completed = listing, completed

    def of(self, files: Sequence[str]) -> dict[str, int]:
        names = local_frame(self.listing.sparkSession, {"path": list(files)})
        rows = self.listing.join(names, "path", "left_semi").select("path", "instant").collect()
        return {r["path"]: r["instant"] for r in rows}

    def later(self, since: int) -> dict[str, int]:
        """Files loaded before whose snapshots take effect after an instant."""
        done = self.completed.select(F.col("file_path").alias("path"))
        rows = self.listing.filter(F.col("instant") > since).join(done, "path", "left_semi")
        return {r["path"]: r["instant"] for r in rows.select("path", "instant").collect()}


def _late(store: TableStore, instants: Mapping[str, int] | None) -> bool:
    latest = store.version().tags.get(_INSTANT) if instants and store.exists() else None
    return latest is not None and min(instants.values()) <= int(latest)


def _merge_late(spark, spec, store, batch, files, as_of, instants, later: Mapping[str, int]) -> None:
    """Merge snapshots that take effect before some that the table has, in their place.

    The later snapshots are read again for the keys of the late ones. If a version to be
    rebuilt comes from a file that is no longer there, nothing is done and the load fails.
    """
    since = F.timestamp_micros(F.lit(min(instants.values())))
    keys = batch.select(*spec.primary_keys).distinct()
    again = {f: t for f, t in later.items() if f not in instants}
    state = store.read()
    if _held(store, files):
        state = materialize(scd2.scd2_undo_load(state, list(files), spec), "undo")
    eff, known = F.col(f"`{spec.scd2_effective_date_column}`"), local_frame(spark, {"_source_file": [*files, *again]})
    lost = state.filter(eff >= since).join(keys, list(spec.primary_keys), "left_semi").join(known, "_source_file", "left_anti")
    gone = lost.select("_source_file").limit(1).collect()
    if gone:
        raise ValueError(f"{spec.full_name}: a late snapshot needs {gone[0][0]}, which is gone")
    rows = batch
    if again:
        names = sorted(again, key=again.get)
        repeated = _read_batch(spark, spec, store, names, as_of, 0, again)
        repeated = repeated.join(keys, list(spec.primary_keys), "left_semi").select(*repeated.columns)
        rows = materialize(append.union_evolved(batch, repeated), "late")
    store.note_files(files)
    latest = max([*instants.values(), int(store.version().tags[_INSTANT])])
    store.create(scd2.scd2_merge_late(state, rows, spec, _EFFECTIVE, since), {_INSTANT: latest})


def _counts(spark, batch: DataFrame, files: Sequence[str]) -> dict:
    """Rows per file, or nothing if they cannot be counted; the load stands either way."""
    try:
        return {r["_source_file"]: r["records"] for r in _file_counts(batch).collect()} or {f: 0 for f in files}
    except Exception:
        return {}


def _load_files(
    spark, spec, store, files: Sequence[str], as_of: str, offset: int, given: FileInstants | None = None
) -> list[tuple]:
    """Load files as one batch; if it fails, find the files at fault and load the others.

    A failed attempt has committed nothing: the commit is the attempt's last step, and a
    lost race for it ends the load. If no file fails alone, as when two of them do not go
    together, the batch is halved until what fails is a single file. What fails before any row is read, for the first file
    alone as well, is the table's fault and fails all files at once.
    """
    started = time.monotonic()
    try:
        with temporary_tables(spark):
            instants = given.of(files) if given else None
            batch = _read_batch(spark, spec, store, files, as_of, offset, instants)
            appends = spec.loading_strategy == "append"
            if not appends:
                # Other strategies read the batch several times, and its rows are counted.
                batch = materialize(batch, "batch")
            if _late(store, instants):
                later = given.later(min(instants.values()))
                _merge_late(spark, spec, store, batch, files, as_of, instants, later)
            else:
                commit_batch(store, batch, spec, as_of, files, offset, instants=instants)
            if appends:
                # Every row was written, and counting it there reads one column.
                names = local_frame(spark, {"_source_file": list(files)})
                batch = store.added().join(names, "_source_file", "left_semi")
            counts = _counts(spark, batch, files)
    except CommitConflict:
        raise
    except Exception as err:  # a bad file must not take the others down
        took = time.monotonic() - started
        if len(files) == 1:
            return [(files[0], spec.table_name, False, took, str(err), 0)]
        if _at_fault(spark, spec, store, files[:1], as_of, err):
            return [(f, spec.table_name, False, took / len(files), str(err), 0) for f in files]
        bad = _bad_files(spark, spec, store, files, as_of)
        if bad:
            failed = [(f, spec.table_name, False, took / len(files), text, 0) for f, text in bad.items()]
            good = [f for f in files if f not in bad]
            return failed + (_load_files(spark, spec, store, good, as_of, offset, given) if good else [])
        half = len(files) // 2
        first = _load_files(spark, spec, store, files[:half], as_of, offset, given)
        offset = next_offset(store, spec, as_of, offset + half)
        return first + _load_files(spark, spec, store, files[half:], as_of, offset, given)
    each = (time.monotonic() - started) / len(files)
    return [(f, spec.table_name, True, each, None, counts.get(f, 0 if counts else None)) for f in files]


def _bad_files(spark, spec, store, files: Sequence[str], as_of: str) -> dict[str, str]:
    """Files whose rows cannot be read and transformed for this table, with the error.

    Jobs that only read, a few at once: a group of files that gets through is done with,
    one that fails is cut in ``PROBE_FAN`` smaller ones. A few bad files among many cost a
    few jobs each, and nothing is written meanwhile.
    """

    def probe(group: Sequence[str]) -> str | None:
        try:
            batch = _read_batch(spark, spec, store, group, as_of, 0)
            lacking = missing_columns(batch, (*spec.primary_keys, *spec.tracking_columns))
            if lacking:
                return f"{spec.full_name}: batch lacks columns {lacking}"
            if store.exists():
                merge_schemas(store.schema(), batch.drop(_EFFECTIVE).schema)
            batch.write.format("noop").mode("overwrite").save()
        except Exception as err:
            return str(err)
        return None

    bad, groups = {}, [list(files)]
    with ThreadPoolExecutor(PROBES) as pool:
        while groups:
            smaller = []
            for group in groups:
                size = -(-len(group) // PROBE_FAN)
                smaller += [group[i : i + size] for i in range(0, len(group), size)]
            found = list(zip(smaller, pool.map(probe, smaller)))
            groups = [g for g, error in found if error is not None and len(g) > 1]
            bad |= {g[0]: error for g, error in found if error is not None and len(g) == 1}
    return bad


def _at_fault(spark, spec, store, one, as_of, err) -> bool:
    """Whether the table's own settings fail: the plan over one file alone is no plan."""
    if not isinstance(err, AnalysisException):
        return False
    try:
        _read_batch(spark, spec, store, one, as_of, 0)
    except AnalysisException as again:
        return again.getCondition() == err.getCondition()
    except Exception:
        return False
    return False


def _overwrite(spark, spec, store, chunks: Sequence[Sequence[str]], as_of: str) -> list[tuple]:
    """One overwrite of all files of a load. Every chunk is read and kept before anything is
    replaced; if a file is bad, the table stays and all files fail."""
    started, files = time.monotonic(), [f for c in chunks for f in c]
    try:
        with temporary_tables(spark):
            batch, done = None, 0
            for chunk in chunks:
                rows = materialize(_read_batch(spark, spec, store, chunk, as_of, done), "batch")
                batch = rows if batch is None else append.union_evolved(batch, rows)
                done += len(chunk)
            commit_batch(store, batch, spec, as_of, files, 0)
            counts = _counts(spark, batch, files)
    except CommitConflict:
        raise
    except Exception as err:
        each = (time.monotonic() - started) / len(files)
        return [(f, spec.table_name, False, each, str(err), 0) for f in files]
    each = (time.monotonic() - started) / len(files)
    return [(f, spec.table_name, True, each, None, counts.get(f, 0 if counts else None)) for f in files]


def _snapshots(listing: DataFrame, spec: TableSpec) -> DataFrame:
    """Listed files with their ``snapshot``, the time ``at`` that it is ordered by, and its
    ``instant`` in microseconds, for tables whose files give it."""
    columns = ("path", "length", "modificationTime")
    if spec.snapshot_by == "folder":
        folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
        rows = listing.select(*columns, folder.alias("snapshot"))
        rows = rows.withColumn("at", F.min("modificationTime").over(Window.partitionBy("snapshot")))
    else:
        rows = listing.select(*columns, F.col("path").alias("snapshot"), F.col("modificationTime").alias("at"))
    if spec.loading_strategy != "scd2" or spec.effective_from != "file":
        return rows
    nth = F.dense_rank().over(Window.partitionBy("at").orderBy("snapshot")) - 1
    return rows.withColumn("instant", F.unix_micros("at") + nth)


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    store: TableStore,
    ledger: TableStore,
    as_of: str | None = None,
    max_files: int = MAX_FILES,
    max_retries: int = 3,
) -> DataFrame:
    """Load every file of a table that is listed and not yet loaded.

    Snapshots (files, or folders of them) go in order of their earliest modification time
    and path, up to ``max_files`` files per batch, until none is left; a folder is divided
    only if it has more files than that; an overwrite reads that way, too, but replaces once. Returns one
    load-result row per file tried. A failed file is tried again by the next call until
    it runs out of retries. One ledger may serve many tables: a file is known by table
    and path. An :class:`EventLedger` is appended to; any other store of ledger rows is
    written anew with every batch.
    """
    start = as_of or _now()
    place = F.struct("at", "snapshot", "path")

    def book() -> DataFrame:
        return ledger.read() if ledger.exists() else led.empty_ledger(spark)

    def change(steps: DataFrame, registered: DataFrame | None = None) -> None:
        steps, now = steps.withColumn("table_name", F.lit(spec.table_name)), as_of or _now()
        if isinstance(ledger, EventLedger):
            events = led.transition_events(steps, now)
            if registered is not None:
                events = led.register_events(registered, spec.table_name, start).unionByName(events)
            return ledger.record(events)
        whole = book()
        if registered is not None:
            whole = led.register_files(whole, registered, spec.table_name, start)
        ledger.create(led.apply_transitions(whole, steps, now))

    with temporary_tables(spark):
        # Listed and compared with the ledger once; chunks are cut from what was kept.
        listing = _snapshots(list_files(spark, spec.source_path_pattern), spec)
        given = None
        if spec.loading_strategy == "scd2" and spec.effective_from == "file":
            listing = materialize(listing, "listing")
            done_files = (F.col("table_name") == spec.table_name) & (F.col("status") == led.COMPLETED)
            given = FileInstants(listing, materialize(book().filter(done_files).select("file_path"), "completed"))
        todo = led.unprocessed_files(listing, book(), True, max_retries, spec.table_name)
        todo = materialize(todo, "todo")
        results, last, done, chunks = None, None, 0, []
        once = spec.loading_strategy == "overwrite"
        while True:
            rest = todo
            if last is not None:
                rest = todo.filter(place > F.struct(F.lit(last["at_text"]).cast("timestamp"), F.lit(last["snapshot"]), F.lit(last["path"])))
            at = F.col("at").cast("string").alias("at_text")
            chunk = rest.orderBy("at", "snapshot", "path").select("*", at).limit(max_files + 1).collect()
            if len(chunk) > max_files:
                # a snapshot that does not fit as well waits for the next batch
                cut = chunk.pop()["snapshot"]
                whole = [r for r in chunk if r["snapshot"] != cut]
                chunk = whole or chunk
            outcome: list[tuple] = []
            if chunk:
                files = [r["path"] for r in chunk]
                last = chunk[-1]
                chosen = local_frame(
                    spark, {n: [r[n] for r in chunk] for n in ("path", "length", "modificationTime")}
                )
                begun = F.col("path").alias("file_path"), F.lit(led.PROCESSING).alias("status")
                change(chosen.select(*begun), chosen)
                if once:
                    chunks.append(files)
                else:
                    outcome = _load_files(
                        spark, spec, store, files, start, 0 if given else next_offset(store, spec, start, done), given
                    )
                    if given:
                        known = given.completed.unionAll(spark.createDataFrame([(r[0],) for r in outcome if r[2]], "file_path string"))
                        given = FileInstants(listing, materialize(known, "completed"))
                done += len(files)
            elif chunks:
                outcome, chunks = _overwrite(spark, spec, store, chunks, start), []
            else:
                break
            if outcome:
                rows = spark.createDataFrame(outcome, RESULT_SCHEMA)
                finished = rows.select(
                    "file_path",
                    F.when(F.col("success"), led.COMPLETED).otherwise(led.FAILED).alias("status"),
                    "error_message",
                )
                change(finished)
                results = rows if results is None else results.unionAll(rows)
    return results if results is not None else spark.createDataFrame([], RESULT_SCHEMA)


class TableStates:
    """What became of each table in the last runs: ``table_name``, ``status``, ``last_updated``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.store = TableStore(spark, f"{root.rstrip('/')}/metadata/table_status")

    def read(self) -> DataFrame:
        if self.store.exists():
            return self.store.read()
        return self.spark.createDataFrame([], "table_name string, status string, last_updated timestamp")

    def set(self, statuses: Mapping[str, str], as_of: str | None = None) -> None:
        """Give tables a status; a row per table, so the table is small and written anew."""
        names = {"table_name": list(statuses), "status": list(statuses.values())}
        new = local_frame(self.spark, names).withColumn("last_updated", as_timestamp(as_of))
        old = self.read().join(new, "table_name", "left_anti")
        self.store.create(old.unionByName(new).coalesce(1))

    def repair(self, ledger: DataFrame, as_of: str | None = None) -> None:
        """Tables that are said to be completed but have failed files are failed."""
        if self.store.exists():
            self.store.create(led.fix_table_status(self.read(), ledger, as_of).coalesce(1))


def load_all(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    root: str,
    as_of: str | None = None,
    only: Sequence[str] | None = None,
    max_files: int = MAX_FILES,
    max_retries: int = 3,
    days_to_keep: int | None = None,
    resume: bool = False,
) -> DataFrame:
    """Repair the ledger, load every table, and give failed files one more try.

    A table that cannot be loaded at all yields one failed result row and leaves
    the others alone. With ``days_to_keep`` older ledger rows are purged at the end.
    Which tables are in progress, completed or failed is kept in :class:`TableStates`;
    with ``resume`` tables that an earlier run completed, with no file failed since, are
    passed over.
    """
    book = EventLedger(spark, f"{root.rstrip('/')}/metadata/file_ledger")
    if book.exists():
        orphans = led.orphaned_files(book.read(), as_of)
        if not orphans.isEmpty():
            book.record(led.orphan_events(book.read(), as_of))
    states = TableStates(spark, root)
    if book.exists():
        states.repair(book.read(), as_of)
    chosen = [s for s in specs if only is None or s.table_name in only]
    if resume and chosen:
        names = local_frame(spark, {"table_name": [s.table_name for s in chosen]})
        left = {r["table_name"] for r in led.tables_to_run(names, states.read()).collect()}
        chosen = [s for s in chosen if s.table_name in left]
    if chosen:
        states.set({s.table_name: "in_progress" for s in chosen}, as_of)
    results, bad = None, {}
    for attempt in (1, 2):
        if attempt == 2:
            failed = results is not None and results.filter(~F.col("success"))
            if failed is False or failed.isEmpty():
                break
            names = {r["table_name"] for r in failed.select("table_name").distinct().collect()}
            chosen = [s for s in chosen if s.table_name in names]
        for spec in chosen:
            try:
                rows = load_table(
                    spark, spec, store_for(spark, root, spec), book, as_of, max_files, max_retries
                )
            except Exception as err:  # keep going with the other tables
                rows = spark.createDataFrame(
                    [(None, spec.table_name, False, 0.0, str(err), 0)], RESULT_SCHEMA
                )
            results = rows if results is None else results.unionAll(rows)
            bad[spec.table_name] = not rows.filter(~F.col("success")).isEmpty()
    if bad:
        states.set({name: "failed" if failed else "completed" for name, failed in bad.items()}, as_of)
    if days_to_keep is not None and book.exists():
        book.create(led.purge_ledger(book.read(), as_of, days_to_keep))
    return results if results is not None else spark.createDataFrame([], RESULT_SCHEMA)
