"""Slowly changing dimensions, type 2, as pure state transitions.

``state`` is the whole dimension (history and current rows), with at most one current
row per complete key, as all loads here keep it; a batch holds source rows. Every
operator returns a DataFrame; none brings rows to the driver.

Join shapes are picked for a state far larger than a batch. In a lookup the current
slice is only ever the streamed side: the batch's keys (or the changed keys) are
joined to it, so Spark broadcasts them whenever their size is under its own
threshold and otherwise sorts both sides by key. Rows with a NULL key part can match
nothing and bypass the joins, so they cannot pile up in one shuffle partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.columns import (
    changed_predicate,
    merge_schemas,
    missing_columns,
    union_evolved,
    with_scd2_columns,
)
from sedimenta.functions.scalars import as_timestamp
from sedimenta.operators.dedup import deduplicate
from sedimenta.operators.lineage import already_loaded, files_frame
from sedimenta.scratch import materialize
from sedimenta.spec import TableSpec

CHANGE = "change_type"
NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def _null_key(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(f"`{k}`").isNull()
    return cond


def _is_current(spec: TableSpec) -> Column:
    return F.col(f"`{spec.scd2_current_flag_column}`").eqNullSafe(F.lit(True))


def _check_batch(batch: DataFrame, spec: TableSpec) -> None:
    missing = missing_columns(batch, (*spec.primary_keys, *spec.tracking_columns))
    if missing:
        raise ValueError(f"{spec.full_name}: batch lacks columns {missing}")


def _admit(batch: DataFrame, spec: TableSpec, extra_keys: Sequence[str] = ()) -> tuple:
    """Split a batch into (one row per key, rows without a complete key)."""
    _check_batch(batch, spec)
    keyed = batch.filter(~_null_key(spec.primary_keys))
    if spec.duplicates == "dedupe":
        keyed = deduplicate(keyed, [*spec.primary_keys, *extra_keys], spec.order_by)
    keyless = None
    if spec.null_keys == "insert":
        keyless = batch.filter(_null_key(spec.primary_keys))
    return keyed, keyless


def scd2_current(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that are current; a partition filter when stored by the current flag."""
    return state.filter(_is_current(spec))


def scd2_history(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that are closed."""
    return state.filter(~_is_current(spec))


def scd2_initial(batch: DataFrame, spec: TableSpec, as_of=None, source_file=None) -> DataFrame:
    """First load: every admitted row becomes an open, current version."""
    keyed, keyless = _admit(batch, spec)
    rows = keyed if keyless is None else keyed.unionByName(keyless)
    return with_scd2_columns(rows, spec, as_of, source_file)


def _verdicts(keyed: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of ``keyed`` that are current in the state, and whether a tracked
    column differs. Reads only key and tracked columns of the current slice."""
    keys, tracked = list(spec.primary_keys), list(spec.tracking_columns)
    narrow = list(dict.fromkeys(keys + tracked))
    cur = scd2_current(state, spec).select(*narrow).alias("cur")
    src = keyed.select(*narrow).alias("src")
    match = [F.col(f"cur.`{k}`") == F.col(f"src.`{k}`") for k in keys]
    pairs = cur.join(src, match, "inner").select(
        *[F.col(f"src.`{k}`").alias(k) for k in keys],
        changed_predicate(tracked, "src", "cur").alias("__differs"),
    )
    return pairs.groupBy(*keys).agg(F.max("__differs").alias("__differs"))


def scd2_classify(batch: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Batch rows with ``change_type``: new, changed or unchanged.

    Untracked columns do not count; a row without a complete key is always new.
    """
    keyed, keyless = _admit(batch, spec)
    verdict = _verdicts(keyed, state, spec)
    differs = F.col("__differs")
    kind = F.when(differs.isNull(), NEW).when(differs, CHANGED).otherwise(UNCHANGED)
    out = (
        keyed.join(verdict, list(spec.primary_keys), "left")
        .withColumn(CHANGE, kind)
        .select(*batch.columns, CHANGE)
    )
    if keyless is not None:
        out = out.unionByName(keyless.withColumn(CHANGE, F.lit(NEW)))
    return out


def scd2_new(batch: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Batch rows whose key has no current row: an anti join on the key tuple."""
    keyed, keyless = _admit(batch, spec)
    keys = list(spec.primary_keys)
    out = keyed.join(scd2_current(state, spec).select(*keys), keys, "left_anti")
    return out if keyless is None else out.unionByName(keyless)


def scd2_changed(batch: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Batch rows whose current row differs in a tracked column."""
    keyed, _ = _admit(batch, spec)
    changed = _verdicts(keyed, state, spec).filter("__differs").drop("__differs")
    return keyed.join(changed, list(spec.primary_keys), "left_semi").select(*batch.columns)


def scd2_close(
    state: DataFrame, changed_keys: DataFrame, spec: TableSpec, as_of=None
) -> DataFrame:
    """State with the current rows of the given keys closed.

    Keys match as a whole tuple. An ``__closes_at`` column in ``changed_keys``
    overrides ``as_of`` per key.
    """
    _, end, current = spec.scd2_columns
    keys = list(spec.primary_keys)
    columns = state.columns
    if "__closes_at" in changed_keys.columns:
        closing = changed_keys.select(*keys, "__closes_at")
    else:
        closing = changed_keys.select(*keys).distinct().withColumn("__closes_at", as_timestamp(as_of))
    reach = _is_current(spec) & ~_null_key(keys)
    hit = F.col("__closes_at").isNotNull()
    closed = (
        state.filter(reach)
        .join(closing, keys, "left")
        .withColumns(
            {
                end: F.when(hit, F.col("__closes_at")).otherwise(F.col(f"`{end}`")),
                current: ~hit,
            }
        )
        .select(*columns)
    )
    return closed.unionByName(state.filter(~reach))


def _lineage(changes: DataFrame, source_file):
    if source_file is None and "_source_file" in changes.columns:
        return F.col("_source_file")
    return source_file


def scd2_delta(
    state: DataFrame, changes: DataFrame, spec: TableSpec, as_of=None, source_file=None
) -> DataFrame:
    """Rows that replace the current slice after a merge: untouched current rows,
    rows closed by it, and the versions it opens. History is not part of it."""
    opened = with_scd2_columns(
        changes.filter(F.col(CHANGE) != UNCHANGED).drop(CHANGE),
        spec,
        as_of,
        _lineage(changes, source_file),
    )
    # Filtered by kind, not by key: rows without a complete key are never "changed".
    changed_keys = changes.filter(F.col(CHANGE) == CHANGED).select(*spec.primary_keys)
    kept = scd2_close(scd2_current(state, spec), changed_keys, spec, as_of)
    return union_evolved(kept, opened)


def _outer_delta(
    state: DataFrame, keyed: DataFrame, spec: TableSpec, as_of, source_file
) -> DataFrame:
    """Like :func:`scd2_delta`, in one pass over both inputs.

    A full outer join on the keys meets every current and every batch row once; each
    joined row yields the kept or closed version, the opened one, or both. Either
    side is shuffled once, the batch in the partitioning its deduplication left.
    """
    eff, end, current = spec.scd2_columns
    keys = list(spec.primary_keys)
    opened = with_scd2_columns(keyed, spec, as_of, _lineage(keyed, source_file))
    schema = merge_schemas(state.schema, opened.schema)
    cur = scd2_current(state, spec).filter(~_null_key(keys))

    def prefixed(df, prefix):
        named = [f"`{c}` AS `{prefix}{c}`" for c in df.columns]
        return df.selectExpr(*named, f"TRUE AS `{prefix}`")

    def version(prefix, columns, override=()):
        """SQL of a row in the common schema."""
        items = []
        for f in schema.fields:
            value = dict(override).get(f.name)
            if value is None:
                value = f"`{prefix}{f.name}`" if f.name in columns else "NULL"
            items.append(f"'{_escaped(f.name)}', CAST({value} AS {f.dataType.simpleString()})")
        return f"named_struct({', '.join(items)})"

    differs = " OR ".join(
        f"NOT (`o.{c}` <=> `n.{c}`)" for c in spec.tracking_columns
    )
    kept = version("o.", state.columns)
    closed = version("o.", state.columns, {end: f"`n.{eff}`", current: "FALSE"})
    new = version("n.", opened.columns)
    joined = prefixed(cur, "o.").join(
        prefixed(opened, "n."),
        [F.col(f"`o.{k}`") == F.col(f"`n.{k}`") for k in keys],
        "full_outer",
    )
    # The new version's effective instant is the old one's end.
    return joined.select(
        F.expr(
            f"inline(CASE WHEN `o.` IS NULL THEN array({new}) "
            f"WHEN `n.` IS NOT NULL AND ({differs}) THEN array({closed}, {new}) "
            f"ELSE array({kept}) END)"
        )
    )


def _escaped(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def scd2_merge(
    state: DataFrame,
    batch: DataFrame,
    spec: TableSpec,
    as_of=None,
    source_file=None,
    changes: DataFrame | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """Full state after merging a batch.

    New keys open a version; changed keys close the current version at ``as_of``
    and open one effective at the same instant; everything else stays.

    By default state and batch meet in one full outer join. For a batch small enough
    to be broadcast, ``small_batch`` looks its keys up in the current slice instead,
    so that the state is not shuffled at all. This classifies the batch right away
    and keeps the rows in the scratch folder, because Spark must know the size of the
    changed keys when it plans the join that closes them. Rows already classified and
    stored (``changes``, from :func:`scd2_classify`) are merged the same way.
    """
    history = scd2_history(state, spec)
    if changes is None and not small_batch:
        keyed, keyless = _admit(batch, spec)
        parts = [_outer_delta(state, keyed, spec, as_of, source_file)]
        parts.append(scd2_current(state, spec).filter(_null_key(spec.primary_keys)))
        if keyless is not None:
            lineage = _lineage(keyless, source_file)
            parts.append(with_scd2_columns(keyless, spec, as_of, lineage))
        return union_evolved(history, *parts)
    if changes is None:
        changes = materialize(scd2_classify(batch, state, spec), "changes")
    return union_evolved(history, scd2_delta(state, changes, spec, as_of, source_file))


def scd2_versions(
    batch: DataFrame, state: DataFrame, spec: TableSpec, effective: str
) -> DataFrame:
    """Versions a batch of several ordered snapshots opens.

    ``effective`` is a timestamp column of the batch, one value per source file.
    Per key, a row opens a version if a tracked column differs from the row before
    it, the first one being compared with the current state. A key has at most one
    row per distinct ``effective`` value here, so its window stays small however
    many rows of the batch carry it. Unchanged rows are left out.
    """
    eff, end, current = spec.scd2_columns
    keys, tracked = list(spec.primary_keys), list(spec.tracking_columns)
    keyed, keyless = _admit(batch, spec, extra_keys=[effective])
    by_key = Window.partitionBy(*keys).orderBy(effective)
    steps = keyed.withColumns(
        {
            "__nth": F.row_number().over(by_key),
            "__same": F.struct(*tracked).eqNullSafe(F.lag(F.struct(*tracked)).over(by_key)),
        }
    ).filter((F.col("__nth") == 1) | ~F.col("__same"))
    verdict = _verdicts(steps.filter(F.col("__nth") == 1), state, spec)
    opened = (
        steps.join(verdict, keys, "left")
        # `differs` is NULL for new keys: their first row opens a version as well.
        .filter((F.col("__nth") > 1) | F.coalesce(F.col("__differs"), F.lit(True)))
        .withColumns(
            {
                "__next": F.lead(effective).over(by_key),
                "__first": F.row_number().over(by_key) == 1,
            }
        )
        .withColumn(
            CHANGE,
            F.when(F.col("__differs").isNull() & F.col("__first"), NEW).otherwise(CHANGED),
        )
        .withColumn("__closes_current", F.col("__differs").isNotNull() & F.col("__first"))
    )
    if keyless is not None:
        opened = opened.unionByName(
            keyless.withColumns(
                {CHANGE: F.lit(NEW), "__closes_current": F.lit(False)}
            ),
            allowMissingColumns=True,
        )
    lineage = F.col("_source_file") if "_source_file" in batch.columns else None
    return (
        with_scd2_columns(opened, spec, F.col(effective), lineage)
        .withColumns({end: F.col("__next"), current: F.col("__next").isNull()})
        .drop("__nth", "__same", "__differs", "__next", "__first")
    )


def scd2_merge_versions(
    state: DataFrame,
    batch: DataFrame,
    spec: TableSpec,
    effective: str,
    versions: DataFrame | None = None,
) -> DataFrame:
    """Full state after merging several ordered snapshots in one pass; equal to
    merging them one after the other, each with its own instant.

    The opened versions (or ``versions``, stored rows of :func:`scd2_versions`) are
    kept in the scratch folder first: they are used twice, and the join that closes
    current rows is planned from their true size.
    """
    if versions is None:
        versions = materialize(scd2_versions(batch, state, spec, effective), "versions")
    delta = scd2_versions_delta(state, versions, spec, effective)
    return union_evolved(scd2_history(state, spec), delta)


def scd2_versions_delta(
    state: DataFrame, versions: DataFrame, spec: TableSpec, effective: str
) -> DataFrame:
    """Like :func:`scd2_delta` for the output of :func:`scd2_versions`."""
    closing = versions.filter("__closes_current").select(
        *spec.primary_keys, F.col(f"`{effective}`").alias("__closes_at")
    )
    kept = scd2_close(scd2_current(state, spec), closing, spec)
    opened = versions.drop(CHANGE, "__closes_current")
    if effective not in state.columns:
        opened = opened.drop(effective)
    return union_evolved(kept, opened)


def scd2_metrics(changes: DataFrame) -> DataFrame:
    """One row of load counts from classified rows."""
    kind = F.col(CHANGE)
    return changes.agg(
        F.count_if(kind == NEW).alias("records_inserted"),
        F.count_if(kind == CHANGED).alias("records_updated"),
        F.lit(0).cast("long").alias("records_deleted"),
        F.count(F.lit(1)).alias("total_records_processed"),
    )


def scd2_undo_load(state: DataFrame, files, spec: TableSpec) -> DataFrame:
    """State as if the given source files had never been merged.

    Their versions disappear; a version that was closed by one of them takes over
    the end and the current flag of the version that replaced it. Consecutive
    versions of undone files are bridged as one.
    """
    eff, end, current = spec.scd2_columns
    keys = list(spec.primary_keys)
    columns = state.columns
    undone_files = files_frame(state, files)
    survivors = state.join(undone_files, "_source_file", "left_anti").select(*columns)
    undone = (
        state.join(undone_files, "_source_file", "left_semi")
        .filter(~_null_key(keys))
        .select(*keys, eff, end, current)
        .distinct()
    )
    # Runs of adjoining undone versions; a key has one row per undone load in here.
    by_key = Window.partitionBy(*keys).orderBy(eff)
    runs = (
        undone.withColumn(
            "__breaks", (~F.col(eff).eqNullSafe(F.lag(end).over(by_key))).cast("int")
        )
        .withColumn("__run", F.sum("__breaks").over(by_key))
        .groupBy(*keys, "__run")
        .agg(
            F.min(eff).alias("__starts"),
            F.max_by(end, eff).alias("__ends"),
            F.max_by(current, eff).alias("__open"),
        )
        .drop("__run")
    )
    runs = runs.select(
        *[F.col(k).alias(f"__run_{k}") for k in keys], "__starts", "__ends", "__open"
    )
    on = [F.col(k) == F.col(f"__run_{k}") for k in keys] + [F.col(end) == F.col("__starts")]
    hit = F.col("__starts").isNotNull()
    reopened = (
        scd2_history(survivors, spec)
        .join(runs, on, "left")
        .withColumns(
            {
                end: F.when(hit, F.col("__ends")).otherwise(F.col(end)),
                current: F.when(hit, F.col("__open")).otherwise(F.col(current)),
            }
        )
        .select(*columns)
    )
    return reopened.unionByName(scd2_current(survivors, spec))


def scd2_rewind(state: DataFrame, keys: DataFrame, spec: TableSpec, since) -> DataFrame:
    """State in which the given keys are as they were before ``since``: their versions that
    start then or later are gone, and the one that held at that instant is current."""
    eff, end, current = spec.scd2_columns
    at, keys = as_timestamp(since), keys.select(*spec.primary_keys).distinct()
    own = state.join(keys, list(spec.primary_keys), "left_semi").select(*state.columns)
    rest = state.join(keys, list(spec.primary_keys), "left_anti").select(*state.columns)
    opens = F.col(f"`{end}`").isNull() | (F.col(f"`{end}`") >= at)
    before = own.filter(F.col(f"`{eff}`") < at).withColumns(
        {
            end: F.when(~opens, F.col(f"`{end}`")),
            current: opens,
        }
    )
    return rest.unionByName(before.select(*state.columns))


def scd2_merge_late(
    state: DataFrame, batch: DataFrame, spec: TableSpec, effective: str, since
) -> DataFrame:
    """Full state after snapshots that come late, equal to merging all in order.

    ``batch`` has the rows of the late snapshots and, for their keys, those of every later
    one, each with its instant in ``effective``; ``since`` is the earliest of these. Which
    values a later snapshot repeats is not in the state, so its rows are needed again. The
    chains of other keys stay as they are.
    """
    keys = batch.filter(~_null_key(spec.primary_keys)).select(*spec.primary_keys)
    rewound = materialize(scd2_rewind(state, keys, spec, since), "rewound")
    return scd2_merge_versions(rewound, batch, spec, effective)


def scd2_idempotent_load(
    state: DataFrame, batch: DataFrame, spec: TableSpec, as_of=None, source_file=None
) -> DataFrame:
    """Merge a file's rows, undoing an earlier load of the same file first.

    Whether there was one is looked up right away; only then is the undone state
    worked out, once, and kept in the scratch folder for the merge.
    """
    files = source_file or batch.select("_source_file").distinct()
    if not already_loaded(state, files).isEmpty():
        state = materialize(scd2_undo_load(state, files, spec), "undo")
    return scd2_merge(state, batch, spec, as_of, source_file)
