import random
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import scd2
from sedimenta.scratch import materialize
from tests.conftest import rows

T0, T1, T2, T3 = (f"2024-0{m}-01 00:00:00" for m in (1, 2, 3, 4))
SPEC = TableSpec(
    table_name="t",
    database_name="d",
    loading_strategy="scd2",
    primary_keys=("a", "b"),
    tracking_columns=("v", "w"),
)
SCHEMA = pa.schema(
    [("a", pa.int32()), ("b", pa.int32()), ("v", pa.string()), ("w", pa.float64()), ("note", pa.string())]
)


def at(text):
    return datetime.fromisoformat(text)


def frame(spark, data):
    columns = list(zip(*data)) or [()] * len(SCHEMA)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, SCHEMA)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=SCHEMA))


@pytest.fixture(scope="module")
def state(spark):
    return materialize(scd2.scd2_initial(
        frame(
            spark,
            [
                (1, 1, "x", 1.0, "n"),
                (1, 2, None, 2.0, "n"),
                (2, 1, "y", None, "n"),
                (2, 2, None, None, "n"),
                (None, 1, "k", 1.0, "n"),
            ],
        ),
        SPEC,
        T0,
        "f0",
    ))


def versions(df):
    return rows(df, "a", "b", "v", "w", "effective_date", "end_date", "is_current")


@pytest.mark.parametrize("small", [False, True])
def test_nulls_keys_and_composites(spark, state, small):
    batch = frame(
        spark,
        [
            (1, 1, None, 1.0, "n"),  # value -> NULL
            (1, 2, "z", 2.0, "n"),  # NULL -> value
            (2, 1, "y", None, "other"),  # only an untracked column
            (2, 2, None, None, "n"),  # NULL -> NULL
            (3, 1, "q", 0.0, "n"),  # new; 3 and 1 both occur apart
            (None, 1, "k", 1.0, "n"),  # no complete key: always new
        ],
    )
    merged = scd2.scd2_merge(state, batch, SPEC, T1, "f1", small_batch=small)
    t0, t1 = at(T0), at(T1)
    assert versions(merged) == sorted(
        [
            (1, 1, "x", 1.0, t0, t1, False),
            (1, 1, None, 1.0, t1, None, True),
            (1, 2, None, 2.0, t0, t1, False),
            (1, 2, "z", 2.0, t1, None, True),
            (2, 1, "y", None, t0, None, True),
            (2, 2, None, None, t0, None, True),
            (None, 1, "k", 1.0, t0, None, True),
            (3, 1, "q", 0.0, t1, None, True),
            (None, 1, "k", 1.0, t1, None, True),
        ],
        key=repr,
    )
    kinds = scd2.scd2_classify(batch, state, SPEC)
    assert rows(kinds.groupBy("change_type").count()) == [
        ("changed", 2), ("new", 2), ("unchanged", 2),
    ]
    metrics = scd2.scd2_metrics(kinds).first().asDict()
    assert metrics == {
        "records_inserted": 2,
        "records_updated": 2,
        "records_deleted": 0,
        "total_records_processed": 6,
    }


def test_one_changed_component_closes_one_tuple(spark, state):
    keys = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    closed = scd2.scd2_close(state, keys, SPEC, T1)
    assert rows(closed.filter("NOT is_current"), "a", "b") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("small", [False, True])
def test_duplicate_keys_in_batch(spark, state, small):
    batch = frame(spark, [(1, 1, "p", 9.0, "n"), (1, 1, "o", 8.0, "n"), (1, 1, "o", 8.0, "n")])
    merged = scd2.scd2_merge(state, batch, SPEC, T1, "f1", small_batch=small)
    assert rows(merged.filter("is_current AND a = 1 AND b = 1"), "v") == [("o",)]
    spec = TableSpec(**{**SPEC.__dict__, "order_by": ("w DESC",)})
    merged = scd2.scd2_merge(state, batch, spec, T1, "f1", small_batch=small)
    assert rows(merged.filter("is_current AND a = 1 AND b = 1"), "v") == [("p",)]


def test_empty_batches(spark, state):
    empty = frame(spark, [])
    assert scd2.scd2_initial(empty, SPEC, T0, "f").count() == 0
    assert versions(scd2.scd2_merge(state, empty, SPEC, T1, "f")) == versions(state)


@pytest.mark.parametrize("small", [False, True])
def test_same_batch_twice_changes_nothing(spark, state, small):
    batch = frame(spark, [(1, 1, "new", 1.0, "n"), (5, 5, "new", 1.0, "n")])
    once = scd2.scd2_merge(state, batch, SPEC, T1, "f1", small_batch=small)
    twice = scd2.scd2_merge(once, batch, SPEC, T2, "f2", small_batch=small)
    assert versions(twice) == versions(once)


def test_undo_restores_state(spark, state):
    batch = frame(spark, [(1, 1, "new", 1.0, "n"), (5, 5, "new", 1.0, "n"), (None, 2, "k", 0.0, "n")])
    merged = scd2.scd2_merge(state, batch, SPEC, T1, "f'1")
    assert versions(scd2.scd2_undo_load(merged, "f'1", SPEC)) == versions(state)
    assert versions(scd2.scd2_undo_load(merged, "unknown", SPEC)) == versions(merged)


def test_undo_between_other_loads(spark, state):
    three = state
    for n, (value, when) in enumerate((("one", T1), ("two", T2), ("three", T3)), 1):
        batch = frame(spark, [(1, 1, value, 1.0, "n")])
        three = materialize(scd2.scd2_merge(three, batch, SPEC, when, f"f{n}"))
    of_key = "a = 1 AND b = 1"
    undone = scd2.scd2_undo_load(three, "f2", SPEC).filter(of_key)
    assert rows(undone, "v", "end_date", "is_current") == sorted(
        [("x", at(T1), False), ("one", at(T3), False), ("three", None, True)], key=repr
    )
    # Two adjoining loads at once, and the last two.
    undone = scd2.scd2_undo_load(three, ["f1", "f2"], SPEC).filter(of_key)
    assert rows(undone, "v", "end_date", "is_current") == sorted(
        [("x", at(T3), False), ("three", None, True)], key=repr
    )
    undone = scd2.scd2_undo_load(three, ["f2", "f3"], SPEC).filter(of_key)
    assert rows(undone, "v", "end_date", "is_current") == sorted(
        [("x", at(T1), False), ("one", None, True)], key=repr
    )


def test_reload_equals_load(spark, state):
    batch = frame(spark, [(1, 1, "new", 1.0, "n"), (5, 5, "new", 1.0, "n")])
    once = scd2.scd2_merge(state, batch, SPEC, T1, "f1")
    again = scd2.scd2_idempotent_load(once, batch, SPEC, T1, "f1")
    assert versions(again) == versions(once)


def test_closed_key_returns_to_old_value(spark, state):
    one = scd2.scd2_merge(state, frame(spark, [(1, 1, "one", 1.0, "n")]), SPEC, T1, "f1")
    back = scd2.scd2_merge(one, frame(spark, [(1, 1, "x", 1.0, "n")]), SPEC, T2, "f2")
    assert rows(back.filter("a = 1 AND b = 1"), "v", "is_current") == [
        ("one", False), ("x", False), ("x", True),
    ]


@pytest.mark.parametrize("small", [False, True])
def test_columns_may_come_go_and_widen(spark, state, small):
    batch = (
        frame(spark, [(1, 1, "new", 1.0, "n")])
        .drop("note")
        .withColumn("extra", F.lit(7))
        .withColumn("a", F.col("a").cast("long"))
    )
    merged = scd2.scd2_merge(state, batch, SPEC, T1, "f1", small_batch=small)
    assert dict(merged.dtypes)["a"] == "bigint"
    new = merged.filter("is_current AND a = 1 AND b = 1").first()
    assert (new["note"], new["extra"], new["v"]) == (None, 7, "new")
    assert merged.filter("extra IS NULL").count() == 5


def test_conflicting_types_are_refused(spark, state):
    batch = frame(spark, [(1, 1, "new", 1.0, "n")]).withColumn("note", F.lit(3))
    with pytest.raises(ValueError, match="note"):
        scd2.scd2_merge(state, batch, SPEC, T1, "f1")


def test_missing_tracked_column_is_refused(spark, state):
    with pytest.raises(ValueError, match="'w'"):
        scd2.scd2_merge(state, frame(spark, []).drop("w"), SPEC, T1)


def test_null_keys_can_be_rejected(spark, state):
    spec = TableSpec(**{**SPEC.__dict__, "null_keys": "reject"})
    batch = frame(spark, [(None, 1, "k", 1.0, "n"), (9, 9, "k", 1.0, "n")])
    merged = scd2.scd2_merge(state, batch, spec, T1, "f1")
    assert rows(merged.filter("_source_file = 'f1'"), "a") == [(9,)]


def test_versions_equal_merges_in_turn(spark, state):
    """Random snapshots, merged one by one and in one pass."""
    rng = random.Random(7)
    batches = []
    for _ in range(4):
        rows_ = {}
        for _ in range(25):
            key = (rng.randint(1, 4), rng.choice([1, 2, None]))
            rows_.setdefault(key, []).append(
                (*key, rng.choice(["x", "y", None]), rng.choice([1.0, 2.0]), "n")
            )
        batches.append([r for group in rows_.values() for r in group])
    instants = [T1, T2, T3, "2024-05-01 00:00:00"]
    expected, union = state, None
    for n, (data, when) in enumerate(zip(batches, instants)):
        batch = frame(spark, data)
        expected = materialize(scd2.scd2_merge(expected, batch, SPEC, when, f"f{n + 1}"))
        stamped = batch.withColumns(
            {"at": F.lit(when).cast("timestamp"), "_source_file": F.lit(f"f{n + 1}")}
        )
        union = stamped if union is None else union.unionByName(stamped)
    got = scd2.scd2_merge_versions(state, union, SPEC, "at")
    assert versions(got) == versions(expected)
    one_current = got.filter("is_current AND a IS NOT NULL AND b IS NOT NULL")
    assert one_current.groupBy("a", "b").count().filter("count > 1").isEmpty()
