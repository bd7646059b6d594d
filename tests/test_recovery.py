"""Loads that are cut off, race, or meet what an earlier one left behind."""

import os

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import append, quality, series
from sedimenta.operators import ledger as led
from sedimenta.plans import loading
from sedimenta.sources.store import SNAPSHOT_EVERY, CommitConflict, TableStore
from sedimenta.streaming import loaders
from tests.conftest import rows
from tests.test_loading import SCD2, T1, T2, put, spec_for


def tables(spark, tmp_path, spec):
    root = str(tmp_path / "root")
    return loading.store_for(spark, root, spec), TableStore(spark, f"{root}/ledger")


@pytest.mark.parametrize("settings", [{}, SCD2, {"loading_strategy": "merge", "primary_keys": "k"}])
def test_counting_fails_after_the_commit(spark, tmp_path, monkeypatch, settings):
    raw = str(tmp_path / "raw")
    for n in range(3):
        put(raw, f"{n}.csv", f"k,v\n{n},x\n", 1000 + n)
    spec = spec_for(raw, **settings)
    store, book = tables(spark, tmp_path, spec)

    def fails(batch):
        raise RuntimeError("no counts")

    monkeypatch.setattr(loading, "_file_counts", fails)
    result = loading.load_table(spark, spec, store, book, T1)
    assert rows(result, "success", "total_records_processed") == [(True, None)] * 3
    assert rows(store.read(), "k") == [(0,), (1,), (2,)]


@pytest.mark.parametrize("settings", [{}, SCD2, {"loading_strategy": "overwrite"}])
def test_commit_fails(spark, tmp_path, monkeypatch, settings):
    raw = str(tmp_path / "raw")
    put(raw, "1.csv", "k,v\n1,x\n", 1000)
    spec = spec_for(raw, **settings)
    store, book = tables(spark, tmp_path, spec)
    publish = TableStore._publish

    def fails(self, new, base):
        if self is store:
            raise CommitConflict("lost")
        publish(self, new, base)

    monkeypatch.setattr(TableStore, "_publish", fails)
    with pytest.raises(CommitConflict):
        loading.load_table(spark, spec, store, book, T1)
    assert not store.exists() and rows(book.read(), "status") == [("processing",)]
    monkeypatch.setattr(TableStore, "_publish", publish)
    assert rows(loading.load_table(spark, spec, store, book, T2), "success") == [(True,)]
    assert rows(store.read(), "k") == [(1,)]


def test_leftovers_of_a_crash_block_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    store = TableStore(spark, root)
    store.create(spark.range(2))
    os.makedirs(f"{root}/log/v=00000002/_temporary/0")
    (tmp_path / "t/log/_draft-x").write_text("{")
    other = TableStore(spark, root)
    other.append(spark.range(2, 3))
    assert rows(TableStore(spark, root).read()) == [(0,), (1,), (2,)]


def test_of_two_writers_one_gets_through(spark, tmp_path):
    root = str(tmp_path / "t")
    TableStore(spark, root).create(spark.range(1))
    one, two = TableStore(spark, root), TableStore(spark, root)
    base = one.version(), two.version()
    assert base[0] == base[1]
    two._latest = base[1]
    one.append(spark.range(1, 2))
    with pytest.raises(CommitConflict):
        two.append(spark.range(5, 6))
    assert rows(TableStore(spark, root).read()) == [(0,), (1,)]


def test_log_holds_changes(spark, tmp_path):
    """Versions read back as they were, and entries do not repeat parts and schemas."""
    root = str(tmp_path / "t")
    store = TableStore(spark, root, ["p"], cluster_writes=False)
    store.create(spark.range(2).withColumn("p", F.lit("a")))
    for n in range(SNAPSHOT_EVERY + 2):
        store.append(spark.range(n, n + 1).withColumn("p", F.lit("b")))
    last = store.version().number
    store.replace_except(spark.range(90, 91).withColumn("p", F.lit("c")), {"p": "a"})
    fresh = TableStore(spark, root)
    assert fresh.version() == store.version()
    assert rows(fresh.read(), "id", "p") == [(0, "a"), (1, "a"), (90, "c")]
    assert fresh.read(last).count() == SNAPSHOT_EVERY + 4
    sizes = {f: os.path.getsize(f"{root}/log/{f}") for f in os.listdir(f"{root}/log") if f.endswith(".delta.json")}
    assert max(sizes.values()) < 2 * min(sizes.values())


def test_broken_transform_fails_at_once(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    for n in range(6):
        put(raw, f"{n}.csv", f"k,v\n{n},x\n", 1000 + n)
    spec = spec_for(raw, transformations={"filter": "no_such_column > 1"})
    store, book = tables(spark, tmp_path, spec)
    tried = []
    read = loading.read_for
    monkeypatch.setattr(loading, "read_for", lambda s, t, files: tried.append(files) or read(s, t, files))
    result = loading.load_table(spark, spec, store, book, T1)
    assert result.filter("success").isEmpty() and result.count() == 6 and len(tried) == 2


def test_stream_and_load_agree_on_the_order_of_files(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "b.csv", "k,v\n1,older\n", 1000)
    put(raw, "a.csv", "k,v\n1,newer\n", 2000)
    spec = spec_for(raw, **SCD2, source_schema="k bigint, v string")
    store, book = tables(spark, tmp_path, spec)
    loading.load_table(spark, spec, store, book, T1)
    streamed = TableStore(spark, str(tmp_path / "stream"), [spec.scd2_current_flag_column])
    source = loaders.stream_source(spark, spec, "k bigint, v string")
    loaders.stream_scd2(source, spec, streamed, str(tmp_path / "checkpoint"), T1).awaitTermination()
    for table in (store, streamed):
        assert rows(table.read().filter("is_current"), "v") == [("newer",)]


def test_stream_batches_of_many_files(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    for n in range(5):
        put(raw, f"{n}.csv", f"k,v\n1,{n}\n", 1000 + n)
    monkeypatch.setattr(loaders, "MAX_FILES", 2)
    spec = spec_for(raw, **SCD2)
    store = TableStore(spark, str(tmp_path / "stream"), [spec.scd2_current_flag_column])
    source = loaders.stream_source(spark, spec, "k bigint, v string", max_files=100)
    loaders.stream_scd2(source, spec, store, str(tmp_path / "checkpoint"), T1).awaitTermination()
    history = store.read().orderBy("effective_date").collect()
    assert [r["v"] for r in history] == list("01234")
    assert all(r["end_date"] is None or r["end_date"] > r["effective_date"] for r in history)


def test_later_steps_win_at_one_instant(spark):
    listing = spark.createDataFrame([("/a",)], "path string")
    book = led.register_files(led.empty_ledger(spark), listing, "t", T1)
    steps = spark.createDataFrame([("/a", "completed"), ("/a", "processing")], "file_path string, status string")
    assert rows(led.apply_transitions(book, steps, T1), "status") == [("completed",)]


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.partition("PushedFilters: [")[2].partition("]")[0]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    book = led.register_files(led.empty_ledger(spark), spark.createDataFrame([("/a",)], "path string"), "t", T1)
    book.write.parquet(path)
    book = spark.read.parquet(path)
    late = append.filter_late(book, "created_at", 3, T2)
    assert "GreaterThanOrEqual(created_at" in pushed(late)
    orphans = led.orphaned_files(book, T2)
    assert "EqualTo(status,processing)" in pushed(orphans) and "LessThan(" in pushed(orphans)


def test_windows_longer_than_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", 2)
    samples = spark.range(20).selectExpr("'s' AS series", "id AS ts", "double(id) AS value")
    found = series.rolling_average(samples, window=7)
    name = next(c for c in found.columns if c not in ("series", "ts", "value"))
    got = {r["ts"]: r[name] for r in found.collect()}
    assert got == {t: None if t < 6 else t - 3.0 for t in range(20)}


def test_small_tables_have_a_size(spark):
    for measure in (False, True):
        row = quality.estimate_size(spark.range(25), measure=measure).first()
        assert row["estimated_size_bytes"] > 0 and row["sample_count"] == 25
    assert quality.estimate_size(spark.range(0)).first()["estimated_size_bytes"] == 0
