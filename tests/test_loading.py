import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import ledger as led
from sedimenta.operators import scd2
from sedimenta.operators.summaries import load_summary, run_summary
from sedimenta.plans import loading
from sedimenta.sources.events import EventLedger
from sedimenta.sources.store import TableStore
from sedimenta.streaming import loaders
from tests.conftest import rows

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def put(folder, name, text, mtime):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (mtime, mtime))
    return path


def spec_for(raw, **settings):
    base = {
        "table_name": "t",
        "database_name": "d",
        "source_path_pattern": f"{raw}/*.csv",
        "file_format": "csv",
    }
    return TableSpec(**{**base, **settings})


SCD2 = {"loading_strategy": "scd2", "primary_keys": "k", "tracking_columns": "v"}


def test_append_isolates_bad_files_and_resumes(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    good = [put(raw, f"{n}.csv", f"k,v\n{n},x\n", 1000 + n) for n in range(3)]
    spec = spec_for(raw, transformations={"filter": "assert_true(v <> 'bad') IS NULL"})
    bad = put(raw, "bad.csv", "k,v\n9,bad\n", 1001)
    store, book = loading.store_for(spark, root, spec), TableStore(spark, f"{root}/ledger")

    result = loading.load_table(spark, spec, store, book, T1)
    assert rows(result, "file_path", "success", "total_records_processed") == sorted(
        [(p, True, 1) for p in good] + [(bad, False, 0)], key=repr
    )
    assert rows(store.read(), "k", "_batch_id") == [(n, f"{n}.csv") for n in range(3)]
    ledger = book.read()
    assert rows(ledger.filter("status = 'failed'"), "file_path", "retry_count") == [(bad, 1)]
    assert rows(ledger.filter("status = 'completed'"), "file_path") == [(p,) for p in good]
    assert load_summary(result).first()["failed_files"] == 1

    put(raw, "bad.csv", "k,v\n9,mended\n", 2000)
    more = put(raw, "new.csv", "k,v,w\n10,x,extra\n", 3000)
    result = loading.load_table(spark, spec, store, book, T2)
    assert rows(result, "file_path", "success") == sorted([(bad, True), (more, True)], key=repr)
    assert rows(store.read(), "k", "w") == sorted(
        [(0, None), (1, None), (2, None), (9, None), (10, "extra")], key=repr
    )
    assert loading.load_table(spark, spec, store, book, T2).isEmpty()
    assert run_summary(result).first()["success_rate"] == 100.0


def test_retries_run_out(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "bad.csv", "k,v\n9,bad\n", 1001)
    spec = spec_for(raw, transformations={"filter": "assert_true(false) IS NULL"})
    result = loading.load_all(spark, [spec], root, T1, max_retries=2)
    assert result.count() == 2  # first try and the retry
    assert loading.load_all(spark, [spec], root, T1, max_retries=2).isEmpty()


def test_small_batches_in_file_order(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    for n, value in enumerate("abcab"):
        put(raw, f"{9 - n}.csv", f"k,v\n1,{value}\n", 1000 + n)
    spec = spec_for(raw, **SCD2, source_schema="k bigint, v string")
    store, book = loading.store_for(spark, root, spec), TableStore(spark, f"{root}/ledger")
    result = loading.load_table(spark, spec, store, book, T1, max_files=2)
    assert dict(store.read().dtypes)["k"] == "bigint"
    assert result.count() == 5
    history = [r["v"] for r in store.read().orderBy("effective_date").collect()]
    assert history == list("abcab")
    assert rows(store.read().filter("is_current"), "v") == [("b",)]


def test_load_cut_off_after_its_commit_is_repeated_cleanly(spark, tmp_path):
    """The table has the file's rows, the ledger still says processing."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    first = put(raw, "1.csv", "k,v\n1,a\n2,a\n", 1000)
    for settings in (SCD2, {}):
        where = f"{root}/{len(settings)}"
        spec = spec_for(raw, **settings)
        store, book = loading.store_for(spark, where, spec), TableStore(spark, f"{where}/ledger")
        loading.load_table(spark, spec, store, book, T1)
        stuck = book.read().withColumn("status", F.lit(led.PROCESSING))
        book.create(stuck)
        before = rows(store.read(), "k", "v")
        result = loading.load_table(spark, spec, store, book, T2)
        assert rows(result, "file_path") == [(first,)]
        assert rows(store.read(), "k", "v") == before
        assert store.read().select("_load_timestamp").distinct().count() == 1


def test_scd2_history_is_carried(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw, **SCD2)
    store, book = loading.store_for(spark, root, spec), TableStore(spark, f"{root}/ledger")
    for n, (value, when) in enumerate([("a", T1), ("b", T2), ("c", "2024-03-01 00:00:00")]):
        put(raw, f"{n}.csv", f"k,v\n1,{value}\n2,z\n", 1000 + n)
        loading.load_table(spark, spec, store, book, when)
    assert rows(store.read(), "k", "v", "is_current") == [
        (1, "a", False), (1, "b", False), (1, "c", True), (2, "z", True),
    ]
    closed = [p for p in store.version().parts if p["only"] == {"is_current": "false"}]
    assert len(closed) == 2 and len(store.version().parts) == 3


@pytest.mark.parametrize("strategy", ["merge", "overwrite"])
def test_merge_and_overwrite(spark, tmp_path, strategy):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw, loading_strategy=strategy, primary_keys="k")
    put(raw, "1.csv", "k,v\n1,a\n2,a\n", 1000)
    put(raw, "2.csv", "k,v\n2,b\n", 1001)
    loading.load_all(spark, [spec], root, T1)
    put(raw, "3.csv", "k,v\n3,c\n", 1002)
    loading.load_all(spark, [spec], root, T2)
    table = loading.store_for(spark, root, spec).read()
    want = [(1, "a"), (2, "b"), (3, "c")] if strategy == "merge" else [(3, "c")]
    assert rows(table, "k", "v") == want


def test_configured_columns_and_header_orders(spark, tmp_path):
    """Columns in another order in one file are matched by name, not by place."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k;v;x\n1;a;0\n", 1000)
    put(raw, "2.csv", "v;x;k\nb;0;2\n", 1001)
    spec = spec_for(
        raw,
        reader_options={"sep": ";"},
        transformations={"add_columns": {"w": "upper(v)"}, "select": ["k", "w"]},
    )
    assert loading.load_all(spark, [spec], root, T1).filter("success").count() == 2
    table = loading.store_for(spark, root, spec).read()
    assert rows(table, "k", "w") == [(1, "A"), (2, "B")]
    assert table.columns == ["k", "w", "_source_file", "_load_timestamp", "_batch_id"]


def test_odd_file_names(spark, tmp_path):
    raw, root = str(tmp_path / "ra w"), str(tmp_path / "root")
    names = ["a[1].csv", "b{x,y}.csv", "c*?.csv", "it's.csv", "p+q%20.csv"]
    paths = [put(raw, n, f"k,v\n{i},x\n", 1000) for i, n in enumerate(names)]
    spec = spec_for(raw)
    result = loading.load_all(spark, [spec], root, T1)
    assert rows(result, "file_path", "success", "total_records_processed") == sorted(
        [(p, True, 1) for p in paths], key=repr
    )
    table = loading.store_for(spark, root, spec).read()
    assert rows(table, "_batch_id", "k") == sorted([(n, i) for i, n in enumerate(names)], key=repr)


def test_own_strategy(spark, tmp_path):
    def keep_largest(state, batch, spec, as_of):
        rows_ = batch if state is None else state.unionByName(batch)
        return rows_.groupBy("k").agg(F.max_by(F.struct("*"), "v").alias("r")).select("r.*")

    loading.register_strategy("largest", keep_largest)
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw, loading_strategy="largest")
    put(raw, "1.csv", "k,v\n1,a\n2,c\n", 1000)
    loading.load_all(spark, [spec], root, T1)
    put(raw, "2.csv", "k,v\n1,b\n2,b\n", 1001)
    assert loading.load_all(spark, [spec], root, T2).first()["success"]
    assert rows(loading.store_for(spark, root, spec).read(), "k", "v") == [(1, "b"), (2, "c")]


def test_one_broken_table_leaves_the_others(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k,v\n1,a\n", 1000)
    fine = spec_for(raw)
    broken = spec_for(raw, table_name="u", loading_strategy="scd2", primary_keys="no", tracking_columns="v")
    result = loading.load_all(spark, [broken, fine], root, T1, only=["t", "u"])
    assert rows(result.filter("success"), "table_name") == [("t",)]
    assert "no" in result.filter("NOT success").first()["error_message"]
    assert loading.load_all(spark, [fine], root, T1, only=["other"]).isEmpty()


def test_odd_parquet_files(spark, tmp_path):
    """A file without columns and one of another type fail alone; NULLs are fine."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    os.makedirs(raw)
    contents = {
        "1_good": pa.table({"id": ["a", "b"], "name": ["x", "y"]}),
        "2_empty": pa.table({}),
        "3_mismatch": pa.table({"id": [1, 2], "name": ["x", "y"], "extra_column": ["e", "e"]}),
        "4_nulls": pa.table({"id": ["c", None], "name": [None, "z"]}),
    }
    for n, (name, data) in enumerate(contents.items()):
        pq.write_table(data, f"{raw}/{name}.parquet")
        os.utime(f"{raw}/{name}.parquet", (1000 + n, 1000 + n))
    spec = spec_for(raw, source_path_pattern=f"{raw}/*.parquet", file_format="parquet")
    result = loading.load_table(
        spark, spec, loading.store_for(spark, root, spec), TableStore(spark, f"{root}/ledger"), T1
    )
    by_name = {os.path.basename(r["file_path"]): r for r in result.collect()}
    assert [r["success"] for _, r in sorted(by_name.items())] == [True, False, False, True]
    assert [r["total_records_processed"] for _, r in sorted(by_name.items())] == [2, 0, 0, 2]
    assert "id" in by_name["3_mismatch.parquet"]["error_message"]
    table = loading.store_for(spark, root, spec).read()
    assert rows(table, "id", "name") == sorted(
        [("a", "x"), ("b", "y"), ("c", None), (None, "z")], key=repr
    )


def test_orphans_are_repaired_first(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k,v\n1,a\n", 1000)
    spec = spec_for(raw)
    loading.load_all(spark, [spec], root, T1)
    book = EventLedger(spark, f"{root}/metadata/file_ledger")
    book.create(book.read().withColumn("status", F.lit(led.PROCESSING)))
    loading.load_all(spark, [spec], root, T2)
    row = EventLedger(spark, book.root).read().first()
    assert (row["status"], row["error_message"]) == ("completed", led.ORPHAN_MESSAGE)
    assert loading.store_for(spark, root, spec).read().count() == 1


def test_redelivered_micro_batch_is_skipped(spark, tmp_path):
    """A lost checkpoint tail makes the stream offer its batches again."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k,v\n1,a\n", 1000)
    put(raw, "2.csv", "k,v\n1,b\n", 1001)
    spec = spec_for(raw, **SCD2)
    store = loading.store_for(spark, root, spec)
    for attempt in range(2):
        source = loaders.stream_source(spark, spec, "k int, v string", max_files=1)
        loaders.stream_scd2(
            source, spec, store, f"{root}/checkpoint-{attempt}", T1
        ).awaitTermination()
        history = [(r["v"], r["is_current"]) for r in store.read().orderBy("effective_date").collect()]
        assert sorted(history) == [("a", False), ("b", True)]
    assert store.version().tags["stream.batch"] == 1
    with pytest.raises(ValueError):
        loaders.stream_scd2(source, spec_for(raw), store, f"{root}/c")


def test_stream_drops_repeats_and_late_rows(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "1.csv", "k,at\n1,2024-01-20\n1,2024-01-21\n2,2024-01-20\n", 1000)
    put(raw, "2.csv", "k,at\n1,2024-01-22\n4,2024-01-19\n", 1001)
    put(raw, "3.csv", "k,at\n3,2024-01-01\n4,2024-01-20\n", 1002)
    stream = (
        spark.readStream.schema("k int, at timestamp").option("header", True)
        .option("maxFilesPerTrigger", 1).csv(raw)
    )
    kept = loaders.stream_deduplicate(stream, ["k"], "at", 7)
    out = str(tmp_path / "out")
    (
        kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(out).awaitTermination()
    )
    assert rows(spark.read.parquet(out), "k") == [(1,), (2,), (4,)]


def test_merge_plan_over_the_store(spark, tmp_path):
    """History is only passed on; the current slice is exchanged once, or not at all
    when a small batch is looked up in it."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k,v\n1,a\n2,a\n", 1000)
    spec = spec_for(raw, **SCD2)
    loading.load_all(spark, [spec], root, T1)
    state = loading.store_for(spark, root, spec).read()
    batch = spark.read.csv(f"{raw}/1.csv", header=True, schema="k int, v string").withColumn(
        "v", F.lit("b")
    )

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    outer = plan(scd2.scd2_merge(state, batch, spec, T2, "f"))
    assert outer.count("Exchange hashpartitioning") == 2 and outer.count("FullOuter") == 1
    assert "PartitionFilters: [NOT (is_current" in outer
    small = plan(scd2.scd2_merge(state, batch, spec, T2, "f", small_batch=True))
    assert "SortMergeJoin" not in small and small.count("BroadcastHashJoin") == 1
    assert "Exchange hashpartitioning" not in small.split("BroadcastExchange")[0]


def test_a_merge_rewrites_only_buckets_it_closes_rows_of(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    keyed = "".join(f"{k},a\n" for k in range(40)) + ",none\n"
    files = [
        ("0.csv", f"k,v\n{keyed}"),
        ("1.csv", "k,v\n3,b\n4,a\n"),  # one key changes
        ("2.csv", "k,v\n100,new\n,none\n"),  # none does
        ("3.csv", "k,v,w\n3,c,1\n7,b,1\n100,new,2\n"),  # a column appears
        ("4.csv", "k,v\n" + "".join(f"{k},z\n" for k in range(40))),  # all do
        ("5.csv", "k,v\nx1,q\n3,z\n"),  # the key becomes text
    ]
    plain, split = spec_for(raw, **SCD2), spec_for(raw, **SCD2, key_buckets=16)
    stores = [loading.store_for(spark, f"{root}/{n}", s) for n, s in enumerate((plain, split))]
    touched = []
    for n, (name, text) in enumerate(files):
        put(raw, name, text, 1000 + n)
        before = [p["commit"] for p in stores[1].version().parts] if stores[1].exists() else []
        lost = {p["commit"]: (p.get("gone") or {"buckets": []})["buckets"] for p in stores[1].version().parts} if before else {}
        for k, (spec, store) in enumerate(zip((plain, split), stores)):
            loading.load_table(spark, spec, store, EventLedger(spark, f"{root}/ledger{k}"), f"2024-0{n + 1}-01 00:00:00")
        same = [s.read().drop("_load_timestamp") for s in stores]
        assert rows(same[0], *sorted(same[0].columns)) == rows(same[1], *sorted(same[0].columns))
        again = TableStore(spark, stores[1].root, ("is_current",), False, ("k",), 16)
        assert again.version() == stores[1].version() and again.read().count() == same[0].count()
        parts = stores[1].version().parts
        carried = [p for p in parts if p["commit"] in before]
        touched.append(max([len(set((p.get("gone") or {"buckets": []})["buckets"]) - set(lost[p["commit"]])) for p in carried], default=None))
    assert touched[:3] == [None, 1, 0] and 1 <= touched[3] <= 2 and touched[4] <= 16
    assert [p["commit"] for p in parts][: len(before)] == before
    sizes = stores[1].part_sizes().agg(F.sum("files")).first()[0]
    stores[1].compact(1 << 30)
    assert stores[1].part_sizes().agg(F.sum("files")).first()[0] <= sizes
    assert rows(stores[1].read().drop("_load_timestamp"), *sorted(same[0].columns)) == rows(same[0], *sorted(same[0].columns))


def test_bucketed_tables_undo_and_reload(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw, **SCD2, key_buckets=4)
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    for n, text in enumerate(("k,v\n1,a\n2,a\n", "k,v\n1,b\n")):
        put(raw, f"{n}.csv", text, 1000 + n)
        loading.load_table(spark, spec, store, book, T1 if n == 0 else T2)
    before = rows(store.read().select("k", "v", "is_current"))
    book.create(led.purge_ledger(book.read(), "2030-01-01 00:00:00", 0))
    loading.load_table(spark, spec, store, book, "2024-05-01 00:00:00")
    assert rows(store.read().select("k", "v", "is_current")) == before
    with pytest.raises(ValueError):
        store.replace_buckets(store.read().withColumn("k", F.col("k").cast("double")), "is_current", "true", [0])


def test_undo_and_reload_touch_only_folders_of_the_file(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw)
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    paths = []
    for n in range(4):
        paths.append(put(raw, f"{n}.csv", f"k,v\n{n},a\n", 1000 + n))
        loading.load_table(spark, spec, store, book, f"2024-0{n + 1}-01 00:00:00")
    parts = store.version().parts
    assert [len(p["holds"]) for p in parts] == [1] * 4
    files = [f"file:{p}" if r[0].startswith("file:") else p for p, r in zip(paths, store.read().select("_source_file").collect())]
    files = sorted(r[0] for r in store.read().select("_source_file").distinct().collect())
    assert [p["commit"] for p in store.parts_holding(files[1:2])] == [parts[1]["commit"]]
    assert store.parts_holding(["/never/seen"]) == []

    assert loading.undo_files(store, spec, files[1:2]) and not loading.undo_files(store, spec, files[1:2])
    assert rows(store.read(), "k") == [(0,), (2,), (3,)]
    kept = [p["commit"] for p in store.version().parts]
    assert kept[:3] == [p["commit"] for n, p in enumerate(parts) if n != 1] and len(kept) == 4

    # another instance, with the ledger purged: only what holds the files is written anew
    store = loading.store_for(spark, root, spec)
    book.create(led.purge_ledger(book.read(), "2030-01-01 00:00:00", 0).filter("file_path LIKE '%/0.csv' OR file_path LIKE '%/3.csv'"))
    put(raw, "0.csv", "k,v\n0,z\n", 5000)
    loading.load_table(spark, spec, store, book, "2024-06-01 00:00:00")
    assert sorted((r.k, r.v) for r in store.read().collect()) == [(0, "z"), (1, "a"), (2, "a"), (3, "a")]
    # folders merged by upkeep still know whose rows they hold
    store.compact(1 << 30)
    assert len(store.version().parts) == 1 and store.parts_holding(files[2:3]) and not store.parts_holding(["/never/seen"])
    assert loading.undo_files(store, spec, files[2:3]) and rows(store.read(), "k") == [(0,), (1,), (3,)]


def test_files_written_past_the_index_are_found(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec, store = spec_for(raw), loading.store_for(spark, root := str(tmp_path / "root"), spec_for(raw))
    store.create(spark.createDataFrame([(1, "old")], "k int, _source_file string"))
    store.note_files(["/new"])
    store.append(spark.createDataFrame([(2, "/new")], "k int, _source_file string"))
    assert len(store.parts_holding(["old"])) == 1 and len(store.parts_holding(["/new"])) == 2
    assert loading.undo_files(store, spec, ["old"]) and rows(store.read(), "k") == [(2,)]


def test_the_file_index_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sedimenta.sources.store.INDEX_FOLDERS", 4)
    store = TableStore(spark, str(tmp_path / "t"))
    for n in range(7):
        store.note_files([f"/f{n}"])
        store.append(spark.createDataFrame([(n, f"/f{n}")], "k int, _source_file string"))
    assert len(store.file_index().version().parts) <= 5
    assert all(len(store.parts_holding([f"/f{n}"])) == 1 for n in range(7))


@pytest.mark.parametrize("bad", [1, 64, 20])
def test_bad_files_are_found_without_loading_the_others_in_turn(spark, tmp_path, monkeypatch, bad):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    for n in range(64):
        put(raw, f"{n:02}.csv", f"k,v\n{n},{'bad' if n * bad % 64 < bad else 'x'}\n", 1000 + n)
    spec = spec_for(raw, transformations={"filter": "assert_true(v <> 'bad') IS NULL"})
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    attempts = []
    commit = loading.commit_batch
    monkeypatch.setattr(loading, "commit_batch", lambda *a, **b: (attempts.append(1), commit(*a, **b))[1])
    result = loading.load_table(spark, spec, store, book, T1).collect()
    assert len(attempts) <= 3
    failed = [r.file_path for r in result if not r.success]
    assert len(result) == 64 and len(failed) == sum(n * bad % 64 < bad for n in range(64))
    assert (not store.exists() and bad == 64) or store.read().count() == 64 - len(failed)


def test_files_that_do_not_go_together_are_still_parted(spark, tmp_path):
    """Each can be loaded alone, but not after the other."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    os.makedirs(raw)
    pq.write_table(pa.table({"k": pa.array([1]), "v": pa.array(["x"])}), f"{raw}/a.parquet")
    pq.write_table(pa.table({"k": pa.array([True]), "v": pa.array(["x"])}), f"{raw}/b.parquet")
    spec = spec_for(raw, file_format="parquet", source_path_pattern=f"{raw}/*.parquet")
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    result = loading.load_table(spark, spec, store, book, T1)
    assert sorted(r.success for r in result.collect()) == [False, True] and store.read().count() == 1


def test_a_folder_is_one_snapshot(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    for n, (folder, text) in enumerate((("a", "1,x"), ("b", "1,y"), ("a", "2,x"), ("b", "2,x"), ("b", "3,new"))):
        put(f"{raw}/{folder}", f"{n}.csv", f"k,v\n{text}\n", 1000 + n)
    spec = spec_for(raw, **SCD2, source_path_pattern=f"{raw}/*/*.csv", snapshot_by="folder")
    for most in (100, 3, 1):
        store = loading.store_for(spark, f"{root}{most}", spec)
        result = loading.load_table(spark, spec, store, EventLedger(spark, f"{root}{most}/ledger"), T1, max_files=most)
        assert result.filter("success").count() == 5
        state = store.read()
        assert rows(state, "k", "v", "is_current") == [(1, "x", False), (1, "y", True), (2, "x", True), (3, "new", True)]
        if most > 1:
            assert state.select("effective_date").distinct().count() == 2


def test_late_snapshots_are_merged_in_their_place(spark, tmp_path):
    """Files that come in any order give the table that they give in order."""
    rng = random.Random(3)
    files = []
    for n in range(5):
        keys = [k for k in range(8) if rng.random() < 0.8] or [0]
        files.append((f"{n}.csv", "k,v,u\n" + "".join(f"{k},{rng.choice('ab')},{n}\n" for k in keys) + f",none{n},0\n", 1000 + 10 * n))
    want = None
    for trial, order in enumerate(([[0, 1, 2, 3, 4]], [[0], [3], [1], [4], [2]], [[4], [2, 1], [0, 3]], [[1, 3], [0, 2, 4]])):
        raw, root = str(tmp_path / f"raw{trial}"), str(tmp_path / f"root{trial}")
        spec = spec_for(raw, **SCD2, effective_from="file")
        store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
        for step in order:
            for n in step:
                put(raw, *files[n])
            assert loading.load_table(spark, spec, store, book, T1).filter("NOT success").count() == 0
        got = rows(store.read().select("k", "v", "u", "effective_date", "end_date", "is_current"))
        want = want or got
        assert got == want
    assert {r[0].second for r in store.read().select("effective_date").collect()} <= {40, 50, 0, 10, 20}


def test_a_late_snapshot_needs_the_later_ones(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    spec = spec_for(raw, **SCD2, effective_from="file")
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    put(raw, "0.csv", "k,v\n1,a\n2,a\n", 1000)
    last = put(raw, "2.csv", "k,v\n1,b\n", 3000)
    loading.load_table(spark, spec, store, book, T1)
    os.remove(last)
    put(raw, "1.csv", "k,v\n1,c\n", 2000)
    failed = loading.load_table(spark, spec, store, book, T1).collect()
    assert [r.success for r in failed] == [False] and "gone" in failed[0].error_message
    assert store.read().count() == 3
    put(raw, "1.csv", "k,v\n2,c\n", 2000)  # of a key that the vanished one does not have
    assert loading.load_table(spark, spec, store, book, T1).first().success
    assert rows(store.read(), "k", "v", "is_current") == [(1, "a", False), (1, "b", True), (2, "a", False), (2, "c", True)]


def test_runs_keep_table_states_and_resume(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    put(raw, "1.csv", "k,v\n1,a\n", 1000)
    fine = spec_for(raw)
    broken = spec_for(raw, table_name="u", transformations={"filter": "nowhere > 1"})
    loading.load_all(spark, [fine, broken], root, T1)
    states = loading.TableStates(spark, root)
    assert rows(states.read(), "table_name", "status") == [("t", "completed"), ("u", "failed")]
    put(raw, "2.csv", "k,v\n2,a\n", 2000)
    mended = spec_for(raw, table_name="u")
    result = loading.load_all(spark, [fine, mended], root, T2, resume=True)
    assert {r.table_name for r in result.collect()} == {"u"}
    assert rows(loading.TableStates(spark, root).read(), "table_name", "status") == [("t", "completed"), ("u", "completed")]
    # a file that failed behind the state's back makes its table run again
    book = EventLedger(spark, f"{root}/metadata/file_ledger")
    book.create(book.read().withColumn("status", F.when(F.col("table_name") == "t", led.FAILED).otherwise(F.col("status"))))
    assert {r.table_name for r in loading.load_all(spark, [fine, mended], root, T2, resume=True).collect()} == {"t"}
