import random
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import ledger as led
from sedimenta.scratch import local_frame
from sedimenta.sources.events import EventLedger
from sedimenta.sources.store import TableStore
from tests.conftest import rows

NOW = "2024-01-01 12:00:00"


def listing(spark, *paths):
    return local_frame(spark, {"path": list(paths)})


@pytest.fixture
def book(spark):
    empty = led.empty_ledger(spark)
    return led.register_files(empty, listing(spark, "/a", "/b's", "/c"), "t", NOW)


def steps(spark, data):
    names = ["file_path", "status", "error_message"]
    return spark.createDataFrame(
        pa.table({n: pa.array([r[i] for r in data], pa.string()) for i, n in enumerate(names)})
    )


def test_register(spark, book):
    assert book.columns == led.LEDGER_SCHEMA.names
    assert [f.dataType for f in book.schema] == [f.dataType for f in led.LEDGER_SCHEMA]
    assert rows(book, "file_path", "status", "retry_count") == sorted(
        [("/a", "pending", 0), ("/b's", "pending", 0), ("/c", "pending", 0)], key=repr
    )
    more = led.register_files(book, listing(spark, "/c", "/d", "/d"), "t", NOW)
    assert rows(more, "file_path") == rows(book.select("file_path"), "file_path") + [("/d",)]


def test_transitions(spark, book):
    begun = led.apply_transitions(
        book, steps(spark, [("/a", "processing", None), ("/b's", "processing", None)]), "2024-01-01 13:00:00"
    )
    ended = led.apply_transitions(
        begun,
        steps(spark, [("/a", "completed", None), ("/b's", "failed", "can't \"read\" /b's")]),
        "2024-01-01 14:00:00",
    )
    by_path = {r["file_path"]: r for r in ended.collect()}
    a, b, c = by_path["/a"], by_path["/b's"], by_path["/c"]
    assert (a["status"], a["retry_count"], a["error_message"]) == ("completed", 0, None)
    assert (a["processing_start_time"].hour, a["processing_end_time"].hour) == (13, 14)
    assert (b["status"], b["retry_count"]) == ("failed", 1)
    assert b["error_message"] == "can't \"read\" /b's"
    assert (c["status"], c["updated_at"].hour) == ("pending", 12)
    assert a["created_at"].hour == 12
    # A later failure without a message clears the old one; a start keeps it.
    restarted = led.apply_transitions(ended, steps(spark, [("/b's", "processing", None)]), NOW)
    assert restarted.filter("file_path LIKE '/b%'").first()["error_message"] is not None
    failed = led.apply_transitions(ended, steps(spark, [("/b's", "failed", None)]), NOW)
    row = failed.filter("file_path LIKE '/b%'").first()
    assert (row["error_message"], row["retry_count"]) == (None, 2)


def test_last_of_several_transitions_counts(spark, book):
    data = steps(spark, [("/a", "processing", None), ("/a", "completed", None)]).withColumn(
        "changed_at",
        F.when(F.col("status") == "processing", F.lit("2024-01-02")).otherwise(F.lit("2024-01-03")).cast("timestamp"),
    )
    out = led.apply_transitions(book, data)
    assert out.count() == 3
    assert out.filter("file_path = '/a'").first()["status"] == "completed"


def test_stats_are_zero_filled(spark, book):
    assert rows(led.ledger_stats(book), "status", "files") == [
        ("completed", 0), ("failed", 0), ("pending", 3), ("processing", 0), ("skipped", 0),
    ]
    assert rows(led.ledger_stats(book, "other"), "files") == [(0,)] * 5


def test_orphan_boundary(spark, book):
    begun = led.apply_transitions(book, steps(spark, [("/a", "processing", None)]), "2024-01-01 10:00:00")
    assert led.orphaned_files(begun, "2024-01-01 12:00:00").isEmpty()
    assert led.orphaned_files(begun, "2024-01-01 12:00:01").count() == 1
    fixed = led.fix_orphans(begun, "2024-01-01 12:00:01")
    row = fixed.filter("file_path = '/a'").first()
    assert (row["status"], row["error_message"], row["retry_count"]) == (
        "failed", led.ORPHAN_MESSAGE, 0,
    )
    assert row["processing_end_time"] == datetime(2024, 1, 1, 12, 0, 1)
    assert led.ledger_validation(begun, None, "2024-01-01 12:00:01").first()["overall_status"] == "inconsistent"
    assert led.ledger_validation(fixed, None, "2024-01-01 12:00:01").first()["overall_status"] == "valid"


def test_purge_keeps_open_files(spark, book):
    done = led.apply_transitions(book, steps(spark, [("/a", "completed", None), ("/c", "failed", "x")]), NOW)
    later = "2024-03-01"
    assert rows(led.purge_ledger(done, later), "file_path") == [("/b's",)]
    assert led.purge_ledger(done, "2024-01-31 12:00:00").count() == 3


def test_unprocessed_and_retries(spark, book):
    found = listing(spark, "/a", "/b's", "/c", "/d")
    done = led.apply_transitions(
        book, steps(spark, [("/a", "completed", None), ("/b's", "failed", "x"), ("/c", "skipped", None)]), NOW
    )
    assert rows(led.unprocessed_files(found, done)) == sorted([("/b's",), ("/c",), ("/d",)], key=repr)
    assert rows(led.unprocessed_files(found, done, True, 1)) == [("/d",)]
    assert led.retryable_files(done, 1).isEmpty()
    assert led.retryable_files(done, 2).count() == 1
    specs = [TableSpec("x", "d", "/b*"), TableSpec("y", "d", "/**")]
    assert rows(led.retry_plan(done, specs), "table_name") == [("x",)]
    assert rows(led.missing_sources(done, listing(spark, "/b's")), "file_path") == [("/a",)]


def test_pending_order(spark, book):
    older = led.register_files(book, listing(spark, "/z"), "u", "2023-01-01")
    assert [r["file_path"] for r in led.pending_files(older).collect()][0] == "/z"
    assert led.pending_files(older, "t", 2).count() == 2


def test_table_consistency(spark, book):
    done = led.apply_transitions(book, steps(spark, [("/a", "failed", "x"), ("/c", "processing", None)]), NOW)
    done = done.withColumn("table_name", F.when(F.col("file_path") == "/c", "u").otherwise("t"))
    status = local_frame(spark, {"table_name": ["t", "u", "v"], "status": ["completed", "in_progress", "completed"]})
    report = {r["table_name"]: r for r in led.consistency_report(done, status).collect()}
    assert (report["t"]["consistent"], report["t"]["issues"]) == (
        False, ["failed_files:1"],
    )
    assert report["u"]["consistent"] and len(report["u"]["issues"]) == 1
    assert report["v"]["consistent"] and report["v"]["issues"] == [] and report["v"]["failed"] == 0
    fixed = led.fix_table_status(status, done, NOW)
    assert rows(fixed, "table_name", "status") == [("t", "failed"), ("u", "in_progress"), ("v", "completed")]
    assert rows(led.tables_to_run(status.select("table_name"), fixed)) == [("t",), ("u",)]
    assert rows(led.tables_to_run(status.select("table_name"), fixed, ["t", "v"])) == [("t",)]


def test_files_are_known_by_table_and_path(spark):
    files = spark.createDataFrame([("/a/1",), ("/a/2",)], "path string")
    book = led.register_files(led.empty_ledger(spark), files, "one", NOW)
    book = led.register_files(book, files.filter("path = '/a/1'"), "two", NOW)
    assert rows(book, "table_name", "file_path") == [("one", "/a/1"), ("one", "/a/2"), ("two", "/a/1")]
    assert rows(led.new_files(files, book, "two")) == [("/a/2",)]
    assert not led.new_files(files, book).collect()
    steps = spark.createDataFrame([("two", "/a/1", "completed")], "table_name string, file_path string, status string")
    after = led.apply_transitions(book, steps, NOW)
    assert rows(after.filter("status = 'completed'"), "table_name", "file_path") == [("two", "/a/1")]
    assert rows(led.unprocessed_files(files, after, table_name="one")) == [("/a/1",), ("/a/2",)]
    assert rows(led.unprocessed_files(files, after, table_name="two")) == [("/a/2",)]


@pytest.mark.parametrize("fold_every", [1, 3, 64])
def test_events_fold_to_the_ledger_of_changes(spark, tmp_path, fold_every):
    """Any order of registrations, changes, orphan repairs and folds."""
    rng = random.Random(fold_every)
    plain, book = led.empty_ledger(spark), EventLedger(spark, str(tmp_path / "ledger"), fold_every)
    for n in range(7):
        at = f"2024-01-0{n + 1} 00:00:00"
        table = rng.choice(("one", "two"))
        files = [f"/f{k}" for k in range(6) if rng.random() < 0.6] or ["/f0"]
        listing = spark.createDataFrame([(f, 5) for f in files], "path string, length long")
        plain = led.register_files(plain, listing, table, at)
        events = led.register_events(listing, table, at)
        moves = [(table, f, rng.choice(led.STATUSES), rng.choice((None, "", "no"))) for f in files + ["/unknown"] for _ in range(rng.randrange(3))]
        steps = spark.createDataFrame(moves, "table_name string, file_path string, status string, error_message string")
        plain = led.apply_transitions(plain, steps, at)
        book.record(events.unionByName(led.transition_events(steps, at)))
        if n == 5:
            book.record(led.orphan_events(book.read(), at))
            plain = led.fix_orphans(plain, at)
        plain = spark.createDataFrame(plain.collect(), led.LEDGER_SCHEMA)
        assert rows(book.read()) == rows(plain)
    assert len(book.version().parts) <= max(fold_every, 10) + 1


def test_event_ledger_goes_on_from_rows(spark, tmp_path):
    """A ledger written as rows is read, appended to, and purged."""
    listing = spark.createDataFrame([("/a",), ("/b",)], "path string")
    old = led.register_files(led.empty_ledger(spark), listing, "t", NOW)
    TableStore(spark, str(tmp_path / "l")).create(old)
    book = EventLedger(spark, str(tmp_path / "l"))
    steps = spark.createDataFrame([("t", "/a", "completed")], "table_name string, file_path string, status string")
    before = book.version().parts
    book.record(led.transition_events(steps, NOW))
    assert book.version().parts[:1] == before and len(book.events().collect()) == 3
    assert rows(book.read(), "file_path", "status") == [("/a", "completed"), ("/b", "pending")]
    book.create(led.purge_ledger(book.read(), "2030-01-01 00:00:00", 1))
    assert rows(book.read(), "file_path") == [("/b",)]
    assert rows(book.read(1), "file_path", "status") == [("/a", "pending"), ("/b", "pending")]
