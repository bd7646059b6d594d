import glob
import os

import pytest
from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.sources import catalog, files
from sedimenta.sources.store import TableStore
from tests.conftest import rows

NAMES = [
    "a.csv", "b b.csv", "c'd.csv", "e%20f.csv", "g+h.csv", "sub/i.csv", "sub/deep/j.csv", "k.json",
]


@pytest.fixture
def folder(tmp_path):
    for n, name in enumerate(NAMES):
        path = tmp_path / "in put" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"x,y\n{n},{name[0]}\n" if name.endswith("csv") else f'{{"x": {n}}}\n')
    return str(tmp_path / "in put")


@pytest.mark.parametrize(
    "pattern", ["*.csv", "*", "**/*.csv", "sub/**/*.csv", "?.csv", "[ab]*.csv", "[!ab]*.csv", "none*"]
)
def test_listing_matches_glob(spark, folder, pattern):
    want = [f for f in glob.glob(f"{folder}/{pattern}", recursive=True) if os.path.isfile(f)]
    found = files.list_files(spark, f"{folder}/{pattern}")
    assert rows(found, "path") == sorted(((p,) for p in want), key=repr)
    for r in found.collect():
        assert r["length"] == os.path.getsize(r["path"])


def test_listing_keeps_scheme_of_pattern(spark, folder):
    found = files.list_files(spark, f"file:{folder}/a.csv")
    assert rows(found, "path") == [(f"file:{folder}/a.csv",)]


def test_source_paths_match_listing(spark, folder):
    pattern = f"{folder}/*.csv"
    found = [r["path"] for r in files.list_files(spark, pattern).collect()]
    df = files.read_source(spark, found, "csv", with_source=pattern)
    assert dict(df.dtypes)["x"] == "int"
    assert rows(df, "_source_file") == sorted(((p,) for p in found), key=repr)


def test_formats(spark, folder):
    assert files.read_source(spark, f"{folder}/k.json", "json").first()["x"] == 7
    with pytest.raises(ValueError, match="xml"):
        files.read_source(spark, folder, "xml")
    with pytest.raises(ValueError, match="delta"):
        files.read_source(spark, folder, "delta")


def test_routing_takes_first_match(spark):
    specs = [TableSpec("one", "d", "/raw/[ab]/*.csv"), TableSpec("two", "d", "/raw/**/*.csv")]
    listing = spark.createDataFrame(
        [("/raw/a/x.csv",), ("/raw/c/d/x.csv",), ("/raw/x.csv",), ("/raw/a/x.json",), ("/raw/a/b/x.csv",)],
        "path string",
    )
    assert rows(files.route_files(listing, specs), "path", "table_name") == sorted(
        [("/raw/a/x.csv", "one"), ("/raw/c/d/x.csv", "two"), ("/raw/x.csv", "two"),
         ("/raw/a/x.json", None), ("/raw/a/b/x.csv", "two")], key=repr,
    )
    preview = files.preview_load(files.route_files(listing, specs), 2)
    assert rows(preview, "table_name", "files", "first_paths") == sorted(
        [("one", 1, ["/raw/a/x.csv"]), ("two", 3, ["/raw/a/b/x.csv", "/raw/c/d/x.csv"]),
         (None, 1, ["/raw/a/x.json"])], key=repr,
    )


def test_metadata(spark):
    listing = spark.sql("SELECT '/r/a.tar.gz' AS path, 1572864L AS length")
    row = files.with_file_metadata(listing).first()
    assert (row["file_name"], row["file_size_mb"], row["file_extension"], row["parent_directory"]) == (
        "a.tar.gz", 1.5, ".gz", "/r",
    )
    assert tuple(files.listing_summary(listing.limit(0)).first()) == (0, 0.0, 0)


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    assert not store.exists() and store.row_count() == 0
    store.create(spark.range(3))
    assert store.row_count() == 3
    store.append(spark.range(3, 5))
    store.create(store.read().filter("id > 1"), tags={"run": "x"})
    assert rows(store.read()) == [(2,), (3,), (4,)]
    assert store.read(1).count() == 3 and store.read(2).count() == 5
    assert TableStore(spark, store.root).version().tags == {"run": "x"}
    store.publish("published")
    assert spark.table("published").count() == 3
    with pytest.raises(ValueError):
        store.read(9)


def test_second_writer_conflicts(spark, tmp_path):
    one = TableStore(spark, str(tmp_path / "t"))
    one.create(spark.range(1))
    two = TableStore(spark, one.root)
    two.append(spark.range(1))
    with pytest.raises(Exception, match="version 2 exists"):
        one.append(spark.range(1))
    assert TableStore(spark, one.root).read().count() == 2


def test_store_evolution(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), ["p"])
    store.create(spark.range(2).selectExpr("CAST(id AS INT) AS a", "CAST(NULL AS STRING) AS p"))
    store.append(spark.range(2).selectExpr("id + 0.5D AS a", "'x' AS p", "true AS fresh"))
    store.append(spark.range(1).selectExpr("'y' AS p", "false AS fresh"))
    assert store.read().dtypes == [("a", "double"), ("p", "string"), ("fresh", "boolean")]
    assert rows(store.read(), "a", "p") == sorted(
        [(0.0, None), (1.0, None), (0.5, "x"), (1.5, "x"), (None, "y")], key=repr
    )
    with pytest.raises(ValueError, match="evolution"):
        store.append(spark.range(1).selectExpr("'y' AS p"), evolve=False)
    with pytest.raises(ValueError, match="no common type"):
        store.append(spark.range(1).selectExpr("'text' AS a", "'y' AS p"))


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), ["p"])
    store.create(spark.range(10).withColumn("p", F.col("id") % 2))
    df = store.read().filter("p = 1")
    assert all("p=1" in f for f in df.inputFiles()) or df.count() == 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan.replace("\n", " ")


def test_carried_partition_is_not_rewritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), ["open"], cluster_writes=False)
    store.create(spark.range(4).withColumn("open", F.col("id") > 1))
    before = {os.path.basename(f) for f in store.read().inputFiles()}
    store.replace_except(spark.range(2, 3).withColumn("open", F.lit(True)), {"open": "false"})
    assert rows(store.read(), "id", "open") == [(0, False), (1, False), (2, True)]
    store.replace_except(spark.range(5, 6).withColumn("open", F.lit(False)), {"open": "false"})
    assert rows(store.read(), "id") == [(0,), (1,), (5,)]
    assert store.part_sizes().agg(F.sum("files")).first()[0] < len(before) + 2
    store.compact()
    assert rows(store.read(), "id") == [(0,), (1,), (5,)]
    assert store.statistics().first()["files"] == 1


def test_compaction_leaves_large_parts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.create(spark.range(200_000).withColumn("x", F.rand(1)).coalesce(1))
    for n in range(3):
        store.append(spark.range(10).withColumn("x", F.lit(0.5)))
    big = store.version().parts[0]
    store.compact(target_bytes=1 << 20)
    assert big in store.version().parts and len(store.version().parts) == 2
    assert store.read().count() == 200_030
    unchanged = store.compact(target_bytes=1 << 20)
    assert unchanged.number == store.version().number


def test_catalog_view_of_parts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), ["code"], bucket_keys=("k",), buckets=4)
    a = spark.createDataFrame([(1, "01", True), (2, None, True), (3, "x'y +%/", False)], "k int, code string, on boolean")
    store.create(a)
    store.append(spark.createDataFrame([(2**40, "01", "more")], "k long, code string, extra string"))
    store.append(a.limit(0))
    store.publish_catalog("view_of_parts")
    seen = spark.newSession().table("view_of_parts")
    assert seen.columns == store.read().columns
    assert rows(seen, "k", "code", "on", "extra") == rows(store.read(), "k", "code", "on", "extra")
    store.create(a.limit(0))
    store.publish_catalog("view_of_parts")
    assert spark.newSession().table("view_of_parts").count() == 0
    with pytest.raises(ValueError):
        TableStore(spark, str(tmp_path / "none")).publish_catalog("view_of_none")


def test_catalog(spark, tmp_path):
    catalog.ensure_database(spark, "cat", str(tmp_path / "it's"))
    catalog.ensure_database(spark, "cat")
    assert not catalog.table_exists(spark, "cat.t")
    assert catalog.table_statistics(spark, "cat.t").first()["table_exists"] is False
    spark.range(5).write.saveAsTable("cat.t")
    spark.sql("ANALYZE TABLE cat.t COMPUTE STATISTICS")
    assert catalog.table_exists(spark, "cat.t")
    row = catalog.table_statistics(spark, "cat.t").first()
    assert row["row_count"] == 5 and "5 rows" in row["size_info"] and "it" in row["location"]
    properties = {r["key"]: r["value"] for r in catalog.table_properties(spark, "cat.t").collect()}
    assert properties["id"] == "bigint" and properties["Provider"] == "parquet"
    from sedimenta.operators.quality import table_ready

    ready = table_ready(spark, ["cat.t", "cat.absent"])
    assert rows(ready, "table_name", "row_count", "satisfied") == [
        ("cat.absent", 0, False), ("cat.t", 5, True),
    ]
    spark.sql("DROP DATABASE cat CASCADE")
