"""Scans, listings, routing, the table store and whole loads.

Files of other formats are written by Spark from the test tables first.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta import TableSpec
from sedimenta.operators import ledger as led
from sedimenta.plans import loading
from sedimenta.plans.suites import scd2
from sedimenta.plans.suites.registry import query, table
from sedimenta.scratch import scratch_path
from sedimenta.sources import catalog, files
from sedimenta.sources.events import EventLedger
from sedimenta.sources.store import TableStore

ORDERS_SQL = "SELECT * FROM orders"


def orders(spark, sf_dir):
    """Orders with their day as a timestamp that text formats can carry."""
    return table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def q_parquet(spark, sf_dir):
    scan = files.read_source(spark, f"{sf_dir}/orders.parquet")
    return scan.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")


@query("scan_csv", ORDERS_SQL)
def q_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders(spark, sf_dir).write.option("header", True).csv(path)
    scan = files.read_source(spark, path, "csv")
    return scan.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("scan_csv_schema", ORDERS_SQL)
def q_csv_schema(spark, sf_dir):
    """A given schema saves the inference pass."""
    path = scratch_path(spark, "csv")
    rows = orders(spark, sf_dir)
    rows.write.option("header", True).csv(path)
    return files.read_source(spark, path, "csv", schema=rows.schema)


@query("scan_json", ORDERS_SQL)
def q_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    orders(spark, sf_dir).write.json(path)
    scan = files.read_source(spark, path, "json")
    return scan.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


@query("scan_merged_schema", """
SELECT p_partkey, p_name, p_brand, CAST(NULL AS INTEGER) AS p_size FROM part WHERE p_size <= 20
UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part WHERE p_size > 20""")
def q_merged(spark, sf_dir):
    path = scratch_path(spark, "evolved")
    part = table(spark, sf_dir, "part")
    part.filter("p_size <= 20").select("p_partkey", "p_name", "p_brand").write.parquet(f"{path}/a")
    part.filter("p_size > 20").select("p_partkey", "p_name", "p_size").write.parquet(f"{path}/b")
    return files.read_source(spark, [f"{path}/a", f"{path}/b"], evolve=True)


@query("list_files", """SELECT 'priority=' || o_orderpriority AS folder, '.parquet' AS file_extension,
  1 AS files, TRUE AS filled FROM orders GROUP BY o_orderpriority""")
def q_list(spark, sf_dir):
    """Files written per priority, one each."""
    root = scratch_path(spark, "listing")
    rows = orders(spark, sf_dir).withColumn("priority", F.col("o_orderpriority"))
    rows.repartition("priority").write.partitionBy("priority").parquet(root)
    listed = files.with_file_metadata(files.list_files(spark, f"{root}/*/*.parquet"))
    folder = F.element_at(F.split("parent_directory", "/"), -1)
    return listed.groupBy(folder.alias("folder"), "file_extension").agg(
        F.count("*").alias("files"), F.bool_and(F.col("length") > 0).alias("filled")
    )


def document_listing(spark, sf_dir):
    """One listed file per document, in its source's folder."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/raw/"), "source", F.lit("/"), "doc_id", F.lit(".json")).alias("path"),
        F.col("n_chars").alias("length"),
        F.lit("2024-01-01").cast("timestamp").alias("modificationTime"),
    )


DOCS = """WITH f AS (SELECT '/raw/' || source || '/' || doc_id || '.json' AS path, n_chars AS length,
  source, doc_id FROM documents)"""
PATTERNS = {
    "teens": "/raw/src1?/*.json",
    "low": "/raw/src[0-4]/**",
    "high": "/**/src[!0-4]/*.json",
}
ROUTE = """CASE WHEN regexp_full_match(source, 'src1[0-9]') THEN 'teens'
  WHEN regexp_full_match(source, 'src[0-4]') THEN 'low'
  WHEN regexp_full_match(source, 'src[5-9]') THEN 'high' END"""


@query("file_metadata", f"""{DOCS} SELECT path, length, TIMESTAMP '2024-01-01' AS "modificationTime",
  doc_id || '.json' AS file_name, round(length / 1048576.0::DOUBLE, 2) AS file_size_mb,
  '.json' AS file_extension, '/raw/' || source AS parent_directory FROM f""")
def q_metadata(spark, sf_dir):
    return files.with_file_metadata(document_listing(spark, sf_dir))


@query("route_files", f"{DOCS} SELECT path, {ROUTE} AS table_name FROM f")
def q_route(spark, sf_dir):
    routed = files.route_files(document_listing(spark, sf_dir), PATTERNS)
    return routed.select("path", "table_name")


@query("preview_load", f"""{DOCS}, r AS (SELECT path, {ROUTE} AS table_name FROM f)
SELECT table_name, count(*) AS files, array_to_string(list_slice(list(path ORDER BY path), 1, 5), ' ')
  AS first_paths FROM r GROUP BY table_name""")
def q_preview(spark, sf_dir):
    routed = files.route_files(document_listing(spark, sf_dir), PATTERNS)
    return files.preview_load(routed).withColumn("first_paths", F.array_join("first_paths", " "))


@query("listing_summary", f"""{DOCS} SELECT count(*) AS files,
  round(sum(length) / 1048576.0::DOUBLE, 2) AS total_mb, count(DISTINCT source) AS directories
FROM f""")
def q_listing_summary(spark, sf_dir):
    return files.listing_summary(document_listing(spark, sf_dir))


def new_store(spark, label, partition_columns=()):
    return TableStore(spark, scratch_path(spark, label), partition_columns)


@query("store_evolve", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
  CAST(NULL AS VARCHAR) AS channel FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'web'
FROM orders WHERE o_orderstatus <> 'F'""")
def q_store_evolve(spark, sf_dir):
    """Create, then append a wider batch with one more column."""
    store = new_store(spark, "store", ["o_orderstatus"])
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    done = F.col("o_orderstatus") == "F"
    store.create(rows.filter(done).withColumn("o_custkey", F.col("o_custkey").cast("int")))
    store.append(rows.filter(~done).withColumn("channel", F.lit("web")))
    return store.read()


@query("store_compact", ORDERS_SQL)
def q_store_compact(spark, sf_dir):
    """One append per priority, then compaction."""
    store = new_store(spark, "compact")
    named = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
    for priority in named:
        store.append(orders(spark, sf_dir).filter(F.col("o_orderpriority") == priority))
    others = ~F.coalesce(F.col("o_orderpriority").isin(*named), F.lit(False))
    store.append(orders(spark, sf_dir).filter(others))
    store.compact()
    return store.read()


@query("store_statistics", """SELECT 1 AS version, count(*) AS row_count FROM orders""")
def q_store_statistics(spark, sf_dir):
    store = new_store(spark, "statistics", ["o_orderpriority"])
    store.create(orders(spark, sf_dir))
    return store.statistics().select("version", "row_count")


@query("load_append_files", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority, TIMESTAMP '2024-01-01' AS _load_timestamp FROM orders""")
def q_load_append(spark, sf_dir):
    """A whole load of files, run twice: the second run finds nothing new."""
    root = scratch_path(spark, "load")
    rows = orders(spark, sf_dir).withColumn("folder", F.col("o_orderpriority"))
    rows.write.partitionBy("folder").parquet(f"{root}/raw")
    spec = TableSpec(
        table_name="orders",
        database_name="facts",
        source_path_pattern=f"{root}/raw/*/*.parquet",
    )
    store = loading.store_for(spark, root, spec)
    book = EventLedger(spark, f"{root}/ledger")
    loading.load_table(spark, spec, store, book, "2024-01-01 00:00:00")
    loading.load_table(spark, spec, store, book, "2024-02-01 00:00:00")
    return store.read().drop("_source_file", "_batch_id")


@query("load_scd2_files", f"""{scd2.TWO_MERGES}
SELECT * EXCLUDE (_source_file, _load_timestamp) FROM s2""")
def q_load_scd2(spark, sf_dir):
    """Three loads of one folder each into an SCD2 table, through listing and ledger."""
    root = scratch_path(spark, "load")
    batches = [
        (table(spark, sf_dir, "customer"), scd2.T0),
        (scd2.first_batch(spark, sf_dir), scd2.T1),
        (scd2.second_batch(spark, sf_dir), scd2.T2),
    ]
    spec = TableSpec(
        **{
            **scd2.CUSTOMER.__dict__,
            "source_path_pattern": f"{root}/raw/*/*.parquet",
            "snapshot_by": "folder",
        }
    )
    store = loading.store_for(spark, root, spec)
    book = EventLedger(spark, f"{root}/ledger")
    for n, (batch, at) in enumerate(batches):
        batch.write.parquet(f"{root}/raw/{n}")
        loading.load_table(spark, spec, store, book, at)
    return store.read().drop("_source_file", "_load_timestamp")


@query("load_scd2_buckets", f"""{scd2.TWO_MERGES}
SELECT * EXCLUDE (_source_file, _load_timestamp), TRUE AS carried FROM s2""")
def q_load_buckets(spark, sf_dir):
    """The loads of ``load_scd2_files`` into a table split by key hash, and then one of a
    single key: it rewrites that key's bucket, and the others' folders stay."""
    root = scratch_path(spark, "load")
    spec = TableSpec(
        **{**scd2.CUSTOMER.__dict__, "source_path_pattern": f"{root}/raw/*/part-*", "key_buckets": 8, "snapshot_by": "folder"}
    )
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    base = table(spark, sf_dir, "customer")
    batches = [(base, scd2.T0), (scd2.first_batch(spark, sf_dir), scd2.T1), (scd2.second_batch(spark, sf_dir), scd2.T2)]
    for n, (batch, at) in enumerate(batches):
        batch.write.parquet(f"{root}/raw/{n}")
        loading.load_table(spark, spec, store, book, at)
    merged = store.read()
    one = merged.filter("is_current AND c_custkey IS NOT NULL").orderBy("c_custkey").limit(1).select(*base.columns)
    one.withColumn("c_name", F.lit("renamed")).write.parquet(f"{root}/raw/3")
    before = store.version().parts
    loading.load_table(spark, spec, store, book, "2024-04-01 00:00:00")
    after = store.version().parts
    carried = [p["commit"] for p in after[:-1]] == [p["commit"] for p in before] and all(
        len(set(p["gone"]["buckets"]) - set((q.get("gone") or {"buckets": []})["buckets"])) <= 1 for p, q in zip(after, before)
    )
    return merged.drop("_source_file", "_load_timestamp").withColumn("carried", F.lit(carried))


@query("load_scd2_backlog", f"""{scd2.TWO_MERGES}
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, is_current, end_date IS NULL AS open FROM s2""")
def q_load_backlog(spark, sf_dir):
    """The same three snapshots waiting together, loaded as one batch: the history
    is that of three loads, its instants one microsecond apart."""
    root = scratch_path(spark, "load")
    spec = TableSpec(
        **{**scd2.CUSTOMER.__dict__, "source_path_pattern": f"{root}/raw/*/*.parquet", "snapshot_by": "folder"}
    )
    for n, batch in enumerate(
        (
            table(spark, sf_dir, "customer"),
            scd2.first_batch(spark, sf_dir),
            scd2.second_batch(spark, sf_dir),
        )
    ):
        batch.write.parquet(f"{root}/raw/{n}")
    store = loading.store_for(spark, root, spec)
    loading.load_table(spark, spec, store, EventLedger(spark, f"{root}/ledger"), scd2.T0)
    return store.read().select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        "is_current",
        F.col("end_date").isNull().alias("open"),
    )


def waiting(spark, rows, root, name):
    """Rows written as files of a folder that the loads below list."""
    rows.write.parquet(f"{root}/raw/{name}")


def load_spec(root, **settings):
    base = {"table_name": "t", "database_name": "d", "source_path_pattern": f"{root}/raw/*/part-*"}
    return TableSpec(**{**base, **settings})


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("load_overwrite_files", f"""SELECT {', '.join(ORDER_COLUMNS)} FROM orders
WHERE o_orderpriority >= '3'""")
def q_load_overwrite(spark, sf_dir):
    """Loads of more files than a batch takes replace the table once, with all of them;
    the last one holds a bad file and so replaces nothing."""
    root = scratch_path(spark, "load")
    spec, rows = load_spec(root, loading_strategy="overwrite"), orders(spark, sf_dir).select(*ORDER_COLUMNS)
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    early = F.col("o_orderpriority") < "3"
    waiting(spark, rows.filter(early).repartition(3), root, "a")
    loading.load_table(spark, spec, store, book, scd2.T0, max_files=1)
    waiting(spark, rows.filter(~early).repartition(3), root, "b")
    loading.load_table(spark, spec, store, book, scd2.T1, max_files=2)
    waiting(spark, rows.filter(early), root, "c")
    rows.select(F.lit("no parquet")).write.text(f"{root}/raw/d")
    loading.load_table(spark, spec, store, book, scd2.T2, max_files=2)
    return store.read().select(*ORDER_COLUMNS)


@query("load_merge_files", """
SELECT nullif(c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_custkey END) AS c_custkey, c_name,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 10 <> 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
FROM customer
UNION ALL SELECT NULL, c_name, c_acctbal + 1 FROM customer WHERE c_custkey % 30 = 0""")
def q_load_merge(spark, sf_dir):
    """An upsert with keyless rows, the second file of which is loaded once more."""
    root = scratch_path(spark, "load")
    spec = load_spec(root, loading_strategy="merge", primary_keys="c_custkey")
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    later = rows.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    for name, batch, at in (("a", rows, scd2.T0), ("b", later, scd2.T1)):
        keyed = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey"))
        waiting(spark, batch.withColumn("c_custkey", keyed), root, name)
        loading.load_table(spark, spec, store, book, at)
    # as after a load that was cut off once it had committed
    cut = F.when(F.col("file_path").contains("/b/"), "processing").otherwise(F.col("status"))
    book.create(book.read().withColumn("status", cut))
    loading.load_table(spark, spec, store, book, scd2.T2)
    return store.read().select("c_custkey", "c_name", "c_acctbal")


@query("load_after_purge", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def q_load_after_purge(spark, sf_dir):
    """Files whose ledger rows were purged are loaded again and doubled by nothing."""
    root = scratch_path(spark, "load")
    spec = load_spec(root)
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    waiting(spark, orders(spark, sf_dir).select(*ORDER_COLUMNS).repartition(3), root, "a")
    loading.load_table(spark, spec, store, book, scd2.T0)
    book.create(led.purge_ledger(book.read(), scd2.T2, days_to_keep=0))
    loading.load_table(spark, spec, store, book, scd2.T2)
    return store.read().select(*ORDER_COLUMNS)


@query("load_strict_schema", """SELECT p_partkey, p_name, 'completed' AS status FROM part WHERE p_size <= 20
UNION ALL SELECT NULL, NULL, 'failed' FROM region WHERE r_regionkey = 0""")
def q_load_strict(spark, sf_dir):
    """Without schema evolution files with another column are refused, and they alone."""
    root = scratch_path(spark, "load")
    spec = load_spec(root, schema_evolution=False)
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    part = table(spark, sf_dir, "part")
    waiting(spark, part.filter("p_size <= 20").select("p_partkey", "p_name"), root, "a")
    waiting(spark, part.filter("p_size > 20").select("p_partkey", "p_name", "p_size"), root, "b")
    loading.load_table(spark, spec, store, book, scd2.T0)
    loaded = store.read().select("p_partkey", "p_name", F.lit("completed").alias("status"))
    refused = book.read().filter("status <> 'completed'")
    nothing = [F.lit(None).cast(loaded.schema[c].dataType).alias(c) for c in ("p_partkey", "p_name")]
    return loaded.unionByName(refused.select("status").distinct().select(*nothing, "status"))


@query("load_shared_files", """SELECT 'one' AS name, n_nationkey, n_name FROM nation
UNION ALL SELECT 'two', n_nationkey, n_name FROM nation""")
def q_load_shared(spark, sf_dir):
    """Two tables over the same files, with one ledger."""
    root = scratch_path(spark, "load")
    waiting(spark, table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), root, "a")
    book, out = EventLedger(spark, f"{root}/ledger"), None
    for name in ("one", "two"):
        spec = load_spec(root, table_name=name)
        store = loading.store_for(spark, root, spec)
        loading.load_table(spark, spec, store, book, scd2.T0)
        rows = store.read().select(F.lit(name).alias("name"), "n_nationkey", "n_name")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("load_resume", """SELECT 1 AS run, 'nations' AS table_name, 'completed' AS status, TRUE AS consistent,
  count(*) AS row_count FROM nation
UNION ALL SELECT 1, 'regions', 'failed', TRUE, 0
UNION ALL SELECT 2, 'nations', 'completed', TRUE, count(*) FROM nation
UNION ALL SELECT 2, 'regions', 'completed', TRUE, count(*) FROM region""")
def q_load_resume(spark, sf_dir):
    """Of two tables one fails; the run that resumes passes over the other, whose new files
    wait, and mends it. Statuses agree with the ledger after each run."""
    root, out = scratch_path(spark, "load"), None
    names = {"nations": "nation", "regions": "region"}
    for name, source in names.items():
        table(spark, sf_dir, source).write.parquet(f"{root}/raw/{name}/a")
    specs = lambda text: [
        load_spec(root, table_name=n, source_path_pattern=f"{root}/raw/{n}/*/part-*", transformations=t)
        for n, t in (("nations", None), ("regions", {"filter": text} if text else None))
    ]
    for run, text in ((1, "assert_true(r_regionkey < 0) IS NULL"), (2, None)):
        loading.load_all(spark, specs(text), f"{root}/lake", scd2.T0, resume=run == 2)
        table(spark, sf_dir, "nation").write.parquet(f"{root}/raw/nations/{run}")
        states = loading.TableStates(spark, f"{root}/lake").read()
        book = EventLedger(spark, f"{root}/lake/metadata/file_ledger").read()
        report = led.consistency_report(book, states).select("table_name", F.col("table_status").alias("status"), "consistent")
        counts = {s.table_name: loading.store_for(spark, f"{root}/lake", s).row_count() for s in specs(None)}
        kept = F.coalesce(*[F.when(F.col("table_name") == n, F.lit(c)) for n, c in counts.items()])
        rows = report.select(F.lit(run).alias("run"), "*", kept.cast("long").alias("row_count"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("load_scd2_late_file", """
WITH s AS (SELECT c_custkey, step::INTEGER AS step, c_acctbal + CASE WHEN step = 1 AND c_custkey % 2 = 0 THEN 1
      WHEN step = 2 AND c_custkey % 3 = 0 THEN 2 ELSE 0 END AS c_acctbal
    FROM customer, range(3) AS steps(step) WHERE step <> 1 OR c_custkey % 5 <> 0),
o AS (SELECT *, c_acctbal IS DISTINCT FROM lag(c_acctbal) OVER (PARTITION BY c_custkey ORDER BY step) AS opens FROM s)
SELECT c_custkey, c_acctbal, step, lead(step) OVER w AS ends, lead(step) OVER w IS NULL AS is_current
FROM o WHERE opens WINDOW w AS (PARTITION BY c_custkey ORDER BY step)""")
def q_load_late(spark, sf_dir):
    """A snapshot that fails is loaded after a later one, under the instants of its files:
    the table is that of merging all in order, also where a later snapshot repeats values."""
    root = scratch_path(spark, "load")
    keys = {"loading_strategy": "scd2", "primary_keys": "c_custkey", "tracking_columns": "c_acctbal",
            "snapshot_by": "folder", "effective_from": "file"}
    strict = load_spec(root, **keys, transformations={"filter": "assert_true(step <> 1) IS NULL"})
    mended = load_spec(root, **keys)
    store, book = loading.store_for(spark, root, strict), EventLedger(spark, f"{root}/ledger")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for step, part in enumerate((None, 2, 3)):
        more = F.when(F.col("c_custkey") % part == 0, step).otherwise(0) if part else F.lit(0)
        snapshot = rows.withColumns({"c_acctbal": F.col("c_acctbal") + more, "step": F.lit(step)})
        waiting(spark, snapshot.filter("step <> 1 OR c_custkey % 5 <> 0"), root, step)
        if step != 1:
            loading.load_table(spark, strict, store, book, scd2.T0 if step == 0 else scd2.T1)
    loading.load_table(spark, mended, store, book, scd2.T1)
    state = store.read()
    starts = state.groupBy("effective_date").agg(F.min("step").alias("ends"))
    return (
        state.join(starts.withColumnRenamed("effective_date", "end_date"), "end_date", "left")
        .select("c_custkey", "c_acctbal", "step", "ends", "is_current")
    )


@query("load_scd2_late_forward", """
SELECT c_custkey, c_acctbal, FALSE AS is_current, TRUE AS forward FROM customer
UNION ALL SELECT c_custkey, c_acctbal + 2, FALSE, TRUE FROM customer
UNION ALL SELECT c_custkey, c_acctbal + 1, TRUE, TRUE FROM customer""")
def q_load_late_forward(spark, sf_dir):
    """A snapshot that fails is loaded after a later one, under instants of loads: its rows
    follow those in the table, and every version ends after it starts."""
    root = scratch_path(spark, "load")
    keys = {"loading_strategy": "scd2", "primary_keys": "c_custkey", "tracking_columns": "c_acctbal", "snapshot_by": "folder"}
    strict = load_spec(root, **keys, transformations={"filter": "assert_true(step <> 1) IS NULL"})
    mended = load_spec(root, **keys)
    store, book = loading.store_for(spark, root, strict), EventLedger(spark, f"{root}/ledger")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for step in range(3):
        more = rows.withColumns({"c_acctbal": F.col("c_acctbal") + step, "step": F.lit(step)})
        waiting(spark, more, root, step)
        if step != 1:
            loading.load_table(spark, strict, store, book, scd2.T0 if step == 0 else scd2.T1)
    loading.load_table(spark, mended, store, book, scd2.T1)
    forward = F.col("end_date").isNull() | (F.col("end_date") > F.col("effective_date"))
    return store.read().select("c_custkey", "c_acctbal", "is_current", forward.alias("forward"))


def catalog_table(spark, sf_dir):
    """Orders as a catalog table whose files lie in the scratch folder."""
    path = scratch_path(spark, "orders")
    name = path.rpartition("/")[2].replace("-", "_")
    orders(spark, sf_dir).write.option("path", path).saveAsTable(name)
    return name


@query("table_statistics", "SELECT TRUE AS table_exists, count(*) AS row_count FROM orders")
def q_table_statistics(spark, sf_dir):
    row = catalog.table_statistics(spark, catalog_table(spark, sf_dir))
    return row.select("table_exists", "row_count")


@query("catalog_view", f"""{scd2.TWO_MERGES}
SELECT * EXCLUDE (_source_file, _load_timestamp) FROM s2""")
def q_catalog_view(spark, sf_dir):
    """Three loads into an SCD2 table split by key hash, read by another session through a
    catalog view that is renewed after each load."""
    root = scratch_path(spark, "load")
    spec = TableSpec(
        **{**scd2.CUSTOMER.__dict__, "source_path_pattern": f"{root}/raw/*/part-*", "key_buckets": 8, "snapshot_by": "folder"}
    )
    store, book = loading.store_for(spark, root, spec), EventLedger(spark, f"{root}/ledger")
    name = "customers_" + root.rpartition("-")[2]
    batches = [
        (table(spark, sf_dir, "customer"), scd2.T0),
        (scd2.first_batch(spark, sf_dir), scd2.T1),
        (scd2.second_batch(spark, sf_dir), scd2.T2),
    ]
    for n, (batch, at) in enumerate(batches):
        waiting(spark, batch, root, n)
        loading.load_table(spark, spec, store, book, at)
        store.publish_catalog(name)
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        other.conf.set(key, spark.conf.get(key))
    return other.table(name).drop("_source_file", "_load_timestamp")


@query("published_statistics", """SELECT TRUE AS table_exists, count(*) AS row_count, TRUE AS sized, TRUE AS placed FROM orders
UNION ALL SELECT FALSE, NULL, NULL, NULL""")
def q_published_statistics(spark, sf_dir):
    """Statistics of a catalog table, whose size and place are those of a listing of its
    files, and of a table that does not exist."""
    name = catalog_table(spark, sf_dir)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    row = catalog.table_statistics(spark, name)
    listed = files.list_files(spark, row.first()["location"] + "/*.parquet").agg(F.sum("length")).first()[0]
    size = F.regexp_extract("size_info", "^([0-9]+) bytes", 1).cast("long")
    found = row.select(
        "table_exists", "row_count", (size == listed).alias("sized"), F.endswith("location", F.lit(name.replace("_", "-", 1))).alias("placed")
    )
    gone = catalog.table_statistics(spark, f"{name}_gone")
    return found.unionByName(gone.select("table_exists", "row_count", *[F.lit(None).cast("boolean").alias(c) for c in ("sized", "placed")]))


@query("table_properties", """SELECT column_name AS key FROM information_schema.columns
WHERE table_name = 'orders'""")
def q_table_properties(spark, sf_dir):
    """Of the properties the columns, whose types have other names elsewhere."""
    details = catalog.table_properties(spark, catalog_table(spark, sf_dir))
    return details.filter("key LIKE 'o\\_%'").select("key")
