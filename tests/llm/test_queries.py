"""The registered corpus queries and the pipeline over the smallest tables."""

import collections

import duckdb
import pytest
from tests.llm.helpers import words
from tests.llm.test_joins import brute_join

import __spark_entry__ as contract
import corpus_pipeline
from sedimenta.llm import pii, queries, toxicity
from sedimenta.scratch import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    got = df.collect()
    assert got and contract.queries()[name] is queries.QUERIES[name]
    sql = queries.ORACLES.get(name)
    if sql:
        con = duckdb.connect()
        for table in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_mixing_is_native(spark):
    plan = queries.QUERIES["op6_mix_sources"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_join", "pii", "mixing", "packing"]
    step = lambda name, df: materialize(stages[name](spark, df, SF_DIR), name)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")

    clean = step("toxicity", docs)
    verdicts = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, labels).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, bad in verdicts.items() if not bad}

    single = step("ngram_join", clean)
    found = brute_join([(r.doc_id, r.text, r.source) for r in clean.collect()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (n, c) in found.items() if i == c)

    masked = step("pii", single)
    before = {r.doc_id: r.text for r in single.collect()}
    for r in masked.collect():
        assert r.text == pii.redact(before[r.doc_id], pii.find(before[r.doc_id])[1]) and r.n_chars == len(r.text)

    mixed = step("mixing", masked)
    for df in (clean, single, masked, mixed):
        assert df.columns == docs.columns
    sizes = collections.Counter(r.source for r in masked.collect() for _ in words(r.text))
    taken = collections.Counter(r.source for r in mixed.collect() for _ in words(r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)

    packed = step("packing", mixed)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_pipeline_of_nothing(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = materialize(stage(spark, df, SF_DIR), "none")
        assert df.count() == 0
