"""The pipeline against its stages by brute force, and the queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from goldpan.llm import toxicity
from goldpan.llm.oracles import llm_oracles
from goldpan.llm.queries import llm_queries
from tests.compare import duck_bag, duck_types, spark_bag, spark_types
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_mixing import by_rounds
from tests.llm.test_near_dedup import brute as near

SF_DIR = "/root/testdata/sf0.001"


def test_queries_are_the_thirteen():
    assert sorted(int(n.removeprefix("op").split("_")[0]) for n in llm_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = llm_queries()[name](spark, SF_DIR)
    assert spark_types(result) == duck_types(connection, llm_oracles()[name])
    assert spark_bag(result) == duck_bag(connection, llm_oracles()[name])


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.fit(docs, labels, F.lit(True))
    clean = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in clean]
    last = {}
    for row in sorted(rows):
        last[row[1]] = row
    rows = sorted(last.values())
    kept = {doc for doc, _, _, stays in near(rows) if stays}
    rows = [r for r in rows if r[0] in kept and hits(r[1], items)[1] == 0]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    goal = by_rounds(sizes)
    mixed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in mixed) == [r[0] for r in rows]
    source = {r[0]: r[2] for r in rows}
    for r in mixed:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(goal[source[r.doc_id]])


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs.limit(0), SF_DIR)
        assert left.columns == docs.columns, name
        assert left.isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF_DIR).isEmpty()


def test_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF_DIR).columns == odd.columns, name
