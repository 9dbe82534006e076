import duckdb
import pytest
from check_queries import TABLES, compare
from pyspark.sql import functions as F
from tests_llm_helpers import frame, odd_rows, words_of

import __spark_entry__ as registry
import corpus_pipeline
from wordloom.llm.oracles import ORACLES
from wordloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, folder, db, name):
    got = registry.queries()[name](spark, folder).toArrow()
    assert compare(got, db, registry.oracle_sql()[name]).startswith("ok")


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())


def test_stages_keep_the_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # Long texts once more, on one line: no line of theirs repeats, all their shingles do.
    long_ = docs.filter("text LIKE '%\n%\n%' AND n_chars > 1000").orderBy("doc_id").limit(20)
    flat = long_.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    flat = flat.withColumn("text", F.translate("text", "\n", " "))
    docs = docs.union(flat)
    columns, before = docs.columns, docs.count()
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).checkpoint()
        assert docs.columns == columns, name
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= ids, name
        if name != "source-mixing":
            assert docs.count() == len(kept) < before, name
        before, ids = docs.count(), kept
    for r in docs.collect():
        assert words_of(r["text"]) and r["n_chars"] == len(r["text"])


def test_stages_of_odd_rows(spark, folder):
    schema = "doc_id long, text string, source string, copy long, own_id long, score double"
    rows = [(r[0], r[1], ["a", None][k % 2], 1, 2, 0.5) for k, r in enumerate(odd_rows())]
    for given in (rows, []):
        docs = frame(spark, given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, folder)
            assert got.schema.names == docs.schema.names
            assert got.count() <= 3 * len(given)
        assert corpus_pipeline.tokens(spark, docs, folder).count() == len(given)


def test_the_pipeline_is_its_stages(spark, folder):
    got = registry.queries()["pipeline"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids"]
    assert all(r["n_tokens"] == len(r["ids"]) for r in got.collect())
