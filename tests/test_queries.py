import duckdb
import pytest
from check_queries import TABLES, compare

import __spark_entry__ as registry
from oracles import ORACLES
from wordloom.functions.words import STOPWORDS


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, folder, db, name):
    got = registry.queries()[name](spark, folder).toArrow()
    verdict = compare(got, db, registry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict
    assert got.num_rows > 0


@pytest.fixture(scope="module")
def odd(spark, folder, tmp_path_factory):
    """The tables with texts that cleaning empties, and an unlabelled word, and their SQL views."""
    path = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = ["... !!!", "<br />", "\u2014 \u00a0", "\u0434\u0430", "", " ", "film"]
    more = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    return str(path), connection


@pytest.mark.parametrize(
    "name",
    ["batch_udf_scores", "nb_pipeline_scores", "nb_tfidf_scores", "predictions_csv",
     "saved_model_scores", "stream_scores"],
)
def test_scores_match_their_sql_on_texts_without_words(spark, odd, name):
    path, connection = odd
    got = registry.queries()[name](spark, path).toArrow()
    verdict = compare(got, connection, registry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).columns == ["word", "total_count", "doc_freq"]


def test_rows_are_dropped_rejected_and_blank(spark, folder):
    queries = registry.queries()
    assert queries["label_rejects"](spark, folder).first().rejected > 0
    assert queries["mixed_labels_typed"](spark, folder).filter("label IS NULL").count() > 0
    assert queries["clean_blanked"](spark, folder).count() < registry.raw_documents(spark, folder).count()
    status = {r.status for r in queries["blanked_status"](spark, folder).collect()}
    assert status == {"ok", "empty"}
    steps = queries["page_steps"](spark, folder)
    assert steps.filter("without_breaks <> trimmed").count() == steps.count() > 0


def test_best_step_prepares_the_texts_once(spark, folder, monkeypatch):
    calls = []
    prepare = registry.train_test
    monkeypatch.setattr(registry, "train_test", lambda *a: calls.append(a) or prepare(*a))
    registry.best_step(spark, folder)
    assert len(calls) == 1


@pytest.mark.parametrize("name", ["count_join_df", "nb_priors"])
def test_one_scan(spark, folder, name):
    plan = registry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_stopwords_are_the_fixed_list():
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 44
    assert {"the", "and", "of", "is"} <= set(STOPWORDS)
