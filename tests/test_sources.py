from pathlib import Path

import pytest
from conftest import rows

from wordloom.session import cut, new_folder, shared_folder, temporary_tables
from wordloom.sources import reviews as R
from wordloom.sources import sinks, stages


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_with_header(spark, tmp_path):
    path = write(tmp_path, "test.csv", "text,label\nhello world,1\ngood movie,0\n")
    df = R.read_csv(spark, path)
    assert df.columns == ["text", "label"] and df.count() == 2


def test_csv_without_header(spark, tmp_path):
    path = write(tmp_path, "plain.csv", "hello world,1\n")
    assert rows(R.read_csv(spark, path, header=False)) == [("hello world", "1")]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.read_csv(spark, str(tmp_path / "none.csv"))


def test_quotes_and_line_breaks_inside_fields(spark, tmp_path):
    path = write(
        tmp_path, "q.csv", 'text,label\n"He said ""wow"" ok, yes",1\n"two\nlines",0\n'
    )
    got = rows(R.typed_reviews(R.read_csv(spark, path)))
    assert got == sorted([('He said "wow" ok, yes', 1), ("two\nlines", 0)], key=repr)


def test_labels_that_are_no_numbers_are_rejected(spark, tmp_path):
    path = write(tmp_path, "l.csv", "text,label\none,x\ntwo,\nthree,1\n")
    typed = R.typed_reviews(R.read_csv(spark, path))
    assert R.rejects(typed).first().rejected == 2
    assert rows(R.labelled(typed)) == [("three", 1)]


def test_loaded_reviews_keep_their_ids(spark, tmp_path):
    path = write(tmp_path, "r.csv", "text,label\nsame,1\nsame,1\n...,0\n")
    loaded = R.load_reviews(spark, path, "train")
    first, second = rows(loaded), rows(loaded)
    assert first == second and len({r[0] for r in first}) == 2
    assert {r[1:] for r in first} == {("same", 1, "train")}


def test_prepared_stage_prunes_to_a_split(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", 1, "train"), (2, "b", 0, "test")],
        "doc_id long, text string, label int, split string",
    )
    path = str(tmp_path / "prepared")
    stages.write_prepared(df, path)
    part = stages.read_prepared(spark, path, "test")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert [r.doc_id for r in part.collect()] == [2]
    only_ids = part.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in only_ids


def test_predictions_survive_the_csv_round_trip(spark, tmp_path, capsys):
    df = spark.createDataFrame(
        [(' a "b",\n c ', 1, 0.25, 0.75)],
        "text string, prediction int, probability_negative double, probability_positive double",
    )
    path = str(tmp_path / "out")
    for _ in range(2):
        sinks.emit_predictions(df, path)
    assert rows(R.read_csv(spark, path)) == [(' a "b",\n c ', "1", "0.25", "0.75")]
    sinks.emit_predictions(df)
    assert "probability_positive" in capsys.readouterr().out


def test_literal_texts(spark):
    assert rows(R.literal_text(spark, "x", "y")) == [(0, "x"), (1, "y")]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scans_are_read_as_they_are(spark, folder):
    plan = R.documents(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["word_count", "tfidf", "nb_pipeline_scores"])
def test_registered_queries_do_not_shuffle_whole_texts(spark, folder, name):
    import __spark_entry__ as registry

    plan = registry.queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "REPARTITION" not in plan.upper()


def test_empty_stage_tables_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, label int, split string")
    assert stages.write_prepared(df, str(tmp_path / "p")).count() == 0
    assert stages.read_prepared(spark, str(tmp_path / "p"), "train").count() == 0
    assert stages.write_features(df, str(tmp_path / "f")).columns == df.columns


def test_files_without_line_breaks_in_fields_can_split(spark, tmp_path):
    path = write(tmp_path, "big.csv", "text,label\n" + "some words of a text,1\n" * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert R.read_csv(spark, path, split=False).rdd.getNumPartitions() == 1
        split = R.read_csv(spark, path, multi_line=False)
        assert split.rdd.getNumPartitions() > 1 and split.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tables_of_a_job_are_deleted_at_its_end(spark):
    before = spark.sparkContext.getCheckpointDir()
    with temporary_tables(spark) as folder:
        spark.range(3).write.parquet(new_folder(spark, "t"))
        assert cut(spark.range(5)).count() == 5
        assert list(Path(folder).iterdir())
    assert not Path(folder).exists()
    assert (spark.sparkContext.getCheckpointDir() is None) == (before is None)
    assert cut(spark.range(5)).count() == 5


class OnACluster:
    def __init__(self, conf):
        self.conf = self
        self.values = conf
        self.sparkContext = self
        self.master = "spark://host:7077"

    def get(self, key, default=None):
        return self.values.get(key, default)

    def getCheckpointDir(self):
        return "set"


def test_a_cluster_needs_a_folder_that_machines_share():
    with pytest.raises(ValueError, match="own disk"):
        shared_folder(OnACluster({"spark.checkpoint.dir": "file:///tmp/x"}))
    mounted = {"spark.checkpoint.dir": "file:///mnt/x", "spark.wordloom.sharedMount": "true"}
    assert shared_folder(OnACluster(mounted)) == "file:///mnt/x"
    assert shared_folder(OnACluster({"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_labels_prune_documents_columns(spark, folder):
    plan = R.reviews(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "IsNotNull(text)" in plan
