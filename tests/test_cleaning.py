import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import cleaning as C

PIECES = st.sampled_from(
    ["a", "B9", "_", " ", "  ", "\t", "\n", "\x0b", "\x1d", "\xa0", " ", "　", "é", "Éa",
     "<br>", "<br />", "<br\t/>", "<br", "<b>", "</b>", "<", ">", ".", "...", "'", "-", "漢"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=30)
SLOW = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def texts_table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def column(df, name="x"):
    return [row[name] for row in df.orderBy("doc_id").collect()]


@SLOW
@given(TEXTS)
def test_classic_clean_is_its_steps_in_order(spark, texts):
    text = F.col("text")
    for unicode in (False, True):
        steps = C.breaks_to_spaces(C.trim_spaces(text))
        steps = C.collapse_spaces(C.punctuation_to_spaces(steps, unicode), unicode)
        df = texts_table(spark, texts).select(
            "doc_id",
            C.classic_clean(text, unicode).alias("x"),
            F.trim(steps).alias("y"),
            F.expr(C.classic_clean_sql("text", unicode)).alias("z"),
        )
        assert column(df, "x") == column(df, "y") == column(df, "z")


@SLOW
@given(TEXTS)
def test_light_clean_matches_unicode_white_space_rules(spark, texts):
    def plain(text):
        text = re.sub(r"<br\s*/?>", " ", text)
        text = re.sub(r"<[^>]+>", "", text)
        return re.sub(r"\s+", " ", text).strip()

    df = texts_table(spark, texts).select("doc_id", C.light_clean(F.col("text")).alias("x"))
    assert column(df) == [plain(text) for text in texts]
    status = texts_table(spark, texts).select("doc_id", C.input_status(F.col("text")).alias("x"))
    assert column(status) == ["ok" if text.strip() else "empty" for text in texts]


def test_accents_go_by_default_and_stay_on_request(spark):
    df = texts_table(spark, ["Café Été!"])
    both = df.select(
        C.classic_clean(F.col("text")).alias("ascii"),
        C.classic_clean(F.col("text"), unicode=True).alias("unicode"),
    ).first()
    assert both == ("Caf t", "Café Été")


def test_breaks_turn_to_spaces_before_tags_vanish(spark):
    df = texts_table(spark, ["a<br/>b<br >c<b>d</b>"])
    assert column(df.select("doc_id", C.light_clean(F.col("text")).alias("x"))) == ["a b cd"]


def test_texts_that_are_blank_after_cleaning_are_dropped(spark):
    df = texts_table(spark, ["...", "!!", '"  "', None, "", " ok... "])
    assert column(C.with_clean_text(df), "text") == ["ok"]
    assert column(C.with_clean_text(df, C.light_clean), "text") == ["...", "!!", '" "', "ok..."]


def test_null_input_is_empty(spark):
    df = texts_table(spark, [None, "\xa0　", "x"])
    got = column(df.select("doc_id", C.input_status(F.col("text")).alias("x")))
    assert got == ["empty", "empty", "ok"]


def test_cleaning_runs_once_per_row_and_null_test_reaches_the_scan(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = C.with_clean_text(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("\\W+") == 1
    assert "IsNotNull(text)" in plan
