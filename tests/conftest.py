import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wordloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def train(spark, folder):
    from wordloom.session import cut
    from wordloom.sources.reviews import clean_reviews

    return cut(clean_reviews(spark, folder))


@pytest.fixture(scope="session")
def nb_model(train):
    from wordloom.plans.pipeline import fit_classifier

    return fit_classifier(train, "naive_bayes")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
