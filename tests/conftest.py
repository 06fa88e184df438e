import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crivo.session import build_session, fresh_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(spark):
    return fresh_path(spark, "test")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def features(spark, small):
    from crivo.sources.contracts import feature_table
    from crivo.sources.tables import staged

    return staged(feature_table(spark, small), "features")
