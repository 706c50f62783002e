import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from kpiloom.session import SHARED_DIR_KEY, local_session  # noqa: E402
from kpiloom.sources.star import RetailStar  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.debug.maxToStringFields": "1000",
        SHARED_DIR_KEY: str(shared),
    }
    session = local_session("tests", 8, **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def star(spark, sf_dir):
    return RetailStar(spark, sf_dir)


@pytest.fixture()
def plan():
    """The physical plan of a frame as text."""
    return lambda frame: frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def many_partitions(spark):
    """Keeps Spark from merging small shuffle partitions, as large data would."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)
