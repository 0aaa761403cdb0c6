import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from orderweir.session import configure  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderweir-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def landing(spark, folder):
    from orderweir.sources.landing import Landing

    return Landing(spark, folder)


def rows(df, *order):
    """All rows as tuples, sorted."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
