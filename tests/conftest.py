import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": f"{shared}/shared",
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame, dates given as text."""
    from pyspark.sql import functions as F

    def make(rows, extra=""):
        schema = "id_1 string, id_2 string, vaccine_group string, vaccination_date string"
        made = spark.createDataFrame(rows, schema + extra)
        return made.withColumn("vaccination_date", F.col("vaccination_date").cast("date"))

    return make
