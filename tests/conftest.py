import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


def executed(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    """Rows as plain tuples, sorted with nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])
