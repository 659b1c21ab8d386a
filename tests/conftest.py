import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from courtside.session import tune


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("courtside-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = os.environ.get("COURTSIDE_TESTDATA", "/root/testdata/sf0.001")
    if not Path(folder).exists():
        pytest.skip("no test tables")
    return folder


def rows_of(df, *order):
    """Rows as sorted plain tuples, floats rounded."""
    columns = sorted(df.columns)
    key = lambda row: [(v is None, str(type(v)), v) for v in row]
    out = [tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect()]
    return sorted(out, key=lambda row: [(v is None, "" if v is None else v) for v in row])
