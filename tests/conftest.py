import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    warehouse = tempfile.mkdtemp(prefix="tidemark-warehouse-")
    session = local_session(
        4, "tidemark-tests", 4, "4g", {"spark.sql.warehouse.dir": warehouse}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
