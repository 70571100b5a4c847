import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from sluice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    options = {
        "spark.checkpoint.dir": shared,
        "spark.driver.memory": "6g",
        "spark.sql.maxMetadataStringLength": "1000",
    }
    session = local_session(4, **options)
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows and a schema string to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def values(df, *names):
    """Sorted tuples of the named columns."""
    rows = [tuple(r) for r in (df.select(*names) if names else df).collect()]
    return sorted(rows, key=repr)
