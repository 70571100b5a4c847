"""Every query of the catalog against its SQL counterpart on the smallest tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

from compare import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from sluice.catalog import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# results that no SQL counterpart describes, tested by hand elsewhere
ROWS_ONLY = {"profile_sketched"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, FOLDER, name, oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows only"))


def test_which_queries_have_no_counterpart():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert not set(SQL) - set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["c_mktsegment", "revenue", "lines", "tier"]
    assert df.count() == 3
