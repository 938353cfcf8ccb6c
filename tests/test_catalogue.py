"""Every query with SQL against DuckDB on the smallest test tables; the others must run."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
from gridweave.plans import catalogue, gate_queries, pipeline_queries, problems  # noqa: E402

SF = os.environ.get("GRIDWEAVE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")
MODULES = [problems, catalogue, pipeline_queries, gate_queries]
NAMES = [(m, n) for m in MODULES for n in m.QUERIES]


@pytest.fixture(scope="module")
def con():
    from tools.compare import connect

    return connect(SF)


@pytest.mark.parametrize("module, name", NAMES, ids=[n for _, n in NAMES])
def test_query(spark, con, module, name):
    from tools.compare import rows_of_df, rows_of_sql

    got = rows_of_df(module.QUERIES[name](spark, SF))
    if name in module.SQL:
        assert got == rows_of_sql(con, module.SQL[name])


def test_entry_has_distinct_names(spark):
    import __spark_entry__ as entry

    assert len(entry.queries()) == sum(len(m.QUERIES) for m in entry._MODULES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() >= 0
