"""Joins of tables that grow with the data are not broadcast, however small the tables look: that passes the driver."""

import os

import pytest

SF = os.environ.get("GRIDWEAVE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")


def plans(spark, since):
    """The plans of the SQL executions from a number on, as they ended."""
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    return [e.physicalPlanDescription() for e in (store.executionsList().apply(i) for i in range(store.executionsList().size())) if e.executionId() >= since]


@pytest.mark.parametrize("name", ["quote_verdicts", "row_audit", "row_audit_counts", "consolidated_findings", "consolidated_notes", "consolidated_statistics", "resolved_documents", "consolidated_documents"])
def test_no_join_is_broadcast(spark, name):
    import __spark_entry__ as entry

    store = spark._jsparkSession.sharedState().statusStore()
    before = [store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())]
    entry.queries()[name](spark, SF).write.format("noop").mode("overwrite").save()
    found = plans(spark, max(before, default=-1) + 1)
    assert found and not [p[:2000] for p in found if "BroadcastHashJoin" in p]
