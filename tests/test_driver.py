"""Queries whose driver filled with plans: what they do once, and what they leave out."""

import os

import pytest

SF = os.environ.get("GRIDWEAVE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")


@pytest.fixture
def written(monkeypatch):
    """The labels of the steps that are written."""
    from gridweave import session

    labels, write = [], session.materialise
    monkeypatch.setattr(session, "materialise", lambda df, label: labels.append(label) or write(df, label))
    return labels


def test_row_audit_counts_scores_texts_once(spark, written):
    from gridweave.plans import gate_queries, page_audit

    got = gate_queries.row_audit_counts(spark, SF).collect()
    assert written.count("printed") == 1  # the labels of a text were scored again for each table
    whole = page_audit.audit_collection(gate_queries._reads(spark, SF), gate_queries._docs(spark, SF))
    assert got == whole.counts.collect() and got[0]["tables"] == whole.tables.count()
    totals = whole.totals.toPandas().sum(numeric_only=True)
    assert all(got[0][c] == totals[c] for c in ("on_page_not_extracted", "extracted_not_on_page", "pages_not_in_any_extraction"))


def test_keys_of_a_text_are_a_short_expression(spark):
    from pyspark.sql import functions as F

    from gridweave.operators import matching

    plan = spark.range(1).select(F.explode(matching._printed_keys(F.col("id").cast("string"))))
    assert len(plan._jdf.queryExecution().analyzed().toString()) < 5000


def test_consolidated_notes_writes_what_it_reads(spark, written):
    from gridweave.plans import consolidate, pipeline_queries

    pipeline_queries.consolidated_notes(spark, SF).collect()
    assert not {"nodes", "entities", "properties", "column_values"} & {*written}  # the walk of the tree and properties, which no note shows
    assert written.count("references") == 2 and {*consolidate.REFERENCES} > {"referenced_xacts", "cell_references"}


def test_consolidated_statistics_writes_what_it_counts(spark, written):
    from gridweave.plans import pipeline_queries

    got = pipeline_queries.consolidated_statistics(spark, SF)
    assert not {"nodes", "entities", "properties", "grid", "cells", "columns", "edges", "references", "notes"} & {*written}
    assert sorted(got.collect()) == sorted(pipeline_queries._both(spark, SF)[1].stats.select(got.columns).collect())
