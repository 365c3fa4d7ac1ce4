"""Every query with SQL gives the same columns, types and values on another engine."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as contract

# The queries of the llm subpackage have tests of their own.
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.LLM_QUERIES}
SQL = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}
MODELS = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def duck(tables):
    return oracle.connect(tables)


@pytest.mark.parametrize("name", [q for q in QUERIES if q in SQL])
def test_same_rows(spark, tables, duck, name):
    assert oracle.compare(QUERIES[name](spark, tables), duck, SQL[name]) == []


def test_only_fitted_models_and_the_document_lack_sql():
    assert set(SQL) <= set(QUERIES)
    assert all(q.startswith(("ml_intent", "ml_quality", "bi_kpi_document")) for q in MODELS)


@pytest.mark.parametrize("name", MODELS)
def test_model_queries_return_rows(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["customer_id", "r_score", "f_score", "m_score", "rfm_score", "segment"]
    assert out.count() == 120
