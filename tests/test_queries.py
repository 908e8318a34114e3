"""Registered queries against their SQL. ``python -m remitlens.verification.compare FOLDER`` checks all of them."""

import pytest

import __spark_entry__ as contract
from remitlens.verification.compare import connect, difference

SAMPLE = [
    "benchmark_variance",
    "weekly_granular_diag",
    "weekly_aggregated",
    "diagnostics_base",
    "underpayment_summary",
    "drivers_key",
    "top5_cpt",
    "gap_by_payer",
    "historical_benchmark",
    "overall_narrative",
    "narratives",
    "clean_report",
    "parse_number",
    "time_ordinal",
    "sample_validation",
    "dq_suite",
    "ml_hotspots_topn",
    "latest_snapshot",
    "forward_fill",
    "ml_features",
    "csv_row_order",
    "clean_report_csv",
    "ml_elasticnet",
    "ml_fitted_hotspots",
    "ml_time_cv",
    "ml_metrics",
]


@pytest.fixture(scope="module")
def db(tables):
    return connect(tables)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, tables, db, name):
    df = contract.queries()[name](spark, tables)
    assert difference(df, db.execute(contract.oracle_sql()[name])) is None


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["invoice_number", "cpt_code"] and df.count() > 0
