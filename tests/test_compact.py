import pytest
from pyspark.sql import functions as F

from remitlens.operators import compact
from remitlens.plans.compact_model import compact_from_report
from tests.samples import plain

SCHEMA = "week int, payer string, group_em string, charge_amount double, payment_amount double"
ROWS = [(1, "A", "g", 100.0, 90.0), (1, "B", "g", 200.0, 100.0), (2, "A", None, 0.0, 5.0), (None, None, "g", 10.0, None), (2, "A", "g", 50.0, 50.0)]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_rows_without_key_are_left_out(lines):
    got = plain(compact.weekly_simple(lines), ["week"])
    assert got[1,] == {"charge_amount": 300.0, "payment_amount": 190.0, "visit_count": 2, "collection_rate": round(190 / 300, 9), "performance_vs_85": round((190 / 300 - 0.85) * 100, 9)}
    assert set(got) == {(1,), (2,)}
    assert set(plain(compact.weekly_simple(lines, ["week", "payer", "group_em"]), ["week", "payer", "group_em"])) == {(1, "A", "g"), (1, "B", "g"), (2, "A", "g")}


def test_visit_count_is_summed_when_present(lines):
    got = plain(compact.weekly_simple(lines.withColumn("visit_count", F.lit(3))), ["week"])
    assert got[1,]["visit_count"] == 6


def test_gap_drivers_round_before_the_rate(lines):
    got = plain(compact.gap_drivers(compact.benchmark_85pct(lines), "payer"), ["payer"])
    assert set(got) == {("A",), ("B",)}
    assert got["A",]["transaction_count"] == 3 and got["A",]["total_gap"] == 17.5
    assert got["A",]["collection_rate"] == 96.67
    assert compact.worst_payer(compact.gap_drivers(compact.benchmark_85pct(lines), "payer")).first().payer == "B"


def test_historical_benchmark_skips_lines_without_charge(lines):
    assert compact.median_rate(lines).first().median_rate == 0.9
    got = [r.historical_benchmark for r in compact.historical_benchmark(lines).orderBy("charge_amount").collect()]
    assert got == [0.0, 9.0, 45.0, 90.0, 180.0]


def test_run_summary(lines):
    row = compact.run_summary(lines).first()
    assert (row.total_transactions, row.total_charges, row.total_payments) == (5, 360.0, 245.0)
    assert row.overall_collection_rate == pytest.approx(245 / 360 * 100)


def test_missing_amounts_count_as_zero(spark):
    """A report line without a payment counts with its full shortfall; block headers reach the lines below."""
    columns = ["row_id", "Year of Visit Service Date", "Primary Financial Class", "Charge Invoice Number", "Charge CPT Code", "Charge Amount", "Payment Amount*", "Unnamed: 9"]
    rows = [(0, "2024", "Aetna", "1", "99213", "100", "50", "x"), (1, None, None, "2", "99214", "100", " ", "x")]
    report = spark.createDataFrame(rows, ", ".join(f"`{c}` {'bigint' if c == 'row_id' else 'string'}" for c in columns))
    tables = compact_from_report(report)
    (r,) = tables["gap_by_payer"].collect()
    assert (r.payer, r.transaction_count, r.avg_gap, r.total_charges, r.total_payments) == ("Aetna", 2, -60.0, 200.0, 50.0)
    assert tables["lines"].count() == 2 and tables["ml_metrics"].count() == 0
