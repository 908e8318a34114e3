"""Line-level variance, over/underpayment and anomaly columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import DIMS
from remitlens.functions.numbers import div_or_zero, is_true, positive_part, sum0
from remitlens.operators.joins import null_safe_join
from remitlens.operators.keys import benchmark_avg, benchmark_keys, cpt_sets, invoice_totals


def variance_85em(df: DataFrame) -> DataFrame:
    """Payment less expected amount, in dollars and relative to the expected amount (0 when that is 0)."""
    dollar = F.col("payment_amount") - F.col("expected_85em")
    return df.withColumns(
        {"revenue_variance_85em_dollar": dollar, "revenue_variance_85em_pct": div_or_zero(dollar, F.col("expected_85em"))}
    )


def attach_benchmark(keyed: DataFrame, totals: DataFrame, averages: DataFrame) -> DataFrame:
    """Lines with their invoice's total and their key's mean total.

    The mean joins the invoice totals first: that table is smaller than the lines, which then move once.
    """
    per_invoice = null_safe_join(totals, averages, ["benchmark_key"])
    return null_safe_join(keyed, per_invoice, ["benchmark_key", "invoice_number"])


def _against_benchmark(df: DataFrame) -> DataFrame:
    dollar = F.col("invoice_total_payment") - F.col("benchmark_avg_payment")
    return df.withColumns(
        {
            "revenue_variance_benchmark_dollar": dollar,
            "revenue_variance_benchmark_pct": div_or_zero(dollar, F.col("benchmark_avg_payment")),
        }
    )


def benchmark_variance(keyed: DataFrame) -> DataFrame:
    """Invoice total against the mean invoice total of its key, on every line."""
    totals = invoice_totals(keyed)
    return _against_benchmark(attach_benchmark(keyed, totals, benchmark_avg(totals)))


def invoice_benchmarks(lines: DataFrame) -> DataFrame:
    """Code set, key, invoice total and key mean per (payer, groups, invoice), from lines without keys.

    Payments are added up per invoice before any join, so the joins handle invoices rather than lines.
    """
    invoice = [*DIMS, "invoice_number"]
    facts = lines.groupBy(*invoice).agg(sum0(F.col("payment_amount")).alias("payment_amount"))
    keyed = benchmark_keys(null_safe_join(facts, cpt_sets(lines), ["invoice_number"]))
    keyed = keyed.withColumnRenamed("payment_amount", "invoice_total_payment")
    return null_safe_join(keyed, benchmark_avg(keyed), ["benchmark_key"])


def benchmark_variance_of_lines(lines: DataFrame) -> DataFrame:
    """``benchmark_variance(keyed_lines(lines))`` with a single join at line level."""
    return _against_benchmark(null_safe_join(lines, invoice_benchmarks(lines), [*DIMS, "invoice_number"]))


def over_under(df: DataFrame) -> DataFrame:
    """Over- and underpayment against the expected amount, in dollars and relative to it. Needs ``variance_85em``."""
    variance, expected = F.col("revenue_variance_85em_dollar"), F.col("expected_85em")
    over, under = positive_part(variance), positive_part(-variance)
    return df.withColumns(
        {
            "overpayment_dollar": over,
            "overpayment_pct": div_or_zero(over, expected),
            "underpayment_dollar": under,
            "underpayment_pct": div_or_zero(under, expected),
        }
    )


def open_anomaly(df: DataFrame) -> DataFrame:
    """No open invoice, yet the zero-balance collection rate is below the collection rate."""
    closed = F.col("open_invoice_count") == 0
    low = F.col("zero_balance_collection_rate") < F.col("collection_rate")
    return df.withColumn("open_invoice_anomaly_flag", is_true(closed & low))


def positive_balances(df: DataFrame) -> DataFrame:
    """Self-pay and insurance balances with credits read as 0."""
    return df.withColumns(
        {
            "sp_positive_balance": positive_part(F.col("sp_balance")),
            "insurance_positive_balance": positive_part(F.col("insurance_balance")),
        }
    )


def nrv_passthrough(df: DataFrame) -> DataFrame:
    """Payment less the stored invoice benchmark, and the gap columns under their invoice-level names."""
    out = {}
    if "benchmark_payment_invoice_level" in df.columns:
        difference = F.col("payment_amount") - F.col("benchmark_payment_invoice_level")
        out["invoice_payment_diff_vs_benchmark_invoice_level"] = difference
    copies = {
        "nrv_gap_dollar": "nrv_gap_dollar_invoice_level",
        "nrv_gap_pct": "nrv_gap_percent_invoice_level",
        "nrv_gap_sum_dollar": "nrv_gap_sum_dollar_invoice_level",
    }
    out.update({new: F.col(old) for old, new in copies.items() if old in df.columns})
    return df.withColumns(out) if out else df


def drop_legacy(df: DataFrame) -> DataFrame:
    """Drop the variance columns of earlier report versions."""
    return df.drop("Revenue_Variance_$", "Revenue_Variance_%")


def enhance(lines: DataFrame) -> DataFrame:
    """All line-level columns. Lines that already carry ``benchmark_key`` keep it."""
    df = benchmark_variance(lines) if "benchmark_key" in lines.columns else benchmark_variance_of_lines(lines)
    return drop_legacy(nrv_passthrough(positive_balances(open_anomaly(over_under(variance_85em(df))))))
