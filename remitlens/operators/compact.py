"""The compact model: 85% and historical benchmarks straight on the lines, and their rollups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import div_or_null, nan_to_null, round2_even, sum0
from remitlens.operators.medians import exact_medians


def benchmark_85pct(df: DataFrame) -> DataFrame:
    """85% of the charge, and the payment's gap to it in dollars and percent (missing without a charge)."""
    benchmark = F.col("charge_amount") * 0.85
    gap = F.col("payment_amount") - benchmark
    return df.withColumns(
        {
            "benchmark_85_percent": benchmark,
            "gap_vs_85_percent": gap,
            "gap_percent_vs_85": div_or_null(gap, benchmark) * 100,
        }
    )


def payment_rate_column() -> Column:
    return div_or_null(F.col("payment_amount"), F.col("charge_amount"))


def median_rate(df: DataFrame) -> DataFrame:
    """Exact median of payment over charge, one row. Lines without a charge have no rate."""
    return exact_medians(df.select(payment_rate_column().alias("median_rate")), ["median_rate"])


def historical_benchmark(df: DataFrame) -> DataFrame:
    """Charge times the median payment rate of all lines, and the gap to it."""
    benchmark = F.col("charge_amount") * median_rate(df).scalar()
    df = df.withColumn("historical_benchmark", benchmark)
    return df.withColumn("gap_vs_historical", F.col("payment_amount") - F.col("historical_benchmark"))


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def collection_perf(df: DataFrame) -> DataFrame:
    """Collection rate, and its distance from 85% in points."""
    rate = div_or_null(F.col("payment_amount"), F.col("charge_amount"))
    return df.withColumns({"collection_rate": rate, "performance_vs_85": (rate - 0.85) * 100})


def weekly_simple(df: DataFrame, keys: Sequence[str] = ("week",)) -> DataFrame:
    """Charges, payments and visits per key with performance. Rows without a key are left out.

    Visits are the sum of ``visit_count`` where the lines carry it, else the number of lines.
    """
    visits = F.sum("visit_count") if "visit_count" in df.columns else F.count(F.lit(1))
    sums = (
        _with_keys(df, keys)
        .groupBy(*keys)
        .agg(
            sum0(F.col("charge_amount")).alias("charge_amount"),
            sum0(F.col("payment_amount")).alias("payment_amount"),
            visits.alias("visit_count"),
        )
    )
    return collection_perf(sums)


def gap_drivers(df: DataFrame, key: str) -> DataFrame:
    """Gap to the 85% benchmark per payer, group or week, to two decimals. Needs ``benchmark_85pct``.

    The collection rate divides the rounded totals.
    """
    gap = F.col("gap_vs_85_percent")
    sums = (
        _with_keys(df, [key])
        .groupBy(key)
        .agg(
            round2_even(F.avg(gap)).alias("avg_gap"),
            round2_even(sum0(gap)).alias("total_gap"),
            F.count(gap).alias("transaction_count"),
            round2_even(sum0(F.col("charge_amount"))).alias("total_charges"),
            round2_even(sum0(F.col("payment_amount"))).alias("total_payments"),
        )
    )
    rate = div_or_null(F.col("total_payments"), F.col("total_charges")) * 100
    return sums.withColumn("collection_rate", round2_even(rate))


def worst_payer(gaps: DataFrame) -> DataFrame:
    """The payer with the lowest mean gap; ties by name."""
    return gaps.filter(F.col("avg_gap").isNotNull()).orderBy("avg_gap", "payer").limit(1)


def gap_totals(df: DataFrame) -> DataFrame:
    """Sum and mean of the gap over all lines."""
    gap = nan_to_null(F.col("gap_vs_85_percent"))
    return df.agg(sum0(gap).alias("total_gap"), F.avg(gap).alias("avg_gap"))


def run_summary(df: DataFrame) -> DataFrame:
    """Line count, charges, payments and overall collection rate in percent."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        sum0(F.col("charge_amount")).alias("total_charges"),
        sum0(F.col("payment_amount")).alias("total_payments"),
    )
    rate = div_or_null(F.col("total_payments"), F.col("total_charges")) * 100
    return totals.withColumn("overall_collection_rate", rate)
