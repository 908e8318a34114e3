"""Underpayment summaries and drivers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import DIMS, GROUP_KEYS, TIME
from remitlens.functions.numbers import div_or_null, is_true, negative_part, sum0

SHORTFALLS = ["shortfall_vs_expected", "shortfall_vs_benchmark", "incremental_shortfall_vs_benchmark"]
LENSES = ("85em", "benchmark")


def underpaid(df: DataFrame, variance: str) -> DataFrame:
    """Rows with a negative variance."""
    return df.filter(F.col(variance) < 0)


def shortfalls(df: DataFrame, vs_expected: str | None = None, vs_benchmark: str | None = None) -> DataFrame:
    """Negative parts of both variances, and what the second adds to the first.

    Without column names the variances are recomputed from the payments, as for rows per key.
    """
    if vs_expected:
        expected_gap, benchmark_gap = F.col(vs_expected), F.col(vs_benchmark)
    else:
        expected_gap = F.col("payment_amount") - F.col("expected_payment")
        if "benchmark_payment" in df.columns:
            benchmark_gap = F.col("expected_payment") - F.col("benchmark_payment")
        else:
            benchmark_gap = F.lit(None).cast("double")
    expected_part, benchmark_part = negative_part(expected_gap), negative_part(benchmark_gap)
    return df.withColumns(dict(zip(SHORTFALLS, [expected_part, benchmark_part, benchmark_part - expected_part])))


def group_shortfalls(weekly: DataFrame) -> DataFrame:
    """Shortfalls of the weekly group table, from its own variance columns."""
    return shortfalls(weekly, "revenue_variance", "expected_vs_benchmark_payment_variance")


def drivers(with_shortfalls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shortfall sums per key with their magnitudes, and visits."""
    sums = with_shortfalls.groupBy(*keys).agg(
        *[sum0(F.col(c)).alias(c) for c in SHORTFALLS], F.sum("visit_count").alias("total_visit_count")
    )
    return sums.withColumns({f"{c}_abs": F.abs(c) for c in SHORTFALLS})


def rank_drivers(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest incremental shortfall first."""
    return df.orderBy("incremental_shortfall_vs_benchmark", *keys)


def drivers_payer(weekly: DataFrame) -> DataFrame:
    return rank_drivers(drivers(group_shortfalls(weekly), ["payer"]), ["payer"])


def drivers_key(granular: DataFrame) -> DataFrame:
    keys = [*DIMS, "benchmark_key"]
    return rank_drivers(drivers(shortfalls(granular), keys), keys)


def drivers_time(weekly: DataFrame) -> DataFrame:
    return drivers(group_shortfalls(weekly), TIME).orderBy(*TIME)


def underpayment_summary(by_key: DataFrame) -> DataFrame:
    """Sum, mean percent and number of underpaid keys per week and group, in both lenses.

    Both lenses come from one aggregation. Rows underpaid in neither are dropped first, so a group without any stays
    out; a group underpaid in one lens only has 0 in the other.
    """
    negative = {lens: is_true(F.col(f"revenue_variance_{lens}") < 0) for lens in LENSES}
    aggregates = []
    for lens, is_negative in negative.items():
        amount = F.when(is_negative, F.col(f"revenue_variance_{lens}"))
        pct = F.when(is_negative, F.col(f"revenue_variance_pct_{lens}"))
        aggregates += [
            sum0(amount).alias(f"total_underpayment_{lens}"),
            F.coalesce(F.avg(pct), F.lit(0.0)).alias(f"avg_underpayment_pct_{lens}"),
            F.count(amount).alias(f"records_{lens}"),
        ]
    rows = by_key.filter(negative["85em"] | negative["benchmark"])
    return rows.groupBy(*GROUP_KEYS).agg(*aggregates)


def by_time(df: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Delivery order of time-keyed tables."""
    return df.orderBy(*keys)


def top_underpaid(summary: DataFrame, lens: str, n: int = 5) -> DataFrame:
    """The ``n`` groups with the largest underpayment in a lens."""
    total = f"total_underpayment_{lens}"
    return summary.select(*GROUP_KEYS, total).orderBy(total, *GROUP_KEYS).limit(n)


def cpt_rate(by_cpt: DataFrame) -> DataFrame:
    """Actual rate per visit of a code, its variance and dollar impact, and whether it is underpaid."""
    visits, expected = F.col("visit_count"), F.col("expected_amount_85_em")
    rate = div_or_null(F.col("payment_amount"), visits)
    return by_cpt.withColumns(
        {
            "actual_rate_per_visit": rate,
            "rate_variance_vs_85em": rate - expected,
            "dollar_impact_vs_85em": (rate - expected) * visits,
            "underpaid_vs_85em": is_true(rate - expected < 0),
        }
    )


def cpt_drivers(by_cpt: DataFrame) -> DataFrame:
    """Rate drivers per week, group and procedure code."""
    return (
        cpt_rate(by_cpt)
        .groupBy(*GROUP_KEYS, "cpt_code")
        .agg(
            F.sum("visit_count").alias("total_visits"),
            F.avg("actual_rate_per_visit").alias("avg_actual_rate"),
            F.avg("expected_amount_85_em").alias("avg_expected_rate_85em"),
            sum0(F.col("dollar_impact_vs_85em")).alias("total_dollar_impact_vs_85em"),
            is_true(F.bool_or("underpaid_vs_85em")).alias("underpaid_flag"),
        )
    )


def top_cpt(cpt_summary: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` codes with the largest negative dollar impact."""
    impact = "total_dollar_impact_vs_85em"
    return cpt_summary.filter(F.col(impact) < 0).orderBy(impact, *GROUP_KEYS, "cpt_code").limit(n)
