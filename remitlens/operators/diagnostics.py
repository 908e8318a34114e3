"""Diagnostics base: two-lens variance, labels, baselines, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.contracts import BASELINE_METRICS, DEFAULT_THRESHOLDS, DIMS, Thresholds
from remitlens.functions.numbers import div_or_null, is_true, performance_label
from remitlens.operators.joins import null_safe_join


def expected_fallback(df: DataFrame) -> DataFrame:
    """Expected payment from rate and visits, when the column is absent or holds no value at all."""
    derivable = {"expected_amount_85_em_invoice_level", "visit_count"} <= set(df.columns)
    if "expected_payment" not in df.columns:
        if not derivable:
            raise ValueError("expected_payment is absent and cannot be derived")
        return df.withColumn("expected_payment", F.col("expected_amount_85_em_invoice_level") * F.col("visit_count"))
    if not derivable:
        return df
    derived = F.col("expected_amount_85_em_invoice_level") * F.col("visit_count")
    # One uncorrelated subquery answers "does any row hold a value".
    held = df.agg(F.count("expected_payment")).scalar()
    return df.withColumn("expected_payment", F.when(held == 0, derived).otherwise(F.col("expected_payment")))


def two_lens_variance(df: DataFrame) -> DataFrame:
    """Payment against expected and against benchmark payment. Without a benchmark that lens is missing."""
    paid, expected = F.col("payment_amount"), F.col("expected_payment")
    benchmark = F.col("benchmark_payment") if "benchmark_payment" in df.columns else F.lit(None).cast("double")
    return df.withColumns(
        {
            "revenue_variance_vs_85em_dollar": paid - expected,
            "revenue_variance_vs_85em_pct": div_or_null(paid - expected, expected),
            "revenue_variance_vs_benchmark_dollar": paid - benchmark,
            "revenue_variance_vs_benchmark_pct": div_or_null(paid - benchmark, benchmark),
        }
    )


def label_lenses(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Performance label in both lenses; a label column that is already there stays."""
    lenses = {"performance_label_vs_85em": "expected_payment", "performance_label_vs_benchmark": "benchmark_payment"}
    out = {}
    for name, reference in lenses.items():
        if name in df.columns:
            continue
        if reference in df.columns:
            label = performance_label(
                F.col("payment_amount"), F.col(reference), thresholds.over_pct, thresholds.under_pct
            )
        else:
            label = F.lit("No Data")
        out[name] = label
    return df.withColumns(out) if out else df


def attach_baselines(df: DataFrame, base: DataFrame) -> DataFrame:
    """Weekly rows with the baseline averages of their payer and groups."""
    return null_safe_join(df, base, DIMS)


def diagnostics_base(
    weekly: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS, fallback: bool = True
) -> DataFrame:
    """Variances, labels and baseline averages on the weekly group table.

    The baselines are averages over the weeks of a payer and its groups, so a window bounded by the calendar adds them
    and the table is computed once; ``attach_baselines`` is for baselines that were stored apart.

    ``fallback=False`` skips ``expected_fallback``, which reads the table once more; tables made by
    ``weekly_aggregated`` do not need it.
    """
    metrics = [m for m in BASELINE_METRICS if m in weekly.columns]
    df = label_lenses(two_lens_variance(expected_fallback(weekly) if fallback else weekly), thresholds)
    same_dims = Window.partitionBy(*DIMS)
    return df.withColumns({f"{m}_avg": F.avg(m).over(same_dims) for m in metrics})


def label_flags(df: DataFrame) -> DataFrame:
    """Both labels as 0/1 columns."""
    out = {}
    for lens in ("85em", "benchmark"):
        label = F.col(f"performance_label_vs_{lens}")
        for prefix, text in (
            ("over_performed", "Over Performing"),
            ("under_performed", "Under Performing"),
            ("average_performance", "Average Performance"),
        ):
            out[f"{prefix}_{lens}"] = is_true(label == text).cast("int")
    return df.withColumns(out)


def volume_no_lift(df: DataFrame) -> DataFrame:
    """1 where visits exceed the overall mean without over-performance. Needs ``label_flags``."""
    mean_visits = df.agg(F.avg("visit_count")).scalar()
    flag = is_true(F.col("visit_count") > mean_visits) & (F.col("over_performed_85em") == 0)
    return df.withColumn("volume_without_revenue_lift", flag.cast("int"))
