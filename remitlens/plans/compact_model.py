"""The compact model: benchmarks on the lines, weekly rollups, gap drivers, linear model, overall narrative."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import DEFAULT_THRESHOLDS, Thresholds
from remitlens.operators import clean, compact, ml, narratives
from remitlens.storage import stored


def run_record(lines: DataFrame, metrics: DataFrame, narrative: DataFrame) -> DataFrame:
    """One row: totals, model metrics and number of narrative lines."""
    totals = compact.run_summary(lines)
    return totals.withColumns(
        {
            "ml_model_performance": metrics.select(F.struct(*metrics.columns)).scalar(),
            "narratives_generated": narrative.agg(F.count(F.lit(1))).scalar(),
        }
    )


def compact_model(
    lines: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS, legacy_text: bool = False
) -> dict[str, DataFrame]:
    """Every table of the compact model from invoice lines with a ``row_id``."""
    with_gaps = compact.historical_benchmark(compact.benchmark_85pct(lines))
    scored, metrics = ml.linear_diagnostics(with_gaps, thresholds=thresholds)
    gaps_by_payer = compact.gap_drivers(with_gaps, "payer")
    narrative = narratives.overall_narrative(with_gaps, gaps_by_payer, metrics, legacy_text)
    return {
        "lines": scored,
        "weekly_by_week": compact.weekly_simple(lines, ["week"]),
        "weekly_by_payer": compact.weekly_simple(lines, ["week", "payer", "group_em"]),
        "gap_by_payer": gaps_by_payer,
        "gap_by_em": compact.gap_drivers(with_gaps, "group_em"),
        "gap_by_week": compact.gap_drivers(with_gaps, "week"),
        "ml_metrics": metrics,
        "narratives": narrative,
        "run_summary": run_record(lines, metrics, narrative),
    }


def compact_from_report(report: DataFrame, **options) -> dict[str, DataFrame]:
    """The compact model from an uncleaned report with a ``row_id``. Cleaned lines are stored once."""
    return compact_model(stored(clean.clean_compact(report), "compact-lines"), **options)
