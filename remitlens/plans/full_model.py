"""The full model, from a report or from invoice lines to every delivered table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from remitlens.contracts import DEFAULT_THRESHOLDS, TIME, Thresholds
from remitlens.operators import clean, diagnostics, drivers, enhance, ml, narratives, weekly
from remitlens.sources.columns import complete_lines
from remitlens.storage import stored


def full_model(
    lines: DataFrame,
    fit: Callable[[DataFrame], object] | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> dict[str, DataFrame]:
    """Every table of the full model from cleaned invoice lines.

    The lines are added up to key weeks once; the weekly tables are roll-ups of these. They are far smaller than the lines
    and feed all later steps, so they are stored; what remains is lazy. ``fit`` (for instance ``ml.fit_boosted``) adds
    model scores.
    """
    lines = complete_lines(clean.drop_total_rows(lines))
    weeks = stored(weekly.key_weeks(lines), "key_weeks")
    granular = stored(weekly.granular_of(weeks), "weekly_granular")
    groups = stored(weekly.aggregated_of(weeks), "weekly_aggregated")
    base = diagnostics.diagnostics_base(groups, thresholds, fallback=False)
    if fit is not None:
        base = ml.score(base, fit)
    base = stored(base, "diagnostics_base")
    underpaid = drivers.underpayment_summary(weekly.weekly_by_key_variance(granular))
    by_cpt = drivers.cpt_drivers(weekly.weekly_by_cpt(lines))
    return {
        "enhanced_lines": enhance.enhance(lines),
        "weekly_granular": granular,
        "weekly_aggregated": groups,
        "diagnostics_base": base,
        "weekly_granular_diag": weekly.granular_diag_of(weeks),
        "underpayment_summary": underpaid,
        "top5_underpaid": drivers.top_underpaid(underpaid, "85em"),
        "top5_underpaid_benchmark": drivers.top_underpaid(underpaid, "benchmark"),
        "drivers_payer": drivers.drivers_payer(groups),
        "drivers_key": drivers.drivers_key(granular),
        "drivers_time": drivers.by_time(drivers.drivers_time(groups), TIME),
        "cpt_rate_drivers": by_cpt,
        "top5_cpt": drivers.top_cpt(by_cpt),
        "narratives": narratives.narratives(base, thresholds),
    }


def from_report(report: DataFrame, **options) -> tuple[dict[str, DataFrame], DataFrame]:
    """The full model from an uncleaned report, and the rejected rows. Cleaned lines are stored once."""
    good, rejects = clean.clean_report(report)
    return full_model(stored(good, "lines"), **options), rejects
