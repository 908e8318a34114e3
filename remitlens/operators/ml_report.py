"""Reports on scored weekly tables: gaps, hotspots, totals, top lists, metrics, residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import DEFAULT_THRESHOLDS, GROUP_KEYS
from remitlens.functions.numbers import div_or_null, is_true, sum0
from remitlens.operators.joins import null_safe_join

BOOSTED, LINEAR = "hgb", "ml"


def with_target(df: DataFrame, col: str) -> DataFrame:
    """Rows that have a target."""
    return df.dropna(subset=[col])


def finite_target(df: DataFrame, col: str) -> DataFrame:
    """Rows whose target is a number other than plus infinity."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~F.isnan(c) & (c != F.lit(float("inf"))))


def rate_gaps(df: DataFrame, predicted: str, prefix: str = LINEAR, per_visit: float = DEFAULT_THRESHOLDS.ml_gap_per_visit) -> DataFrame:
    """Actual less predicted rate, the same in dollars, and a 0/1 flag where the gap is material."""
    gap = F.col("actual_rate_per_visit") - F.col(predicted)
    return df.withColumns(
        {
            f"{prefix}_rate_gap": gap,
            f"{prefix}_dollar_gap": gap * F.col("visit_count"),
            f"{prefix}_material_gap_flag": F.when(gap.isNotNull(), (F.abs(gap) >= per_visit).cast("int")),
        }
    )


def linear_gap(df: DataFrame, predicted: str, threshold: float = DEFAULT_THRESHOLDS.linear_gap) -> DataFrame:
    """Gap of the payment rate to its prediction, and whether it exceeds the threshold."""
    gap = F.col("payment_rate") - F.col(predicted)
    return df.withColumns({"ml_rate_gap": gap, "ml_materiality_flag": is_true(F.abs(gap) > threshold)})


def attach_scores(df: DataFrame, scored: DataFrame, prefix: str = LINEAR) -> DataFrame:
    """Weekly table with score columns computed elsewhere; rows repeat if a group occurs twice in ``scored``."""
    scores = [c for c in scored.columns if c.startswith(f"{prefix}_")]
    return null_safe_join(df, scored.select(*GROUP_KEYS, *scores), GROUP_KEYS)


def ml_columns(df: DataFrame) -> dict[str, str] | None:
    """Score columns to report on: those of the boosted model when present, else the linear ones, else None."""
    for prefix in (BOOSTED, LINEAR):
        if f"{prefix}_dollar_gap" in df.columns:
            return {name: f"{prefix}_{name}" for name in ("rate_gap", "dollar_gap", "material_gap_flag")}
    return None


def _required_columns(df: DataFrame) -> dict[str, str]:
    cols = ml_columns(df)
    if cols is None:
        raise ValueError("No model gap columns. Score the table first.")
    return cols


def _flags(df: DataFrame, cols: dict[str, str]) -> Column:
    flag = cols["material_gap_flag"]
    return F.coalesce(F.sum(flag), F.lit(0)).cast("bigint") if flag in df.columns else F.count(cols["dollar_gap"])


def hotspots(df: DataFrame) -> DataFrame:
    """Dollar gap, material flags and mean rate gap per week and group."""
    cols = _required_columns(df)
    return df.groupBy(*GROUP_KEYS).agg(
        sum0(F.col(cols["dollar_gap"])).alias("ml_dollar_gap_sum"),
        _flags(df, cols).alias("ml_material_flag_sum"),
        F.avg(cols["rate_gap"]).alias("ml_rate_gap_mean"),
    )


def ml_totals(df: DataFrame) -> DataFrame:
    """Overall dollar gap and number of material flags, which is missing where no flags are recorded."""
    cols = _required_columns(df)
    flags = _flags(df, cols) if cols["material_gap_flag"] in df.columns else F.lit(None).cast("bigint")
    return df.agg(sum0(F.col(cols["dollar_gap"])).alias("dollar_gap_total"), flags.alias("material_flags_total"))


def _gap_sums(df: DataFrame) -> DataFrame:
    cols = _required_columns(df)
    return df.groupBy(*GROUP_KEYS).agg(
        sum0(F.col(cols["dollar_gap"])).alias("dollar_gap_sum"), _flags(df, cols).alias("material_flags")
    )


def ml_top(df: DataFrame, side: str, n: int = 10) -> DataFrame:
    """The ``n`` groups with the lowest ("under") or highest ("over") dollar gap."""
    gap = F.col("dollar_gap_sum")
    return _gap_sums(df).orderBy(gap.asc() if side == "under" else gap.desc(), *GROUP_KEYS).limit(n)


def ml_hotspots_topn(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` groups with the largest dollar gap in either direction."""
    if n < 1:
        raise ValueError("n must be at least 1")
    sums = _gap_sums(df).select(*GROUP_KEYS, "dollar_gap_sum")
    return sums.orderBy(F.abs("dollar_gap_sum").desc(), *GROUP_KEYS).limit(n)


def ml_record(df: DataFrame, year: int, week: int, payer: str, group_em: str, group_em2: str) -> DataFrame:
    """Score columns of one week and group."""
    wanted = (F.col("year") == year) & (F.col("week") == week)
    wanted &= (F.col("payer") == payer) & (F.col("group_em") == group_em) & (F.col("group_em2") == group_em2)
    names = ["visit_count", "payment_amount"]
    for prefix in (BOOSTED, LINEAR):
        names += [f"{prefix}_{c}" for c in ("expected_rate_per_visit", "rate_gap", "dollar_gap", "material_gap_flag")]
    return df.filter(wanted).select(*[c for c in names if c in df.columns], *GROUP_KEYS)


def residual_analysis(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Residual, residual standardised by mean and population deviation, and absolute error."""
    residual = F.col(actual) - F.col(predicted)
    moments = df.agg(F.struct(F.avg(residual).alias("mean"), F.stddev_pop(residual).alias("sd"))).scalar()
    return df.withColumns(
        {
            "residuals": residual,
            "std_residuals": div_or_null(residual - moments["mean"], moments["sd"]),
            "abs_error": F.abs(residual),
        }
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R² per group of ``by`` (or overall), over rows that have both values.

    R² of a constant target is 1 for a perfect fit, else 0; one row alone has none.
    """
    error = F.col(actual) - F.col(predicted)
    squares, spread = F.avg(error * error), F.var_pop(actual)
    r2 = (
        F.when(F.count(F.lit(1)) < 2, F.lit(None).cast("double"))
        .when(spread == 0, F.when(squares == 0, 1.0).otherwise(0.0))
        .otherwise(1 - div_or_null(squares, spread))
    )
    return (
        df.filter(error.isNotNull())
        .groupBy(*by)
        .agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(squares).alias("rmse"), r2.alias("r2"))
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean of each fold metric, and the sample deviation of MAE and R² (0 for a single fold)."""
    sd = {m: F.when(F.count(m) > 1, F.stddev_samp(m)).otherwise(0.0) for m in ("mae", "r2")}
    return folds.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in ("mae", "rmse", "r2")],
        *[c.alias(f"{m}_std") for m, c in sd.items()],
    )
