"""Cleaning of invoice lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from remitlens.contracts import HEADER_FIELDS, REQUIRED_FIELDS, TOTAL_ROW_FIELDS
from remitlens.functions.numbers import blank_as_null, div_or_zero, nan_to_null, parse_week, parse_year, strip, to_number
from remitlens.operators.ordering import forward_fill
from remitlens.sources.columns import billed_balance, drop_unnamed, ensure_columns, quoted, standardize_columns

# What makes a report column a currency, percent or count column.
CURRENCY_MARKS = ("$", "Amount", "Balance")
PERCENT_MARKS = ("%", "Rate")
COUNT_MARKS = ("Count", "Visit", "Procedure", "Radiology")
# The groups whose E/M weight is meaningful.
WEIGHTED_GROUPS = ("Existing E/M Code", "New E/M Code")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty or blank text becomes NULL, NaN too; other values keep their outer blanks."""
    out = []
    for field in df.schema:
        c = F.col(quoted(field.name))
        if isinstance(field.dataType, StringType):
            c = blank_as_null(c)
        elif field.dataType.typeName() in ("double", "float"):
            c = nan_to_null(c)
        out.append(c.alias(field.name))
    return df.select(out)


def measure_columns(df: DataFrame) -> list[str]:
    """Report columns whose name marks them as currency, percent or count.

    Report names carry the marks, so this runs before or after renaming: headers renamed to canonical dimension
    names hold none of them.
    """
    marks = CURRENCY_MARKS + PERCENT_MARKS + COUNT_MARKS
    skip = {"Year of Visit Service Date", "ISO Week of Visit Service Date"}
    return [c for c in df.columns if c not in skip and any(m in c for m in marks)]


def coerce_by_class(df: DataFrame) -> DataFrame:
    """Currency, percent and count columns to numbers; missing or unreadable values (``"5%"`` too) become 0."""
    measures = set(measure_columns(df))
    zero = F.lit(0.0)
    return df.select(
        [
            (F.coalesce(to_number(F.col(quoted(c))), zero) if c in measures else F.col(quoted(c))).alias(c)
            for c in df.columns
        ]
    )


def coerce(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns to numbers; unreadable values become NULL. Absent columns are skipped."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: to_number(F.col(c)) for c in present}) if present else df


def fill_numeric(df: DataFrame) -> DataFrame:
    """Missing values of numeric columns become 0."""
    return df.fillna(0)


def split_required(df: DataFrame, cols: Sequence[str] = REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rest."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])
    return df.filter(complete), df.filter(~complete)


def drop_total_rows(df: DataFrame, cols: Sequence[str] = TOTAL_ROW_FIELDS) -> DataFrame:
    """Drop report summary rows: a field that reads "total" or "grand total", or week 0 of a "grand total" year."""
    texts = {c: F.lower(strip(F.col(c).cast("string"))) for c in cols if c in df.columns}
    if not texts:
        return df
    total = reduce(Column.__or__, [F.coalesce(t.rlike(r"^(grand\s+total|total)$"), F.lit(False)) for t in texts.values()])
    if "year" in texts and "week" in texts:
        total |= F.coalesce((texts["week"] == "0") & texts["year"].rlike(r"\bgrand\s*total\b"), F.lit(False))
    return df.filter(~total)


def zero_payment_rules(df: DataFrame) -> DataFrame:
    """A line without payment has no rates, and its whole billed balance is uncollected."""
    unpaid = F.col("payment_amount") == 0
    zeroed = ["payment_per_visit", "nrv_zero_balance", "zero_balance_collection_rate", "collection_rate"]
    rules = {c: F.when(unpaid, 0.0).otherwise(F.col(c)) for c in zeroed}
    star = "zero_balance_collection_star_charges"
    rules[star] = F.when(unpaid, F.col("charge_billed_balance")).otherwise(F.col(star))
    return df.withColumns(rules)


def remaining_charges(df: DataFrame) -> DataFrame:
    """Billed balance as a share of the charge; 0 without a charge."""
    return df.withColumn(
        "remaining_charges_pct", div_or_zero(F.col("charge_billed_balance"), F.col("charge_amount"))
    )


def em_weight_rule(df: DataFrame) -> DataFrame:
    """The E/M weight counts only for existing and new E/M codes; elsewhere it is 0."""
    if "avg_charge_em_weight" not in df.columns:
        return df
    weighted = F.coalesce(F.col("group_em").isin(*WEIGHTED_GROUPS), F.lit(False))
    return df.withColumn("avg_charge_em_weight", F.when(weighted, F.col("avg_charge_em_weight")).otherwise(0.0))


def clean_report(report: DataFrame, order: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """From an uncleaned report to invoice lines, and the rows rejected for want of a required field.

    Required fields are checked while a missing one is still NULL, and after block headers have been filled down.
    """
    df = coerce_by_class(blank_to_null(drop_unnamed(report)))
    df = ensure_columns(standardize_columns(df), {c: None for c in HEADER_FIELDS}, "string")
    df = forward_fill(df, HEADER_FIELDS, order)
    df = df.withColumns({"cpt_code": strip(F.col("cpt_code")), "year": parse_year(F.col("year")), "week": parse_week(F.col("week"))})
    good, rejects = split_required(df)
    good = billed_balance(good)
    wanted = [
        "payment_per_visit",
        "nrv_zero_balance",
        "zero_balance_collection_rate",
        "collection_rate",
        "zero_balance_collection_star_charges",
        "charge_billed_balance",
    ]
    good = ensure_columns(good, {c: 0.0 for c in wanted})
    return em_weight_rule(remaining_charges(zero_payment_rules(good))), rejects


def clean_compact(report: DataFrame, order: str = "row_id") -> DataFrame:
    """From an uncleaned report to the compact model's lines: all rows stay, and missing amounts are 0.

    Block headers are filled down for time, payer and groups, not for the invoice number.
    """
    df = coerce_by_class(blank_to_null(drop_unnamed(report)))
    headers = [c for c in HEADER_FIELDS if c != "invoice_number"]
    df = ensure_columns(standardize_columns(df), {c: None for c in HEADER_FIELDS}, "string")
    df = forward_fill(df, headers, order)
    return fill_numeric(df.withColumns({"cpt_code": strip(F.col("cpt_code")), "year": parse_year(F.col("year")), "week": parse_week(F.col("week"))}))
