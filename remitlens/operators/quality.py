"""Data checks. Each gives rows (check, status, issue); status is ok, warn or fail.

A check states what it counts and how it judges the counts; ``run`` folds all checks on one table into one aggregation, that
for duplicate keys included, so a suite reads each table once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from remitlens.contracts import GROUP_KEYS
from remitlens.functions.numbers import to_number

_REPORT = "check string, status string, issue string"


def _static(df: DataFrame, rows: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Rows known from the schema alone."""
    return df.sparkSession.createDataFrame(list(rows), _REPORT)


def check_columns(df: DataFrame, required: Sequence[str], subset_ok: bool = False) -> tuple[str, str | None]:
    """Status and issue for required columns, from the schema. With ``subset_ok`` a partial set only warns."""
    missing = [c for c in required if c not in df.columns]
    if not missing:
        return "ok", None
    listed = ", ".join(missing)
    if subset_ok and len(missing) < len(required):
        return "warn", f"absent, but not required: {listed}"
    return "fail", f"columns that have to be there are absent: {listed}"


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` for a missing column, else return the frame."""
    status, issue = check_columns(df, required)
    if status == "fail":
        raise ValueError(issue)
    return df


def _entry(check: str, bad: Column, status: str, issue: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.when(bad, status).otherwise("ok").alias("status"),
        F.when(bad, issue).alias("issue"),
    )


def _known(check: str, status: str, issue: str | None) -> Column:
    """An entry known from the schema alone."""
    return F.struct(F.lit(check).alias("check"), F.lit(status).alias("status"), F.lit(issue).cast("string").alias("issue"))


@dataclass(frozen=True)
class Check:
    """``counts`` names conditions on rows; ``entries`` are judgements of the numbers of rows that meet them.

    The number of all rows is ``_rows``, and with ``keys`` that of rows which share their key is ``_repeated``. A check that
    is known from the schema alone does not read the table.
    """

    entries: tuple[Column, ...]
    counts: Mapping[str, Column] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    reads: bool = True


def run(df: DataFrame, *checks: Check) -> DataFrame:
    """All checks on ``df`` with one aggregation, or one for each set of keys where there are several.

    Keys are counted first, with the other counts added up beside them; missing keys equal each other.
    """
    if not any(c.reads for c in checks):
        return df.sparkSession.range(1).select(F.inline(F.array(*[e for c in checks for e in c.entries])))
    key_sets = list(dict.fromkeys(c.keys for c in checks if c.keys))
    parts = []
    for keys in key_sets or [()]:
        mine = [c for c in checks if c.keys == keys or (not c.keys and keys == (key_sets or [()])[0])]
        counts = {"_rows": F.lit(1), **{n: F.when(cond, 1) for c in mine for n, cond in c.counts.items()}}
        if keys:
            by_key = df.groupBy(*keys).agg(*[F.count(c).alias(n) for n, c in counts.items()])
            repeated = F.sum(F.when(F.col("_rows") > 1, F.col("_rows")))
            sums = by_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts], F.coalesce(repeated, F.lit(0)).alias("_repeated"))
        else:
            sums = df.agg(*[F.count(c).alias(n) for n, c in counts.items()])
        parts.append(sums.select(F.inline(F.array(*[e for c in mine for e in c.entries]))))
    return _union(parts)


def columns_check(df: DataFrame, required: Sequence[str], subset_ok: bool = False, label: str = "columns") -> Check:
    return Check((_known(label, *check_columns(df, required, subset_ok)),), reads=False)


def all_null(df: DataFrame, cols: Sequence[str] | None = None) -> Check:
    """Warn for each column without any value."""
    cols = [c for c in (cols or df.columns) if c in df.columns]
    entries = [_entry(f"all_null:{c}", F.col(f"_some_{c}") == 0, "warn", F.lit(f"no value in {c}")) for c in cols]
    return Check(tuple(entries), {f"_some_{c}": F.col(c).isNotNull() for c in cols})


def row_count(n: int = 1) -> Check:
    """Fail below ``n`` rows."""
    issue = F.concat(F.col("_rows").cast("string"), F.lit(f" rows where at least {n} are expected"))
    return Check((_entry("row_count", F.col("_rows") < n, "fail", issue),))


def unique(df: DataFrame, keys: Sequence[str]) -> Check:
    """Warn about rows that share their key with another row (missing equals missing)."""
    if check_columns(df, keys)[0] == "fail":
        issue = f"cannot compare keys, of which some are absent: {', '.join(keys)}"
        return Check((_known("unique_keys", "fail", issue),), reads=False)
    issue = F.concat(F.col("_repeated").cast("string"), F.lit(f" rows share their ({', '.join(keys)})"))
    return Check((_entry("unique_keys", F.col("_repeated") > 0, "warn", issue),), keys=tuple(keys))


def numeric(df: DataFrame, cols: Sequence[str], non_negative: bool = True, finite: bool = True) -> Check:
    """Warn about values that are missing, unreadable or infinite, about negative ones, and about absent columns."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    counts, entries = {}, []
    for c in [c for c in cols if c in df.columns]:
        v = F.col(c) if c in floats else to_number(F.col(c))
        good = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
        judged = []
        if finite:
            judged.append(("finite", f"_bad_{c}", ~F.coalesce(good, F.lit(False)), "without a finite number"))
        if non_negative:
            judged.append(("non_negative", f"_neg_{c}", v < 0, "below zero"))
        for check, name, condition, text in judged:
            counts[name] = condition
            issue = F.concat(F.lit(f"{c}: "), F.col(name).cast("string"), F.lit(f" {text}"))
            entries.append(_entry(f"{check}:{c}", F.col(name) > 0, "warn", issue))
    absent = [_known(f"numeric:{c}", "warn", f"no column {c} to check") for c in cols if c not in df.columns]
    return Check((*entries, *absent), counts, reads=bool(counts))


def check_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return run(df, all_null(df, cols))


def check_row_count(df: DataFrame, n: int = 1) -> DataFrame:
    return run(df, row_count(n))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return run(df, unique(df, keys))


def check_numeric(df: DataFrame, cols: Sequence[str], non_negative: bool = True, finite: bool = True) -> DataFrame:
    return run(df, numeric(df, cols, non_negative, finite))


# Columns and row minimums each stage must deliver.
_STAGE_COLUMNS = {
    "preprocess": ["invoice_number", "year", "week", "payer", "group_em", "group_em2", "cpt_code"],
    "enhance": ["invoice_number", "payer", "group_em", "group_em2", "benchmark_key", "payment_amount", "expected_85em"],
    "weekly": [*GROUP_KEYS, "visit_count", "payment_amount"],
    "diag_base": [
        *GROUP_KEYS,
        "payment_amount",
        "expected_payment",
        "revenue_variance_vs_85em_dollar",
        "revenue_variance_vs_85em_pct",
        "revenue_variance_vs_benchmark_dollar",
        "revenue_variance_vs_benchmark_pct",
    ],
    "ml_agg": GROUP_KEYS,
}
_MIN_ROWS = {"preprocess": 10, "weekly": 5}
_ML_FAMILIES = ("hgb", "ml")
_ML_COLUMNS = ("expected_rate_per_visit", "rate_gap", "dollar_gap")


def _tagged(stage: str, report: DataFrame) -> DataFrame:
    return report.select(F.lit(stage).alias("stage"), "check", "status", "issue")


def _union(reports: Sequence[DataFrame]) -> DataFrame:
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def suite_preprocess(tables: Mapping[str, DataFrame]) -> DataFrame:
    df, required = tables["lines"], _STAGE_COLUMNS["preprocess"]
    columns = columns_check(df, required)
    if check_columns(df, required)[0] == "fail":
        return run(df, columns)
    return run(df, columns, row_count(_MIN_ROWS["preprocess"]), unique(df, ["invoice_number", "cpt_code"]))


def suite_enhance(tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables["lines"]
    return run(df, columns_check(df, _STAGE_COLUMNS["enhance"]), numeric(df, ["payment_amount", "expected_85em"]))


def suite_weekly(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Problems with either weekly table are warnings."""
    reports = []
    for name in ("granular", "aggregated"):
        if name not in tables:
            raise ValueError(f"The weekly checks need the {name} table")
        df = tables[name]
        report = run(df, columns_check(df, _STAGE_COLUMNS["weekly"]), row_count(_MIN_ROWS["weekly"]))
        softened = F.when(F.col("status") == "fail", "warn").otherwise(F.col("status"))
        reports.append(report.select(F.concat(F.lit(f"{name}:"), "check").alias("check"), softened.alias("status"), "issue"))
    return _union(reports)


def suite_diag_base(tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables["diagnostics"]
    return run(df, columns_check(df, _STAGE_COLUMNS["diag_base"], subset_ok=True))


def suite_ml_agg(tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables["scored"]
    found = any(all(f"{p}_{c}" in df.columns for c in _ML_COLUMNS) for p in _ML_FAMILIES)
    families = _known("ml_columns", "ok" if found else "warn", None if found else "No model columns of either kind")
    return run(df, columns_check(df, _STAGE_COLUMNS["ml_agg"]), Check((families,), reads=False))


def suite_narratives(tables: Mapping[str, DataFrame]) -> DataFrame:
    return check_row_count(tables["narratives"], 0)


def suite_underpay(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All three underpayment tables must be given."""
    names = ["summary", "by_key", "by_payer"]
    some = next(iter(tables.values()))
    rows = [(n, "ok", None) if n in tables else (n, "fail", f"Missing table: {n}") for n in names]
    return _static(some, rows)


SUITES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "preprocess": suite_preprocess,
    "enhance": suite_enhance,
    "weekly": suite_weekly,
    "diag_base": suite_diag_base,
    "ml_agg": suite_ml_agg,
    "narratives": suite_narratives,
    "underpay": suite_underpay,
}


def run_checkpoint(stage: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (stage, check, status, issue) of a stage's checks; an unknown stage is itself a failure."""
    if stage not in SUITES:
        some = next(iter(tables.values()))
        return _tagged(stage, _static(some, [("stage", "fail", f"Unknown stage: {stage}")]))
    return _tagged(stage, SUITES[stage](tables))
