"""Registered queries: each operator on the supplied tables, and the SQL for the same result.

Doubles are rounded on both sides, since the engines add in different orders; both sides scale and round to even, so
that equal inputs give equal results at ties too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from remitlens.contracts import BASELINE_METRICS, DIMS, DISPLAY_NAMES, GROUP_KEYS, HEADER_FIELDS, KEY_KEYS, MEAN_MEASURES, ML_NUMERIC, PERCENT_COLUMNS, SUM_MEASURES, TIME
from remitlens.functions import numbers, text
from remitlens.operators import (
    clean,
    compact,
    diagnostics,
    drivers,
    enhance,
    keys,
    ml,
    ml_report,
    narratives,
    ordering,
    quality,
    validation,
    weekly,
)
from remitlens.operators.joins import null_safe_join
from remitlens.sources import columns, readers
from remitlens.sources.claims_adapter import invoice_lines, raw_report
from remitlens.sources.sinks import publish, write_csv_in_order, write_parquet
from remitlens.storage import shared_folder, stored
from remitlens.verification import sql as q

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)}
    scale = float(10**digits)
    return df.select([(F.rint(F.col(c) * scale) / scale + 0.0).alias(c) if c in doubles else F.col(c) for c in df.columns])


def query(name: str, select: str | None = None, needs: str = "", doubles: str = "", digits: int = 6):
    """Register a query; ``select`` over the CTEs in ``needs`` gives the same table, ``doubles`` rounded."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: rounded(build(spark, folder), digits)
        if select is not None:
            body = q.rounded(select, doubles, digits) if doubles else select
            ORACLE[name] = q.compose(body, *needs.split())
        return build

    return register


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    return keys.keyed_lines(invoice_lines(spark, folder))


def _standard_report(spark: SparkSession, folder: str) -> DataFrame:
    return columns.standardize_columns(columns.drop_unnamed(raw_report(spark, folder)))


def _weekly(spark: SparkSession, folder: str) -> DataFrame:
    return weekly.weekly_aggregated(invoice_lines(spark, folder))


def _granular(spark: SparkSession, folder: str) -> DataFrame:
    return weekly.weekly_granular(invoice_lines(spark, folder))


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    return compact.benchmark_85pct(invoice_lines(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly rows scored with the benchmark rate, in whole dollars, in a model's place."""
    rate = F.floor(numbers.div_or_null(F.col("benchmark_payment"), F.col("visit_count")) + 0.3).cast("double")
    table = _weekly(spark, folder).withColumn("ml_expected_rate_per_visit", rate)
    return ml_report.rate_gaps(table, "ml_expected_rate_per_visit")


# --- Sources and cleaning -------------------------------------------------------------------------------------------
@query("scan_lines", "SELECT * EXCLUDE (row_id) FROM lines", "lines", q.LINE_DOUBLES)
def scan_lines(spark, folder):
    return invoice_lines(spark, folder)


@query("file_order", "SELECT row_id, invoice_number, cpt_code FROM lines", "lines")
def file_order(spark, folder):
    return invoice_lines(spark, folder, row_id=True).select("row_id", "invoice_number", "cpt_code")


@query(
    "latest_snapshot",
    "SELECT l_returnflag, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1",
    doubles="quantity",
)
def latest_snapshot(spark, folder):
    lines = readers.load(spark, f"{folder}/lineitem.parquet")
    at = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    write_parquet(lines.where("l_returnflag = 'R'"), f"{at}/lines_1.parquet")
    write_parquet(lines, f"{at}/lines_2.parquet", partition_by=("l_linestatus",))
    newest = readers.latest_snapshot(spark, [f"{at}/lines_*.parquet", f"{at}/lines_*.csv"])
    return newest.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))


@query("standardize_columns", "SELECT * FROM std_report", "std_report")
def standardize_columns(spark, folder):
    return _standard_report(spark, folder)


@query("blank_to_null", "SELECT row_id, " + ", ".join(f"{q.blank(c)} AS {c}" for c in q.STD_TEXT.split()) + " FROM std_report", "std_report")
def blank_to_null(spark, folder):
    return clean.blank_to_null(_standard_report(spark, folder))


@query(
    "numeric_coerce_zero",
    "SELECT row_id, "
    + ", ".join(
        f"coalesce({q.number(c)}, 0) AS {c}" for c in ("charge_amount", "payment_amount", "denial_pct", "labs_per_visit")
    )
    + " FROM std_report",
    "std_report",
    "charge_amount payment_amount denial_pct labs_per_visit",
)
def numeric_coerce_zero(spark, folder):
    table = columns.standardize_columns(clean.coerce_by_class(raw_report(spark, folder)))
    return table.select("row_id", "charge_amount", "payment_amount", "denial_pct", "labs_per_visit")


@query(
    "numeric_coerce_null",
    "SELECT row_id, " + ", ".join(f"{q.number(c)} AS {c}" for c in ("charge_amount", "payment_amount", "denial_pct")) + " FROM std_report",
    "std_report",
    "charge_amount payment_amount denial_pct",
)
def numeric_coerce_null(spark, folder):
    table = clean.coerce(_standard_report(spark, folder), ["charge_amount", "payment_amount", "denial_pct"])
    return table.select("row_id", "charge_amount", "payment_amount", "denial_pct")


@query(
    "fill_numeric",
    "SELECT invoice_number, coalesce(labs_per_visit, 0) AS labs_per_visit, coalesce(expected_85em, 0) AS expected_85em FROM lines",
    "lines",
    "labs_per_visit expected_85em",
)
def fill_numeric(spark, folder):
    return clean.fill_numeric(invoice_lines(spark, folder).select("invoice_number", "labs_per_visit", "expected_85em"))


@query(
    "ensure_columns",
    "SELECT invoice_number, charge_amount, CAST(0 AS DOUBLE) AS late_fee, CAST(NULL AS DOUBLE) AS write_off FROM lines",
    "lines",
    "charge_amount late_fee",
)
def ensure_columns(spark, folder):
    table = invoice_lines(spark, folder).select("invoice_number", "charge_amount")
    return columns.ensure_columns(table, {"late_fee": 0.0, "write_off": None, "charge_amount": 0.0})


@query("parse_number", f"SELECT row_id, {q.loose_number('charge_amount')} AS charge, {q.loose_number('denial_pct')} AS denial FROM std_report", "std_report", "charge denial")
def parse_number(spark, folder):
    c = [numbers.parse_number(F.col(x)).alias(y) for x, y in (("charge_amount", "charge"), ("denial_pct", "denial"))]
    return _standard_report(spark, folder).select("row_id", *c)


@query("normalize_columns", f"SELECT row_id, {q.loose_number('charge_amount')} AS charge_amount, {q.loose_number('denial_pct')} AS denial_pct FROM std_report", "std_report", "charge_amount denial_pct")
def normalize_columns(spark, folder):
    table = _standard_report(spark, folder).select("row_id", "charge_amount", "denial_pct")
    return columns.normalize_columns(table, percent=["denial_pct"], numeric=["charge_amount", "absent"])


@query("parse_year", "SELECT row_id, CAST(CAST(nullif(trim(year), '') AS DOUBLE) AS INTEGER) AS year FROM std_report", "std_report")
def parse_year(spark, folder):
    return _standard_report(spark, folder).select("row_id", numbers.parse_year(F.col("year")).alias("year"))


@query("parse_week", "SELECT row_id, coalesce(TRY_CAST(nullif(regexp_extract(week, '[0-9]+'), '') AS INTEGER), 0) AS week FROM std_report", "std_report")
def parse_week(spark, folder):
    return _standard_report(spark, folder).select("row_id", numbers.parse_week(F.col("week")).alias("week"))


@query("trim_ids", "SELECT row_id, trim(cpt_code) AS cpt_code, trim(payer) AS payer FROM std_report", "std_report")
def trim_ids(spark, folder):
    return columns.trim_ids(_standard_report(spark, folder).select("row_id", "cpt_code", "payer"), ["cpt_code", "payer"])


@query("forward_fill", f"SELECT row_id, {', '.join(f'{q.filled(c)} AS {c}' for c in HEADER_FIELDS)} FROM std_report", "std_report")
def forward_fill(spark, folder):
    table = clean.blank_to_null(_standard_report(spark, folder).select("row_id", *HEADER_FIELDS))
    return ordering.forward_fill(table, HEADER_FIELDS)


@query("required_fields", f"SELECT row_id, invoice_number, payer, group_em, group_em2, cpt_code FROM filled_report WHERE {q.COMPLETE}", "filled_report")
def required_fields(spark, folder):
    table = ordering.forward_fill(clean.blank_to_null(_standard_report(spark, folder)), HEADER_FIELDS)
    return clean.split_required(table)[0].select("row_id", "invoice_number", "payer", "group_em", "group_em2", "cpt_code")


@query("rejected_rows", f"SELECT row_id, invoice_number, payer, charge_amount, denial_pct FROM filled_report WHERE NOT ({q.COMPLETE})", "filled_report", "charge_amount denial_pct")
def rejected_rows(spark, folder):
    _, rejects = clean.clean_report(raw_report(spark, folder))
    return rejects.select("row_id", "invoice_number", "payer", "charge_amount", "denial_pct")


_CLEAN_REPORT = f"""SELECT row_id, CAST(CAST(year AS DOUBLE) AS INTEGER) AS year, CAST(regexp_extract(week, '[0-9]+') AS INTEGER) AS week,
  payer, group_em, group_em2, invoice_number, trim(cpt_code) AS cpt_code, charge_amount, payment_amount, denial_pct,
  CAST(0 AS DOUBLE) AS remaining_charges_pct FROM filled_report WHERE {q.COMPLETE}"""
_CLEAN_DOUBLES = "charge_amount payment_amount denial_pct remaining_charges_pct"
_CLEAN_COLUMNS = ["row_id", *TIME, *DIMS, "invoice_number", "cpt_code", *_CLEAN_DOUBLES.split()]


@query("clean_report", _CLEAN_REPORT, "filled_report", _CLEAN_DOUBLES)
def clean_report(spark, folder):
    good, _ = clean.clean_report(raw_report(spark, folder))
    return good.select(_CLEAN_COLUMNS)


def _report_as_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The report as it is delivered: text files with headers, blanks kept, in the order of its rows; read back with positions."""
    at = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    rows = readers.load(spark, f"{folder}/lineitem.parquet").count()
    write_csv_in_order(raw_report(spark, folder), at, "row_id", rows, least=6)
    return readers.read_csv_in_order(spark, at)


@query(
    "csv_row_order",
    'SELECT * REPLACE (nullif("Primary Financial Class", \'\') AS "Primary Financial Class") FROM report',  # CSV has no empty texts
    "report",
)
def csv_row_order(spark, folder):
    return columns.drop_unnamed(_report_as_csv(spark, folder))


@query("clean_report_csv", _CLEAN_REPORT, "filled_report", _CLEAN_DOUBLES)
def clean_report_csv(spark, folder):
    good, _ = clean.clean_report(_report_as_csv(spark, folder))
    return good.select(_CLEAN_COLUMNS)


_COMPACT_HEADERS = ", ".join(f"{q.filled(c)} AS {c}" for c in ("year", "week", *DIMS))


@query(
    "compact_from_report",
    f"""WITH filled AS (SELECT {_COMPACT_HEADERS}, coalesce({q.number("charge_amount")}, 0) AS charge_amount,
  coalesce({q.number("payment_amount")}, 0) AS payment_amount FROM std_report),
gaps AS (SELECT *, payment_amount - 0.85 * charge_amount AS gap FROM filled WHERE payer IS NOT NULL)
SELECT payer, count(*) AS transaction_count, sum(charge_amount) AS charges, sum(payment_amount) AS payments, sum(gap) AS gap
FROM gaps GROUP BY payer""",
    "std_report",
    "charges payments gap",
    digits=3,
)
def compact_from_report(spark, folder):
    lines = compact.benchmark_85pct(clean.clean_compact(raw_report(spark, folder))).where("payer IS NOT NULL")
    amounts = {"charges": "charge_amount", "payments": "payment_amount", "gap": "gap_vs_85_percent"}
    return lines.groupBy("payer").agg(F.count("gap_vs_85_percent").alias("transaction_count"), *[F.sum(c).alias(n) for n, c in amounts.items()])


_TOTAL = " OR ".join(
    f"coalesce(regexp_full_match(lower(trim({c})), 'grand\\s+total|total'), false)"
    for c in [*HEADER_FIELDS, "cpt_code"]
)


@query("drop_total_rows", f"SELECT row_id, payer, cpt_code FROM std_report WHERE NOT ({_TOTAL})", "std_report")
def drop_total_rows(spark, folder):
    return clean.drop_total_rows(_standard_report(spark, folder)).select("row_id", "payer", "cpt_code")


_PAID_COLUMNS = "payment_per_visit nrv_zero_balance zero_balance_collection_rate collection_rate".split()


@query(
    "zero_payment_rules",
    "SELECT invoice_number, payment_amount, "
    + ", ".join(f"CASE WHEN payment_amount = 0 THEN 0.0 ELSE {c} END AS {c}" for c in _PAID_COLUMNS)
    + ", CASE WHEN payment_amount = 0 THEN charge_billed_balance ELSE zero_balance_collection_star_charges END "
    "AS zero_balance_collection_star_charges FROM lines",
    "lines",
    " ".join(_PAID_COLUMNS) + " payment_amount zero_balance_collection_star_charges",
)
def zero_payment_rules(spark, folder):
    table = clean.zero_payment_rules(invoice_lines(spark, folder))
    return table.select("invoice_number", "payment_amount", *_PAID_COLUMNS, "zero_balance_collection_star_charges")


@query(
    "remaining_charges_pct",
    f"SELECT invoice_number, charge_amount, {q.div0('charge_billed_balance', 'charge_amount')} AS remaining_charges_pct FROM lines",
    "lines",
    "charge_amount remaining_charges_pct",
)
def remaining_charges_pct(spark, folder):
    table = clean.remaining_charges(invoice_lines(spark, folder))
    return table.select("invoice_number", "charge_amount", "remaining_charges_pct")


@query(
    "em_weight_rule",
    """SELECT invoice_number, group_em, CASE WHEN group_em IN ('Existing E/M Code', 'New E/M Code')
  THEN avg_charge_em_weight ELSE 0.0 END AS avg_charge_em_weight FROM lines""",
    "lines",
    "avg_charge_em_weight",
)
def em_weight_rule(spark, folder):
    return clean.em_weight_rule(invoice_lines(spark, folder)).select("invoice_number", "group_em", "avg_charge_em_weight")


# --- Keys and benchmarks ----------------------------------------------------------------------------------------------
@query("cpt_sets", "SELECT invoice_number, cpt_list, '[''' || array_to_string(cpt_list, ''', ''') || ''']' AS cpt_list_str FROM sets", "sets")
def cpt_sets(spark, folder):
    sets = keys.cpt_sets(invoice_lines(spark, folder))
    return sets.withColumn("cpt_list_str", text.list_repr(F.col("cpt_list")))


@query("benchmark_keys", "SELECT invoice_number, cpt_code, benchmark_key, abbreviated_benchmark_key FROM keyed", "keyed")
def benchmark_keys(spark, folder):
    return _keyed(spark, folder).select("invoice_number", "cpt_code", "benchmark_key", "abbreviated_benchmark_key")


@query("cpt_count", "SELECT DISTINCT benchmark_key, CAST(len(cpt_list) AS INTEGER) AS cpt_count FROM keyed", "keyed")
def cpt_count(spark, folder):
    distinct = _keyed(spark, folder).select("benchmark_key").distinct()
    return distinct.withColumn("cpt_count", text.cpt_count(F.col("benchmark_key")))


@query("invoice_totals", "SELECT * FROM totals", "totals", "invoice_total_payment")
def invoice_totals(spark, folder):
    return keys.invoice_totals(_keyed(spark, folder))


@query("benchmark_avg_invoice", "SELECT * FROM averages", "averages", "benchmark_avg_payment")
def benchmark_avg_invoice(spark, folder):
    return keys.benchmark_avg(keys.invoice_totals(_keyed(spark, folder)))


@query("expected_rate_by_key", "SELECT benchmark_key, expected_amount_85_em_invoice_level FROM key_rates", "key_rates", "expected_amount_85_em_invoice_level")
def expected_rate_by_key(spark, folder):
    return keys.expected_rate(_keyed(spark, folder))


@query("mean_payment_by_key", "SELECT benchmark_key, benchmark_payment_amount FROM key_rates", "key_rates", "benchmark_payment_amount")
def mean_payment_by_key(spark, folder):
    return keys.mean_payment(_keyed(spark, folder))


@query("mean_weekly_visits", "SELECT benchmark_key, benchmark_invoice_count FROM key_rates", "key_rates", "benchmark_invoice_count")
def mean_weekly_visits(spark, folder):
    return keys.mean_weekly_visits(_keyed(spark, folder))


@query("payment_rate_by_key", "SELECT benchmark_key, benchmark_payment_rate_per_visit FROM key_rates", "key_rates", "benchmark_payment_rate_per_visit")
def payment_rate_by_key(spark, folder):
    return keys.payment_rate(_keyed(spark, folder))


# --- Line-level variances ---------------------------------------------------------------------------------------------
_AGAINST = "invoice_total_payment benchmark_avg_payment revenue_variance_benchmark_dollar revenue_variance_benchmark_pct"
_AGAINST_SQL = f"""SELECT invoice_number, cpt_code, payment_amount, benchmark_key, invoice_total_payment,
  benchmark_avg_payment, invoice_total_payment - benchmark_avg_payment AS revenue_variance_benchmark_dollar,
  {q.div0("invoice_total_payment - benchmark_avg_payment", "benchmark_avg_payment")} AS revenue_variance_benchmark_pct
FROM keyed JOIN totals USING (benchmark_key, invoice_number) JOIN averages USING (benchmark_key)"""
_AGAINST_COLUMNS = ["invoice_number", "cpt_code", "payment_amount", "benchmark_key", *_AGAINST.split()]


@query("benchmark_variance", _AGAINST_SQL, "keyed totals averages", "payment_amount " + _AGAINST)
def benchmark_variance(spark, folder):
    return enhance.benchmark_variance_of_lines(invoice_lines(spark, folder)).select(_AGAINST_COLUMNS)


@query("benchmark_variance_keyed", _AGAINST_SQL, "keyed totals averages", "payment_amount " + _AGAINST)
def benchmark_variance_keyed(spark, folder):
    return enhance.benchmark_variance(_keyed(spark, folder)).select(_AGAINST_COLUMNS)


_VAR85 = f"payment_amount - expected_85em AS revenue_variance_85em_dollar, {q.div0('payment_amount - expected_85em', 'expected_85em')} AS revenue_variance_85em_pct"


@query("variance_85em", f"SELECT invoice_number, {_VAR85} FROM lines", "lines", "revenue_variance_85em_dollar revenue_variance_85em_pct")
def variance_85em(spark, folder):
    table = enhance.variance_85em(invoice_lines(spark, folder))
    return table.select("invoice_number", "revenue_variance_85em_dollar", "revenue_variance_85em_pct")


@query(
    "over_under_payment",
    f"""SELECT invoice_number, o AS overpayment_dollar, {q.div0("o", "expected_85em")} AS overpayment_pct,
  u AS underpayment_dollar, {q.div0("u", "expected_85em")} AS underpayment_pct
FROM (SELECT *, CASE WHEN payment_amount > expected_85em THEN payment_amount - expected_85em ELSE 0.0 END AS o,
  CASE WHEN payment_amount < expected_85em THEN expected_85em - payment_amount ELSE 0.0 END AS u FROM lines)""",
    "lines",
    "overpayment_dollar overpayment_pct underpayment_dollar underpayment_pct",
)
def over_under_payment(spark, folder):
    table = enhance.over_under(enhance.variance_85em(invoice_lines(spark, folder)))
    return table.select("invoice_number", "overpayment_dollar", "overpayment_pct", "underpayment_dollar", "underpayment_pct")


@query(
    "open_invoice_anomaly",
    """SELECT invoice_number, cpt_code,
  coalesce(open_invoice_count = 0 AND zero_balance_collection_rate < collection_rate, false) AS open_invoice_anomaly_flag FROM lines""",
    "lines",
)
def open_invoice_anomaly(spark, folder):
    table = enhance.open_anomaly(invoice_lines(spark, folder))
    return table.select("invoice_number", "cpt_code", "open_invoice_anomaly_flag")


@query(
    "positive_balances",
    """SELECT invoice_number, greatest(coalesce(sp_balance, 0), 0) AS sp_positive_balance,
  greatest(coalesce(insurance_balance, 0), 0) AS insurance_positive_balance FROM lines""",
    "lines",
    "sp_positive_balance insurance_positive_balance",
)
def positive_balances(spark, folder):
    table = enhance.positive_balances(invoice_lines(spark, folder))
    return table.select("invoice_number", "sp_positive_balance", "insurance_positive_balance")


_NRV = "nrv_gap_dollar_invoice_level nrv_gap_percent_invoice_level nrv_gap_sum_dollar_invoice_level"


@query(
    "nrv_passthrough",
    """SELECT invoice_number, payment_amount - benchmark_payment_invoice_level AS invoice_payment_diff_vs_benchmark_invoice_level,
  nrv_gap_dollar AS nrv_gap_dollar_invoice_level, nrv_gap_pct AS nrv_gap_percent_invoice_level,
  nrv_gap_sum_dollar AS nrv_gap_sum_dollar_invoice_level FROM lines""",
    "lines",
    "invoice_payment_diff_vs_benchmark_invoice_level " + _NRV,
)
def nrv_passthrough(spark, folder):
    table = enhance.nrv_passthrough(invoice_lines(spark, folder))
    return table.select("invoice_number", "invoice_payment_diff_vs_benchmark_invoice_level", *_NRV.split())


_POSITIVE = "sp_positive_balance insurance_positive_balance"
_ENHANCED = f"payment_amount {_AGAINST} revenue_variance_85em_dollar revenue_variance_85em_pct overpayment_dollar underpayment_pct {_POSITIVE} invoice_payment_diff_vs_benchmark_invoice_level"


@query(
    "enhanced_lines",
    f"""SELECT invoice_number, cpt_code, benchmark_key, {", ".join(_AGAINST.split())}, {_VAR85}, payment_amount,
  CASE WHEN payment_amount > expected_85em THEN payment_amount - expected_85em ELSE 0.0 END AS overpayment_dollar,
  {q.div0("CASE WHEN payment_amount < expected_85em THEN expected_85em - payment_amount ELSE 0.0 END", "expected_85em")} AS underpayment_pct,
  coalesce(open_invoice_count = 0 AND zero_balance_collection_rate < collection_rate, false) AS open_invoice_anomaly_flag,
  greatest(coalesce(sp_balance, 0), 0) AS sp_positive_balance, greatest(coalesce(insurance_balance, 0), 0) AS insurance_positive_balance,
  payment_amount - benchmark_payment_invoice_level AS invoice_payment_diff_vs_benchmark_invoice_level
FROM keyed JOIN (SELECT benchmark_key, invoice_number, invoice_total_payment, benchmark_avg_payment,
    invoice_total_payment - benchmark_avg_payment AS revenue_variance_benchmark_dollar,
    {q.div0("invoice_total_payment - benchmark_avg_payment", "benchmark_avg_payment")} AS revenue_variance_benchmark_pct
  FROM totals JOIN averages USING (benchmark_key)) USING (benchmark_key, invoice_number)""",
    "keyed totals averages",
    _ENHANCED,
)
def enhanced_lines(spark, folder):
    lines = invoice_lines(spark, folder).withColumn("Revenue_Variance_$", F.lit(0.0))  # of an earlier version, to be dropped
    return enhance.enhance(lines).select("invoice_number", "cpt_code", "benchmark_key", *_ENHANCED.split(), "open_invoice_anomaly_flag")


# --- Weekly tables ------------------------------------------------------------------------------------------------------
@query("granular_metrics", f"SELECT {q.KEYS}, {', '.join(q.GRANULAR_METRICS.split())} FROM granular", "granular", q.GRANULAR_METRICS)
def granular_metrics(spark, folder):
    return _granular(spark, folder).select(*KEY_KEYS, *q.GRANULAR_METRICS.split())


@query("weekly_granular", "SELECT * FROM granular", "granular", f"{q.MEASURE_DOUBLES} {q.GRANULAR_RATES} {q.GRANULAR_METRICS}")
def weekly_granular(spark, folder):
    return _granular(spark, folder)


@query(
    "key_benchmarks_joined",
    f"SELECT {q.KEYS}, visit_count, {', '.join(q.GRANULAR_RATES.split())} FROM granular",
    "granular",
    q.GRANULAR_RATES,
)
def key_benchmarks_joined(spark, folder):
    keyed = _keyed(spark, folder)
    visits = keyed.groupBy(*KEY_KEYS).agg(F.count_distinct("invoice_number").alias("visit_count"))
    tables = [keys.expected_rate(keyed), keys.mean_weekly_visits(keyed), keys.payment_rate(keyed)]
    return weekly.attach_key_benchmarks(visits, *tables)


@query("group_weighting", f"SELECT {q.G}, {q.WEIGHTING_COLUMNS} FROM weighting", "weighting", q.WEIGHTING_DOUBLES)
def group_weighting(spark, folder):
    return weekly.group_weighting(_granular(spark, folder))


@query("group_invoice_count", "SELECT * FROM group_invoices", "group_invoices")
def group_invoice_count(spark, folder):
    return weekly.group_invoice_count(invoice_lines(spark, folder))


_DIAG_SQL = f"""SELECT g.*, w.* EXCLUDE ({q.G}), group_benchmark_invoice_count FROM granular g
JOIN (SELECT {q.G}, {q.WEIGHTING_COLUMNS} FROM weighting) w ON {q.same("g", "w", q.G)}
JOIN group_invoices i ON {q.same("g", "i", q.G)}"""
_DIAG_DOUBLES = f"{q.MEASURE_DOUBLES} {q.GRANULAR_RATES} {q.GRANULAR_METRICS} {q.WEIGHTING_DOUBLES}"


@query("weekly_granular_diag", _DIAG_SQL, "granular weighting group_invoices", _DIAG_DOUBLES)
def weekly_granular_diag(spark, folder):
    return weekly.weekly_granular_diag(invoice_lines(spark, folder))


@query("group_diag_joined", _DIAG_SQL, "granular weighting group_invoices", _DIAG_DOUBLES)
def group_diag_joined(spark, folder):
    lines = invoice_lines(spark, folder)
    granular = stored(weekly.weekly_granular(lines), "granular")
    return weekly.attach_group_diag(granular, weekly.group_weighting(granular), weekly.group_invoice_count(lines))


@query("weekly_aggregated", "SELECT * FROM weekly", "weekly", q.WEEKLY_DOUBLES)
def weekly_aggregated(spark, folder):
    return _weekly(spark, folder)


_PERCENTS = ["collection_rate", "denial_percent", "remaining_charges_percent", "revenue_variance_pct"]


@query(
    "format_percent",
    f"SELECT {q.G}, "
    + ", ".join(
        f"coalesce(CAST(CAST(round_even({c} * 100, 0) AS BIGINT) AS VARCHAR), '<NA>') || '%' AS {c}"
        for c in _PERCENTS
    )
    + " FROM weekly",
    "weekly",
)
def format_percent(spark, folder):
    return _weekly(spark, folder).select(*GROUP_KEYS, *[text.percent_text(F.col(c)).alias(c) for c in _PERCENTS])


def _shown(c: str) -> str:
    """A weekly column as it is delivered: percent texts and display names."""
    value = f"coalesce(CAST(CAST(round_even({c} * 100, 0) AS BIGINT) AS VARCHAR), '<NA>') || '%'" if c in PERCENT_COLUMNS else c
    return f'{value} AS "{DISPLAY_NAMES.get(c, c)}"'


_DELIVERED = [*GROUP_KEYS, "visit_count", "payment_amount", "collection_rate", "denial_percent", "expected_payment", "revenue_variance_pct"]


@query(
    "delivered_weekly",
    f"SELECT {', '.join(_shown(c) for c in _DELIVERED)} FROM weekly",
    "weekly",
    f"{DISPLAY_NAMES['payment_amount']} {DISPLAY_NAMES['expected_payment']}",
)
def delivered_weekly(spark, folder):
    """The weekly table as readers of the delivery folder get it, beside another table of the same delivery."""
    at = f"{shared_folder(spark)}/delivery-{uuid.uuid4().hex}"
    table = stored(_weekly(spark, folder), "weekly").select(*_DELIVERED)
    publish({"weekly_aggregated": table, "by_payer": table.groupBy("payer").count()}, at, compression="gzip")
    texts = readers.published(spark, at, "weekly_aggregated")
    kinds = {DISPLAY_NAMES.get(f.name, f.name): f.dataType for f in table.schema if f.name not in PERCENT_COLUMNS}
    return texts.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


# --- Diagnostics ----------------------------------------------------------------------------------------------------------
@query(
    "expected_fallback",
    f"SELECT {q.G}, expected_amount_85_em_invoice_level * visit_count AS expected_payment FROM weekly",
    "weekly",
    "expected_payment",
)
def expected_fallback(spark, folder):
    empty = _weekly(spark, folder).withColumn("expected_payment", F.lit(None).cast("double"))
    return diagnostics.expected_fallback(empty).select(*GROUP_KEYS, "expected_payment")


_LENSES = (
    "revenue_variance_vs_85em_dollar revenue_variance_vs_85em_pct revenue_variance_vs_benchmark_dollar "
    "revenue_variance_vs_benchmark_pct"
)


@query("diagnostics_variance", f"SELECT {q.G}, {', '.join(_LENSES.split())} FROM diagnostics", "diagnostics", _LENSES)
def diagnostics_variance(spark, folder):
    return diagnostics.two_lens_variance(_weekly(spark, folder)).select(*GROUP_KEYS, *_LENSES.split())


@query(
    "performance_label",
    f"SELECT {q.G}, performance_label_vs_85em, performance_label_vs_benchmark FROM diagnostics",
    "diagnostics",
)
def performance_label(spark, folder):
    table = diagnostics.label_lenses(_weekly(spark, folder))
    return table.select(*GROUP_KEYS, "performance_label_vs_85em", "performance_label_vs_benchmark")


@query("diagnostics_base", "SELECT * FROM diagnostics", "diagnostics", q.DIAGNOSTIC_DOUBLES)
def diagnostics_base(spark, folder):
    return diagnostics.diagnostics_base(_weekly(spark, folder), fallback=False)


_FLAGS = [f"{p}_{lens}" for lens in ("85em", "benchmark") for p in ("over_performed", "under_performed", "average_performance")]


@query("label_flags", f"SELECT {q.G}, {', '.join(_FLAGS)} FROM flags", "flags")
def label_flags(spark, folder):
    return diagnostics.label_flags(diagnostics.label_lenses(_weekly(spark, folder))).select(*GROUP_KEYS, *_FLAGS)


@query("volume_no_lift", f"SELECT {q.G}, visit_count, volume_without_revenue_lift FROM flags", "flags")
def volume_no_lift(spark, folder):
    table = diagnostics.volume_no_lift(diagnostics.label_flags(diagnostics.label_lenses(_weekly(spark, folder))))
    return table.select(*GROUP_KEYS, "visit_count", "volume_without_revenue_lift")


# --- Underpayment ---------------------------------------------------------------------------------------------------------
@query(
    "shortfalls",
    f"""SELECT {q.G}, se AS shortfall_vs_expected, sb AS shortfall_vs_benchmark, sb - se AS incremental_shortfall_vs_benchmark
FROM short_weekly""",
    "short_weekly",
    " ".join(drivers.SHORTFALLS),
)
def shortfalls(spark, folder):
    return drivers.group_shortfalls(_weekly(spark, folder)).select(*GROUP_KEYS, *drivers.SHORTFALLS)


@query("drivers_payer", f"SELECT payer, {q.SHORT_SUMS} FROM short_weekly GROUP BY payer", "short_weekly", q.SHORT_DOUBLES, 4)
def drivers_payer(spark, folder):
    return drivers.drivers_payer(_weekly(spark, folder))


@query(
    "drivers_key",
    f"SELECT {q.D}, benchmark_key, {q.SHORT_SUMS} FROM short_granular GROUP BY {q.D}, benchmark_key",
    "short_granular",
    q.SHORT_DOUBLES,
    4,
)
def drivers_key(spark, folder):
    return drivers.drivers_key(_granular(spark, folder))


@query("drivers_time", f"SELECT year, week, {q.SHORT_SUMS} FROM short_weekly GROUP BY year, week", "short_weekly", q.SHORT_DOUBLES, 4)
def drivers_time(spark, folder):
    return drivers.by_time(drivers.drivers_time(_weekly(spark, folder)), TIME)


_UNDER = (
    "total_underpayment_85em avg_underpayment_pct_85em total_underpayment_benchmark avg_underpayment_pct_benchmark"
)


@query("underpayment_summary", "SELECT * FROM under_summary", "under_summary", _UNDER)
def underpayment_summary(spark, folder):
    return drivers.underpayment_summary(weekly.weekly_by_key_variance(_granular(spark, folder)))


_ORDER = ", ".join(f"{c} NULLS FIRST" for c in GROUP_KEYS)


def _top5_sql(lens: str) -> str:
    total = f"total_underpayment_{lens}"
    return f"SELECT {q.G}, {total} FROM under_summary ORDER BY {total}, {_ORDER} LIMIT 5"


@query("top5_underpaid", _top5_sql("85em"), "under_summary", "total_underpayment_85em")
def top5_underpaid(spark, folder):
    return drivers.top_underpaid(underpayment_summary(spark, folder), "85em")


@query("top5_underpaid_benchmark", _top5_sql("benchmark"), "under_summary", "total_underpayment_benchmark")
def top5_underpaid_benchmark(spark, folder):
    return drivers.top_underpaid(underpayment_summary(spark, folder), "benchmark")


_CPT = "avg_actual_rate avg_expected_rate_85em total_dollar_impact_vs_85em"


@query("cpt_rate_drivers", "SELECT * FROM cpt_summary", "cpt_summary", _CPT)
def cpt_rate_drivers(spark, folder):
    return drivers.cpt_drivers(weekly.weekly_by_cpt(invoice_lines(spark, folder)))


@query(
    "top5_cpt",
    f"""SELECT * FROM cpt_summary WHERE total_dollar_impact_vs_85em < 0
ORDER BY total_dollar_impact_vs_85em, {_ORDER}, cpt_code LIMIT 5""",
    "cpt_summary",
    _CPT,
)
def top5_cpt(spark, folder):
    return drivers.top_cpt(cpt_rate_drivers(spark, folder))


# --- Compact model --------------------------------------------------------------------------------------------------------
_B85 = "benchmark_85_percent gap_vs_85_percent gap_percent_vs_85"


@query("benchmark_85pct", f"SELECT invoice_number, {', '.join(_B85.split())} FROM gaps", "gaps", _B85)
def benchmark_85pct(spark, folder):
    return _gaps(spark, folder).select("invoice_number", *_B85.split())


_RATE = q.div("payment_amount", "charge_amount")


@query("median_rate", f"SELECT median({_RATE}) AS median_rate FROM lines", "lines", "median_rate", 9)
def median_rate(spark, folder):
    return compact.median_rate(invoice_lines(spark, folder))


@query(
    "historical_benchmark",
    f"""SELECT invoice_number, charge_amount * m AS historical_benchmark, payment_amount - charge_amount * m AS gap_vs_historical
FROM lines, (SELECT median({_RATE}) AS m FROM lines)""",
    "lines",
    "historical_benchmark gap_vs_historical",
)
def historical_benchmark(spark, folder):
    table = compact.historical_benchmark(invoice_lines(spark, folder))
    return table.select("invoice_number", "historical_benchmark", "gap_vs_historical")


_SIMPLE = "charge_amount payment_amount collection_rate performance_vs_85"


@query("weekly_simple", q.simple_week("week"), "lines", _SIMPLE)
def weekly_simple(spark, folder):
    return compact.weekly_simple(invoice_lines(spark, folder))


@query("weekly_simple_payer", q.simple_week("week, payer, group_em"), "lines", _SIMPLE)
def weekly_simple_payer(spark, folder):
    return compact.weekly_simple(invoice_lines(spark, folder), ["week", "payer", "group_em"])


@query("gap_by_payer", q.gap_by("payer"), "gaps", q.GAP_DOUBLES, 2)
def gap_by_payer(spark, folder):
    return compact.gap_drivers(_gaps(spark, folder), "payer")


@query("gap_by_em", q.gap_by("group_em"), "gaps", q.GAP_DOUBLES, 2)
def gap_by_em(spark, folder):
    return compact.gap_drivers(_gaps(spark, folder), "group_em")


@query("gap_by_week", q.gap_by("week"), "gaps", q.GAP_DOUBLES, 2)
def gap_by_week(spark, folder):
    return compact.gap_drivers(_gaps(spark, folder), "week")


@query("worst_payer", "SELECT * FROM payer_gaps ORDER BY avg_gap, payer LIMIT 1", "payer_gaps", q.GAP_DOUBLES, 2)
def worst_payer(spark, folder):
    return compact.worst_payer(gap_by_payer(spark, folder))


@query(
    "run_summary",
    f"""SELECT count(*) AS total_transactions, sum(charge_amount) AS total_charges, sum(payment_amount) AS total_payments,
  {q.div("sum(payment_amount)", "sum(charge_amount)")} * 100 AS overall_collection_rate FROM lines""",
    "lines",
    "total_charges total_payments overall_collection_rate",
)
def run_summary(spark, folder):
    return compact.run_summary(invoice_lines(spark, folder))


@query(
    "overall_narrative",
    f"""SELECT 1 AS n, CASE WHEN t < 0 THEN '💰 Overall Performance: The practice is underperforming by $' || {q.thousands("abs(t)", 2)}
    || ' against the 85% benchmark, with an average gap of $' || {q.fixed2("abs(a)")} || ' per transaction.'
  ELSE '✅ Overall Performance: The practice is performing well, exceeding the 85% benchmark by $'
    || {q.thousands("abs(t)", 2)} || '.' END AS text
FROM (SELECT sum(gap_vs_85_percent) AS t, avg(gap_vs_85_percent) AS a FROM gaps)
UNION ALL
SELECT 2, '📊 Top Underpayment Driver: ' || payer || ' shows the largest average gap ($' || {q.fixed2("avg_gap")}
  || ') and represents $' || CASE WHEN total_gap < 0 THEN '-' ELSE '' END || {q.thousands("abs(total_gap)", 2)}
  || ' in total underpayments.' FROM (SELECT * FROM payer_gaps ORDER BY avg_gap, payer LIMIT 1)""",
    "gaps payer_gaps",
)
def overall_narrative(spark, folder):
    gaps = _gaps(spark, folder)
    return narratives.overall_narrative(gaps, compact.gap_drivers(gaps, "payer"))


# --- Narratives -------------------------------------------------------------------------------------------------------------
def _diagnostics(spark, folder):
    return stored(diagnostics.diagnostics_base(_weekly(spark, folder), fallback=False), "diagnostics")


@query("narrative_top6", "SELECT year, week, side, CAST(rank AS INTEGER) AS rank, text FROM top_sentences", "top_sentences")
def narrative_top6(spark, folder):
    return narratives.top_sentences(narratives.metric_changes(_diagnostics(spark, folder)))


@query("revenue_cycle_narrative", "SELECT * FROM revenue_cycle", "revenue_cycle")
def revenue_cycle_narrative(spark, folder):
    return narratives.revenue_cycle(_diagnostics(spark, folder))


_ZERO = "zero_balance_collection_rate collection_rate zbcr_baseline cr_baseline"


@query("zero_balance", "SELECT * FROM zero_balance", "zero_balance", _ZERO)
def zero_balance(spark, folder):
    return narratives.zero_balance(_weekly(spark, folder))


@query("zero_balance_summary", "SELECT * FROM zero_texts", "zero_texts")
def zero_balance_summary(spark, folder):
    return narratives.join_text(narratives.zero_balance(_weekly(spark, folder)))


@query(
    "narratives",
    f"""SELECT {", ".join("f." + c for c in GROUP_KEYS)}, {", ".join(_FLAGS)}, volume_without_revenue_lift,
  '' AS ml_narrative_summary, went_well, can_improve, z.zero_balance_narrative
FROM flags f JOIN revenue_cycle r ON f.year = r.year AND f.week = r.week
JOIN zero_texts z ON f.year = z.year AND f.week = z.week""",
    "flags revenue_cycle zero_texts",
)
def full_narratives(spark, folder):
    table = narratives.narratives(_diagnostics(spark, folder))
    extra = ["volume_without_revenue_lift", "ml_narrative_summary", "went_well", "can_improve", "zero_balance_narrative"]
    return table.select(*GROUP_KEYS, *_FLAGS, *extra)


# --- Reports on scored rows ---------------------------------------------------------------------------------------------------
@query(
    "rate_gaps",
    f"SELECT {q.G}, ml_expected_rate_per_visit, ml_rate_gap, ml_dollar_gap, ml_material_gap_flag FROM scored",
    "scored",
    q.SCORE_DOUBLES,
)
def rate_gaps(spark, folder):
    return _scored(spark, folder).select(*GROUP_KEYS, *q.SCORE_DOUBLES.split(), "ml_material_gap_flag")


@query("ml_hotspots", "SELECT * FROM spots", "spots", "ml_dollar_gap_sum ml_rate_gap_mean")
def ml_hotspots(spark, folder):
    return ml_report.hotspots(_scored(spark, folder))


@query(
    "ml_totals",
    "SELECT sum(ml_dollar_gap) AS dollar_gap_total, CAST(sum(ml_material_gap_flag) AS BIGINT) AS material_flags_total FROM scored",
    "scored",
    "dollar_gap_total",
    2,
)
def ml_totals(spark, folder):
    return ml_report.ml_totals(_scored(spark, folder))


def _top10_sql(direction: str) -> str:
    return f"""SELECT {q.G}, ml_dollar_gap_sum AS dollar_gap_sum, ml_material_flag_sum AS material_flags FROM spots
ORDER BY round(ml_dollar_gap_sum, 6) {direction}, {_ORDER} LIMIT 10"""


@query("ml_top_under", _top10_sql("ASC"), "spots", "dollar_gap_sum")
def ml_top_under(spark, folder):
    return ml_report.ml_top(_scored(spark, folder), "under")


@query("ml_top_over", _top10_sql("DESC"), "spots", "dollar_gap_sum")
def ml_top_over(spark, folder):
    return ml_report.ml_top(_scored(spark, folder), "over")


@query(
    "ml_hotspots_topn",
    f"""SELECT {q.G}, ml_dollar_gap_sum AS dollar_gap_sum FROM spots
ORDER BY round(abs(ml_dollar_gap_sum), 6) DESC, {_ORDER} LIMIT 20""",
    "spots",
    "dollar_gap_sum",
)
def ml_hotspots_topn(spark, folder):
    return ml_report.ml_hotspots_topn(_scored(spark, folder), 20)


@query(
    "ml_record",
    f"""SELECT visit_count, payment_amount, ml_expected_rate_per_visit, ml_rate_gap, ml_dollar_gap, ml_material_gap_flag, {q.G}
FROM scored WHERE year = 1998 AND week = 30 AND payer = 'Medicare' AND group_em = 'New E/M Code' AND group_em2 = 'O'""",
    "scored",
    "payment_amount " + q.SCORE_DOUBLES,
)
def ml_record(spark, folder):
    return ml_report.ml_record(_scored(spark, folder), 1998, 30, "Medicare", "New E/M Code", "O")


@query(
    "ml_narrative",
    f"""SELECT {q.G}, 'ML signals ' || CASE WHEN ml_dollar_gap_sum < 0 THEN 'under' ELSE 'over' END || '-payment ≈ $'
  || {q.thousands("abs(ml_dollar_gap_sum)", 0)} || ' (' || ml_material_flag_sum || ' material flags; avg rate gap '
  || {q.fixed2("ml_rate_gap_mean", "+")} || '/visit).' AS ml_narrative_summary FROM spots""",
    "spots",
)
def ml_narrative(spark, folder):
    spots = ml_report.hotspots(_scored(spark, folder))
    sentence = text.ml_sentence(F.col("ml_dollar_gap_sum"), F.col("ml_material_flag_sum"), F.col("ml_rate_gap_mean"))
    return spots.select(*GROUP_KEYS, sentence.alias("ml_narrative_summary"))


@query(
    "attach_scores",
    f"SELECT {q.G}, payment_amount, {', '.join(q.SCORE_DOUBLES.split())}, ml_material_gap_flag FROM scored",
    "scored",
    "payment_amount " + q.SCORE_DOUBLES,
)
def attach_scores(spark, folder):
    table = ml_report.attach_scores(_weekly(spark, folder), _scored(spark, folder))
    return table.select(*GROUP_KEYS, "payment_amount", *q.SCORE_DOUBLES.split(), "ml_material_gap_flag")


_RESIDUALS = "residuals std_residuals abs_error"


@query(
    "residual_analysis",
    f"""SELECT {q.G}, r AS residuals, (r - (SELECT avg(ml_rate_gap) FROM scored)) / (SELECT stddev_pop(ml_rate_gap) FROM scored)
  AS std_residuals, abs(r) AS abs_error FROM (SELECT *, ml_rate_gap AS r FROM scored)""",
    "scored",
    _RESIDUALS,
)
def residual_analysis(spark, folder):
    table = ml_report.residual_analysis(_scored(spark, folder), "actual_rate_per_visit", "ml_expected_rate_per_visit")
    return table.select(*GROUP_KEYS, *_RESIDUALS.split())


@query(
    "regression_metrics",
    """SELECT year, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, CASE WHEN count(*) > 1 THEN
  CASE WHEN max(y) = min(y) THEN CASE WHEN max(abs(e)) = 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - sum(e * e) / sum((y - m) * (y - m)) END END AS r2
FROM (SELECT year, ml_rate_gap AS e, actual_rate_per_visit AS y, avg(actual_rate_per_visit) OVER (PARTITION BY year) AS m
      FROM scored WHERE ml_rate_gap IS NOT NULL) GROUP BY year""",
    "scored",
    "mae rmse r2",
)
def regression_metrics(spark, folder):
    scored = _scored(spark, folder)
    return ml_report.regression_metrics(scored, "actual_rate_per_visit", "ml_expected_rate_per_visit", ["year"])


_ORD = f"row_number() OVER (ORDER BY {_ORDER}) - 1"


@query("time_ordinal", f"SELECT {q.G}, {_ORD} AS ord FROM weekly", "weekly")
def time_ordinal(spark, folder):
    return ordering.time_ordinal(_weekly(spark, folder), DIMS).select(*GROUP_KEYS, "ord")


@query(
    "latest_window",
    f"""SELECT {q.G}, visit_count, payment_amount FROM (SELECT *, {_ORD} AS ord, count(*) OVER () AS n FROM weekly)
WHERE ord >= n - 2500""",
    "weekly",
    "payment_amount",
)
def latest_window(spark, folder):
    return ordering.latest_window(_weekly(spark, folder), 2500, DIMS).select(*GROUP_KEYS, "visit_count", "payment_amount")


# --- Validation ---------------------------------------------------------------------------------------------------------------
def _processed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyed lines, their processed form with some wrong values so that the checks have something to find, and invoice facts.

    Of the lines only what benchmarks are recomputed from is kept: keys and two amounts.
    """
    amounts = ["payment_amount", "expected_85em"]
    lines = invoice_lines(spark, folder, row_id=True).select("row_id", *DIMS, "invoice_number", "cpt_code", *amounts)
    source = stored(keys.keyed_lines(lines).select("row_id", *validation.INVOICE, *amounts), "keyed-lines")
    facts = stored(validation.invoice_facts(source), "invoice-facts")
    table = validation.with_benchmarks(source, validation.invoice_benchmarks(facts))
    total, average, row = F.col("invoice_total_payment"), F.col("benchmark_avg_payment"), F.col("row_id")
    table = table.withColumn("revenue_variance_benchmark_dollar", total - average)
    rate = "expected_amount_85_em_invoice_level"
    processed = table.withColumns(
        {
            "invoice_total_payment": F.when(row % 20 == 0, total + 5).otherwise(total),
            rate: F.when(row % 30 != 0, F.col(rate)),
        }
    )
    return source, processed, facts


def _passed_through(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lines with their gap columns, and their processed form with some wrong gaps. No key or benchmark takes part in this."""
    source = stored(invoice_lines(spark, folder, row_id=True).select("row_id", *validation.PASSTHROUGH), "gap-lines")
    gap = F.col("nrv_gap_dollar_invoice_level")
    wrong = F.when(F.col("row_id") % 40 == 0, gap + 1).otherwise(gap)
    return source, enhance.nrv_passthrough(source).withColumn("nrv_gap_dollar_invoice_level", wrong)


@query(
    "is_close",
    f"SELECT invoice_number, {q.close('payment_amount', 'expected_85em', '0.05')} AS near FROM lines",
    "lines",
)
def is_close(spark, folder):
    near = numbers.is_close(F.col("payment_amount"), F.col("expected_85em"), 0.05)
    return invoice_lines(spark, folder).select("invoice_number", near.alias("near"))


_RECALC = "expected_amount_85_em_recalc benchmark_payment_amount_recalc benchmark_avg_payment_recalc"


@query(
    "recompute_key",
    """SELECT benchmark_key, expected_amount_85_em_invoice_level AS expected_amount_85_em_recalc,
  benchmark_payment_amount AS benchmark_payment_amount_recalc, benchmark_avg_payment AS benchmark_avg_payment_recalc
FROM key_rates JOIN averages USING (benchmark_key)""",
    "key_rates averages",
    _RECALC,
)
def recompute_key(spark, folder):
    return validation.recompute_key(_keyed(spark, folder))


@query(
    "merge_recalc",
    """SELECT benchmark_key, expected_amount_85_em_invoice_level, benchmark_payment_amount, benchmark_avg_payment
FROM key_rates JOIN averages USING (benchmark_key)""",
    "key_rates averages",
    "expected_amount_85_em_invoice_level benchmark_payment_amount benchmark_avg_payment",
)
def merge_recalc(spark, folder):
    keyed = _keyed(spark, folder)
    averages = keys.benchmark_avg(keys.invoice_totals(keyed))
    return validation.merge_recalc(keys.expected_rate(keyed), keys.mean_payment(keyed), averages)


_COMPARED = ["expected_amount_85_em_invoice_level", "benchmark_payment_amount", "invoice_total_payment", "benchmark_avg_payment"]
_ORIGINALS = {
    "expected_amount_85_em_invoice_level": "r.expected_amount_85_em_invoice_level",
    "benchmark_payment_amount": "r.benchmark_payment_amount",
    "invoice_total_payment": "t.invoice_total_payment",
    "benchmark_avg_payment": "v.benchmark_avg_payment",
}
_COMPARE_SQL = (
    "SELECT p.row_id, "
    + ", ".join(
        f"p.{c} - {o} AS {c}__delta, {q.close(f'p.{c}', o, '1e-3')} AS {c}__match" for c, o in _ORIGINALS.items()
    )
    + " FROM processed p JOIN key_rates r USING (benchmark_key) JOIN averages v USING (benchmark_key) "
    "JOIN totals t USING (benchmark_key, invoice_number)"
)
_COMPARE_COLUMNS = [f"{c}__{part}" for c in _COMPARED for part in ("delta", "match")]
_DELTAS = " ".join(f"{c}__delta" for c in _COMPARED)


@query("recompute_compare", _COMPARE_SQL, "processed key_rates averages totals", _DELTAS)
def recompute_compare(spark, folder):
    return validation.recompute_compare(*_processed(spark, folder)).select("row_id", *_COMPARE_COLUMNS)


@query(
    "discrepancies",
    f"SELECT * FROM ({_COMPARE_SQL}) WHERE NOT ({' AND '.join(f'{c}__match' for c in _COMPARED)})",
    "processed key_rates averages totals",
    _DELTAS,
)
def discrepancies(spark, folder):
    return validation.mismatches(recompute_compare(spark, folder))


_MATCHES = [f"{c}_row_match" for c in validation.PASSTHROUGH.values()]


@query(
    "row_passthrough",
    "SELECT row_id, " + ", ".join(f"{q.close(out, src, '1e-6')} AS {out}_row_match" for src, out in validation.PASSTHROUGH.items()) + " FROM processed",
    "processed",
)
def row_passthrough(spark, folder):
    return validation.row_passthrough(*_passed_through(spark, folder)).select("row_id", *_MATCHES)


@query("sample_invoices", "SELECT * FROM sample", "sample")
def sample_invoices(spark, folder):
    return validation.sample_invoices(invoice_lines(spark, folder))


_SAMPLE = "processed_value recalc_value delta"


@query("sample_validation", "SELECT * FROM sample_details", "sample_details", _SAMPLE)
def sample_validation(spark, folder):
    source, processed, facts = _processed(spark, folder)
    return validation.sample_validation(source, processed, facts=facts)


@query(
    "sample_validation_summary",
    """SELECT "check", count(*) AS total, CAST(count(*) FILTER (match) AS BIGINT) AS pass,
  CAST(count(*) FILTER (NOT match) AS BIGINT) AS fail, count(*) FILTER (match) / count(*) AS pass_rate
FROM sample_details GROUP BY 1""",
    "sample_details",
    "pass_rate",
)
def sample_validation_summary(spark, folder):
    return validation.check_summary(sample_validation(spark, folder))


@query(
    "sample_mismatches",
    "SELECT * FROM sample_details WHERE NOT match",
    "sample_details",
    _SAMPLE,
)
def sample_mismatches(spark, folder):
    return validation.mismatches(sample_validation(spark, folder), ["match"])


# --- Data checks --------------------------------------------------------------------------------------------------------------
_CHECKED = ["labs_per_visit", "expected_85em", "payer"]


@query(
    "dq_all_null",
    "\nUNION ALL ".join(
        f"SELECT 'all_null:{c}' AS \"check\", CASE WHEN count({c}) = 0 THEN 'warn' ELSE 'ok' END AS status, "
        f"CASE WHEN count({c}) = 0 THEN 'no value in {c}' END AS issue FROM checked"
        for c in [*_CHECKED, "nothing"]
    ).replace("FROM checked", "FROM (SELECT *, NULL AS nothing FROM lines)"),
    "lines",
)
def dq_all_null(spark, folder):
    table = columns.ensure_columns(invoice_lines(spark, folder), {"nothing": None})
    return quality.check_all_null(table, [*_CHECKED, "nothing"])


@query(
    "dq_row_count",
    """SELECT 'row_count' AS "check", CASE WHEN count(*) < 1000000000 THEN 'fail' ELSE 'ok' END AS status,
  CASE WHEN count(*) < 1000000000 THEN count(*) || ' rows where at least 1000000000 are expected' END AS issue FROM lines""",
    "lines",
)
def dq_row_count(spark, folder):
    return quality.check_row_count(invoice_lines(spark, folder), 1_000_000_000)


@query(
    "dq_duplicates",
    """SELECT 'unique_keys' AS "check", CASE WHEN n > 0 THEN 'warn' ELSE 'ok' END AS status, CASE WHEN n > 0 THEN
  n || ' rows share their (invoice_number, cpt_code)' END AS issue
FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n
      FROM (SELECT count(*) AS c FROM lines GROUP BY invoice_number, cpt_code HAVING count(*) > 1))""",
    "lines",
)
def dq_duplicates(spark, folder):
    return quality.check_unique(invoice_lines(spark, folder), ["invoice_number", "cpt_code"])


def _numeric_sql(c: str) -> str:
    checks = (("finite", f"{c} IS NULL", "without a finite number"), ("non_negative", f"{c} < 0", "below zero"))
    return "\nUNION ALL ".join(
        f"SELECT '{name}:{c}' AS \"check\", CASE WHEN n > 0 THEN 'warn' ELSE 'ok' END AS status, CASE WHEN n > 0 THEN "
        f"'{c}: ' || n || ' {words}' END AS issue FROM (SELECT count(*) AS n FROM lines WHERE {bad})"
        for name, bad, words in checks
    )


@query(
    "dq_numeric",
    "\nUNION ALL ".join(_numeric_sql(c) for c in ("payment_amount", "expected_85em", "nrv_gap_dollar"))
    + "\nUNION ALL SELECT 'numeric:absent', 'warn', 'no column absent to check'",
    "lines",
)
def dq_numeric(spark, folder):
    return quality.check_numeric(invoice_lines(spark, folder), ["payment_amount", "expected_85em", "nrv_gap_dollar", "absent"])


@query(
    "dq_suite",
    f"""SELECT 'preprocess' AS stage, 'columns' AS "check", 'ok' AS status, NULL AS issue
UNION ALL SELECT 'preprocess', 'row_count', CASE WHEN count(*) < 10 THEN 'fail' ELSE 'ok' END, NULL FROM lines
UNION ALL SELECT 'preprocess', 'unique_keys', CASE WHEN n > 0 THEN 'warn' ELSE 'ok' END,
  CASE WHEN n > 0 THEN n || ' rows share their (invoice_number, cpt_code)' END
  FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n
        FROM (SELECT count(*) AS c FROM lines GROUP BY invoice_number, cpt_code HAVING count(*) > 1))
UNION ALL SELECT 'enhance', 'columns', 'ok', NULL
UNION ALL SELECT 'enhance', "check", status, issue FROM ({_numeric_sql("payment_amount")} UNION ALL {_numeric_sql("expected_85em")})
UNION ALL SELECT 'weekly', 'granular:columns', 'ok', NULL
UNION ALL SELECT 'weekly', 'granular:row_count', CASE WHEN count(*) < 5 THEN 'warn' ELSE 'ok' END, NULL FROM granular
UNION ALL SELECT 'weekly', 'aggregated:columns', 'ok', NULL
UNION ALL SELECT 'weekly', 'aggregated:row_count', CASE WHEN count(*) < 5 THEN 'warn' ELSE 'ok' END, NULL FROM weekly
UNION ALL SELECT 'diag_base', 'columns', 'ok', NULL
UNION ALL SELECT 'ml_agg', 'columns', 'ok', NULL
UNION ALL SELECT 'ml_agg', 'ml_columns', 'ok', NULL
UNION ALL SELECT 'underpay', t, 'ok', NULL FROM (VALUES ('summary'), ('by_key'), ('by_payer')) v(t)""",
    "lines granular weekly",
)
def dq_suite(spark, folder):
    keyed = _keyed(spark, folder)
    groups, granular = _weekly(spark, folder), _granular(spark, folder)
    by_payer = drivers.drivers(drivers.group_shortfalls(groups), ["payer"])
    tables = {
        "preprocess": {"lines": keyed},
        "enhance": {"lines": keyed},
        "weekly": {"granular": granular, "aggregated": groups},
        "diag_base": {"diagnostics": diagnostics.diagnostics_base(groups, fallback=False)},
        "ml_agg": {"scored": _scored(spark, folder)},
        "underpay": {"summary": underpayment_summary(spark, folder), "by_key": granular, "by_payer": by_payer},
    }
    reports = [quality.run_checkpoint(stage, given) for stage, given in tables.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


# --- Models (SQL for the imputed features and least squares) -------------------------------------------------------------
_IMPUTED = ", ".join(f"coalesce({c}, median({c}) OVER ()) AS {c}" for c in ML_NUMERIC)


@query(
    "ml_features",
    f"SELECT year, week, coalesce(payer, 'nan') AS payer, group_em, group_em2, {_IMPUTED} FROM (SELECT * REPLACE "
    "(CAST(visit_count AS DOUBLE) AS visit_count) FROM weekly) WHERE actual_rate_per_visit IS NOT NULL",
    "weekly",
    " ".join(ML_NUMERIC),
)
def ml_features(spark, folder):
    rows = ml.model_rows(stored(_weekly(spark, folder), "weekly"))
    features = ml.fit_features(rows)
    renamed = {f"_f_{c}": c for c in [*ML_NUMERIC, *DIMS]}
    return features.impute(rows).select(*TIME, *[F.col(old).alias(new) for old, new in renamed.items()])


@query("ml_boosted")
def ml_boosted(spark, folder):
    scored = ml.score(stored(_weekly(spark, folder), "weekly"), ml.fit_boosted)
    return scored.select(*GROUP_KEYS, "hgb_expected_rate_per_visit", "hgb_rate_gap", "hgb_dollar_gap", "hgb_material_gap_flag")


_EN_DOUBLES = "ml_expected_rate_per_visit ml_rate_gap ml_dollar_gap"


@query("ml_elasticnet", f"SELECT {q.G}, {', '.join(_EN_DOUBLES.split())}, ml_material_gap_flag FROM elastic_scored", "elastic_scored", _EN_DOUBLES, 3)
def ml_elasticnet(spark, folder):
    scored = ml.score(stored(_weekly(spark, folder), "weekly"), ml.fit_elasticnet)
    return scored.select(*GROUP_KEYS, *_EN_DOUBLES.split(), "ml_material_gap_flag")


@query(
    "ml_fitted_hotspots",
    f"""SELECT {q.G}, coalesce(sum(ml_dollar_gap), 0) AS ml_dollar_gap_sum, CAST(coalesce(sum(ml_material_gap_flag), 0) AS BIGINT) AS ml_material_flag_sum,
  avg(ml_rate_gap) AS ml_rate_gap_mean FROM elastic_scored GROUP BY {q.G}""",
    "elastic_scored",
    "ml_dollar_gap_sum ml_rate_gap_mean",
    3,
)
def ml_fitted_hotspots(spark, folder):
    return ml_report.hotspots(ml.score(stored(_weekly(spark, folder), "weekly"), ml.fit_elasticnet))


@query("ml_time_cv", "SELECT * FROM elastic_cv", "elastic_cv", "mae rmse r2", 4)
def ml_time_cv(spark, folder):
    return ml.elastic_cv(stored(_weekly(spark, folder), "weekly"))[0]


@query(
    "ml_metrics",
    """SELECT 0.1::DOUBLE AS alpha, 0.2::DOUBLE AS l1_ratio, (SELECT count(*) FROM elastic_rows) AS rows_used_for_model, c.*, t.* FROM
  (SELECT avg(mae) AS mae_mean, avg(rmse) AS rmse_mean, avg(r2) AS r2_mean, stddev_samp(mae) AS mae_std, stddev_samp(r2) AS r2_std FROM elastic_cv) c,
  (SELECT avg(abs(y - expected)) AS mae, sqrt(avg((y - expected) ** 2)) AS rmse, 1 - avg((y - expected) ** 2) / var_pop(y) AS r2
   FROM elastic_fitted WHERE fold = 0) t""",
    "elastic_rows elastic_cv elastic_fitted",
    "alpha l1_ratio mae_mean rmse_mean r2_mean mae_std r2_std mae rmse r2",
    4,
)
def ml_metrics(spark, folder):
    folds, model, rows = ml.elastic_cv(stored(_weekly(spark, folder), "weekly"))
    record = ml.metrics_record(folds, model.score(rows), model)
    return record.select("params.*", "rows_used_for_model", "cross_validation.*", "train_fit.*")


@query("feature_importance")
def feature_importance(spark, folder):
    rows = ml.model_rows(stored(_weekly(spark, folder), "weekly"))
    return ml.feature_importance(ml.fit_boosted(rows), rows)


_LINEAR = """WITH rated AS (SELECT row_id, payment_amount / nullif(charge_amount, 0) AS payment_rate, coalesce(charge_amount, 0) AS charge,
  ('0x' || substr(md5(row_id::VARCHAR || ':42'), 1, 8))::BIGINT % 5 = 0 AS held_out FROM lines),
fitted AS (SELECT regr_slope(payment_rate, charge) AS slope, regr_intercept(payment_rate, charge) AS level
  FROM rated WHERE payment_rate IS NOT NULL AND NOT held_out),
scored AS (SELECT *, level + slope * charge AS expected, payment_rate - (level + slope * charge) AS gap FROM rated, fitted)"""


@query(
    "ml_linear",
    f"""SELECT * FROM ({_LINEAR}
SELECT row_id, payment_rate, expected AS ml_expected_rate, gap AS ml_rate_gap, coalesce(abs(gap) > 0.1, false) AS ml_materiality_flag FROM scored)""",
    "lines",
    "payment_rate ml_expected_rate ml_rate_gap",
)
def ml_linear(spark, folder):
    scored, _ = ml.linear_diagnostics(invoice_lines(spark, folder, row_id=True))
    return scored.select("row_id", "payment_rate", "ml_expected_rate", "ml_rate_gap", "ml_materiality_flag")


@query(
    "ml_linear_metrics",
    f"""SELECT * FROM ({_LINEAR}
SELECT 'Linear Regression' AS model_type, 1 - avg(gap * gap) FILTER (held_out) / var_pop(payment_rate) FILTER (held_out) AS r2,
  avg(abs(gap)) FILTER (held_out) AS mean_absolute_error, ['charge_amount'] AS features_used,
  count(*) FILTER (NOT held_out) AS training_samples, count(*) FILTER (held_out) AS test_samples
FROM scored WHERE payment_rate IS NOT NULL)""",
    "lines",
    "r2 mean_absolute_error",
)
def ml_linear_metrics(spark, folder):
    return ml.linear_diagnostics(invoice_lines(spark, folder, row_id=True))[1]
