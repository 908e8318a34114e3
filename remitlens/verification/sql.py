"""Building blocks of the comparison SQL (DuckDB dialect), written from the definitions rather than from our plans."""

from __future__ import annotations

from remitlens.contracts import BASELINE_METRICS, KEY_KEYS, MEAN_MEASURES, ML_NUMERIC, SUM_MEASURES

G = "year, week, payer, group_em, group_em2"
D = "payer, group_em, group_em2"

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    _CTES[name] = (body, needs)


def same(a: str, b: str, keys: str) -> str:
    """Null-safe join condition."""
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.replace(",", " ").split())


def compose(select: str, *needs: str) -> str:
    """``select`` preceded by the CTEs it needs, each after its own needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in _CTES[name][1]:
                add(need)
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in ordered) + "\n" + select


def rounded(select: str, cols: str, digits: int = 6) -> str:
    """Round the named columns of ``select``; adding 0.0 turns a negative zero into zero."""
    replaced = ", ".join(f'round_even("{c}" * 1e{digits}, 0) / 1e{digits} + 0.0 AS "{c}"' for c in cols.replace(",", " ").split())
    return f"SELECT * REPLACE ({replaced}) FROM ({select})"


def div(a: str, b: str) -> str:
    return f"({a}) / nullif(CAST({b} AS DOUBLE), 0)"


def div0(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE {div(a, b)} END"


# --- Lines from the order tables --------------------------------------------------------------------------------
cte(
    "raw_lines",
    """
SELECT l.*, o_orderdate, o_orderpriority, o_orderstatus, c_mktsegment, p_type, p_size,
  CASE WHEN l_orderkey % 211 = 0 THEN 0.0 ELSE floor(l_extendedprice * (1 + l_tax)) END AS chg,
  floor(l_extendedprice * (1 - l_discount)) AS paid
FROM (SELECT *, row_number() OVER () - 1 AS row_id FROM lineitem) l
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey""",
)
cte(
    "lines",
    """
SELECT row_id, CAST(isoyear(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week,
  CASE WHEN l_orderkey % 97 <> 0 THEN CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Aetna' WHEN 'BUILDING' THEN 'Medicare'
    WHEN 'MACHINERY' THEN 'Cigna' ELSE c_mktsegment END END AS payer,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'New E/M Code' WHEN '2-HIGH' THEN 'Existing E/M Code'
    ELSE o_orderpriority END AS group_em,
  o_orderstatus AS group_em2, CAST(l_orderkey AS VARCHAR) AS invoice_number, p_type AS cpt_code,
  chg AS charge_amount, pay AS payment_amount, expd AS expected_85em, chg - pay AS charge_billed_balance,
  CASE WHEN l_linenumber % 3 = 0 THEN -(chg - pay) ELSE (chg - pay) * 0.5 END AS zero_balance_collection_star_charges,
  paid * 0.5 AS nrv_zero_balance,
  floor(paid / nullif(chg, 0) * 4096) / 4096 AS zero_balance_collection_rate,
  floor((1 - l_discount) * 1024) / 1024 AS collection_rate, floor(l_discount * 1024) / 1024 AS denial_pct,
  pay - expd AS nrv_gap_dollar, floor((l_discount - l_tax) * 1024) / 1024 AS nrv_gap_pct,
  chg - expd AS nrv_gap_sum_dollar, floor((chg - pay) / nullif(chg, 0) * 1024) / 1024 AS remaining_charges_pct,
  l_quantity / 16 AS avg_charge_em_weight, CASE WHEN l_orderkey % 89 <> 0 THEN l_quantity % 4 END AS labs_per_visit,
  CAST(l_linenumber AS DOUBLE) AS procedure_per_visit, CAST(p_size % 5 AS DOUBLE) AS radiology_count,
  CASE WHEN l_linestatus = 'O' THEN CAST(1 AS DOUBLE) ELSE 0 END AS open_invoice_count,
  expd - pay AS sp_balance, pay - expd AS insurance_balance, paid AS payment_per_visit, chg AS fee_schedule_expected,
  CASE WHEN l_linenumber % 4 <> 0 THEN floor(paid * 0.75) END AS benchmark_payment_invoice_level
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE paid END AS pay,
        CASE WHEN l_orderkey % 83 <> 0 THEN floor(chg * 0.85) END AS expd FROM raw_lines)""",
    "raw_lines",
)
LINE_DOUBLES = (
    "charge_amount payment_amount expected_85em charge_billed_balance zero_balance_collection_star_charges "
    "nrv_zero_balance zero_balance_collection_rate collection_rate denial_pct nrv_gap_dollar nrv_gap_pct "
    "nrv_gap_sum_dollar remaining_charges_pct avg_charge_em_weight labs_per_visit procedure_per_visit radiology_count "
    "open_invoice_count sp_balance insurance_balance payment_per_visit fee_schedule_expected "
    "benchmark_payment_invoice_level"
)

# --- The uncleaned report ---------------------------------------------------------------------------------------
cte(
    "report",
    """
SELECT row_id,
  CASE WHEN row_id % 4 = 0 THEN CAST(year AS VARCHAR) || '.0' WHEN row_id % 4 = 1 THEN '  ' END
    AS "Year of Visit Service Date",
  CASE WHEN row_id % 4 = 0 THEN 'Week ' || lpad(CAST(week AS VARCHAR), 2, '0') END AS "ISO Week of Visit Service Date",
  CASE WHEN row_id % 4 = 0 THEN CASE WHEN row_id % 1000 = 0 THEN ' Grand  Total ' ELSE payer END
    WHEN row_id % 4 = 2 THEN '' END AS "Primary Financial Class",
  CASE WHEN row_id % 4 = 0 THEN group_em END AS "Chart E/M Code Grouping",
  CASE WHEN row_id % 4 = 0 THEN group_em2 END AS "Chart E/M Code Second Layer",
  CASE WHEN row_id % 3 = 0 THEN invoice_number END AS "Charge Invoice Number",
  CASE WHEN row_id % 51 = 7 THEN NULL WHEN row_id % 777 = 5 THEN 'total' ELSE ' ' || cpt_code END AS "Charge CPT Code",
  CASE row_id % 7 WHEN 0 THEN ' ' || num || '.5' WHEN 1 THEN 'abc' WHEN 2 THEN '   '
    WHEN 3 THEN '1,' || CASE WHEN length(num) > 6 THEN left(num, 6) ELSE lpad(num, 6, '0') END
    WHEN 4 THEN num || '%' WHEN 5 THEN num || 'd' ELSE '-' || num || 'e-2' END AS "Charge Amount",
  CAST(CAST(payment_amount AS BIGINT) AS VARCHAR) AS "Payment Amount*",
  CAST(CAST(denial_pct * 1024 AS BIGINT) AS VARCHAR) || '%' AS "Denial %",
  CAST(CAST(labs_per_visit AS BIGINT) AS VARCHAR) AS "Lab per Visit (copy)"
FROM (SELECT *, CAST(CAST(charge_amount AS BIGINT) AS VARCHAR) AS num FROM lines)""",
    "lines",
)
# Renamed to canonical names, blanks still in place.
cte(
    "std_report",
    """
SELECT row_id, "Year of Visit Service Date" AS year, "ISO Week of Visit Service Date" AS week,
  "Primary Financial Class" AS payer, "Chart E/M Code Grouping" AS group_em,
  "Chart E/M Code Second Layer" AS group_em2, "Charge Invoice Number" AS invoice_number,
  "Charge CPT Code" AS cpt_code, "Charge Amount" AS charge_amount, "Payment Amount*" AS payment_amount,
  "Denial %" AS denial_pct, "Lab per Visit (copy)" AS labs_per_visit FROM report""",
    "report",
)
STD_TEXT = (
    "year week payer group_em group_em2 invoice_number cpt_code charge_amount payment_amount denial_pct labs_per_visit"
)


def blank(c: str) -> str:
    return f"CASE WHEN trim({c}) <> '' THEN {c} END"


def number(c: str) -> str:
    """Plain number; comma and percent forms are unreadable."""
    return rf"CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def loose_number(c: str) -> str:
    """Number with commas dropped and percent divided by 100."""
    t = f"replace(trim({c}), ',', '')"
    return f"CASE WHEN {t} LIKE '%\\%' ESCAPE '\\' THEN ({number(f'left({t}, length({t}) - 1)')}) / 100.0 ELSE {number(t)} END"


def filled(c: str) -> str:
    return f"last_value({blank(c)} IGNORE NULLS) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING)"


cte(
    "filled_report",
    f"""
SELECT row_id, {", ".join(f"{filled(c)} AS {c}" for c in "year week payer group_em group_em2 invoice_number".split())},
  {blank("cpt_code")} AS cpt_code, coalesce({number("charge_amount")}, 0) AS charge_amount,
  coalesce({number("payment_amount")}, 0) AS payment_amount, coalesce({number("denial_pct")}, 0) AS denial_pct
FROM std_report""",
    "std_report",
)
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in "invoice_number payer group_em group_em2 cpt_code".split())

# --- Keys and benchmarks ----------------------------------------------------------------------------------------
cte(
    "sets",
    "SELECT invoice_number, list_sort(list(DISTINCT trim(cpt_code))) AS cpt_list FROM lines GROUP BY 1",
    "lines",
)
cte(
    "keyed",
    """
SELECT *, concat_ws('|', coalesce(payer, 'nan'), coalesce(group_em, 'nan'), coalesce(group_em2, 'nan'), cpt_list_str)
    AS benchmark_key,
  concat_ws('|', invoice_number, coalesce(payer, 'nan'), coalesce(group_em, 'nan'), coalesce(group_em2, 'nan'),
    cpt_list_str) AS abbreviated_benchmark_key
FROM (SELECT lines.*, cpt_list, '[''' || array_to_string(cpt_list, ''', ''') || ''']' AS cpt_list_str
      FROM lines JOIN sets USING (invoice_number))""",
    "lines",
    "sets",
)
cte(
    "totals",
    "SELECT benchmark_key, invoice_number, sum(payment_amount) AS invoice_total_payment FROM keyed GROUP BY 1, 2",
    "keyed",
)
cte(
    "averages",
    "SELECT benchmark_key, avg(invoice_total_payment) AS benchmark_avg_payment FROM totals GROUP BY 1",
    "totals",
)
cte(
    "key_weeks",
    """SELECT benchmark_key, year, week, sum(payment_amount) AS paid, count(DISTINCT invoice_number) AS visits
FROM keyed GROUP BY 1, 2, 3""",
    "keyed",
)
cte(
    "key_rates",
    """
SELECT * FROM (SELECT benchmark_key, avg(expected_85em) AS expected_amount_85_em_invoice_level,
    avg(payment_amount) AS benchmark_payment_amount FROM keyed GROUP BY 1)
JOIN (SELECT benchmark_key, avg(visits) AS benchmark_invoice_count, avg(paid / nullif(visits, 0))
    AS benchmark_payment_rate_per_visit FROM key_weeks GROUP BY 1) USING (benchmark_key)""",
    "keyed",
    "key_weeks",
)

# --- Weekly tables ----------------------------------------------------------------------------------------------
_MEASURES = ", ".join(
    ["count(DISTINCT invoice_number) AS visit_count", "count(invoice_number) AS group_size"]
    + [f"coalesce(sum({src}), 0) AS {name}" for name, src in SUM_MEASURES.items()]
    + [f"avg({src}) AS {name}" for name, src in MEAN_MEASURES.items()]
)
MEASURE_DOUBLES = " ".join([*SUM_MEASURES, *MEAN_MEASURES])
KEYS = ", ".join(KEY_KEYS)
cte("granular_base", f"SELECT {KEYS}, {_MEASURES}, CAST(max(len(cpt_list)) AS INTEGER) AS cpt_count FROM keyed GROUP BY {KEYS}", "keyed")
cte(
    "granular",
    f"""
SELECT *, payment_amount - expected_payment AS revenue_variance,
  {div("payment_amount - expected_payment", "expected_payment")} AS revenue_variance_pct,
  visit_count - benchmark_invoice_count AS volume_gap,
  actual_rate_per_visit - expected_amount_85_em_invoice_level AS rate_variance
FROM (SELECT b.*, expected_amount_85_em_invoice_level, benchmark_invoice_count, benchmark_payment_rate_per_visit,
        expected_amount_85_em_invoice_level * visit_count AS expected_payment,
        benchmark_payment_rate_per_visit * visit_count AS benchmark_payment,
        {div("payment_amount", "visit_count")} AS actual_rate_per_visit
      FROM granular_base b JOIN key_rates USING (benchmark_key))""",
    "granular_base",
    "key_rates",
)
GRANULAR_RATES = "expected_amount_85_em_invoice_level benchmark_invoice_count benchmark_payment_rate_per_visit"
GRANULAR_METRICS = (
    "expected_payment benchmark_payment actual_rate_per_visit revenue_variance revenue_variance_pct volume_gap rate_variance"
)
cte(
    "weighting",
    f"""
SELECT *, w - u AS diff, {div("w - u", "u")} AS pct FROM (
  SELECT {G}, coalesce(sum(benchmark_payment_rate_per_visit * visit_count), 0) AS w,
    CAST(sum(visit_count) AS BIGINT) AS visits, avg(benchmark_payment_rate_per_visit) AS mean_rate,
    avg(benchmark_payment_rate_per_visit) * sum(visit_count) AS u
  FROM granular GROUP BY {G})""",
    "granular",
)
WEIGHTING_COLUMNS = """w AS group_benchmark_payment_weighted, visits AS group_total_visits,
  mean_rate AS group_mean_rate_unweighted, u AS group_benchmark_payment_unweighted,
  diff AS group_benchmark_payment_diff_dollar, pct AS group_benchmark_payment_diff_pct,
  coalesce(abs(pct) >= 0.03, false) AS group_benchmark_payment_material_flag"""
WEIGHTING_DOUBLES = (
    "group_benchmark_payment_weighted group_mean_rate_unweighted group_benchmark_payment_unweighted "
    "group_benchmark_payment_diff_dollar group_benchmark_payment_diff_pct"
)
cte(
    "group_invoices",
    f"SELECT {G}, count(DISTINCT invoice_number) AS group_benchmark_invoice_count FROM lines GROUP BY {G}",
    "lines",
)
cte(
    "weekly",
    f"""
SELECT m.*, k.expected_payment, k.benchmark_payment, {div("payment_amount", "visit_count")} AS actual_rate_per_visit,
  payment_amount - k.expected_payment AS revenue_variance,
  {div("payment_amount - k.expected_payment", "k.expected_payment")} AS revenue_variance_pct,
  k.expected_payment - k.benchmark_payment AS expected_vs_benchmark_payment_variance
FROM (SELECT {G}, {_MEASURES}, avg(expected_85em) AS expected_amount_85_em_invoice_level FROM lines GROUP BY {G}) m
JOIN (SELECT {G}, sum(expected_payment) AS expected_payment, sum(benchmark_payment) AS benchmark_payment
      FROM granular GROUP BY {G}) k ON {same("m", "k", G)}""",
    "lines",
    "granular",
)
WEEKLY_DOUBLES = (
    MEASURE_DOUBLES + " expected_amount_85_em_invoice_level expected_payment benchmark_payment actual_rate_per_visit "
    "revenue_variance revenue_variance_pct expected_vs_benchmark_payment_variance"
)


def label(reference: str) -> str:
    d = div(f"payment_amount - {reference}", reference)
    return f"""CASE WHEN {d} IS NULL THEN 'No Data' WHEN {d} > 0.05 THEN 'Over Performing'
    WHEN {d} < -0.05 THEN 'Under Performing' ELSE 'Average Performance' END"""


cte(
    "diagnostics",
    f"""
SELECT w.*, payment_amount - expected_payment AS revenue_variance_vs_85em_dollar,
  {div("payment_amount - expected_payment", "expected_payment")} AS revenue_variance_vs_85em_pct,
  payment_amount - benchmark_payment AS revenue_variance_vs_benchmark_dollar,
  {div("payment_amount - benchmark_payment", "benchmark_payment")} AS revenue_variance_vs_benchmark_pct,
  {label("expected_payment")} AS performance_label_vs_85em,
  {label("benchmark_payment")} AS performance_label_vs_benchmark,
  {", ".join(f"b.{m}_avg" for m in BASELINE_METRICS)}
FROM weekly w JOIN (SELECT {D}, {", ".join(f"avg({m}) AS {m}_avg" for m in BASELINE_METRICS)} FROM weekly GROUP BY {D}) b
  ON {same("w", "b", D)}""",
    "weekly",
)
DIAGNOSTIC_DOUBLES = (
    WEEKLY_DOUBLES
    + " revenue_variance_vs_85em_dollar revenue_variance_vs_85em_pct revenue_variance_vs_benchmark_dollar "
    + "revenue_variance_vs_benchmark_pct "
    + " ".join(f"{m}_avg" for m in BASELINE_METRICS)
)
cte(
    "flags",
    """
SELECT *, CASE WHEN visit_count > (SELECT avg(visit_count) FROM diagnostics) AND over_performed_85em = 0
    THEN 1 ELSE 0 END AS volume_without_revenue_lift
FROM (SELECT *, """
    + ", ".join(
        f"CASE WHEN performance_label_vs_{lens} = '{text}' THEN 1 ELSE 0 END AS {name}_{lens}"
        for lens in ("85em", "benchmark")
        for name, text in (
            ("over_performed", "Over Performing"),
            ("under_performed", "Under Performing"),
            ("average_performance", "Average Performance"),
        )
    )
    + " FROM diagnostics)",
    "diagnostics",
)

# --- Shortfalls ---------------------------------------------------------------------------------------------------
_SHORT = "CASE WHEN {a} < 0 THEN {a} ELSE 0.0 END AS se, CASE WHEN {b} < 0 THEN {b} ELSE 0.0 END AS sb"
cte(
    "short_weekly",
    f"SELECT *, {_SHORT.format(a='revenue_variance', b='expected_vs_benchmark_payment_variance')} FROM weekly",
    "weekly",
)
cte(
    "short_granular",
    f"SELECT *, {_SHORT.format(a='(payment_amount - expected_payment)', b='(expected_payment - benchmark_payment)')} FROM granular",
    "granular",
)
SHORT_SUMS = """sum(se) AS shortfall_vs_expected, sum(sb) AS shortfall_vs_benchmark,
  sum(sb - se) AS incremental_shortfall_vs_benchmark, CAST(sum(visit_count) AS BIGINT) AS total_visit_count,
  abs(sum(se)) AS shortfall_vs_expected_abs, abs(sum(sb)) AS shortfall_vs_benchmark_abs,
  abs(sum(sb - se)) AS incremental_shortfall_vs_benchmark_abs"""
SHORT_DOUBLES = (
    "shortfall_vs_expected shortfall_vs_benchmark incremental_shortfall_vs_benchmark shortfall_vs_expected_abs "
    "shortfall_vs_benchmark_abs incremental_shortfall_vs_benchmark_abs"
)
cte(
    "key_variance",
    f"""SELECT {KEYS}, payment_amount - expected_payment AS v85,
  {div("payment_amount - expected_payment", "expected_payment")} AS p85, payment_amount - benchmark_payment AS vb,
  {div("payment_amount - benchmark_payment", "benchmark_payment")} AS pb FROM granular""",
    "granular",
)
cte(
    "under_summary",
    f"""
SELECT {", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in G.split(", "))},
  coalesce(t85, 0) AS total_underpayment_85em, coalesce(a85, 0) AS avg_underpayment_pct_85em,
  coalesce(n85, 0) AS records_85em, coalesce(tb, 0) AS total_underpayment_benchmark,
  coalesce(ab, 0) AS avg_underpayment_pct_benchmark, coalesce(nb, 0) AS records_benchmark
FROM (SELECT {G}, sum(v85) AS t85, avg(p85) AS a85, count(v85) AS n85 FROM key_variance WHERE v85 < 0 GROUP BY {G}) a
FULL JOIN (SELECT {G}, sum(vb) AS tb, avg(pb) AS ab, count(vb) AS nb FROM key_variance WHERE vb < 0 GROUP BY {G}) b
  ON {same("a", "b", G)}""",
    "key_variance",
)
cte(
    "cpt_summary",
    f"""
SELECT {G}, cpt_code, CAST(sum(v) AS BIGINT) AS total_visits, avg(p / nullif(v, 0)) AS avg_actual_rate,
  avg(e) AS avg_expected_rate_85em, coalesce(sum((p / nullif(v, 0) - e) * v), 0) AS total_dollar_impact_vs_85em,
  coalesce(bool_or(p / nullif(v, 0) - e < 0), false) AS underpaid_flag
FROM (SELECT {KEYS}, cpt_code, sum(payment_amount) AS p, count(DISTINCT invoice_number) AS v, avg(expected_85em) AS e
      FROM keyed GROUP BY {KEYS}, cpt_code)
GROUP BY {G}, cpt_code""",
    "keyed",
)

# --- Compact model ------------------------------------------------------------------------------------------------
cte(
    "gaps",
    f"""SELECT *, charge_amount * 0.85 AS benchmark_85_percent, payment_amount - charge_amount * 0.85 AS gap_vs_85_percent,
  {div("payment_amount - charge_amount * 0.85", "charge_amount * 0.85")} * 100 AS gap_percent_vs_85 FROM lines""",
    "lines",
)


def round2(c: str) -> str:
    return f"round_even(({c}) * 100, 0) / 100"


def gap_by(key: str) -> str:
    return f"""SELECT *, {round2(div("total_payments", "total_charges") + " * 100")} AS collection_rate FROM (
  SELECT {key}, {round2("avg(gap_vs_85_percent)")} AS avg_gap, {round2("sum(gap_vs_85_percent)")} AS total_gap,
    count(gap_vs_85_percent) AS transaction_count, {round2("sum(charge_amount)")} AS total_charges,
    {round2("sum(payment_amount)")} AS total_payments
  FROM gaps WHERE {key} IS NOT NULL GROUP BY {key})"""


cte("payer_gaps", gap_by("payer"), "gaps")
GAP_DOUBLES = "avg_gap total_gap total_charges total_payments collection_rate"


def simple_week(keys: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    rate = div("sum(payment_amount)", "sum(charge_amount)")
    return f"""SELECT {keys}, sum(charge_amount) AS charge_amount, sum(payment_amount) AS payment_amount,
  count(*) AS visit_count, {rate} AS collection_rate, ({rate} - 0.85) * 100 AS performance_vs_85
FROM lines WHERE {present} GROUP BY {keys}"""


# --- Scored rows: the key benchmarks stand in for a model's prediction ---------------------------------------------
cte(
    "scored",
    f"""
SELECT *, actual_rate_per_visit - ml_expected_rate_per_visit AS ml_rate_gap,
  (actual_rate_per_visit - ml_expected_rate_per_visit) * visit_count AS ml_dollar_gap,
  CASE WHEN actual_rate_per_visit - ml_expected_rate_per_visit IS NOT NULL THEN
    CASE WHEN abs(actual_rate_per_visit - ml_expected_rate_per_visit) >= 10 THEN 1 ELSE 0 END END AS ml_material_gap_flag
FROM (SELECT *, floor({div("benchmark_payment", "visit_count")} + 0.3) AS ml_expected_rate_per_visit FROM weekly)""",
    "weekly",
)
SCORE_DOUBLES = "ml_expected_rate_per_visit ml_rate_gap ml_dollar_gap"
cte(
    "spots",
    f"""SELECT {G}, coalesce(sum(ml_dollar_gap), 0) AS ml_dollar_gap_sum,
  CAST(coalesce(sum(ml_material_gap_flag), 0) AS BIGINT) AS ml_material_flag_sum, avg(ml_rate_gap) AS ml_rate_gap_mean
FROM scored GROUP BY {G}""",
    "scored",
)


def fixed2(c: str, sign: str = "") -> str:
    return f"printf('%{sign}.2f', round_even(({c}) * 100, 0) / 100)"


def thousands(c: str, digits: int) -> str:
    """Text with thousands separators of a non-negative number."""
    scaled = f"CAST(round_even(({c}) * {10 ** digits}, 0) AS BIGINT)"
    whole = f"format('{{:,}}', {scaled} // {10 ** digits})"
    if digits == 0:
        return f"format('{{:,}}', {scaled})"
    return f"{whole} || '.' || lpad(CAST({scaled} % {10 ** digits} AS VARCHAR), {digits}, '0')"


# --- Narratives ---------------------------------------------------------------------------------------------------
_METRICS = [
    ("charge_billed_balance", "Charge Billed Balance", 0),
    ("zero_balance_collection_star_charges", "Zero Balance - Collection * Charges", 0),
    ("nrv_zero_balance", "NRV Zero Balance*", 1),
    ("zero_balance_collection_rate", "Zero Balance Collection Rate", 1),
    ("collection_rate", "Collection Rate*", 1),
    ("payment_amount", "Payment Amount*", 1),
    ("denial_percent", "Denial %", 0),
    ("nrv_gap_dollar", "NRV Gap ($)", 0),
    ("nrv_gap_percent", "NRV Gap (%)", 0),
    ("remaining_charges_percent", "% of Remaining Charges", 0),
    ("nrv_gap_sum_dollar", "NRV Gap Sum ($)", 0),
]
cte(
    "sentences",
    """
SELECT year, week, subject, CASE WHEN star AND av < 0 AND act >= 0 THEN CASE WHEN act = 0 THEN 'good' ELSE 'bad' END
    WHEN (act > av AND up = 1) OR (act < av AND up = 0) THEN 'good' ELSE 'bad' END AS side,
  abs((act - av) / av) * 100.0 AS pct,
  subject || ' from avg ' || """
    + fixed2("av")
    + " || ' to ' || "
    + fixed2("act")
    + """ AS text
FROM (SELECT *, coalesce(payer, 'nan') || ' – ' || coalesce(group_em, 'nan') || ' ' || name ||
        CASE WHEN act > av THEN ' increased' ELSE ' decreased' END AS subject FROM ("""
    + "\nUNION ALL ".join(
        f"SELECT year, week, payer, group_em, '{name}' AS name, {up} AS up, {str(m.endswith('star_charges')).lower()} AS star, "
        f"{m} AS act, {m}_avg AS av FROM diagnostics"
        for m, name, up in _METRICS
    )
    + ") WHERE act IS NOT NULL AND av <> 0)",
    "diagnostics",
)
cte(
    "top_sentences",
    """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY year, week, side ORDER BY prio, pct DESC, text) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY year, week, side, subject ORDER BY pct DESC, text) AS same_subject,
      CASE upper(trim(split_part(subject, '–', 1))) WHEN 'BCBS' THEN 0 WHEN 'AETNA' THEN 1 WHEN 'MEDICAID' THEN 2
        WHEN 'SELF PAY' THEN 3 WHEN 'UNITED HEALTHCARE' THEN 4 WHEN 'CIGNA' THEN 5 WHEN 'HUMANA' THEN 6
        WHEN 'TRICARE' THEN 7 WHEN 'MEDICARE' THEN 8 ELSE 9 END AS prio
    FROM sentences) WHERE same_subject = 1) WHERE rank <= 6""",
    "sentences",
)
cte(
    "revenue_cycle",
    """
SELECT w.year, w.week, coalesce(g, '') AS went_well, coalesce(b, '') AS can_improve
FROM (SELECT DISTINCT year, week FROM diagnostics) w
LEFT JOIN (SELECT year, week, string_agg(text, '; ' ORDER BY rank) FILTER (side = 'good') AS g,
    string_agg(text, '; ' ORDER BY rank) FILTER (side = 'bad') AS b FROM top_sentences GROUP BY 1, 2) t
  ON w.year = t.year AND w.week = t.week""",
    "diagnostics",
    "top_sentences",
)
cte(
    "zero_groups",
    f"""SELECT {G}, avg(zero_balance_collection_rate) AS zero_balance_collection_rate, avg(collection_rate) AS collection_rate
FROM weekly GROUP BY {G}""",
    "weekly",
)
cte(
    "zero_balance",
    f"""
SELECT *, payer || ' – ' || group_em || ' – ' || group_em2 || ' – ' || zero_balance_text AS zero_balance_narrative
FROM (SELECT g.*, zbcr_baseline, cr_baseline,
    CASE WHEN zero_balance_collection_rate IS NULL OR zbcr_baseline IS NULL OR collection_rate IS NULL OR cr_baseline IS NULL
        THEN 'Collection data incomplete'
      WHEN zero_balance_collection_rate < 0.75 * zbcr_baseline THEN 'Below baseline'
      WHEN zero_balance_collection_rate > 1.25 * zbcr_baseline OR zero_balance_collection_rate > 1.2 * cr_baseline
        THEN 'Above baseline' ELSE 'Normal range' END AS zero_balance_text
  FROM zero_groups g JOIN (SELECT {D}, avg(zero_balance_collection_rate) AS zbcr_baseline, avg(collection_rate) AS cr_baseline
      FROM zero_groups GROUP BY {D}) b ON {same("g", "b", D)})""",
    "zero_groups",
)
cte(
    "zero_texts",
    """SELECT year, week, coalesce(string_agg(s, '; ' ORDER BY s), '') AS zero_balance_narrative
FROM (SELECT DISTINCT year, week, zero_balance_narrative AS s FROM zero_balance) GROUP BY 1, 2""",
    "zero_balance",
)


# --- Validation ---------------------------------------------------------------------------------------------------
def close(a: str, b: str, rtol: str, atol: str = "1e-6") -> str:
    x, y = f"coalesce({a}, 0)", f"coalesce({b}, 0)"
    return f"(({a} IS NULL AND {b} IS NULL) OR abs({x} - {y}) <= {atol} + {rtol} * abs({y}))"


# Processed lines with some wrong values, so that the checks have something to find.
cte(
    "processed",
    """
SELECT k.*, CASE WHEN row_id % 20 = 0 THEN invoice_total_payment + 5 ELSE invoice_total_payment END AS invoice_total_payment,
  benchmark_avg_payment, CASE WHEN row_id % 30 = 0 THEN NULL ELSE expected_amount_85_em_invoice_level END
    AS expected_amount_85_em_invoice_level,
  benchmark_payment_amount,
  invoice_total_payment - benchmark_avg_payment AS revenue_variance_benchmark_dollar,
  CASE WHEN row_id % 40 = 0 THEN nrv_gap_dollar + 1 ELSE nrv_gap_dollar END AS nrv_gap_dollar_invoice_level,
  nrv_gap_pct AS nrv_gap_percent_invoice_level, nrv_gap_sum_dollar AS nrv_gap_sum_dollar_invoice_level
FROM keyed k JOIN totals USING (benchmark_key, invoice_number) JOIN averages USING (benchmark_key)
JOIN key_rates USING (benchmark_key)""",
    "keyed",
    "totals",
    "averages",
    "key_rates",
)
cte(
    "sample",
    """SELECT invoice_number FROM (SELECT DISTINCT invoice_number FROM lines)
ORDER BY md5(invoice_number || ':42'), invoice_number LIMIT 30""",
    "lines",
)
cte(
    "sample_pairs",
    """
SELECT p.benchmark_key, p.invoice_number, p.invoice_total_payment AS a1, t.invoice_total_payment AS b1,
  p.expected_amount_85_em_invoice_level AS a2, e.rate AS b2, p.revenue_variance_benchmark_dollar AS a3,
  t.invoice_total_payment - v.benchmark_avg_payment AS b3
FROM processed p JOIN sample USING (invoice_number) JOIN totals t USING (benchmark_key, invoice_number)
JOIN averages v USING (benchmark_key)
JOIN (SELECT benchmark_key, avg(expected_85em) AS rate FROM keyed JOIN sample USING (invoice_number) GROUP BY 1) e
  USING (benchmark_key)""",
    "processed",
    "sample",
    "totals",
    "averages",
    "keyed",
)
cte(
    "sample_details",
    "\nUNION ALL ".join(
        f"SELECT benchmark_key, invoice_number, '{x} vs {y}' AS \"check\", a{i} AS processed_value, b{i} AS recalc_value, "
        f"a{i} - b{i} AS delta, {close(f'coalesce(a{i}, 0)', f'coalesce(b{i}, 0)', r)} AS match FROM sample_pairs"
        for i, x, y, r in (
            (1, "invoice_total_payment", "invoice_total_payment_recalc", "1e-3"),
            (2, "expected_amount_85_em_invoice_level", "expected_amount_85_em_recalc", "1e-3"),
            (3, "revenue_variance_benchmark_dollar", "variance_against_benchmark_recalc", "1e-2"),
        )
    ),
    "sample_pairs",
)


# --- Elastic net: fold 0 trains on all rows, folds 1 to 5 on what lies before their test block -------------------------
_SWEEPS, _L1, _L2 = 250, 0.1 * 0.2, 0.1 * 0.8
cte(
    "elastic_rows",
    f"""SELECT * REPLACE (CAST(visit_count AS DOUBLE) AS visit_count), actual_rate_per_visit AS y,
  row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in G.split(", "))}) - 1 AS ord
FROM weekly WHERE actual_rate_per_visit IS NOT NULL""",
    "weekly",
)
cte(
    "elastic_folds",
    """SELECT fold, n // 6 AS size, CASE fold WHEN 0 THEN n ELSE n - (6 - fold) * (n // 6) END AS start
FROM (SELECT count(*) AS n FROM elastic_rows), (SELECT unnest(range(0, 6)) AS fold)""",
    "elastic_rows",
)
cte(
    "elastic_medians",
    f"SELECT fold, {', '.join(f'median({c}) AS {c}' for c in ML_NUMERIC)} FROM elastic_rows JOIN elastic_folds ON ord < start GROUP BY fold",
    "elastic_rows",
    "elastic_folds",
)
cte(
    "elastic_features",
    f"""
SELECT fold, ord, start, y, name, v FROM (SELECT fold, ord, start, y,
    unnest([{", ".join(f"'{c}'" for c in ML_NUMERIC)}, {", ".join(f"'{c}=' || coalesce(r.{c}, 'nan')" for c in D.split(", "))}]) AS name,
    unnest([{", ".join(f"coalesce(r.{c}, m.{c})" for c in ML_NUMERIC)}, 1.0, 1.0, 1.0]) AS v
  FROM elastic_rows r JOIN elastic_folds f ON ord < start + size JOIN elastic_medians m USING (fold))
WHERE v IS NOT NULL""",
    "elastic_rows",
    "elastic_folds",
    "elastic_medians",
)
cte(
    "elastic_names",
    """SELECT fold, name, row_number() OVER (PARTITION BY fold ORDER BY name) AS j, start AS n, sum(v) / start AS mean, sum(v * y) / start AS vy
FROM elastic_features WHERE ord < start GROUP BY fold, name, start""",
    "elastic_features",
)
cte("elastic_level", "SELECT fold, avg(y) AS level FROM elastic_rows JOIN elastic_folds ON ord < start GROUP BY fold", "elastic_rows", "elastic_folds")
cte(
    "elastic_matrix",
    """
SELECT fold, list(list_concat([CAST(j AS DOUBLE), vy - mean * level], second) ORDER BY j) AS m
FROM (SELECT a.fold, a.j, a.vy, a.mean, list(coalesce(s.s, 0) / a.n - a.mean * b.mean ORDER BY b.j) AS second
  FROM elastic_names a JOIN elastic_names b ON a.fold = b.fold
  LEFT JOIN (SELECT p.fold, p.name AS x, q.name AS z, sum(p.v * q.v) AS s FROM elastic_features p
    JOIN elastic_features q ON p.fold = q.fold AND p.ord = q.ord WHERE p.ord < p.start GROUP BY 1, 2, 3) s ON s.fold = a.fold AND s.x = a.name AND s.z = b.name
  GROUP BY 1, 2, 3, 4) JOIN elastic_level USING (fold)
GROUP BY fold""",
    "elastic_names",
    "elastic_features",
    "elastic_level",
)
cte(
    "elastic_weights",
    f"""
SELECT fold, unnest(w) AS weight, unnest(range(1, len(w) + 1)) AS j FROM (
  WITH RECURSIVE sweeps AS (
    SELECT fold, 0 AS sweep, list_transform(m, lambda g: CAST(0 AS DOUBLE)) AS w FROM elastic_matrix
    UNION ALL
    SELECT sweeps.fold, sweep + 1, list_reduce(list_prepend(w, m), lambda now, g: list_concat(list_concat(now[1:CAST(g[1] AS INTEGER) - 1],
      list_transform([g[2] - list_dot_product(g[3:], now) + g[2 + CAST(g[1] AS INTEGER)] * now[CAST(g[1] AS INTEGER)]],
        lambda rho: sign(rho) * greatest(abs(rho) - {_L1!r}, 0) / (g[2 + CAST(g[1] AS INTEGER)] + {_L2!r}))), now[CAST(g[1] AS INTEGER) + 1:]))
    FROM sweeps JOIN elastic_matrix ON elastic_matrix.fold = sweeps.fold WHERE sweep < {_SWEEPS})
  SELECT fold, w FROM sweeps WHERE sweep = {_SWEEPS})""",
    "elastic_matrix",
)
cte(
    "elastic_fitted",
    """
SELECT x.fold, x.ord, x.start, any_value(x.y) AS y, any_value(b.constant) + sum(v * weight) AS expected
FROM elastic_features x JOIN elastic_names n USING (fold, name) JOIN elastic_weights w ON w.fold = x.fold AND w.j = n.j
JOIN (SELECT l.fold, any_value(level) - sum(mean * weight) AS constant FROM elastic_level l JOIN elastic_names n ON n.fold = l.fold
  JOIN elastic_weights w ON w.fold = n.fold AND w.j = n.j GROUP BY l.fold) b ON b.fold = x.fold
GROUP BY x.fold, x.ord, x.start""",
    "elastic_features",
    "elastic_names",
    "elastic_weights",
    "elastic_level",
)
cte(
    "elastic_cv",
    """SELECT CAST(fold AS INTEGER) AS fold, avg(abs(y - expected)) AS mae, sqrt(avg((y - expected) ** 2)) AS rmse,
  1 - avg((y - expected) ** 2) / var_pop(y) AS r2 FROM elastic_fitted WHERE fold > 0 AND ord >= start GROUP BY fold""",
    "elastic_fitted",
)
cte(
    "elastic_scored",
    f"""
SELECT *, CASE WHEN ml_rate_gap IS NOT NULL THEN CAST(abs(ml_rate_gap) >= 10 AS INTEGER) END AS ml_material_gap_flag
FROM (SELECT {G}, visit_count, expected AS ml_expected_rate_per_visit, y - expected AS ml_rate_gap, (y - expected) * visit_count AS ml_dollar_gap
  FROM (SELECT {G}, visit_count, ord FROM elastic_rows UNION ALL SELECT {G}, visit_count, NULL FROM weekly WHERE actual_rate_per_visit IS NULL) r
  LEFT JOIN (SELECT ord, y, expected FROM elastic_fitted WHERE fold = 0) e USING (ord))""",
    "elastic_rows",
    "weekly",
    "elastic_fitted",
)
