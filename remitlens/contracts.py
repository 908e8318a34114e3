"""Table contracts: column names, groupings and thresholds shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# --- Groupings -------------------------------------------------------------------------------------------------
DIMS = ["payer", "group_em", "group_em2"]
TIME = ["year", "week"]
GROUP_KEYS = TIME + DIMS
KEY_KEYS = GROUP_KEYS + ["benchmark_key"]

# --- Fixed values: source report headers and their canonical names ----------------------------------------------
SOURCE_NAMES = {
    "Year of Visit Service Date": "year",
    "ISO Week of Visit Service Date": "week",
    "Primary Financial Class": "payer",
    "Chart E/M Code Grouping": "group_em",
    "Chart E/M Code Second Layer": "group_em2",
    "Charge Invoice Number": "invoice_number",
    "Charge CPT Code": "cpt_code",
    "Charge Amount": "charge_amount",
    "Payment Amount*": "payment_amount",
    "Expected Amount (85% E/M)": "expected_85em",
    "Charge Billed Balance": "charge_billed_balance",
    "Zero Balance - Collection * Charges": "zero_balance_collection_star_charges",
    "NRV Zero Balance*": "nrv_zero_balance",
    "Zero Balance Collection Rate": "zero_balance_collection_rate",
    "Collection Rate*": "collection_rate",
    "Denial %": "denial_pct",
    "NRV Gap ($)": "nrv_gap_dollar",
    "NRV Gap (%)": "nrv_gap_pct",
    "NRV Gap Sum ($)": "nrv_gap_sum_dollar",
    "% of Remaining Charges": "remaining_charges_pct",
    "Avg. Charge E/M Weight": "avg_charge_em_weight",
    "Lab per Visit": "labs_per_visit",
    "Procedure per Visit": "procedure_per_visit",
    "Radiology Count": "radiology_count",
    "Open Invoice Count": "open_invoice_count",
    "SP Charge Billed Balance": "sp_balance",
    "Insurance Charge Billed Balance": "insurance_balance",
    "Payment per Visit": "payment_per_visit",
    "Fee Schedule Expected Amount": "fee_schedule_expected",
    "Visit Count": "visit_count",
    "Benchmark_Payment_Amount_invoice_level": "benchmark_payment_invoice_level",
}

# Other spellings under which a column may arrive, matched without regard to case and outer blanks.
ALTERNATE_NAMES = {
    "invoice_number": ["invoice_number", "invoice number", "charge invoice number"],
    "cpt_code": ["charge cpt code"],
    "labs_per_visit": ["lab per visit", "labs per visit", "lab per visit (copy)"],
    "year": ["year"],
    "week": ["week"],
    "payer": ["payer"],
    "group_em": ["group_em"],
    "group_em2": ["group_em2"],
}

# Column names of the delivered tables, by canonical name.
DISPLAY_NAMES = {
    "year": "Year",
    "week": "Week",
    "payer": "Payer",
    "group_em": "Group_EM",
    "group_em2": "Group_EM2",
    "invoice_number": "Invoice_Number",
    "benchmark_key": "Benchmark_Key",
    "abbreviated_benchmark_key": "Abbreviate_Benchmark_Key",
    "cpt_list": "CPT_List",
    "cpt_list_str": "CPT_List_Str",
    "cpt_count": "CPT_Count",
    "visit_count": "Visit_Count",
    "group_size": "Group_Size",
    "denial_percent": "Denial_Percent",
    "nrv_gap_percent": "NRV_Gap_Percent",
    "remaining_charges_percent": "Remaining_Charges_Percent",
    "zero_balance_collection_rate": "Zero_Balance_Collection_Rate",
    "collection_rate": "Collection_Rate",
    "payment_amount": "Payment_Amount",
    "charge_amount": "Charge_Amount",
    "expected_payment": "Expected_Payment",
    "benchmark_payment": "benchmark_payment",
    "revenue_variance": "Revenue_Variance",
    "revenue_variance_pct": "Revenue_Variance_Pct",
    "revenue_variance_vs_85em_dollar": "Revenue_Variance_vs_85EM_$",
    "revenue_variance_vs_85em_pct": "Revenue_Variance_vs_85EM_%",
    "revenue_variance_vs_benchmark_dollar": "Revenue_Variance_vs_Benchmark_$",
    "revenue_variance_vs_benchmark_pct": "Revenue_Variance_vs_Benchmark_%",
    "performance_label_vs_85em": "Performance_Label_vs_85EM",
    "performance_label_vs_benchmark": "Performance_Label_vs_Benchmark",
    "shortfall_vs_expected": "Shortfall_vs_Expected_$",
    "shortfall_vs_benchmark": "Shortfall_vs_Benchmark_$",
    "incremental_shortfall_vs_benchmark": "Incremental_Shortfall_vs_Benchmark_$",
    "shortfall_vs_expected_abs": "Shortfall_vs_Expected_Abs_$",
    "shortfall_vs_benchmark_abs": "Shortfall_vs_Benchmark_Abs_$",
    "incremental_shortfall_vs_benchmark_abs": "Incremental_Shortfall_vs_Benchmark_Abs_$",
    "total_visit_count": "Total_Visit_Count",
    "went_well": "Revenue Cycle - What Went Well",
    "can_improve": "Revenue Cycle - What Can Be Improved",
    "zero_balance_narrative": "Zero-Balance Collection Narrative",
    "ml_narrative_summary": "ML_Narrative_Summary",
    "volume_without_revenue_lift": "Volume Without Revenue Lift",
    "over_performed_85em": "Over Performed (85% E/M)",
    "under_performed_85em": "Under Performed (85% E/M)",
    "average_performance_85em": "Average Performance (85% E/M)",
    "over_performed_benchmark": "Over Performed (Benchmark)",
    "under_performed_benchmark": "Under Performed (Benchmark)",
    "average_performance_benchmark": "Average Performance (Benchmark)",
}

# --- Line measures and how a weekly rollup combines them ---------------------------------------------------------
# rollup column -> line column
SUM_MEASURES = {
    "charge_amount": "charge_amount",
    "payment_amount": "payment_amount",
    "charge_billed_balance": "charge_billed_balance",
    "zero_balance_collection_star_charges": "zero_balance_collection_star_charges",
    "nrv_zero_balance": "nrv_zero_balance",
    "nrv_gap_dollar": "nrv_gap_dollar",
    "nrv_gap_sum_dollar": "nrv_gap_sum_dollar",
    "open_invoice_count": "open_invoice_count",
}
MEAN_MEASURES = {
    "avg_charge_em_weight": "avg_charge_em_weight",
    "labs_per_visit": "labs_per_visit",
    "procedure_per_visit": "procedure_per_visit",
    "radiology_count": "radiology_count",
    "zero_balance_collection_rate": "zero_balance_collection_rate",
    "collection_rate": "collection_rate",
    "denial_percent": "denial_pct",
    "nrv_gap_percent": "nrv_gap_pct",
    "remaining_charges_percent": "remaining_charges_pct",
}
GAP_MEASURES = ["nrv_gap_dollar", "nrv_gap_pct", "nrv_gap_sum_dollar"]
LINE_MEASURES = [
    *dict.fromkeys([*SUM_MEASURES.values(), *MEAN_MEASURES.values()]),
    "expected_85em",
    "sp_balance",
    "insurance_balance",
]
WEEKLY_MEASURES = ["visit_count", "group_size", *SUM_MEASURES, *MEAN_MEASURES]

# Metrics with a baseline average; the narratives walk the same list.
BASELINE_METRICS = [
    "charge_billed_balance",
    "zero_balance_collection_star_charges",
    "nrv_zero_balance",
    "zero_balance_collection_rate",
    "collection_rate",
    "payment_amount",
    "denial_percent",
    "nrv_gap_dollar",
    "nrv_gap_percent",
    "remaining_charges_percent",
    "nrv_gap_sum_dollar",
]

PERCENT_COLUMNS = [
    "zero_balance_collection_rate",
    "collection_rate",
    "denial_percent",
    "nrv_gap_percent",
    "remaining_charges_percent",
    "revenue_variance_pct",
    "group_benchmark_payment_diff_pct",
    "revenue_variance_vs_85em_pct",
    "revenue_variance_vs_benchmark_pct",
]

REQUIRED_FIELDS = ["invoice_number", "payer", "group_em", "group_em2", "cpt_code"]
HEADER_FIELDS = ["year", "week", "payer", "group_em", "group_em2", "invoice_number"]
TOTAL_ROW_FIELDS = [*HEADER_FIELDS, "cpt_code", "cpt_list_str"]

ML_NUMERIC = [
    "visit_count",
    "avg_charge_em_weight",
    "labs_per_visit",
    "procedure_per_visit",
    "radiology_count",
    "zero_balance_collection_rate",
    "collection_rate",
    "denial_percent",
    "nrv_gap_dollar",
    "nrv_gap_percent",
    "remaining_charges_percent",
    "expected_payment",
    "benchmark_payment",
]
ML_CATEGORICAL = DIMS


@dataclass(frozen=True)
class Thresholds:
    """Materiality limits, passed explicitly to the operators that use them (fixed default values)."""

    over_pct: float = 0.05
    under_pct: float = -0.05
    weighting_materiality_pct: float = 0.03
    ml_gap_per_visit: float = 10.0
    linear_gap: float = 0.1


DEFAULT_THRESHOLDS = Thresholds()
