import pytest
from pyspark.sql import functions as F

from remitlens.contracts import BASELINE_METRICS, GROUP_KEYS
from remitlens.functions.text import zero_balance_text
from remitlens.operators import compact, diagnostics, narratives
from tests.samples import plain

STAR = "zero_balance_collection_star_charges"
SCHEMA = (
    "year int, week int, payer string, group_em string, group_em2 string, "
    + ", ".join(f"{m} double, {m}_avg double" for m in BASELINE_METRICS)
)


def weekly_row(payer="A", group_em="g", group_em2="h", week=1, **metrics):
    """A row without any metric but those given as name=(actual, average)."""
    values = []
    for m in BASELINE_METRICS:
        values += list(metrics.get(m, (None, None)))
    return (2024, week, payer, group_em, group_em2, *values)


def texts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.week: (r.went_well, r.can_improve) for r in narratives.revenue_cycle(df).collect()}


def sides(spark, **metrics):
    well, improve = texts(spark, [weekly_row(**metrics)])[1]
    return bool(well), bool(improve)


@pytest.mark.parametrize(
    "metric, act, avg, good",
    [
        ("payment_amount", 2.0, 1.0, True),
        ("payment_amount", 1.0, 2.0, False),
        ("payment_amount", 1.0, 1.0, False),
        ("denial_percent", 0.1, 0.2, True),
        ("denial_percent", 0.2, 0.1, False),
        (STAR, 0.0, -5.0, True),
        (STAR, 3.0, -5.0, False),
        (STAR, -9.0, -5.0, True),
        (STAR, -2.0, -5.0, False),
        (STAR, 0.0, 5.0, True),
    ],
)
def test_polarity(spark, metric, act, avg, good):
    assert sides(spark, **{metric: (act, avg)}) == (good, not good)


def test_missing_and_zero_averages_say_nothing(spark):
    assert texts(spark, [weekly_row(payment_amount=(1.0, 0.0), denial_percent=(None, 1.0))]) == {1: ("", "")}


def test_sentence_text(spark):
    well, improve = texts(spark, [weekly_row(payer=None, payment_amount=(1234.567, 0.125))])[1]
    assert (well, improve) == ("nan – g Payment Amount* increased from avg 0.12 to 1234.57", "")
    _, same = texts(spark, [weekly_row(payment_amount=(1.0, 1.0))])[1]
    assert same == "A – g Payment Amount* decreased from avg 1.00 to 1.00"


def test_rows_that_differ_in_second_layer_collapse_to_the_largest_change(spark):
    rows = [weekly_row(group_em2="x", payment_amount=(2.0, 1.0)), weekly_row(group_em2="y", payment_amount=(5.0, 1.0))]
    assert texts(spark, rows)[1][0] == "A – g Payment Amount* increased from avg 1.00 to 5.00"


def test_priority_payers_come_first_and_six_remain(spark):
    rows = [weekly_row(payer=f"P{i}", payment_amount=(2.0 + i, 1.0)) for i in range(7)]
    rows += [weekly_row(payer="Medicare", payment_amount=(1.1, 1.0)), weekly_row(payer="bcbs", payment_amount=(1.2, 1.0))]
    rows += [weekly_row(week=2, payment_amount=(None, 1.0))]
    got = texts(spark, rows)
    payers = [s.split(" – ")[0] for s in got[1][0].split("; ")]
    assert payers == ["bcbs", "Medicare", "P6", "P5", "P4", "P3"]
    assert got[2] == ("", "")


def test_zero_balance_bands(spark):
    rows = [(0.7, 1.0, 1.0, 1.0), (1.3, 1.0, 1.0, 9.0), (1.21, 1.0, 1.0, 1.0), (0.75, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "z double, c double, zb double, cb double")
    got = [r[0] for r in df.select(zero_balance_text(*[F.col(c) for c in ("z", "c", "zb", "cb")])).collect()]
    incomplete = "Collection data incomplete"
    assert got == ["Below baseline", "Above baseline", "Above baseline", "Normal range", incomplete, incomplete]


def test_zero_balance_summary_skips_missing_names(spark):
    schema = "year int, week int, payer string, group_em string, group_em2 string, zero_balance_collection_rate double, collection_rate double"
    rows = [(1, 1, "B", "g", "h", 1.0, 1.0), (1, 1, "A", "g", "h", 1.0, 1.0), (1, 1, None, "g", "h", 1.0, 1.0)]
    out = narratives.join_text(narratives.zero_balance(spark.createDataFrame(rows, schema))).first()
    assert out.zero_balance_narrative == "A – g – h – Normal range; B – g – h – Normal range"


def gaps(spark, rows):
    return spark.createDataFrame(rows, "payer string, charge_amount double, payment_amount double, gap_vs_85_percent double")


def overall(spark, rows, **options):
    df = gaps(spark, rows)
    return [r.text for r in narratives.overall_narrative(df, compact.gap_drivers(df, "payer"), **options).orderBy("n").collect()]


def test_overall_narrative_and_its_legacy_form(spark):
    rows = [("A", 10.0, 5.0, -1000.0), ("B", 10.0, 5.0, -3000.5), ("C", 10.0, 5.0, 5.0)]
    first, worst = overall(spark, rows)
    assert "underperforming by $3,995.50 against" in first and "average gap of $1331.83 per" in first
    assert "Driver: B shows the largest average gap ($-3000.50) and represents $-3,000.50 in" in worst
    first, worst = overall(spark, rows, legacy_text=True)
    assert "exceeding the 85% benchmark by $3,995.50." in first
    assert "Driver: A shows the largest average gap ($-3000.50)" in worst


@pytest.mark.parametrize("r2, word, share", [(0.71, "strong", "71.0%"), (0.7, "moderate", "70.0%"), (0.5, "limited", "50.0%"), (-0.1234, "limited", "-12.3%")])
def test_model_quality_line(spark, r2, word, share):
    metrics = spark.createDataFrame([(r2,)], "r2 double")
    lines = overall(spark, [("A", 1.0, 1.0, 1.0)], metrics=metrics)
    assert len(lines) == 3 and f"shows {word} predictive power (R²={share})" in lines[1]


def weekly_table(spark):
    schema = "year int, week int, payer string, group_em string, group_em2 string, visit_count bigint, payment_amount double, expected_payment double, benchmark_payment double, zero_balance_collection_rate double, collection_rate double"
    rows = [
        (2024, 1, "A", "g", "h", 10, 50.0, 100.0, 50.0, 0.5, 0.5),
        (2024, 2, "A", "g", "h", 1, 200.0, 100.0, None, 0.9, 0.5),
        (2024, 1, None, "g", "h", 1, 100.0, None, 0.0, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def test_diagnostics_flags_and_narratives_together(spark):
    base = diagnostics.diagnostics_base(weekly_table(spark))
    out = narratives.narratives(base)
    got = plain(out, GROUP_KEYS)
    a1 = got[2024, 1, "A", "g", "h"]
    assert (a1["performance_label_vs_85em"], a1["under_performed_85em"], a1["volume_without_revenue_lift"]) == ("Under Performing", 1, 1)
    assert a1["average_performance_benchmark"] == 1 and a1["ml_narrative_summary"] == ""
    assert a1["payment_amount_avg"] == 125.0 and "Payment Amount* decreased from avg 125.00 to 50.00" in a1["can_improve"]
    none = got[2024, 1, None, "g", "h"]
    assert none["performance_label_vs_85em"] == none["performance_label_vs_benchmark"] == "No Data"
    scored = base.withColumns({"hgb_rate_gap": F.lit(-2.0), "hgb_dollar_gap": F.lit(-20.0), "hgb_material_gap_flag": F.lit(0)})
    row = narratives.narratives(scored).filter("payer = 'A'").first()
    assert row.ml_narrative_summary == "ML signals under-payment ≈ $20 (0 material flags; avg rate gap -2.00/visit)."


def test_expected_fallback_only_without_any_value(spark):
    df = weekly_table(spark).withColumn("expected_amount_85_em_invoice_level", F.lit(3.0))
    kept = [r.expected_payment for r in diagnostics.expected_fallback(df).orderBy("week", "payer").collect()]
    assert kept == [None, 100.0, 100.0]
    empty = df.withColumn("expected_payment", F.lit(None).cast("double"))
    for table in (empty, df.drop("expected_payment")):
        got = [r.expected_payment for r in diagnostics.expected_fallback(table).orderBy("week", "payer").collect()]
        assert got == [3.0, 30.0, 3.0]


def test_benchmark_lens_without_a_benchmark(spark):
    out = diagnostics.diagnostics_base(weekly_table(spark).drop("benchmark_payment"))
    assert {r.performance_label_vs_benchmark for r in out.collect()} == {"No Data"}
    assert out.filter("revenue_variance_vs_benchmark_dollar is not null").count() == 0
