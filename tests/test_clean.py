from pyspark.sql import functions as F

from remitlens.operators import clean
from remitlens.sources import columns


def test_blank_and_nan_become_null(spark):
    df = spark.createDataFrame([(" ", float("nan"), 1), (" x ", 2.0, None), ("\t", 0.0, 3)], "s string, d double, i int")
    assert [tuple(r) for r in clean.blank_to_null(df).collect()] == [(None, None, 1), (" x ", 2.0, None), (None, 0.0, 3)]


def test_total_rows(spark):
    rows = [("Total", 1), (" grand   TOTAL ", 2), ("Total care", 3), (None, 4), ("subtotal", 5)]
    df = spark.createDataFrame(rows, "payer string, n int")
    assert {r.n for r in clean.drop_total_rows(df).collect()} == {3, 4, 5}
    weeks = spark.createDataFrame([("2024 grand total", "0", 1), ("2024 grand total", "1", 2), (None, "0", 3)], "year string, week string, n int")
    assert {r.n for r in clean.drop_total_rows(weeks).collect()} == {2, 3}
    assert clean.drop_total_rows(weeks.select("n")).count() == 3


def test_required_fields_are_checked_before_text_casts(spark):
    df = spark.createDataFrame([(1, "a", "i"), (2, None, "i"), (3, "a", None)], "n int, payer string, invoice_number string")
    good, bad = clean.split_required(df, ["payer", "invoice_number"])
    assert [r.n for r in good.collect()] == [1] and {r.n for r in bad.collect()} == {2, 3}


def test_zero_payment(spark):
    schema = "payment_amount double, payment_per_visit double, nrv_zero_balance double, zero_balance_collection_rate double, collection_rate double, zero_balance_collection_star_charges double, charge_billed_balance double"
    df = spark.createDataFrame([(0.0, 1.0, 1.0, 1.0, 1.0, 5.0, 7.0), (2.0, 1.0, 1.0, 1.0, 1.0, 5.0, 7.0), (None, 1.0, 1.0, 1.0, 1.0, 5.0, 7.0)], schema)
    got = [tuple(r) for r in clean.zero_payment_rules(df).collect()]
    assert got[0] == (0.0, 0.0, 0.0, 0.0, 0.0, 7.0, 7.0) and got[1][1:] == (1.0, 1.0, 1.0, 1.0, 5.0, 7.0) and got[2][1:] == got[1][1:]


def test_coerce_by_class_uses_column_names(spark):
    df = spark.createDataFrame([("5%", "1,2", "7", "x", "Week 3")], ["Denial %", "Charge Amount", "Visit Count", "note", "ISO Week of Visit Service Date"])
    assert tuple(clean.coerce_by_class(df).first()) == (0.0, 0.0, 7.0, "x", "Week 3")


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["Unnamed: 0", " Invoice Number ", "Lab per Visit (copy)", "Primary Financial Class", "a.b"])
    out = columns.standardize_columns(columns.drop_unnamed(df))
    assert out.columns == ["invoice_number", "labs_per_visit", "payer", "a.b"]
    both = spark.createDataFrame([(1, 2)], ["Lab per Visit", "Lab per Visit (copy)"])
    assert columns.standardize_columns(both).columns == ["labs_per_visit", "Lab per Visit (copy)"]


def test_billed_balance_from_another_column(spark):
    df = spark.createDataFrame([("3",), ("x",)], ["SP Charge Billed Open Balance"])
    assert [r.charge_billed_balance for r in columns.billed_balance(df).collect()] == [3.0, 0.0]


def test_report_end_to_end(spark):
    schema = "row_id bigint, `Year of Visit Service Date` string, `ISO Week of Visit Service Date` string, `Primary Financial Class` string, `Chart E/M Code Grouping` string, `Chart E/M Code Second Layer` string, `Charge Invoice Number` string, `Charge CPT Code` string, `Charge Amount` string, `Payment Amount*` string, `Charge Billed Balance` string, `Avg. Charge E/M Weight` string, `Unnamed: 0` string"
    rows = [
        (0, None, None, None, None, None, None, "9", "10", "5", "5", "1", "0"),
        (1, "2024.0", "Week 07", "A", "New E/M Code", "s", "i1", " 10 ", "100", "0", "40", "1.5", "1"),
        (2, " ", None, None, None, None, None, "11", "0", "5", "40", "2.5", "2"),
        (3, None, "Week 8", "B", "Other", None, "i2", None, "1", "1", "1", "3", "3"),
        (4, None, None, None, None, None, None, "12", "50", "x", "5", "3", "4"),
    ]
    good, bad = clean.clean_report(spark.createDataFrame(rows, schema).repartition(3))
    assert {r.row_id for r in bad.collect()} == {0, 3}
    got = {r.row_id: r for r in good.collect()}
    assert set(got) == {1, 2, 4}
    assert (got[1].year, got[1].week, got[1].cpt_code, got[1].remaining_charges_pct) == (2024, 7, "10", 0.4)
    assert got[1].zero_balance_collection_star_charges == 40.0
    assert (got[2].invoice_number, got[2].remaining_charges_pct, got[2].avg_charge_em_weight) == ("i1", 0.0, 2.5)
    assert (got[4].year, got[4].week, got[4].payer, got[4].group_em2, got[4].invoice_number) == (2024, 8, "B", "s", "i2")
    assert (got[4].payment_amount, got[4].avg_charge_em_weight) == (0.0, 0.0)


def test_ensure_and_normalize(spark):
    df = spark.createDataFrame([("5%", "1,000")], "p string, n string")
    out = columns.normalize_columns(columns.ensure_columns(df, {"z": 0.0, "m": None, "p": 9.0}), ["p", "gone"], ["n"])
    assert tuple(out.first()) == (0.05, 1000.0, 0.0, None)
    shown = columns.present(df.select(F.lit(0.25).alias("collection_rate"), F.lit("a").alias("payer")))
    assert shown.columns == ["Collection_Rate", "Payer"] and tuple(shown.first()) == ("25%", "a")
