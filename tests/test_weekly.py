import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from remitlens.contracts import GROUP_KEYS, KEY_KEYS, MEAN_MEASURES, SUM_MEASURES, WEEKLY_MEASURES
from remitlens.operators import drivers, enhance, keys, weekly
from tests.samples import plain, random_lines, to_spark, with_keys


@pytest.fixture(scope="module")
def frame():
    return with_keys(random_lines())


@pytest.fixture(scope="module")
def lines(spark, frame):
    return to_spark(spark, frame.drop(columns=["cpt_list_str", "benchmark_key"])).repartition(5).cache()


def number(v):
    return None if v is None or pd.isna(v) else round(float(v), 9)


def by_hand(frame, group):
    out = {}
    for key, rows in frame.groupby(group, dropna=False):
        record = {"visit_count": rows.invoice_number.nunique(), "group_size": int(rows.invoice_number.count())}
        record.update({name: number(rows[src].sum()) for name, src in SUM_MEASURES.items()})
        record.update({name: number(rows[src].mean()) for name, src in MEAN_MEASURES.items()})
        out[tuple(None if pd.isna(k) else (k.item() if hasattr(k, "item") else k) for k in key)] = record
    return out


def test_granular_measures_and_rates(frame, lines):
    got = plain(weekly.weekly_granular(lines), KEY_KEYS)
    want = by_hand(frame, KEY_KEYS)
    assert got.keys() == want.keys()
    expected = frame.groupby("benchmark_key").expected_85em.mean()
    weeks = frame.groupby(["benchmark_key", "year", "week"]).agg(paid=("payment_amount", "sum"), n=("invoice_number", "nunique"))
    rates = (weeks.paid / weeks.n).groupby("benchmark_key").mean()
    visits = weeks.n.groupby("benchmark_key").mean()
    for key, record in want.items():
        row = got[key]
        assert {m: row[m] for m in WEEKLY_MEASURES} == record
        assert row["expected_amount_85_em_invoice_level"] == number(expected[key[-1]])
        assert row["benchmark_payment_rate_per_visit"] == pytest.approx(rates[key[-1]])
        assert row["benchmark_invoice_count"] == pytest.approx(visits[key[-1]])


def test_aggregated_is_the_sum_of_granular(frame, lines):
    groups = plain(weekly.weekly_aggregated(lines), GROUP_KEYS)
    want = by_hand(frame, GROUP_KEYS)
    assert groups.keys() == want.keys()
    sums = {}
    for key, row in plain(weekly.weekly_granular(lines), KEY_KEYS).items():
        part = sums.setdefault(key[:5], {"expected_payment": [], "benchmark_payment": []})
        for c in part:
            part[c].append(row[c])
    for key, record in want.items():
        assert {m: groups[key][m] for m in WEEKLY_MEASURES} == record
        for c, parts in sums[key].items():
            present = [p for p in parts if p is not None]
            assert groups[key][c] == (pytest.approx(sum(present)) if present else None)


def odd_lines(spark):
    """Lines without invoice or measures, with NaN, and invoices of several groups."""
    frame = random_lines(400, seed=5, hot=True)
    rows = to_spark(spark, frame)
    rows = rows.withColumn("invoice_number", F.when(F.col("row_id") % 13 != 0, F.col("invoice_number")))
    rows = rows.withColumns({c: F.when(F.col("row_id") % 41 == 0, F.lit(float("nan"))).otherwise(F.col(c)) for c in ("payment_amount", "collection_rate")})
    empty = F.col("payer").isNull() & (F.col("week") == 2)
    return rows.withColumns({c: F.when(~empty, F.col(c)) for c in ("payment_amount", "expected_85em", "denial_pct")}).repartition(5)


@pytest.mark.parametrize("keyed", [False, True])
def test_aggregated_at_once_equals_roll_up_of_key_weeks(spark, keyed):
    lines = odd_lines(spark)
    if keyed:
        lines = keys.keyed_lines(lines).withColumn("benchmark_key", F.when(F.col("row_id") % 7 != 0, F.col("benchmark_key")))
    at_once, rolled_up = weekly.weekly_aggregated(lines), weekly.aggregated_of(weekly.key_weeks(lines))
    assert at_once.dtypes == rolled_up.dtypes
    got, want = plain(at_once, GROUP_KEYS, 6), plain(rolled_up, GROUP_KEYS, 6)
    assert str(sorted(got.items(), key=str)) == str(sorted(want.items(), key=str))  # as texts, NaN equals itself
    assert {r["denial_percent"] is None for r in got.values()} == {True, False} and any(r["payment_amount"] == 0.0 for r in got.values())


def test_invoices_carry_only_what_rates_are_made_of(spark):
    """Measures are added up per group before they are sent; what moves by invoice and by key has no others."""
    lines = odd_lines(spark)
    parts = weekly.group_parts(lines)
    rate = {"payment_amount", "_sum_expected", "_n_expected"}
    others = [c for c in parts.columns if c not in {*rate, "of_invoice", "invoice_number", *GROUP_KEYS}]
    per_invoice = parts.where("of_invoice").agg(*[F.max(F.abs(c)).alias(c) for c in others]).first()
    assert all(not v for v in per_invoice)
    assert parts.where("NOT of_invoice").count() == lines.select(*GROUP_KEYS).distinct().count()
    assert parts.where("of_invoice").count() == lines.select(*GROUP_KEYS, "invoice_number").distinct().count()


def test_given_keys_give_the_same_tables(lines):
    keyed = keys.keyed_lines(lines)
    for build, by in ((weekly.weekly_granular, KEY_KEYS), (weekly.weekly_aggregated, GROUP_KEYS)):
        assert plain(build(keyed), by, 6) == plain(build(lines), by, 6)


def test_result_does_not_depend_on_partitioning(lines):
    table = plain(weekly.weekly_aggregated(lines), GROUP_KEYS)
    assert plain(weekly.weekly_aggregated(lines.repartition(11, F.rand(3))), GROUP_KEYS) == table


def test_group_invoices_equal_key_visits(lines):
    diag = weekly.weekly_granular_diag(lines).select(*GROUP_KEYS, "group_benchmark_invoice_count").distinct()
    counts = weekly.group_invoice_count(lines)
    assert plain(diag, GROUP_KEYS) == plain(counts, GROUP_KEYS)


def test_benchmark_variance_both_ways(frame, lines):
    totals = frame.groupby(["benchmark_key", "invoice_number"]).payment_amount.sum()
    mean = totals.groupby("benchmark_key").mean()
    fast = plain(enhance.benchmark_variance_of_lines(lines), ["row_id"])
    slow = plain(enhance.benchmark_variance(keys.keyed_lines(lines)), ["row_id"])
    assert len(fast) == len(frame)
    for r in frame.itertuples():
        for table in (fast, slow):
            row = table[(r.row_id,)]
            assert row["benchmark_key"] == r.benchmark_key
            assert row["invoice_total_payment"] == totals[r.benchmark_key, r.invoice_number]
            assert row["benchmark_avg_payment"] == pytest.approx(mean[r.benchmark_key])


def test_enhance_keeps_every_line(lines):
    out = enhance.enhance(lines.withColumns({"sp_balance": F.lit(-1.0), "insurance_balance": F.lit(2.0)}))
    assert out.count() == lines.count()
    row = out.first()
    assert (row.sp_positive_balance, row.insurance_positive_balance) == (0.0, 2.0)


def test_shortfalls_and_drivers(lines):
    groups = weekly.weekly_aggregated(lines)
    short = drivers.group_shortfalls(groups)
    assert short.filter((F.col("shortfall_vs_expected") > 0) | (F.col("shortfall_vs_benchmark") > 0)).count() == 0
    by_payer = drivers.drivers_payer(groups).collect()
    gaps = [r.incremental_shortfall_vs_benchmark for r in by_payer]
    assert gaps == sorted(gaps) and None in {r.payer for r in by_payer}
    total = groups.agg(F.sum("visit_count")).first()[0]
    assert sum(r.total_visit_count for r in by_payer) == total


def test_underpayment_summary_covers_one_sided_groups(spark):
    schema = "year int, week int, payer string, group_em string, group_em2 string, benchmark_key string, revenue_variance_85em double, revenue_variance_pct_85em double, revenue_variance_benchmark double, revenue_variance_pct_benchmark double"
    rows = [
        (1, 1, "a", "g", "h", "k1", -5.0, -0.5, 2.0, 0.2),
        (1, 1, "a", "g", "h", "k2", -1.0, None, None, None),
        (1, 1, None, "g", "h", "k1", 5.0, 0.5, -2.0, -0.2),
        (1, 1, "c", "g", "h", "k1", 5.0, 0.5, 2.0, 0.2),
    ]
    got = plain(drivers.underpayment_summary(spark.createDataFrame(rows, schema)), GROUP_KEYS)
    assert set(got) == {(1, 1, "a", "g", "h"), (1, 1, None, "g", "h")}
    assert list(got[1, 1, "a", "g", "h"].values()) == [-6.0, -0.5, 2, 0.0, 0.0, 0]
    assert list(got[1, 1, None, "g", "h"].values()) == [0.0, 0.0, 0, -2.0, -0.2, 1]


def test_cpt_drivers(spark):
    schema = "year int, week int, payer string, group_em string, group_em2 string, cpt_code string, payment_amount double, visit_count bigint, expected_amount_85_em double"
    rows = [(1, 1, "a", "g", "h", "c", 90.0, 1, 100.0), (1, 1, "a", "g", "h", "c", 0.0, 0, 5.0), (1, 1, "a", "g", "h", "d", 300.0, 2, 100.0)]
    got = plain(drivers.cpt_drivers(spark.createDataFrame(rows, schema)), ["cpt_code"])
    assert (got["c",]["total_dollar_impact_vs_85em"], got["c",]["underpaid_flag"], got["c",]["avg_actual_rate"]) == (-10.0, True, 90.0)
    assert (got["d",]["total_dollar_impact_vs_85em"], got["d",]["underpaid_flag"]) == (100.0, False)
    assert np.isclose(got["c",]["avg_expected_rate_85em"], 52.5)


def test_materiality_flag(spark):
    schema = "year int, week int, payer string, group_em string, group_em2 string, benchmark_payment_rate_per_visit double, visit_count bigint"
    rows = [(1, 1, "a", "g", "h", 10.0, 9), (1, 1, "a", "g", "h", 20.0, 1), (1, 1, "b", "g", "h", None, 3)]
    got = plain(weekly.group_weighting(spark.createDataFrame(rows, schema)), ["payer"])
    assert got["a",]["group_benchmark_payment_diff_dollar"] == -40.0
    assert got["a",]["group_benchmark_payment_material_flag"] is True
    assert got["b",]["group_benchmark_payment_weighted"] == 0.0
    assert got["b",]["group_benchmark_payment_material_flag"] is False
