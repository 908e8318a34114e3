import re

import pytest
from pyspark.sql import functions as F

from remitlens.operators import enhance, keys, quality, validation
from remitlens.storage import stored
from remitlens.verification import catalog
from tests.samples import random_lines, to_spark


def report(df):
    return {r.check: (r.status, r.issue) for r in df.collect()}


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert quality.check_columns(df, ["a", "b"]) == ("ok", None)
    assert quality.check_columns(df, ["a", "c"]) == ("fail", "columns that have to be there are absent: c")
    assert quality.check_columns(df, ["a", "c"], subset_ok=True)[0] == "warn"
    assert quality.check_columns(df, ["c"], subset_ok=True)[0] == "fail"
    with pytest.raises(ValueError, match="c"):
        quality.require_columns(df, ["c"])
    assert quality.require_columns(df, ["a"]) is df


def test_row_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", -2.0, None), (None, float("nan"), None), (None, float("inf"), None), ("b", None, None)],
        "k string, x double, n double",
    )
    assert report(quality.check_all_null(df, ["x", "n", "absent"])) == {"all_null:x": ("ok", None), "all_null:n": ("warn", "no value in n")}
    assert report(quality.check_row_count(df, 5)) == {"row_count": ("ok", None)}
    assert report(quality.check_row_count(df, 6)) == {"row_count": ("fail", "5 rows where at least 6 are expected")}
    assert report(quality.check_unique(df, ["k"])) == {"unique_keys": ("warn", "4 rows share their (k)")}
    assert report(quality.check_unique(df, ["z"]))["unique_keys"][0] == "fail"
    assert report(quality.check_unique(df.limit(0), ["k"])) == {"unique_keys": ("ok", None)}
    got = report(quality.check_numeric(df, ["x", "gone"]))
    assert got["finite:x"] == ("warn", "x: 3 without a finite number") and got["non_negative:x"][1].startswith("x: 1 below")
    assert got["numeric:gone"] == ("warn", "no column gone to check")


def test_stages(spark):
    lines = to_spark(spark, random_lines(50))
    assert {r.stage for r in quality.run_checkpoint("preprocess", {"lines": lines}).collect()} == {"preprocess"}
    assert report(quality.run_checkpoint("preprocess", {"lines": lines.limit(3)}))["row_count"][0] == "fail"
    assert report(quality.run_checkpoint("preprocess", {"lines": lines.drop("payer")})) == {"columns": ("fail", "columns that have to be there are absent: payer")}
    assert report(quality.run_checkpoint("weekly", {"granular": lines, "aggregated": lines.limit(1)}))["aggregated:row_count"][0] == "warn"
    assert report(quality.run_checkpoint("nope", {"x": lines})) == {"stage": ("fail", "Unknown stage: nope")}
    assert report(quality.run_checkpoint("ml_agg", {"scored": lines}))["ml_columns"][0] == "warn"
    assert report(quality.run_checkpoint("underpay", {"summary": lines}))["by_key"] == ("fail", "Missing table: by_key")
    with pytest.raises(ValueError):
        quality.run_checkpoint("weekly", {"granular": lines})


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_suites_read_each_table_once(spark):
    lines = stored(keys.keyed_lines(to_spark(spark, random_lines(200))), "checked")
    assert scans(quality.run_checkpoint("preprocess", {"lines": lines})) == 1
    assert scans(quality.run_checkpoint("enhance", {"lines": lines})) == 1
    assert scans(quality.run_checkpoint("weekly", {"granular": lines, "aggregated": lines})) == 2
    assert scans(quality.run_checkpoint("ml_agg", {"scored": lines})) == 0
    every = quality.run(lines, quality.row_count(10), quality.unique(lines, ["invoice_number"]), quality.numeric(lines, ["payment_amount"]), quality.all_null(lines, ["payer"]))
    assert scans(every) == 1
    apart = [quality.check_row_count(lines, 10), quality.check_unique(lines, ["invoice_number"]), quality.check_numeric(lines, ["payment_amount"]), quality.check_all_null(lines, ["payer"])]
    assert report(every) == {k: v for df in apart for k, v in report(df).items()}
    two = quality.run(lines, quality.unique(lines, ["invoice_number"]), quality.unique(lines, ["cpt_code"]), quality.row_count(10))
    assert two.count() == 3


def test_checks_read_invoice_facts(spark, monkeypatch):
    """Comparison and sample read the source's lines once, the processed lines once."""
    source = stored(keys.keyed_lines(to_spark(spark, random_lines(300, seed=4))), "source")
    facts = stored(validation.invoice_facts(source), "facts")
    totals = validation.fact_totals(facts)
    table = stored(enhance.attach_benchmark(validation.with_key_columns(source, facts), totals, keys.benchmark_avg(totals)), "processed")
    plan = validation.recompute_compare(source, table, facts)._jdf.queryExecution().executedPlan().toString()
    folders = [f.split("/")[-1].split("-")[0] for f in re.findall(r"InMemoryFileIndex\([^)]*\)\[([^\],]*)", plan)]
    assert folders.count("processed") == 1 and folders.count("source") == 0
    plan = validation.sample_validation(source, table.withColumn("revenue_variance_benchmark_dollar", F.lit(0.0)), 5, 1, facts)._jdf.queryExecution().executedPlan().toString()
    folders = [f.split("/")[-1].split("-")[0] for f in re.findall(r"InMemoryFileIndex\([^)]*\)\[([^\],]*)", plan)]
    assert folders.count("processed") == 1 and folders.count("source") == 0


def test_benchmarks_of_lines_in_one_join(spark):
    source = stored(keys.keyed_lines(to_spark(spark, random_lines(300, seed=4))), "source")
    totals = keys.invoice_totals(source)
    apart = enhance.attach_benchmark(validation.with_key_columns(source), totals, keys.benchmark_avg(totals))
    at_once = validation.with_benchmarks(source, validation.invoice_benchmarks(validation.invoice_facts(source)))
    names = ["row_id", *validation.RECOMPUTED]
    assert sorted(apart.select(names).collect()) == sorted(at_once.select(names).collect()) and set(apart.columns) == set(at_once.columns)
    plan = at_once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # the means meet the invoices, both meet the lines


def test_checks_store_what_they_read(spark, tables, monkeypatch):
    """Lines are stored without the columns that no check reads, and the facts of a query's lines once."""
    kept = []
    for module in (catalog, validation):
        monkeypatch.setattr(module, "stored", lambda df, name: kept.append((name, set(df.columns))) or stored(df, name))
    facts = {*validation.INVOICE, "total", "n_payment", "expected", "n_expected"}
    lines = ("keyed-lines", {"row_id", *validation.INVOICE, "payment_amount", "expected_85em"})
    for name in ("recompute_compare", "discrepancies", "sample_validation", "sample_validation_summary", "sample_mismatches"):
        kept.clear()
        catalog.QUERIES[name](spark, tables)
        assert [k for k in kept if k[0] != "sampled-invoices"] == [lines, ("invoice-facts", facts)]

def test_row_passthrough_stores_what_it_reads(spark, tables, monkeypatch):
    kept = []
    monkeypatch.setattr(catalog, "stored", lambda df, name: kept.append((name, set(df.columns))) or stored(df, name))
    catalog.QUERIES["row_passthrough"](spark, tables)
    assert kept == [("gap-lines", {"row_id", *validation.PASSTHROUGH})]


@pytest.fixture(scope="module")
def processed(spark):
    source = keys.keyed_lines(to_spark(spark, random_lines(400, seed=4))).cache()
    totals = keys.invoice_totals(source)
    table = enhance.attach_benchmark(validation.with_key_columns(source), totals, keys.benchmark_avg(totals))
    table = enhance.nrv_passthrough(table)
    variance = F.col("invoice_total_payment") - F.col("benchmark_avg_payment")
    return source, table.withColumn("revenue_variance_benchmark_dollar", variance)


def test_own_output_passes_every_comparison(processed):
    source, table = processed
    compared = validation.recompute_compare(source, table)
    assert compared.count() == source.count()
    assert validation.mismatches(compared).count() == 0
    rows = validation.row_passthrough(source, table)
    assert rows.count() == source.count() and validation.mismatches(rows).count() == 0


def test_wrong_values_are_found(processed):
    source, table = processed
    wrong = table.withColumn("invoice_total_payment", F.when(F.col("row_id") == 7, -1e6).otherwise(F.col("invoice_total_payment")))
    assert [r.row_id for r in validation.mismatches(validation.recompute_compare(source, wrong)).collect()] == [7]


def test_sample_is_stable_and_within_bounds(processed):
    source, table = processed
    first = {r.invoice_number for r in validation.sample_invoices(source, 12, 1).collect()}
    again = {r.invoice_number for r in validation.sample_invoices(source.repartition(9), 12, 1).collect()}
    assert first == again and len(first) == 12
    assert first != {r.invoice_number for r in validation.sample_invoices(source, 12, 2).collect()}
    assert validation.sample_invoices(source, 10_000).count() == validation.distinct_invoices(source).count()
    details = validation.sample_validation(source, table, 12, 1)
    assert {r.invoice_number for r in details.select("invoice_number").distinct().collect()} == first
    summary = {r.check.split(" ")[0]: r for r in validation.check_summary(details).collect()}
    assert summary["invoice_total_payment"].pass_rate == 1.0
    assert summary["revenue_variance_benchmark_dollar"].pass_rate == 1.0
    assert all(r["total"] == r["pass"] + r["fail"] for r in summary.values())
