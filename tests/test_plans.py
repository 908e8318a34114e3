"""Whole models, and the shape of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from remitlens.contracts import GROUP_KEYS
from remitlens.operators import diagnostics, keys, ml, narratives, weekly
from remitlens.plans.compact_model import compact_model
from remitlens.plans.full_model import from_report, full_model
from remitlens.sources.claims_adapter import invoice_lines, raw_report
from remitlens.storage import stored
from remitlens.verification import catalog
from remitlens.verification.catalog import ORACLE, QUERIES
from tests.samples import random_lines, to_spark


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def change(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_full_model(spark, tables):
    out = full_model(invoice_lines(spark, tables), fit=ml.fit_elasticnet)
    groups = out["weekly_aggregated"].count()
    assert out["narratives"].count() == out["diagnostics_base"].count() == groups
    assert out["narratives"].filter(F.col("ml_narrative_summary") != "").count() > groups * 0.9
    assert out["enhanced_lines"].count() == spark.read.parquet(f"{tables}/lineitem.parquet").count()
    for name in ("underpayment_summary", "drivers_payer", "drivers_key", "drivers_time", "cpt_rate_drivers"):
        assert out[name].count() > 0, name


def test_model_from_a_report(spark, tables):
    report = raw_report(spark, tables)
    out, rejects = from_report(report)
    total = out["enhanced_lines"].count() + rejects.count()
    assert 0.95 * report.count() < total <= report.count()


def test_compact_model(spark, tables):
    out = compact_model(invoice_lines(spark, tables, row_id=True))
    record = out["run_summary"].first()
    assert record.total_transactions == out["lines"].count() and record.narratives_generated == 3
    assert record.ml_model_performance.model_type == "Linear Regression"
    assert out["gap_by_week"].count() == out["weekly_by_week"].count()


def test_every_query_is_registered_with_sql_where_sql_can_express_it():
    without = set(QUERIES) - set(ORACLE)
    assert without == {n for n in QUERIES if n.startswith("ml_") and n not in ORACLE} | {"feature_importance"}
    assert set(ORACLE) <= set(QUERIES) and len(ORACLE) > 90


LAZY = ["benchmark_variance", "weekly_granular_diag", "forward_fill", "time_ordinal", "historical_benchmark", "cpt_rate_drivers", "zero_balance", "recompute_compare", "sample_validation"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, tables, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = physical(QUERIES[name](spark, tables))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "InPandas"):
        assert bad not in plan


def test_scans_read_only_what_a_query_needs(spark, tables):
    plan = physical(QUERIES["weekly_simple"](spark, tables))
    (line,) = re.findall(r"FileScan parquet \[(l_[^\]]*)\]", plan)
    read = {re.sub(r"#\d+L?", "", c) for c in line.split(",")}
    assert read == {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"}


def test_rank_is_limited_before_the_shuffle(spark, tables):
    plan = physical(narratives.top_sentences(narratives.metric_changes(stored(QUERIES["diagnostics_base"](spark, tables), "t"))))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # Sentences are put into words above the join with the leading subjects only.
    lines = plan.splitlines()
    worded = [i for i, line in enumerate(lines) if "format_string" in line]
    joins = [i for i, line in enumerate(lines) if "Join" in line]
    assert worded and joins and max(worded) <= min(joins)


def test_hot_invoice_is_split_across_tasks(spark, conf):
    """An invoice with 40% of all lines: the join's partition is split, and no line is lost."""
    frame = random_lines(40_000, seed=9, hot=True)
    lines = stored(to_spark(spark, frame).repartition(12), "hot")
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    joined = keys.attach_cpt_sets(lines, keys.cpt_sets(lines))
    rows = joined.collect()
    assert "skew=true" in physical(joined)
    assert len(rows) == 40_000 and all(r.cpt_list for r in rows)
    # The weekly tables add lines up per invoice before they join, so the hot invoice is small by then.
    facts = weekly.invoice_weeks(lines).filter("invoice_number = 'hot'").count()
    assert facts <= lines.select(*GROUP_KEYS).distinct().count()


def test_weekly_tables_are_roll_ups_of_stored_key_weeks(spark, tables):
    """Once key weeks are stored no line is read again, and the diagnostics read the weekly table once."""
    weeks = stored(weekly.key_weeks(invoice_lines(spark, tables)), "weeks")
    groups = weekly.aggregated_of(weeks)
    for df, reads in ((groups, 1), (weekly.granular_of(weeks), 1), (diagnostics.diagnostics_base(groups, fallback=False), 1), (weekly.granular_diag_of(weeks), 2)):
        plan = physical(df)
        assert plan.count("FileScan") == reads and "l_orderkey" not in plan
    apart = diagnostics.attach_baselines(groups, weekly.baselines(groups, ["payment_amount", "collection_rate"]))
    names = ["payment_amount_avg", "collection_rate_avg"]
    got, want = ({tuple(r[c] for c in GROUP_KEYS): [r[n] for n in names] for r in df.collect()} for df in (diagnostics.diagnostics_base(groups, fallback=False), apart))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_code_sets_do_not_read_orders(spark, tables, conf):
    """Orders join lines last, so what needs none of their columns leaves them out."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = physical(keys.cpt_sets(invoice_lines(spark, tables)))
    assert plan.count("FileScan") == 2 and "o_orderkey" not in plan and "l_partkey" in plan


def test_sums_per_invoice_follow_the_join_with_orders(spark, tables, conf):
    """The join that deals lines out by invoice stands right below the first sums, which therefore combine before they are sent."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = physical(weekly.group_parts(invoice_lines(spark, tables))).splitlines()
    joins = [line for line in plan if "Join" in line]
    assert "l_orderkey" in joins[0]
    between = plan[: plan.index(joins[0])]
    assert sum("Exchange" in line for line in between) == 1  # that of the sums themselves


@pytest.mark.parametrize("name", ["ml_elasticnet", "ml_fitted_hotspots", "ml_time_cv", "ml_metrics"])
def test_models_read_narrow_invoices(spark, tables, monkeypatch, name):
    """Weekly rows of a model come from stored parts; what is read per invoice has the measures of rates alone."""
    plans = []
    for module in (weekly, catalog, ml):
        monkeypatch.setattr(module, "stored", lambda df, what: plans.append((what, physical(df))) or stored(df, what))
    QUERIES[name](spark, tables)
    assert [what for what, _ in plans][:2] == ["group-parts", "weekly"]
    reads = [{re.sub(r"#\d+L?", "", c) for c in line.split(",")} for line in re.findall(r"FileScan parquet \[(of_invoice[^\]]*)\]", dict(plans)["weekly"])]
    assert {"of_invoice", *GROUP_KEYS, "invoice_number", "payment_amount", "_sum_expected", "_n_expected"} in reads


def test_stored_tables_are_read_back_with_pruned_columns(spark):
    table = stored(spark.range(10).select("id", (F.col("id") * 2).alias("x")), "t")
    assert table.count() == 10
    assert "ReadSchema: struct<x:bigint>" in physical(table.select("x"))
