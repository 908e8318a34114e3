"""Procedure-code sets, benchmark keys, and the benchmark aggregates of AGG-1 to AGG-6 and AGG-27."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import TIME
from remitlens.functions.numbers import div_or_null, strip, sum0
from remitlens.functions.text import list_repr, pipe_key
from remitlens.operators.joins import null_safe_join


def cpt_sets(lines: DataFrame) -> DataFrame:
    """Sorted distinct procedure codes of each invoice.

    The set is collected on the map side first, so an invoice of any length sends each code once per task.
    """
    return lines.groupBy("invoice_number").agg(F.sort_array(F.collect_set(strip(F.col("cpt_code")))).alias("cpt_list"))


def attach_cpt_sets(lines: DataFrame, sets: DataFrame) -> DataFrame:
    """Each line with the code set of its invoice."""
    return null_safe_join(lines, sets, ["invoice_number"])


def benchmark_keys(df: DataFrame) -> DataFrame:
    """Benchmark key payer|group|second layer|code list, and the same behind the invoice number.

    Without a code list the key has its first three parts. A key therefore determines the payer and groups, which the
    weekly operators rely on.
    """
    parts = [F.col("payer"), F.col("group_em"), F.col("group_em2")]
    added = {}
    if "cpt_list" in df.columns:
        added["cpt_list_str"] = list_repr(F.col("cpt_list"))
        parts.append(added["cpt_list_str"])
    elif "cpt_list_str" in df.columns:
        parts.append(F.col("cpt_list_str"))
    added["benchmark_key"] = pipe_key(*parts)
    if "invoice_number" in df.columns:
        added["abbreviated_benchmark_key"] = pipe_key(F.col("invoice_number"), *parts)
    return df.withColumns(added)


def keyed_lines(lines: DataFrame) -> DataFrame:
    """Lines with code set and keys. Worth writing out once when several later steps need line detail."""
    return benchmark_keys(attach_cpt_sets(lines, cpt_sets(lines)))


def invoice_totals(keyed: DataFrame) -> DataFrame:
    """Total payment of each invoice within a key."""
    return keyed.groupBy("benchmark_key", "invoice_number").agg(sum0(F.col("payment_amount")).alias("invoice_total_payment"))


def benchmark_avg(totals: DataFrame) -> DataFrame:
    """Mean invoice total of each key."""
    return totals.groupBy("benchmark_key").agg(F.avg("invoice_total_payment").alias("benchmark_avg_payment"))


def expected_rate(keyed: DataFrame) -> DataFrame:
    """Mean expected amount per line of each key."""
    return keyed.groupBy("benchmark_key").agg(F.avg("expected_85em").alias("expected_amount_85_em_invoice_level"))


def mean_payment(keyed: DataFrame) -> DataFrame:
    """Mean payment per line of each key."""
    return keyed.groupBy("benchmark_key").agg(F.avg("payment_amount").alias("benchmark_payment_amount"))


def _key_weeks(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("benchmark_key", *TIME).agg(
        sum0(F.col("payment_amount")).alias("_paid"), F.count_distinct("invoice_number").alias("_visits")
    )


def mean_weekly_visits(keyed: DataFrame) -> DataFrame:
    """Mean number of distinct invoices per week of each key."""
    return _key_weeks(keyed).groupBy("benchmark_key").agg(F.avg("_visits").alias("benchmark_invoice_count"))


def payment_rate(keyed: DataFrame) -> DataFrame:
    """Mean over weeks of payment per distinct invoice, of each key."""
    rate = div_or_null(F.col("_paid"), F.col("_visits"))
    return _key_weeks(keyed).groupBy("benchmark_key").agg(F.avg(rate).alias("benchmark_payment_rate_per_visit"))
