"""Recompute benchmarks from source lines and compare them with processed lines, in full and on a sample.

The checks share one layer of invoice facts, so the source's lines are added up once for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import is_close, sum0
from remitlens.operators.joins import null_safe_join
from remitlens.storage import stored

INVOICE = ["benchmark_key", "invoice_number"]
PASSTHROUGH = {
    "nrv_gap_dollar": "nrv_gap_dollar_invoice_level",
    "nrv_gap_pct": "nrv_gap_percent_invoice_level",
    "nrv_gap_sum_dollar": "nrv_gap_sum_dollar_invoice_level",
}
# Processed column -> its recomputed counterpart.
RECOMPUTED = {
    "expected_amount_85_em_invoice_level": "expected_amount_85_em_recalc",
    "benchmark_payment_amount": "benchmark_payment_amount_recalc",
    "invoice_total_payment": "invoice_total_payment_recalc",
    "benchmark_avg_payment": "benchmark_avg_payment_recalc",
}


def invoice_facts(source: DataFrame) -> DataFrame:
    """Sums and counts of each invoice within a key, in one pass: all that the checks recompute derives from them.

    Worth storing where several checks run on the same lines; each takes the stored facts.
    """
    return source.groupBy(*INVOICE).agg(
        sum0(F.col("payment_amount")).alias("total"),
        F.count("payment_amount").alias("n_payment"),
        F.sum("expected_85em").alias("expected"),
        F.count("expected_85em").alias("n_expected"),
    )


def fact_totals(facts: DataFrame) -> DataFrame:
    """Total payment of each invoice within a key."""
    return facts.select(*INVOICE, F.col("total").alias("invoice_total_payment"))


def _mean_expected() -> Column:
    return F.try_divide(F.sum("expected"), F.sum("n_expected"))


def fact_means(facts: DataFrame) -> DataFrame:
    """Per key: mean expected amount and payment per line, and mean invoice total."""
    return facts.groupBy("benchmark_key").agg(
        _mean_expected().alias("expected_amount_85_em_recalc"),
        F.try_divide(F.sum("total"), F.sum("n_payment")).alias("benchmark_payment_amount_recalc"),
        F.avg("total").alias("benchmark_avg_payment_recalc"),
    )


def invoice_benchmarks(facts: DataFrame) -> DataFrame:
    """``fact_totals`` and ``fact_means`` side by side: all that lines of an invoice within a key are compared with.

    Worth storing where lines get these columns and are compared with them later.
    """
    return null_safe_join(fact_totals(facts), fact_means(facts), ["benchmark_key"])


def with_benchmarks(keyed: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Processed form of keyed lines, from ``invoice_benchmarks``; the lines move once."""
    return null_safe_join(keyed, benchmarks.withColumnsRenamed({again: c for c, again in RECOMPUTED.items()}), INVOICE)


def recompute_key(source: DataFrame) -> DataFrame:
    """``fact_means`` of lines. Sums and counts of invoices give the line means, so one pass is enough."""
    return fact_means(invoice_facts(source))


def merge_recalc(*tables: DataFrame) -> DataFrame:
    """Per-key tables computed apart, side by side; a key of any of them is kept."""
    return reduce(lambda a, b: null_safe_join(a, b, ["benchmark_key"], "full"), tables)


def compare(processed: DataFrame, recalc: DataFrame, totals: DataFrame, rtol: float = 1e-3) -> DataFrame:
    """Difference and match flag of each benchmark column the processed lines carry."""
    totals = totals.withColumnRenamed("invoice_total_payment", "invoice_total_payment_recalc")
    per_invoice = null_safe_join(totals, recalc, ["benchmark_key"])
    df = null_safe_join(processed, per_invoice, INVOICE)
    out = {}
    for column, again in RECOMPUTED.items():
        if column in processed.columns:
            out[f"{column}__delta"] = F.col(column) - F.col(again)
            out[f"{column}__match"] = is_close(F.col(column), F.col(again), rtol)
    return df.withColumns(out)


def recompute_compare(source: DataFrame, processed: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Processed lines with recomputed benchmarks, differences and match flags.

    ``facts`` are stored ones of ``source``; without them they are made and stored here, so its lines are read once.
    """
    facts = stored(invoice_facts(source), "invoice-facts") if facts is None else facts
    return compare(processed, fact_means(facts), fact_totals(facts))


def row_passthrough(source: DataFrame, processed: DataFrame, order: str = "row_id") -> DataFrame:
    """Whether the gap columns went through unchanged, row by row (rows are paired by ``order``)."""
    original = source.select(order, *[F.col(c).alias(f"_src_{c}") for c in PASSTHROUGH])
    df = null_safe_join(processed, original, [order])
    present = {src: out for src, out in PASSTHROUGH.items() if out in processed.columns}
    flags = {f"{out}_row_match": is_close(F.col(out), F.col(f"_src_{src}"), 1e-6) for src, out in present.items()}
    return df.withColumns(flags).drop(*[f"_src_{c}" for c in PASSTHROUGH])


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("__match") or c.endswith("_row_match")]


def mismatches(df: DataFrame, flags: Sequence[str] | None = None) -> DataFrame:
    """Rows on which some flag is false."""
    flags = list(flags or flag_columns(df))
    return df.filter(~reduce(Column.__and__, [F.coalesce(F.col(c), F.lit(False)) for c in flags]))


def distinct_invoices(df: DataFrame) -> DataFrame:
    return df.select("invoice_number").filter(F.col("invoice_number").isNotNull()).distinct()


def sample_invoices(df: DataFrame, n: int = 30, seed: int = 42) -> DataFrame:
    """``n`` distinct invoices drawn by a hash of number and seed: the same for any partitioning."""
    draw = F.md5(F.concat(F.col("invoice_number"), F.lit(f":{seed}")))
    return distinct_invoices(df).orderBy(draw, "invoice_number").limit(n)


def sample_rows(df: DataFrame, invoices: DataFrame) -> DataFrame:
    """Lines of the sampled invoices."""
    return df.join(invoices, "invoice_number", "left_semi")


# Processed column, recomputed column, relative tolerance.
SAMPLE_CHECKS = [
    ("invoice_total_payment", "invoice_total_payment_recalc", 1e-3),
    ("expected_amount_85_em_invoice_level", "expected_amount_85_em_recalc", 1e-3),
    ("revenue_variance_benchmark_dollar", "variance_against_benchmark_recalc", 1e-2),
]


def check_rows(df: DataFrame, checks: Sequence[tuple[str, str, float]]) -> DataFrame:
    """One row per line and check, unpivoted in one pass; a missing value compares as 0."""
    zero = F.lit(0.0)
    entries = [
        F.struct(
            F.lit(f"{a} vs {b}").alias("check"),
            F.col(a).alias("processed_value"),
            F.col(b).alias("recalc_value"),
            (F.col(a) - F.col(b)).alias("delta"),
            is_close(F.coalesce(a, zero), F.coalesce(b, zero), rtol).alias("match"),
        )
        for a, b, rtol in checks
        if a in df.columns and b in df.columns
    ]
    return df.select(*INVOICE, F.inline(F.array(*entries)))


def sample_validation(source: DataFrame, processed: DataFrame, n: int = 30, seed: int = 42, facts: DataFrame | None = None) -> DataFrame:
    """Checks on the lines of sampled invoices.

    Invoice totals and the expected rate are recomputed within the sample, the benchmark average from all lines. Sample and
    recomputation read invoice facts (stored ones of ``source``, or made and stored here), not lines.
    """
    facts = stored(invoice_facts(source), "invoice-facts") if facts is None else facts
    invoices = stored(sample_invoices(facts, n, seed), "sampled-invoices")
    drawn = sample_rows(facts, invoices)
    totals = drawn.select(*INVOICE, F.col("total").alias("invoice_total_payment_recalc"))
    rates = drawn.groupBy("benchmark_key").agg(_mean_expected().alias("expected_amount_85_em_recalc"))
    # Only keys in the sample need a full-data average.
    keys = drawn.select("benchmark_key").distinct()
    peers = null_safe_join(facts, keys, ["benchmark_key"], "left_semi")
    average = peers.groupBy("benchmark_key").agg(F.avg("total").alias("_key_average"))
    again = null_safe_join(null_safe_join(totals, rates, ["benchmark_key"]), average, ["benchmark_key"])
    again = again.withColumn(
        "variance_against_benchmark_recalc", F.col("invoice_total_payment_recalc") - F.col("_key_average")
    ).drop("_key_average")
    compared = null_safe_join(sample_rows(processed, invoices), again, INVOICE)
    return check_rows(compared, SAMPLE_CHECKS)


def check_summary(details: DataFrame) -> DataFrame:
    """Per check: number of rows, passes, failures and pass rate."""
    passed = F.count(F.when(F.col("match"), 1))
    sums = details.groupBy("check").agg(F.count(F.lit(1)).alias("total"), passed.alias("pass"))
    return sums.withColumns(
        {"fail": F.col("total") - F.col("pass"), "pass_rate": F.try_divide(F.col("pass"), F.col("total"))}
    )


def with_key_columns(keyed: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Processed form of keyed lines: per-key means on every line, from the lines' invoice facts."""
    means = fact_means(invoice_facts(keyed) if facts is None else facts)
    names = {"expected_amount_85_em_recalc": "expected_amount_85_em_invoice_level", "benchmark_payment_amount_recalc": "benchmark_payment_amount"}
    return null_safe_join(keyed, means.select("benchmark_key", *names).withColumnsRenamed(names), ["benchmark_key"])
