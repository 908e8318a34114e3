"""Weekly rollups: per key, per group, per procedure code.

One pass serves them all. Lines are first added up per (week, group, invoice), which shrinks them before the join
with the code sets and makes a visit (distinct invoice) a plain count; then per (week, group, key). Sums and counts
travel together, so means at any coarser grain are exact. The tables per key and per group are roll-ups of that one
(``key_weeks``), which is worth storing where both are wanted. Where only the table per group is, the measures are
added up per group at once, and invoices and keys carry no more than the rates of keys are made of.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.contracts import DEFAULT_THRESHOLDS, DIMS, GROUP_KEYS, KEY_KEYS, MEAN_MEASURES, SUM_MEASURES, WEEKLY_MEASURES
from remitlens.functions.numbers import div_or_null, is_true, sum0
from remitlens.functions.text import cpt_count
from remitlens.operators.joins import null_safe_join
from remitlens.operators.keys import benchmark_keys, cpt_sets
from remitlens.storage import stored

# Measures carried as a sum and a count, by rollup name.
_RATIOS = {**MEAN_MEASURES, "expected": "expected_85em"}
# The measures that the rates of keys are made of.
_RATE_SUMS = {"payment_amount": SUM_MEASURES["payment_amount"]}
_RATE_RATIOS = {"expected": _RATIOS["expected"]}


def _added_up(sums: Mapping[str, str], ratios: Mapping[str, str]) -> list[Column]:
    """Aggregates of lines: the sums, and a sum and a count for each ratio."""
    out = [F.sum(src).alias(name) for name, src in sums.items()]
    for name, src in ratios.items():
        out += [F.sum(src).alias(f"_sum_{name}"), F.count(src).alias(f"_n_{name}")]
    return out


def invoice_weeks(lines: DataFrame) -> DataFrame:
    """Lines added up per week, group, invoice and, when present, key."""
    given = [c for c in ("benchmark_key", "cpt_list", "cpt_list_str") if c in lines.columns]
    keys = [*GROUP_KEYS, "invoice_number", *(["benchmark_key"] if "benchmark_key" in given else [])]
    aggregates = [F.count("invoice_number").alias("group_size"), *_added_up(SUM_MEASURES, _RATIOS)]
    if "cpt_list" in given:
        aggregates.append(F.max(F.size("cpt_list")).alias("cpt_count"))
    facts = lines.groupBy(*keys).agg(*aggregates)
    if "benchmark_key" in given:
        return facts if "cpt_list" in given else facts.withColumn("cpt_count", cpt_count(F.col("benchmark_key")))
    return benchmark_keys(null_safe_join(facts.drop("cpt_count"), cpt_sets(lines), ["invoice_number"])).withColumn("cpt_count", F.size("cpt_list"))


def key_weeks(lines: DataFrame) -> DataFrame:
    """Per (week, group, key): visits, sums and counts, and the historical rates of the key on every row.

    A key determines its group, so a key's rows here are its weeks; the window over a key is bounded by the calendar.
    """
    totals = [F.sum("group_size").alias("group_size"), F.max("cpt_count").alias("cpt_count")]
    return _weeks_of_keys(invoice_weeks(lines), totals, SUM_MEASURES, _RATIOS)


def _weeks_of_keys(invoices: DataFrame, totals: list[Column], sums: Mapping[str, str], ratios: Mapping[str, str]) -> DataFrame:
    """``key_weeks`` of keyed ``invoice_weeks`` with these measures."""
    carried = [f"_{part}_{name}" for name in ratios for part in ("sum", "n")]
    base = invoices.groupBy(*KEY_KEYS).agg(
        F.count("invoice_number").alias("visit_count"),
        *totals,
        *[sum0(F.col(c)).alias(c) for c in sums],
        *[F.sum(c).alias(c) for c in carried],
    )
    key = Window.partitionBy("benchmark_key")
    week_rate = div_or_null(F.col("payment_amount"), F.col("visit_count"))
    return base.withColumns(
        {
            "expected_amount_85_em_invoice_level": div_or_null(
                F.sum("_sum_expected").over(key), F.sum("_n_expected").over(key)
            ),
            "benchmark_invoice_count": F.avg("visit_count").over(key),
            "benchmark_payment_rate_per_visit": F.avg(week_rate).over(key),
        }
    )


def group_parts(lines: DataFrame) -> DataFrame:
    """Lines added up in one pass at two grains, told apart by ``of_invoice``.

    Per week and group with every measure; and per invoice of these (and key, when present) with only the measures that
    the rates of keys are made of. A line counts in both. The first are few before they are sent.
    """
    ids = ["invoice_number", *(c for c in ("benchmark_key",) if c in lines.columns)]
    twice = lines.withColumn("of_invoice", F.explode(F.array(F.lit(False), F.lit(True))))
    in_group = ~F.col("of_invoice")
    both = {*_RATE_SUMS.values(), *_RATE_RATIOS.values()}
    wide = [c for c in dict.fromkeys([*SUM_MEASURES.values(), *_RATIOS.values()]) if c not in both]
    twice = twice.withColumns({c: F.when(in_group, F.col(c)) for c in wide})
    parts = twice.groupBy("of_invoice", *GROUP_KEYS, *[F.when(~in_group, F.col(c)).alias(c) for c in ids])
    return parts.agg(F.count(F.when(in_group, F.col("invoice_number"))).alias("group_size"), *_added_up(SUM_MEASURES, _RATIOS))


def _means() -> dict:
    return {name: div_or_null(F.col(f"_sum_{name}"), F.col(f"_n_{name}")) for name in MEAN_MEASURES}


_KEY_RATES = ["expected_amount_85_em_invoice_level", "benchmark_invoice_count", "benchmark_payment_rate_per_visit"]


def granular_base(weeks: DataFrame) -> DataFrame:
    """Weekly rows per key with their measures, the key's historical rates and number of procedure codes."""
    return weeks.withColumns(_means()).select(*KEY_KEYS, *WEEKLY_MEASURES, *_KEY_RATES, "cpt_count")


def attach_key_benchmarks(weekly: DataFrame, *benchmarks: DataFrame) -> DataFrame:
    """Weekly rows with per-key benchmark tables, for benchmarks that were computed or stored separately."""
    for table in benchmarks:
        weekly = null_safe_join(weekly, table, ["benchmark_key"])
    return weekly


def granular_metrics(weekly: DataFrame) -> DataFrame:
    """Expected and benchmark payment, actual rate, revenue variance, volume gap and rate variance."""
    visits, paid = F.col("visit_count"), F.col("payment_amount")
    rate = F.col("expected_amount_85_em_invoice_level")
    weekly = weekly.withColumns(
        {
            "expected_payment": rate * visits,
            "benchmark_payment": F.col("benchmark_payment_rate_per_visit") * visits,
            "actual_rate_per_visit": div_or_null(paid, visits),
        }
    )
    variance = paid - F.col("expected_payment")
    return weekly.withColumns(
        {
            "revenue_variance": variance,
            "revenue_variance_pct": div_or_null(variance, F.col("expected_payment")),
            "volume_gap": visits - F.col("benchmark_invoice_count"),
            "rate_variance": F.col("actual_rate_per_visit") - rate,
        }
    )


def weekly_granular(lines: DataFrame) -> DataFrame:
    """Weekly table per key, with derived metrics."""
    return granular_of(key_weeks(lines))


def granular_of(weeks: DataFrame) -> DataFrame:
    """``weekly_granular`` from key weeks."""
    return granular_metrics(granular_base(weeks))


def weighting_diff(df: DataFrame, materiality: float = DEFAULT_THRESHOLDS.weighting_materiality_pct) -> DataFrame:
    """Weighted less unweighted benchmark payment of a group, in dollars and relative, and whether it is material."""
    weighted = F.col("group_benchmark_payment_weighted")
    unweighted = F.col("group_mean_rate_unweighted") * F.col("group_total_visits")
    pct = div_or_null(weighted - unweighted, unweighted)
    return df.withColumns(
        {
            "group_benchmark_payment_unweighted": unweighted,
            "group_benchmark_payment_diff_dollar": weighted - unweighted,
            "group_benchmark_payment_diff_pct": pct,
            "group_benchmark_payment_material_flag": is_true(F.abs(pct) >= materiality),
        }
    )


def group_weighting(granular: DataFrame, materiality: float = DEFAULT_THRESHOLDS.weighting_materiality_pct) -> DataFrame:
    """Benchmark payment of each week's group, keys weighted by visits against the plain mean of key rates."""
    rate, visits = F.col("benchmark_payment_rate_per_visit"), F.col("visit_count")
    groups = granular.groupBy(*GROUP_KEYS).agg(
        sum0(rate * visits).alias("group_benchmark_payment_weighted"),
        F.sum(visits).alias("group_total_visits"),
        F.avg(rate).alias("group_mean_rate_unweighted"),
    )
    return weighting_diff(groups, materiality)


def group_invoice_count(lines: DataFrame) -> DataFrame:
    """Distinct invoices of each week's group."""
    return lines.groupBy(*GROUP_KEYS).agg(F.count_distinct("invoice_number").alias("group_benchmark_invoice_count"))


def attach_group_diag(weekly: DataFrame, diagnostics: DataFrame, counts: DataFrame) -> DataFrame:
    """Weekly rows per key with the diagnostics and invoice count of their group."""
    groups = null_safe_join(diagnostics, counts, GROUP_KEYS)
    return null_safe_join(weekly, groups, GROUP_KEYS)


def weekly_granular_diag(
    lines: DataFrame, materiality: float = DEFAULT_THRESHOLDS.weighting_materiality_pct
) -> DataFrame:
    """Weekly table per key with group diagnostics.

    An invoice has one code set, so within a group it has one key, and the group's distinct invoices are the sum of
    its keys' visits. The key weeks are stored, as their rows and their groups' sums meet again.
    """
    return granular_diag_of(stored(key_weeks(lines), "key-weeks"), materiality)


def granular_diag_of(weeks: DataFrame, materiality: float = DEFAULT_THRESHOLDS.weighting_materiality_pct) -> DataFrame:
    """``weekly_granular_diag`` from key weeks."""
    granular = granular_of(weeks)
    groups = group_weighting(granular, materiality)
    groups = groups.withColumn("group_benchmark_invoice_count", F.col("group_total_visits"))
    return null_safe_join(granular, groups, GROUP_KEYS)


def weekly_aggregated(lines: DataFrame) -> DataFrame:
    """Weekly table per group.

    Measures are those of the granular table at group grain. Expected and benchmark payment are the sums over the
    group's keys; the expected rate is the mean over lines. No table of this grain is written by the scripts this
    models, so its definition follows what the later steps read.

    The ``group_parts`` of the lines are stored, since groups and invoices are read from them.
    """
    parts = stored(group_parts(lines), "group-parts")
    rate_parts = [*_RATE_SUMS, *[f"_{part}_{name}" for name in _RATE_RATIOS for part in ("sum", "n")]]
    ids = ["invoice_number", *(c for c in ("benchmark_key",) if c in lines.columns)]
    invoices = parts.where("of_invoice").select(*GROUP_KEYS, *ids, *rate_parts)
    if "benchmark_key" not in ids:
        invoices = benchmark_keys(null_safe_join(invoices, cpt_sets(lines), ["invoice_number"]))
    paid = _payments(_weeks_of_keys(invoices, [], _RATE_SUMS, _RATE_RATIOS))
    groups = parts.where("NOT of_invoice").drop("of_invoice", *ids).withColumns({c: F.coalesce(c, F.lit(0.0)) for c in SUM_MEASURES})
    return _of_groups(null_safe_join(groups, paid, GROUP_KEYS))


def aggregated_of(weeks: DataFrame) -> DataFrame:
    """``weekly_aggregated`` from key weeks."""
    carried = [f"_{part}_{name}" for name in _RATIOS for part in ("sum", "n")]
    return _of_groups(_payments(weeks, [F.sum(c).alias(c) for c in ("group_size", *SUM_MEASURES, *carried)]))


def _payments(weeks: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Visits, expected and benchmark payment of each week's group, from the weeks of its keys."""
    visits = F.col("visit_count")
    return weeks.groupBy(*GROUP_KEYS).agg(
        F.sum(visits).alias("visit_count"),
        *more,
        F.sum(F.col("expected_amount_85_em_invoice_level") * visits).alias("expected_payment"),
        F.sum(F.col("benchmark_payment_rate_per_visit") * visits).alias("benchmark_payment"),
    )


def _of_groups(groups: DataFrame) -> DataFrame:
    """The weekly table from sums and counts of its groups."""
    rate = div_or_null(F.col("_sum_expected"), F.col("_n_expected"))
    groups = groups.withColumns({**_means(), "expected_amount_85_em_invoice_level": rate})
    paid, expected = F.col("payment_amount"), F.col("expected_payment")
    return groups.select(
        *GROUP_KEYS,
        *WEEKLY_MEASURES,
        "expected_amount_85_em_invoice_level",
        "expected_payment",
        "benchmark_payment",
        div_or_null(paid, F.col("visit_count")).alias("actual_rate_per_visit"),
        (paid - expected).alias("revenue_variance"),
        div_or_null(paid - expected, expected).alias("revenue_variance_pct"),
        (expected - F.col("benchmark_payment")).alias("expected_vs_benchmark_payment_variance"),
    )


def weekly_by_key_variance(granular: DataFrame) -> DataFrame:
    """Weekly variances per key in both lenses, the input of the underpayment summary."""
    paid = F.col("payment_amount")
    lenses = {"85em": F.col("expected_payment"), "benchmark": F.col("benchmark_payment")}
    out = [F.col(c) for c in KEY_KEYS]
    for lens, reference in lenses.items():
        out.append((paid - reference).alias(f"revenue_variance_{lens}"))
        out.append(div_or_null(paid - reference, reference).alias(f"revenue_variance_pct_{lens}"))
    return granular.select(out)


def weekly_by_cpt(lines: DataFrame) -> DataFrame:
    """Weekly table per key and procedure code, the input of the procedure-code drivers.

    The expected rate is the mean expected amount of the key's lines for that code and week.
    """
    per_invoice = lines.groupBy(*GROUP_KEYS, "invoice_number", "cpt_code").agg(
        F.sum("payment_amount").alias("payment_amount"),
        F.sum("expected_85em").alias("_sum_expected"),
        F.count("expected_85em").alias("_n_expected"),
    )
    keyed = benchmark_keys(null_safe_join(per_invoice, cpt_sets(lines), ["invoice_number"]))
    return (
        keyed.groupBy(*KEY_KEYS, "cpt_code")
        .agg(
            sum0(F.col("payment_amount")).alias("payment_amount"),
            F.count("invoice_number").alias("visit_count"),
            div_or_null(F.sum("_sum_expected"), F.sum("_n_expected")).alias("expected_amount_85_em"),
        )
    )


def baselines(weekly: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of each weekly metric per payer and groups, as ``<metric>_avg``."""
    return weekly.groupBy(*DIMS).agg(*[F.avg(m).alias(f"{m}_avg") for m in metrics])
