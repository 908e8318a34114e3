"""Narratives: what went well, what can be improved, zero-balance collection, model signals, overall text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.contracts import BASELINE_METRICS, DEFAULT_THRESHOLDS, DIMS, GROUP_KEYS, TIME, Thresholds
from remitlens.functions.text import MISSING_PART, fixed2, ml_sentence, money, zero_balance_text
from remitlens.operators.compact import gap_totals
from remitlens.operators.diagnostics import label_flags, label_lenses, volume_no_lift
from remitlens.operators.joins import null_safe_join
from remitlens.operators.ml_report import hotspots, ml_columns

# Report name of each metric, and whether an increase is good.
METRIC_TEXT = {
    "charge_billed_balance": ("Charge Billed Balance", False),
    "zero_balance_collection_star_charges": ("Zero Balance - Collection * Charges", False),
    "nrv_zero_balance": ("NRV Zero Balance*", True),
    "zero_balance_collection_rate": ("Zero Balance Collection Rate", True),
    "collection_rate": ("Collection Rate*", True),
    "payment_amount": ("Payment Amount*", True),
    "denial_percent": ("Denial %", False),
    "nrv_gap_dollar": ("NRV Gap ($)", False),
    "nrv_gap_percent": ("NRV Gap (%)", False),
    "remaining_charges_percent": ("% of Remaining Charges", False),
    "nrv_gap_sum_dollar": ("NRV Gap Sum ($)", False),
}

# Payers reported first, in this order.
PRIORITY_PAYERS = [
    "BCBS",
    "AETNA",
    "MEDICAID",
    "SELF PAY",
    "UNITED HEALTHCARE",
    "CIGNA",
    "HUMANA",
    "TRICARE",
    "MEDICARE",
]

TOP_SENTENCES = 6


def metric_changes(df: DataFrame) -> DataFrame:
    """One row per week, group and metric that differs from its baseline: side, relative change, subject and both values.

    No change at all counts as a decrease on the bad side. A negative baseline of the collection-adjusted balance has
    its own rule: nothing left is good, a positive balance is bad.
    """
    metrics = [m for m in BASELINE_METRICS if m in df.columns and f"{m}_avg" in df.columns]
    entries = []
    for m in metrics:
        label, rise_is_good = METRIC_TEXT[m]
        entries.append(
            F.struct(
                F.lit(m).alias("metric"),
                F.lit(label).alias("label"),
                F.lit(rise_is_good).alias("rise_is_good"),
                F.col(m).cast("double").alias("act"),
                F.col(f"{m}_avg").cast("double").alias("avg"),
            )
        )
    rows = df.select(*TIME, "payer", "group_em", F.inline(F.array(*entries)))
    act, avg = F.col("act"), F.col("avg")
    rows = rows.filter(act.isNotNull() & (avg != 0))
    rose, fell = act > avg, act < avg
    good = (rose & F.col("rise_is_good")) | (fell & ~F.col("rise_is_good"))
    special = (F.col("metric") == "zero_balance_collection_star_charges") & (avg < 0)
    good = F.when(special & (act >= 0), act == 0).otherwise(good)

    def part(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(MISSING_PART))

    subject = F.concat(
        part("payer"),
        F.lit(" – "),
        part("group_em"),
        F.lit(" "),
        F.col("label"),
        F.when(rose, " increased").otherwise(" decreased"),
    )
    return rows.select(
        *TIME,
        F.when(good, "good").otherwise("bad").alias("side"),
        (F.abs(F.try_divide(act - avg, avg)) * 100.0).alias("pct"),
        subject.alias("subject"),
        "act",
        "avg",
    )


def _priority(subject: Column) -> Column:
    payer = F.upper(F.trim(F.substring_index(subject, "–", 1)))
    position = F.array_position(F.array(*[F.lit(p) for p in PRIORITY_PAYERS]), payer)
    return F.when(position > 0, position - 1).otherwise(len(PRIORITY_PAYERS))


def top_sentences(changes: DataFrame, k: int = TOP_SENTENCES) -> DataFrame:
    """The ``k`` leading sentences per week and side: priority payers first, then the largest relative change.

    Sentences on one subject collapse to the one with the largest change; ties go by text. The cut is made on numbers:
    of each subject its largest change, of these the first k, with those that tie. Only what is left is put into words, to
    settle the ties. ``changes`` are read twice, so hand in stored ones where they cost something.
    """
    subject = [*TIME, "side", "subject"]
    largest = changes.groupBy(*subject).agg(F.max("pct").alias("_largest")).withColumn("_prio", _priority(F.col("subject")))
    order = Window.partitionBy(*TIME, "side").orderBy("_prio", F.desc("_largest"))
    # The rank filter lets Spark keep k ranks per week and task before the shuffle.
    leading = largest.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") <= k).drop("_rank")
    tied = null_safe_join(changes, leading, subject, "inner").filter(F.col("pct") == F.col("_largest"))
    text = F.concat("subject", F.lit(" from avg "), fixed2(F.col("avg")), F.lit(" to "), fixed2(F.col("act")))
    best = tied.groupBy(*subject, "_prio", "_largest").agg(F.min(text).alias("text"))
    final = Window.partitionBy(*TIME, "side").orderBy("_prio", F.desc("_largest"), "text")
    ranked = best.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ranked.select(*TIME, "side", "rank", "text")


def revenue_cycle(df: DataFrame, k: int = TOP_SENTENCES) -> DataFrame:
    """Both texts per week; empty when there is nothing to say."""
    top = top_sentences(metric_changes(df), k)

    def joined(side: str) -> Column:
        entries = F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("rank", "text"))))
        return F.array_join(F.transform(entries, lambda e: e["text"]), "; ")

    texts = top.groupBy(*TIME).agg(joined("good").alias("went_well"), joined("bad").alias("can_improve"))
    weeks = null_safe_join(df.select(*TIME).distinct(), texts, TIME)
    return weeks.withColumns({c: F.coalesce(c, F.lit("")) for c in ("went_well", "can_improve")})


def zero_balance(df: DataFrame) -> DataFrame:
    """Mean collection rates per week and group, their baselines over weeks, and the narrative on both."""
    rates = ["zero_balance_collection_rate", "collection_rate"]
    groups = df.groupBy(*GROUP_KEYS).agg(*[F.avg(c).alias(c) for c in rates])
    base = groups.groupBy(*DIMS).agg(
        F.avg("zero_balance_collection_rate").alias("zbcr_baseline"), F.avg("collection_rate").alias("cr_baseline")
    )
    groups = null_safe_join(groups, base, DIMS)
    text = zero_balance_text(*[F.col(c) for c in [*rates, "zbcr_baseline", "cr_baseline"]])
    dash = F.lit(" – ")
    sentence = F.concat(F.col("payer"), dash, F.col("group_em"), dash, F.col("group_em2"), dash, text)
    return groups.withColumns({"zero_balance_text": text, "zero_balance_narrative": sentence})


def join_text(df: DataFrame, text: str = "zero_balance_narrative") -> DataFrame:
    """Distinct sentences of each week in text order, joined by "; ". Missing ones are skipped."""
    return df.groupBy(*TIME).agg(F.array_join(F.sort_array(F.collect_set(text)), "; ").alias(text))


def narratives(diagnostics: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Weekly group table with flags, weekly texts and, when model columns are there, a model sentence.

    Takes the diagnostics base, which the texts need for its averages; scored rows keep their model columns. The
    table is read several times, so hand in a stored one.
    """
    df = volume_no_lift(label_flags(label_lenses(diagnostics, thresholds)))
    if ml_columns(df) is None:
        df = df.withColumn("ml_narrative_summary", F.lit(""))
    else:
        df = null_safe_join(df, hotspots(df), GROUP_KEYS)
        sentence = ml_sentence(F.col("ml_dollar_gap_sum"), F.col("ml_material_flag_sum"), F.col("ml_rate_gap_mean"))
        df = df.withColumn("ml_narrative_summary", sentence)
    df = null_safe_join(df, revenue_cycle(diagnostics), TIME)
    return null_safe_join(df, join_text(zero_balance(diagnostics)), TIME)


def overall_narrative(
    with_gaps: DataFrame, gaps_by_payer: DataFrame, metrics: DataFrame | None = None, legacy_text: bool = False
) -> DataFrame:
    """Numbered lines: overall gap, model quality when ``metrics`` (a row with ``r2``) is given, worst payer.

    The gap is payment less benchmark, so a negative total is underperformance. ``legacy_text=True`` reproduces the
    earlier reports, which read the sign the other way and named the alphabetically first payer.
    """
    total, avg = F.col("total_gap"), F.col("avg_gap")
    behind, shown = (total > 0, lambda c: c) if legacy_text else (total < 0, F.abs)
    overall = F.when(
        behind,
        F.concat(
            F.lit("💰 Overall Performance: The practice is underperforming by $"),
            money(shown(total)),
            F.lit(" against the 85% benchmark, with an average gap of $"),
            fixed2(shown(avg)),
            F.lit(" per transaction."),
        ),
    ).otherwise(
        F.concat(
            F.lit("✅ Overall Performance: The practice is performing well, exceeding the 85% benchmark by $"),
            money(F.abs(total)),
            F.lit("."),
        )
    )
    parts = [gap_totals(with_gaps).select(F.lit(1).alias("part"), overall.alias("text"))]
    if metrics is not None:
        r2 = F.col("r2")
        shown_r2 = F.concat(F.lit("(R²="), F.format_string("%.1f%%", F.rint(r2 * 1000) / 10), F.lit(")"))
        power = F.when(r2 > 0.7, "strong").when(r2 > 0.5, "moderate").otherwise("limited")
        ending = (
            F.when(r2 > 0.7, " for payment rates, indicating reliable rate estimation.")
            .when(r2 > 0.5, " for payment rates.")
            .otherwise(", suggesting payment rates may be influenced by external factors.")
        )
        text = F.concat(
            F.lit("🤖 ML Insights: The machine learning model shows "), power, F.lit(" predictive power "), shown_r2, ending
        )
        parts.append(metrics.filter(r2.isNotNull()).select(F.lit(2).alias("part"), text.alias("text")))
    ranked = gaps_by_payer.agg(
        F.min_by(F.struct("payer", "avg_gap", "total_gap"), F.struct("avg_gap", "payer")).alias("worst"),
        F.min("payer").alias("first"),
    ).filter(F.col("worst").isNotNull())
    named = F.col("first") if legacy_text else F.col("worst.payer")
    text = F.concat(
        F.lit("📊 Top Underpayment Driver: "),
        named,
        F.lit(" shows the largest average gap ($"),
        fixed2(F.col("worst.avg_gap")),
        F.lit(") and represents $"),
        money(F.col("worst.total_gap")),
        F.lit(" in total underpayments."),
    )
    parts.append(ranked.select(F.lit(3).alias("part"), text.alias("text")))
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    # At most three lines, so numbering them in one task is cheap.
    return lines.select(F.row_number().over(Window.orderBy("part")).alias("n"), "text")
