"""Quality rules as a ledger of failure bits.

Every rule is evaluated once. The ledger keeps the measurements and one bit for each failed rule; policies are versioned
masks over these bits, so that a new policy, or the effect of leaving one rule out, needs no second look at the texts.

Defined cases: a null text counts as empty (no words, so it fails ``few_words``); rows are judged on their own, so
repeated rows give repeated results and null ids stay; ratios of texts without words are not failures; columns of the
input that carry a ledger name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import SPACE, SPACED_WORD, let, shielded, without

SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` never changes meaning once ledgers are stored."""

    name: str
    bit: int
    fails: str


@dataclass(frozen=True)
class Policy:
    """Rules that reject a document, under a version."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...]) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in self.rules)


RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
)
#: ``base`` is what the contract calls base_failed; ``v1`` is in force.
BASE = Policy("base", ("few_words", "repeated_words"))
V1 = Policy("v1", ("few_words", "repeated_words", "many_symbols", "repeated_lines", "word_length"))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Column) -> Column:
    """Words inside a window of eight that the text holds twice or more, the first one included.

    Windows are compared by a 64-bit hash of their words' hashes. Only texts in which a hash occurs twice sort them.
    """

    def covered(windows: Column) -> Column:
        def starts(ordered: Column) -> Column:
            again = F.filter(ordered, lambda w, i: (w["h"] == F.get(ordered, i - 1)["h"]) | (w["h"] == F.get(ordered, i + 1)["h"]))
            return F.sort_array(F.transform(again, lambda w: w["at"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.get(at, i + 1) - p))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        repeated = let(let(by_hash, starts), length)
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), repeated).otherwise(F.lit(0))

    def windows(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(hashed, windows), covered)).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = without(docs, *MEASURES, "_words", "_lines")
    split = rest.withColumns(
        {
            "_words": F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0)),
            "_lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    return split.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
        }
    ).drop("_words", "_lines")


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``fail_bits``; no shuffle, no text leaves its partition."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(without(docs, "fail_bits")).withColumn("fail_bits", total.cast("long"))


def rejected(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules))) != 0


def ablation(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents that fail it, and documents that only it rejects.

    Ledger rows are first counted by their failure bits: at most one row for each combination of rules is shuffled.
    """
    mask = policy.mask(rules)
    counts = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    named = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in policy.rules]))
    each = counts.select("bits", "n", named.alias("r")).select("bits", "n", "r.rule", "r.bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def passing(docs: DataFrame, policy: Policy = V1) -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    rows, restored = shielded(docs, *MEASURES, "fail_bits", "_words", "_lines")
    return restored(ledger(rows).where(~rejected(policy)))
