"""Text column helpers: keys, percent text and narrative sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text a missing key part takes, so that keys with missing parts stay distinct.
MISSING_PART = "nan"


def list_repr(arr: Column) -> Column:
    """``['a', 'b']``; ``[]`` when empty."""
    return F.when(F.size(arr) == 0, "[]").otherwise(F.concat(F.lit("['"), F.array_join(arr, "', '"), F.lit("']")))


def pipe_key(*parts: Column) -> Column:
    """Parts joined by ``|``, missing parts spelled out (``concat_ws`` alone would drop them)."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(MISSING_PART)) for p in parts])


def cpt_count(key: Column) -> Column:
    """Number of codes in the list that ends a benchmark key; 0 when the last part is not such a list."""
    tail = F.trim(F.substring_index(key, "|", -1))
    item = r"(?:'[^']*'|\"[^\"]*\"|[0-9]+)"
    is_list = tail.rlike(rf"^\[\s*({item}\s*(,\s*{item}\s*)*,?\s*)?\]$")
    return F.when(is_list, F.regexp_count(tail, F.lit(item))).otherwise(F.lit(0))


def percent_text(c: Column) -> Column:
    """0.455 to ``"46%"`` (halves to even); a missing value is ``"<NA>%"``."""
    whole = F.rint(c.cast("double") * 100).cast("bigint").cast("string")
    return F.concat(F.coalesce(whole, F.lit("<NA>")), F.lit("%"))


def ml_sentence(dollars: Column, flags: Column, rate_gap: Column) -> Column:
    """One sentence on a group's model gaps; empty when there is no dollar gap."""
    text = F.format_string(
        "ML signals %s-payment ≈ $%s (%d material flags; avg rate gap %s/visit).",
        F.when(dollars < 0, "under").otherwise("over"),
        F.format_number(F.abs(dollars), 0),
        F.coalesce(flags, F.lit(0)).cast("bigint"),
        fixed2(rate_gap, sign=True),
    )
    return F.when(dollars.isNull(), "").otherwise(text)


def zero_balance_text(zbcr: Column, cr: Column, zbcr_base: Column, cr_base: Column) -> Column:
    """Where a group's zero-balance collection rate stands against its baseline."""
    missing = zbcr.isNull() | cr.isNull() | zbcr_base.isNull() | cr_base.isNull()
    return (
        F.when(missing, "Collection data incomplete")
        .when(zbcr < 0.75 * zbcr_base, "Below baseline")
        .when((zbcr > 1.25 * zbcr_base) | (zbcr > 1.2 * cr_base), "Above baseline")
        .otherwise("Normal range")
    )


def fixed2(c: Column, sign: bool = False) -> Column:
    """Two decimals with halves to even; ``sign`` also marks positive numbers."""
    return F.format_string("%+.2f" if sign else "%.2f", F.rint(c * 100) / 100)


def money(c: Column) -> Column:
    """Two decimals with thousands separators."""
    return F.format_number(c, 2)
