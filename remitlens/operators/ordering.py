"""Order-dependent operators that never sort a whole table in one task.

Each works on blocks: rows inside a block are handled by a window over the block, and what a block inherits from
earlier blocks comes from a much smaller table of block summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.operators.joins import null_safe_join


def forward_fill(df: DataFrame, cols: Sequence[str], order: str = "row_id", block_bits: int = 18) -> DataFrame:
    """Replace missing values by the last one above, in ``order`` (a unique, non-negative integer position).

    Blocks of ``2**block_bits`` positions are filled on their own. What a block inherits is found the same way among the
    blocks, level by level until a level has one block, so no window ever holds more than ``2**block_bits`` rows.
    """
    above = (Window.unboundedPreceding, -1)

    def inherited(rows: DataFrame, at: str, last: int) -> DataFrame:
        """(at, value before it) of ``rows``, whose positions ``at`` go up to ``last``."""
        window = Window.partitionBy(F.shiftright(at, block_bits)).orderBy(at).rowsBetween(*above)
        before = {f"_before_{c}": F.last(c, ignorenulls=True).over(window) for c in cols}
        if last >> block_bits == 0:
            return rows.withColumns(before).select(at, *before)
        up = f"{at}_up"
        spans = rows.withColumn(up, F.shiftright(at, block_bits))
        tops = spans.groupBy(up).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in cols])
        carried = inherited(tops, up, last >> block_bits).withColumnsRenamed({f"_before_{c}": f"_carry_{c}" for c in cols})
        joined = spans.withColumns(before).join(carried, up, "left")
        return joined.select(at, *[F.coalesce(f"_before_{c}", f"_carry_{c}").alias(f"_before_{c}") for c in cols])

    blocked = df.withColumn("_block", F.shiftright(F.col(order), block_bits))
    last = (df.agg(F.max(order)).first()[0] or 0) >> block_bits
    blocks = blocked.groupBy("_block").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols])
    carried = inherited(blocks, "_block", last).withColumnsRenamed({f"_before_{c}": f"_carry_{c}" for c in cols})

    in_block = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = blocked.withColumns({c: F.last(c, ignorenulls=True).over(in_block) for c in cols})
    filled = filled.join(carried, "_block", "left").withColumns({c: F.coalesce(c, f"_carry_{c}") for c in cols})
    return filled.select(df.columns)


def time_ordinal(df: DataFrame, tiebreak: Sequence[str], time: Sequence[str] = ("year", "week"), name: str = "ord") -> DataFrame:
    """Add each row's 0-based position by time, rows of one period ordered by ``tiebreak``.

    Row counts per prefix of (time, tiebreak) are summed level by level. The only global window runs over distinct
    periods; the others run inside one parent prefix, over the distinct values of one column.
    """
    above = (Window.unboundedPreceding, -1)
    prefix = [*time, *tiebreak[:-1]]
    counts = df.groupBy(*prefix).agg(F.count(F.lit(1)).alias("_n"))
    offsets = None
    for depth in range(len(time), len(prefix) + 1):
        level = prefix[:depth]
        at_level = counts.groupBy(*level).agg(F.sum("_n").alias("_n")) if depth < len(prefix) else counts
        if depth == len(time):
            window = Window.orderBy(*level)
        else:
            window = Window.partitionBy(*level[:-1]).orderBy(level[-1])
        step = at_level.select(*level, F.coalesce(F.sum("_n").over(window.rowsBetween(*above)), F.lit(0)).alias("_step"))
        if offsets is None:
            offsets = step.withColumnRenamed("_step", "_offset")
        else:
            offsets = null_safe_join(step, offsets, level[:-1])
            offsets = offsets.select(*level, (F.col("_offset") + F.col("_step")).alias("_offset"))
    within = Window.partitionBy(*prefix).orderBy(*tiebreak[-1:])
    ranked = df.withColumn("_rank", F.row_number().over(within) - 1)
    ranked = null_safe_join(ranked, offsets, prefix)
    return ranked.withColumn(name, (F.col("_offset") + F.col("_rank")).cast("bigint")).drop("_offset", "_rank")


def latest_window(df: DataFrame, n: int, tiebreak: Sequence[str], time: Sequence[str] = ("year", "week")) -> DataFrame:
    """The latest ``n`` rows by time, as a cap on training data. All rows when there are no more than ``n``."""
    total = df.agg(F.count(F.lit(1))).scalar()
    placed = time_ordinal(df, tiebreak, time, name="_ord")
    return placed.filter(F.col("_ord") >= total - n).drop("_ord")
