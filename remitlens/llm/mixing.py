"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected equally often (target by source size). These expectations are summed along the
source, longest documents first; with one random offset for the source, a document is emitted once for each integer
that its part of the sum crosses. Since sizes fall along the sum, what a source gives differs from its target by less
than its longest document.

Positions inside a source come from one range partitioning of all documents by (source, size, id): each partition
numbers its rows, and the partitions' counts by source give the offsets. No source, however large, meets in one task.

Defined cases: null texts have size 0; a null source is a source, last in order; null ids come last among equals;
repeated rows count as rows; sources without words have target 0; an empty table gives an empty mix; added columns
replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.common import SPACED_WORD, without
from remitlens.storage import stored

#: Weights that sources take in turn, by code point order of their names.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def size() -> Column:
    return F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACED_WORD)).cast("long")


def offset(source: Column, seed: int) -> Column:
    """Uniform in [0, 1), the same at every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) with its target.

    A level is raised until targets of weight times level, none above ``most`` times its size, add up to all sizes. It is
    found along the sources in order of the level at which they are full; that is one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long")
    rows = sources.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(rest))
    rows = rows.withColumn("at", F.row_number().over(by_fill))
    holds = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))
    level = F.min(holds).over(everything)["level"]
    return rows.withColumn("target", F.least(level * F.col("weight"), F.col("cap").cast("double"))).select("source", "source_size", "target")


def with_copies(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix takes the document).

    Documents without a ``text`` column bring their ``size`` along.
    """
    sized = docs.withColumn("size", size()) if "text" in docs.columns else docs
    rest = without(sized, "source_size", "target", "copies", "_mid", "_p", "_s", "_skip", "_expected")
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    ranged = rest.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_mid", F.monotonically_increasing_id()), "mixing")
    part, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    parts = placed.groupBy(part.alias("_p"), "source").agg(F.count("*").alias("n"), F.min(at).alias("first"), F.sum("size").alias("words"))
    parts = stored(parts, "mixing-parts")
    sources = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    places = parts.withColumn("_skip", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).select("_p", F.col("source").alias("_s"), "_skip")
    known = places.join(sources, F.col("_s").eqNullSafe(F.col("source"))).select("_p", "_s", "_skip", "source_size", "target")
    known = known.withColumn("_expected", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST_COPIES)))).otherwise(0.0))
    rows = placed.join(known, (part == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    nth, shift = at + F.col("_skip"), offset(F.col("source"), seed)
    crossed = F.floor(F.col("_expected") * (nth + 1) + shift) - F.floor(F.col("_expected") * nth + shift)
    return rows.withColumn("copies", crossed.cast("long")).drop("_mid", "_p", "_s", "_skip", "_expected")


def emitted(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: a document once for each copy, numbered in ``copy``."""
    rows = with_copies(without(docs, "copy"), seed).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
