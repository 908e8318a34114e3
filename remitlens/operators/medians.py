"""Exact medians of large columns in two scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.storage import stored

#: The sketch's greatest error in rank is one in this many; the pivots lie twice that from the middle.
ACCURACY = 1000
#: Values around a median that one task ranks; where there are more, they are cut into buckets first.
WINDOW_ROWS = 1 << 18
_BUCKETS = 4096


def _values(cols: Sequence[str]) -> dict[str, Column]:
    """Numbers of each column; missing ones and NaN are null."""
    value = {c: F.col(c).cast("double") for c in cols}
    return {c: F.when(~F.isnan(v), v) for c, v in value.items()}


def exact_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row holding the exact median of each column, missing values skipped.

    The built-in exact median keeps every distinct value of a column in one task. Here a first scan makes one mergeable
    quantile sketch a column, which gives two pivots around its median. A second scan counts what lies below them and
    what stands between, the latter value by value; both are summed before the shuffle. That is some thousandth of
    the rows, and what else has to be done to find the middle rank reads that table alone.
    """
    values = _values(cols)
    near = F.array(F.lit(0.5 - 2 / ACCURACY), F.lit(0.5 + 2 / ACCURACY))
    sketches = [F.struct(F.count(v).alias("n"), F.percentile_approx(v, near, F.lit(ACCURACY)).alias("pivots")) for v in values.values()]
    found = dict(zip(cols, df.agg(*[s.alias(f"_{i}") for i, s in enumerate(sketches)]).first(), strict=True))
    # Ranks of the two middle values (one for an odd count).
    ranks = {c: ((f["n"] - 1) // 2, f["n"] // 2) for c, f in found.items() if f["n"]}
    counts = _between(df, {c: (values[c], *found[c]["pivots"]) for c in ranks}) if ranks else None
    medians = _middle(counts, ranks) if ranks else {}
    return df.sparkSession.createDataFrame([tuple(medians.get(c) for c in cols)], ", ".join(f"`{c}` double" for c in cols))


def _between(df: DataFrame, pivots: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """(name, v, n): how often each value between a column's pivots occurs; v is null for all that lie below."""
    marks = [
        F.when(v <= high, F.struct(F.lit(c).alias("name"), F.when(v >= low, v).alias("v")))
        for c, (v, low, high) in pivots.items()
    ]
    rows = df.select(F.inline(F.filter(F.array(*marks), lambda m: m.isNotNull())))
    return stored(rows.groupBy("name", "v").agg(F.count(F.lit(1)).alias("n")), "median-counts")


def _middle(counts: DataFrame, ranks: dict[str, tuple[int, int]]) -> dict[str, float]:
    """The medians, from ``counts`` alone. The driver holds a few numbers a column."""
    sizes = counts.groupBy("name").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("below"),
        F.sum("n").alias("all"),
        F.count("v").alias("values"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    spans = {r["name"]: r for r in sizes.collect()}
    below = {c: r["below"] for c, r in spans.items()}
    for c, (first, last) in ranks.items():
        if not below[c] <= first <= last < spans[c]["all"]:
            raise ArithmeticError(f"The sketch of {c} is off by more than its bound")
    inside = counts.where("v IS NOT NULL")
    while max(r["values"] for r in spans.values()) > WINDOW_ROWS:
        inside, spans, below = _narrowed(inside, spans, below, ranks)
    window = Window.partitionBy("name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    start = _lookup(below)
    upto = inside.withColumn("upto", F.sum("n").over(window) + start)
    at = [F.min(F.when(F.col("upto") > _lookup({c: r[i] for c, r in ranks.items()}), F.col("v"))).alias(f"_{i}") for i in (0, 1)]
    return {r["name"]: (r["_0"] + r["_1"]) / 2 for r in upto.groupBy("name").agg(*at).collect()}


def _lookup(numbers: dict[str, float]) -> Column:
    table = F.create_map(*[x for c, n in numbers.items() for x in (F.lit(c), F.lit(n))])
    return F.element_at(table, F.col("name"))


def _narrowed(inside: DataFrame, spans: dict, below: dict[str, int], ranks: dict[str, tuple[int, int]]) -> tuple[DataFrame, dict, dict[str, int]]:
    """Only the equal-width buckets that hold a middle rank, with their spans and the rows below them."""
    low, high = (_lookup({c: float(r[k]) for c, r in spans.items()}) for k in ("low", "high"))
    # Halves keep the width finite for any two numbers.
    share = F.try_divide(F.col("v") / 2 - low / 2, high / 2 - low / 2)
    bucket = F.least(F.coalesce(F.floor(share * _BUCKETS), F.lit(0)), F.lit(_BUCKETS - 1)).cast("int")
    rows = inside.withColumn("bucket", bucket)
    stats = rows.groupBy("name", "bucket").agg(F.sum("n").alias("n"), F.count("v").alias("values"), F.min("v").alias("low"), F.max("v").alias("high"))
    by_name: dict[str, list] = {}
    for r in stats.orderBy("name", "bucket").collect():  # at most _BUCKETS a column
        by_name.setdefault(r["name"], []).append(r)
    kept, new_spans, new_below = {}, {}, {}
    for c, buckets in by_name.items():
        at, chosen = below[c], []
        for r in buckets:
            if at <= ranks[c][1] and at + r["n"] > ranks[c][0]:
                if not chosen:
                    new_below[c] = at
                chosen.append(r)
            at += r["n"]
        kept[c] = (float(chosen[0]["low"]), float(chosen[-1]["high"]))
        new_spans[c] = {"values": sum(r["values"] for r in chosen), "low": kept[c][0], "high": kept[c][1]}
    first, last = (_lookup({c: k[i] for c, k in kept.items()}) for i in (0, 1))
    return inside.where((F.col("v") >= first) & (F.col("v") <= last)), new_spans, new_below
