"""Elastic net from sufficient statistics.

One pass over the rows adds up products of features and target for each block of time and combination of categories.
These sums are mergeable: the training matrix of a fold is the sum over the blocks before it, so all folds and the final
fit come from one table of sums and no fold reads rows again. Missing numbers are kept apart (a product of
indicators), so that each fold's own training medians can be put in afterwards, by a linear map of its sums.

The penalised least-squares problem is then solved by coordinate descent on the centred second moments, feature by feature
in a fixed order until nothing moves. Its size is that of the features, not of the rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import ML_CATEGORICAL, ML_NUMERIC
from remitlens.functions.text import MISSING_PART
from remitlens.sources.columns import ensure_columns
from remitlens.storage import stored

#: Category values up to which second moments are held by the driver (8 bytes for each pair of them).
MAX_LEVELS = 4096
SWEEPS, TOLERANCE = 5000, 1e-12
_TARGET, _ONE = "y", "one"
_PRODUCTS = ["block", "c", "a", "d", "b", "value"]


@dataclass(frozen=True)
class Linear:
    """A fitted linear model: medians for gaps, a weight for each number and category value, and a constant."""

    medians: Mapping[str, float]
    weights: Mapping[str, float]
    levels: Mapping[str, Mapping[str, float]]
    intercept: float

    def predicted(self) -> Column:
        """The prediction as an expression on the feature columns; unknown category values weigh nothing."""
        out = F.lit(self.intercept)
        for c, median in self.medians.items():
            out = out + F.coalesce(_number(c), F.lit(median)) * F.lit(self.weights[c])
        for c, weights in self.levels.items():
            table = F.create_map(*[x for level, w in sorted(weights.items()) for x in (F.lit(level), F.lit(w))])
            out = out + F.coalesce(F.try_element_at(table, _category(c)), F.lit(0.0))
        return out


def _number(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def _category(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(MISSING_PART))


@dataclass(frozen=True)
class Statistics:
    """Sums of products by block, on the driver: blocks x features x features over numbers, gaps and categories.

    ``names`` are the features in order: the numbers, their gap indicators, the target, the constant, and each category
    value as (column, value).
    """

    names: list
    sums: np.ndarray

    def prefix(self, n_blocks: int) -> np.ndarray:
        """Sums over the first blocks."""
        return self.sums[:n_blocks].sum(axis=0)


def statistics(rows: DataFrame, target: str, gaps: Sequence[str], n_blocks: int, block: str = "block") -> Statistics:
    """Sums over ``rows`` (which name their block) in one pass; ``gaps`` are the numbers that may be missing.

    Each task multiplies its batches' columns out and adds up; it sends one row for each pair of features that it saw
    together, and these rows are summed before and after the shuffle.
    """
    rows = ensure_columns(rows, {c: None for c in ML_NUMERIC})
    parts = {c: F.coalesce(_number(c), F.lit(0.0)) for c in ML_NUMERIC}
    parts |= {f"gap:{c}": _number(c).isNull().cast("double") for c in gaps}
    parts |= {_TARGET: F.col(target).cast("double"), _ONE: F.lit(1.0)}
    names, n_categories = list(parts), len(ML_CATEGORICAL)
    categories = [_category(c).alias(f"_c{i}") for i, c in enumerate(ML_CATEGORICAL)]
    given = rows.select(F.col(block).cast("int").alias("block"), *categories, F.array(*parts.values()).alias("z"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, float] = defaultdict(float)
        for batch in batches:
            z = batch.column("z").flatten().to_numpy().reshape(-1, len(names))
            blocks, block_of = np.unique(batch.column("block").to_numpy(), return_inverse=True)
            coded = [batch.column(f"_c{i}").dictionary_encode() for i in range(n_categories)]
            levels = [c.dictionary.to_pylist() for c in coded]
            codes = [c.indices.to_numpy() for c in coded]
            for k, at in enumerate(blocks.tolist()):
                own = block_of == k
                some = z[own]
                second = some.T @ some
                for i, a in enumerate(names):
                    for j in range(i, len(names)):
                        sums[at, -1, a, -1, names[j]] += second[i, j]
                for c in range(n_categories):
                    mine, n = codes[c][own], len(levels[c])
                    first = np.stack([np.bincount(mine, some[:, i], n) for i in range(len(names))])
                    for level in np.flatnonzero(first[-1]).tolist():
                        for i, a in enumerate(names):
                            sums[at, -1, a, c, levels[c][level]] += first[i, level]
                        sums[at, c, levels[c][level], c, levels[c][level]] += first[-1, level]
                    for other in range(c + 1, n_categories):
                        both = np.bincount(mine * len(levels[other]) + codes[other][own])
                        for pair in np.flatnonzero(both).tolist():
                            x, y = divmod(pair, len(levels[other]))
                            sums[at, c, levels[c][x], other, levels[other][y]] += float(both[pair])
        columns = [[key[i] for key in sums] for i in range(5)]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array(list(sums.values()), pa.float64())], names=_PRODUCTS)

    sent = given.mapInArrow(products, "block int, c int, a string, d int, b string, value double")
    sums = stored(sent.groupBy(*_PRODUCTS[:-1]).agg(F.sum("value").alias("value")), "rate-statistics")
    levels = sums.where("c >= 0").select("c", "a").distinct()
    n_levels = levels.count()
    if n_levels > MAX_LEVELS:
        raise ValueError(f"{n_levels} category values are more than an elastic net takes here ({MAX_LEVELS})")
    features = [*names, *sorted((r["c"], r["a"]) for r in levels.collect())]
    at = {n: i for i, n in enumerate(features)}
    out = np.zeros((n_blocks, len(at), len(at)))
    for block_no, c, a, d, b, value in sums.collect():
        x, y = at[a if c < 0 else (c, a)], at[b if d < 0 else (d, b)]
        out[block_no, x, y] = out[block_no, y, x] = value
    return Statistics(features, out)


def descend(second: np.ndarray, first: np.ndarray, l1: float, l2: float, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights that minimise w'Cw / 2 - c'w + l1 |w| + l2 w'w / 2, by cyclic coordinate descent.

    ``second`` is C, ``first`` is c, both centred and per row. A sweep that moves no prediction by more than
    ``tolerance`` of the largest first step ends it.
    """
    weights, spread = np.zeros(len(first)), np.sqrt(np.maximum(np.diag(second), 0))
    largest = 0.0
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(spread > 0):
            rho = first[j] - second[j] @ weights + second[j, j] * weights[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (second[j, j] + l2)
            moved = max(moved, abs(new - weights[j]) * spread[j])
            weights[j] = new
        largest = max(largest, moved)
        if moved <= tolerance * largest:
            break
    return weights


def solve(stats: Statistics, n_blocks: int, medians: Mapping[str, float | None], alpha: float, l1_ratio: float) -> Linear:
    """The elastic net on the first blocks: 1 / 2n |y - b - Xw|² + alpha (l1_ratio |w| + (1 - l1_ratio) / 2 w²).

    Numbers without any value, whose median is None, are left out.
    """
    sums = stats.prefix(n_blocks)
    at = {n: i for i, n in enumerate(stats.names)}
    used = [c for c in ML_NUMERIC if medians[c] is not None]
    levels = [n for n in stats.names if isinstance(n, tuple)]
    # Rows of the map: each imputed number, each category value, the target; columns: what was summed.
    lift = np.zeros((len(used) + len(levels) + 1, len(stats.names)))
    for i, c in enumerate(used):
        lift[i, at[c]] = 1.0
        if f"gap:{c}" in at:
            lift[i, at[f"gap:{c}"]] = medians[c]
    for i, level in enumerate(levels, len(used)):
        lift[i, at[level]] = 1.0
    lift[-1, at[_TARGET]] = 1.0
    n = sums[at[_ONE], at[_ONE]]
    mean = lift @ sums[:, at[_ONE]] / n
    centred = lift @ sums @ lift.T / n - np.outer(mean, mean)
    weights = descend(centred[:-1, :-1], centred[:-1, -1], alpha * l1_ratio, alpha * (1 - l1_ratio))
    by_column = {c: {} for c in ML_CATEGORICAL}
    for (c, level), w in zip(levels, weights[len(used) :], strict=True):
        by_column[ML_CATEGORICAL[c]][level] = float(w)
    return Linear({c: float(medians[c]) for c in used}, dict(zip(used, map(float, weights))), by_column, float(mean[-1] - mean[:-1] @ weights))
