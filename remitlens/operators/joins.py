"""Joins in which missing keys match missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` with NULL equal to NULL; ``right`` adds its other columns.

    ``<=>`` plans as an ordinary hash or sort-merge join. Both inputs are exchanged for it even when one is an
    aggregate on the same keys, and that is wanted: only then may adaptive execution split the partitions of a key
    that holds a large share of the left rows, or switch to a broadcast once the right side's real size is known.
    """
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(other, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        # The two sides' keys are equal where both exist, so either serves.
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    return joined.drop(*[f"_right_{k}" for k in keys])
