"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words as the contracts define them: by white space, and by ASCII letters and digits after lower-casing A-Z.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: The second kind on text that still has its capitals; lower-casing a word afterwards gives the contract's words.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once for each row.

    A plain reference inside a lambda may be replaced by its expression, which would then run for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (names are compared as Spark does, without case)."""
    gone = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in gone])


def shielded(df: DataFrame, *reserved: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with columns of reserved names renamed, and a function that gives its columns back under their names.

    For filters, whose result has exactly the columns of the input even where an operator uses the same names, and, with
    ``more`` names, for results that add those columns.
    """
    taken = {n.lower() for n in reserved}
    names = {c: f"_own{i}" if c.lower() in taken else c for i, c in enumerate(df.columns)}
    renamed = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda out, *more: out.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()], *more)


def joined_sha256(values: Column) -> Column:
    return F.sha2(F.array_join(values, ",").cast("binary"), 256)


LONG, STRING, BOOL, BINARY = T.LongType(), T.StringType(), T.BooleanType(), T.BinaryType()
