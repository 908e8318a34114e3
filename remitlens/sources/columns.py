"""Column standardisation of source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import ALTERNATE_NAMES, DISPLAY_NAMES, GAP_MEASURES, LINE_MEASURES, PERCENT_COLUMNS, SOURCE_NAMES
from remitlens.functions.numbers import parse_number, strip
from remitlens.functions.text import percent_text


def quoted(name: str) -> str:
    """Column reference for names holding dots."""
    return "`" + name.replace("`", "``") + "`"


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop index columns left over by spreadsheet exports (``Unnamed: 0`` and the like)."""
    return df.select([F.col(quoted(c)) for c in df.columns if not c.startswith("Unnamed")])


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename report headers to canonical names; alternate spellings apply where the canonical name is still free."""
    renames = {c: SOURCE_NAMES[c] for c in df.columns if c in SOURCE_NAMES}
    taken = {renames.get(c, c) for c in df.columns}
    for name, spellings in ALTERNATE_NAMES.items():
        if name in taken:
            continue
        for spelling in spellings:
            match = next((c for c in df.columns if c not in renames and c.strip().lower() == spelling), None)
            if match is not None:
                renames[match] = name
                break
    return df.select([F.col(quoted(c)).alias(renames.get(c, c)) for c in df.columns])


def ensure_columns(df: DataFrame, defaults: Mapping[str, object], dtype: str = "double") -> DataFrame:
    """Add the columns that are absent, filled with their default (None for a missing value)."""
    absent = {c: F.lit(v).cast(dtype) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def complete_lines(df: DataFrame) -> DataFrame:
    """Give invoice lines all measures: absent gap columns are 0, other absent measures missing."""
    return ensure_columns(df, {c: 0.0 if c in GAP_MEASURES else None for c in LINE_MEASURES})


def billed_balance(df: DataFrame) -> DataFrame:
    """Supply ``charge_billed_balance`` from the first column named like it when it is absent."""
    if "charge_billed_balance" in df.columns:
        return df
    for c in df.columns:
        if "Charge Billed" in c and "Balance" in c:
            value = F.coalesce(parse_number(F.col(quoted(c))), F.lit(0.0))
            return df.withColumn("charge_billed_balance", value)
    return df


def trim_ids(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast identifiers to text and trim them."""
    return df.withColumns({c: strip(F.col(c).cast("string")) for c in cols if c in df.columns})


def normalize_columns(df: DataFrame, percent: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """Parse the listed percent and numeric columns; absent ones are skipped."""
    wanted = [c for c in [*percent, *numeric] if c in df.columns]
    return df.withColumns({c: parse_number(F.col(c)) for c in wanted}) if wanted else df


def present(df: DataFrame, percent_as_text: bool = True) -> DataFrame:
    """Delivery form: report column names, and percent columns as whole-percent text."""
    out = []
    for c in df.columns:
        value = percent_text(F.col(c)) if percent_as_text and c in PERCENT_COLUMNS else F.col(c)
        out.append(value.alias(DISPLAY_NAMES.get(c, c)))
    return df.select(out)
