"""Writers. Each runs a Spark job and writes one folder of part files per table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from remitlens.functions.text import list_repr
from remitlens.operators.clean import split_required
from remitlens.sources.columns import present
from remitlens.sources.readers import COMMIT, COMMITS, commits


def _flat(df: DataFrame) -> DataFrame:
    """CSV holds no nested values: text lists take their bracketed form, other nested values become JSON."""
    out = {}
    for field in df.schema:
        if field.dataType == ArrayType(StringType()):
            out[field.name] = list_repr(F.col(field.name))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            out[field.name] = F.to_json(F.col(field.name))
    return df.withColumns(out) if out else df


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV with a header, optionally compressed (``compression="gzip"``)."""
    writer = _flat(df).write.mode("overwrite").option("header", True)
    (writer.option("compression", compression) if compression else writer).csv(path)


#: Rows that one task of ``write_csv_in_order`` sorts and writes, about.
ROWS_PER_FILE = 250_000


def write_csv_in_order(df: DataFrame, path: str, order: str, rows: int, least: int = 1) -> None:
    """CSV files with headers whose rows, files in path order, follow ``order``, which is not written; outer blanks stay.

    ``rows`` says about how many there are. The number of files grows with it, so a task sorts some ``ROWS_PER_FILE`` of
    a table of any size; there are ``least`` at least.
    """
    files = max(least, -(-rows // ROWS_PER_FILE))
    blocks = df.repartitionByRange(files, order).sortWithinPartitions(order).drop(order)
    blocks.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Hand-off table for later steps, partitioned by low-cardinality columns such as ``year``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, compression: str | None = None) -> None:
    """Several tables delivered together, one sub-folder each."""
    for name, df in tables.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}", compression)


def publish(tables: Mapping[str, DataFrame], folder: str, compression: str | None = None, display: bool = True) -> str:
    """Several tables delivered at once: readers see all of them, or those of the delivery before.

    Tables are written as CSV to a folder of their own, in delivery form unless ``display`` is off. The last step writes
    the delivery's commit record, a JSON table of one file that Spark's committer makes visible as a whole; ``published``
    follows the newest record only. A writer that dies between tables leaves a folder that nothing points to. Returns the
    name of the delivery.
    """
    some = next(iter(tables.values()))
    root = folder.rstrip("/")
    number = max((r["number"] for r in commits(some.sparkSession, root)), default=0) + 1
    version = f"{number:09d}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        write_csv(present(df) if display else df, f"{root}/{version}/{name}", compression)
    record = some.sparkSession.createDataFrame([(number, version, sorted(tables))], COMMIT).coalesce(1)
    record.write.mode("errorifexists").json(f"{root}/{COMMITS}/{version}")
    return version


def write_json(df: DataFrame, path: str) -> None:
    """Records such as run summaries and model metrics."""
    df.write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str) -> None:
    """Narrative lines: ``n``, ``text`` become ``"n. text"``."""
    lines = df.orderBy("n").select(F.concat(F.col("n").cast("string"), F.lit(". "), F.col("text")).alias("value"))
    lines.write.mode("overwrite").text(path)


def write_with_rejects(df: DataFrame, path: str, rejects_path: str) -> None:
    """Accepted rows to one Parquet table, rows lacking a required field to a CSV report."""
    good, rejects = split_required(df)
    write_parquet(good, path)
    write_csv(rejects, rejects_path)
