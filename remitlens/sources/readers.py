"""Table readers."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from remitlens.storage import stored

_FORMATS = {"csv": "csv", "parquet": "parquet", "json": "json"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header line. Without a schema every column is text, so no inference pass over the data is made."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def _format(path: str) -> str | None:
    return _FORMATS.get(path.rstrip("/").lower().removesuffix(".gz").rsplit(".", 1)[-1])


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """Path and modification time of all files at and below a path or glob, contents unread; ``None`` if there is no such path."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return listing.select("path", "modificationTime")


def load(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str | None = None) -> DataFrame:
    """Read csv (also compressed), parquet or json: by ``fmt``, else by suffix, else by the suffix of a folder's files.

    Where none of these tells one format, ``ValueError`` is raised.
    """
    fmt = fmt or _format(path)
    if fmt is None and (files := _files(spark, path)) is not None:
        suffix = F.regexp_extract("path", r"\.(csv|parquet|json)(?:\.[a-z0-9]+)?$", 1)
        found = [r.suffix for r in files.select(suffix.alias("suffix")).where("suffix <> ''").distinct().limit(2).collect()]
        fmt = found[0] if len(found) == 1 else None
    if fmt not in _FORMATS.values():
        raise ValueError(f"Unsupported file format: {path}")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


#: Folder of the commit records of deliveries, and their columns.
COMMITS = "commits"
COMMIT = "number bigint, version string, tables array<string>"


def commits(spark: SparkSession, folder: str) -> list[Row]:
    """Commit records of deliveries in a folder, one for each complete one (number, version, tables)."""
    path = f"{folder.rstrip('/')}/{COMMITS}/*"
    return [] if _files(spark, path) is None else spark.read.schema(COMMIT).json(path).collect()


def published(spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """A table of the newest complete delivery that ``publish`` made; ``FileNotFoundError`` if there is none."""
    newest = max(commits(spark, folder), key=lambda r: (r["number"], r["version"]), default=None)
    if newest is None or name not in newest["tables"]:
        raise FileNotFoundError(f"No delivery of {name} in {folder}")
    return read_csv(spark, f"{folder.rstrip('/')}/{newest['version']}/{name}", schema)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path (or glob) that is present; ``FileNotFoundError`` when none is."""
    for path in paths:
        if _files(spark, path) is not None:
            return path
    raise FileNotFoundError(f"None of these exists: {list(paths)}")


def _depth(path: str) -> int:
    """Names in a path, without scheme and host."""
    return len([p for p in re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).split("/") if p])


def latest_snapshot(spark: SparkSession, patterns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Read the most recently modified of several snapshots, whole.

    A snapshot is what a pattern matches: a file, or a folder with all files below it, partitioned or not. Its age is
    that of its newest file. Modification times come from a listing that does not read contents, and only the winner
    is read. Ties go to the greatest path.
    """
    found = None
    for pattern in patterns:
        files = _files(spark, pattern)
        if files is not None:
            root = rf"^((?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?(?:/+[^/]+){{{_depth(pattern)}}})"
            units = files.select(F.regexp_extract("path", root, 1).alias("unit"), "modificationTime")
            found = units if found is None else found.unionByName(units)
    if found is None:
        raise FileNotFoundError(f"No file matches {list(patterns)}")
    newest = found.groupBy("unit").agg(F.max("modificationTime").alias("at")).orderBy(F.desc("at"), F.desc("unit")).first()
    if newest is None:
        raise FileNotFoundError(f"No file matches {list(patterns)}")
    return load(spark, newest["unit"], fmt=fmt)


#: Byte ranges up to which the table of their row offsets is broadcast (some 200 bytes each, so 20 MB).
BROADCAST_RANGES = 100_000


def _offsets(rows: DataFrame, headers: bool) -> DataFrame:
    """(_file, _block, _first, _before): where the rows of each byte range begin, over all files in path order.

    ``rows`` has _file, _block and _at, which grows along a range. One row for each range, summed before the shuffle;
    the first row of a file is at -1 if it is a header.
    """
    sizes = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    above = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(*above)
    ranges = sizes.withColumn("_in_file", F.coalesce(F.sum("_n").over(in_file), F.lit(0)))
    files = sizes.groupBy("_file").agg((F.sum("_n") - int(headers)).alias("_rows"))
    start = F.coalesce(F.sum("_rows").over(Window.orderBy("_file").rowsBetween(*above)), F.lit(0))
    joined = ranges.join(files.select("_file", start.alias("_start")), "_file")
    before = F.col("_start") - int(headers) + F.col("_in_file") - F.col("_first")
    return joined.select("_file", "_block", "_first", "_in_file", before.alias("_before"))


def _beside(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` with the offsets of their byte range."""
    small = offsets.count() <= BROADCAST_RANGES
    return rows.join(F.broadcast(offsets) if small else offsets, ["_file", "_block"])


def _numbered(rows: DataFrame, offsets: DataFrame, name: str, headers: bool) -> DataFrame:
    """``rows`` with their positions, without headers and helper columns."""
    placed = _beside(rows, offsets)
    if headers:
        placed = placed.where((F.col("_in_file") > 0) | (F.col("_at") > F.col("_first")))
    return placed.withColumn(name, F.col("_before") + F.col("_at")).drop("_file", "_block", "_at", "_first", "_in_file", "_before")


def _header(lines: DataFrame, offsets: DataFrame) -> list[str]:
    """Column names of the files' first lines, which must agree. The offsets tell where these lines are, so none is sorted."""
    first = _beside(lines, offsets.where("_in_file = 0")).where("_at = _first")
    found = [r.value for r in first.select(F.regexp_replace("value", "^\\x{FEFF}", "").alias("value")).distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError("The files have no common header" if found else "The files hold no lines")
    names = next(csv.reader(found))
    if len(set(names)) < len(names):
        raise ValueError(f"Columns occur twice in the header: {names}")
    return names


def read_csv_in_order(
    spark: SparkSession, path: str, schema: StructType | None = None, name: str = "row_id", multi_line: bool = False
) -> DataFrame:
    """CSV files with a header line each, and every row's position: files in path order, rows in file order.

    Lines are numbered where they are read: inside each byte range by a running number, and over the ranges by a prefix
    sum of their row counts. The lines are written out once with that number, because range bounds may differ between
    two scans of the files; so every later step, also after the loss of an executor, sees one numbering, and columns are
    parsed from the copy.

    A line with an odd number of quotes would be a part of a record with line feeds; rather than to misnumber it,
    ``ValueError`` is raised. With ``multi_line`` such records are read; then a file is a single range. Empty lines do
    not count. Without a schema every column is text.
    """
    source = F.col("_metadata.file_path").alias("_file")
    if multi_line:
        reader = spark.read.options(header=True, multiLine=True, escape='"', enforceSchema=False)
        table = (reader.schema(schema) if schema is not None else reader).csv(path)
        rows = table.select("*", source, F.lit(0).cast("bigint").alias("_block"), F.monotonically_increasing_id().alias("_at"))
        rows = stored(rows, "csv-rows")
        return _numbered(rows, stored(_offsets(rows, headers=False), "row-offsets"), name, headers=False)
    filled = spark.read.text(path).where(F.trim("value") != "")
    lines = filled.select("value", source, F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    lines = stored(lines, "csv-lines")
    offsets = stored(_offsets(lines, headers=True), "row-offsets")
    names = _header(lines, offsets)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    broken = lines.where(quotes % 2 == 1).select("_file", "value").first()
    if broken is not None:
        raise ValueError(f"A record of {broken['_file']} does not end on its line (multi_line reads it): {broken['value'][:80]}")
    if schema is None:
        schema = StructType([StructField(n, StringType()) for n in names])
    elif schema.fieldNames() != names:
        raise ValueError(f"The header {names} is not that of the schema {schema.fieldNames()}")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("value", fields, {"escape": '"'}).alias("_record")
    return _numbered(lines, offsets, name, headers=True).select(parsed, name).select("_record.*", name)


def with_file_order(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add each row's position in the files the frame was read from, files taken in path order.

    A single file needs no join; several need one small table of file offsets, counted from the files' own rows.
    """
    files = df.inputFiles()
    position = F.col("_metadata.row_index")
    if len(files) <= 1:
        return df.withColumn(name, position)
    sizes = df.select(F.col("_metadata.file_path").alias("_file"), position.alias("_at"))
    sizes = sizes.groupBy("_file").agg((F.max("_at") + 1).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    columns = [F.col(c) for c in df.columns]
    rows = df.select(*columns, F.col("_metadata.file_path").alias("_file"), position.alias("_at"))
    return rows.join(offsets, "_file", "left").select(*df.columns, (F.col("_offset") + F.col("_at")).alias(name))
