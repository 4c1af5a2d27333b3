"""Workbook files: discovery, scan into sheet rows, presence on disk."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from sheetstar import fixed, schemas
from sheetstar.sources.workbook_cells import read_rows

# Rows per Arrow batch handed back by a scan task.
ROWS_PER_BATCH = 2_000

# Up to so many files are opened by their paths; the paths pass the driver, as every listing does.
PATHS_AT_ONCE = 10_000
LISTED = ["path", "length", "modificationTime"]
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_CELL = pa.struct([("col_idx", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("num", pa.float64())])
_ROW = pa.schema(
    [("file_id", pa.string()), ("row_idx", pa.int32()), ("cells", pa.list_(_CELL)), ("error", pa.string())]
)


def workbook_files(spark: SparkSession, directory: str, glob: str = fixed.WORKBOOK_GLOB) -> DataFrame:
    """Files of a directory (not of its sub-folders) matching the glob, case-sensitively; empty if
    the directory is missing.

    The content is read only where a plan uses it.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    try:
        return reader.load(directory)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)


def file_contents(listing: DataFrame, chosen: DataFrame, at_once: int = PATHS_AT_ONCE) -> DataFrame | None:
    """Content of the ``chosen`` files (``path, length, modificationTime``) of a listing, as they are listed; None if there are none.

    No other file is opened: up to ``at_once`` files are scanned by path, which needs no second listing of
    the folder. For more, the folder is scanned between the bounds of their times and lengths, which the source checks
    before it opens a file; within these bounds, files that aren't chosen are left out after the scan. A file that has
    changed since it was listed comes with a later listing.
    """
    time = F.unix_micros("modificationTime")
    bounds = chosen.agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"), F.min("length").alias("least"), F.max("length").alias("most")).first()
    if not bounds["n"]:
        return None
    scan = listing
    if bounds["n"] <= at_once:
        # A path is read as a pattern unless what has a meaning in patterns is marked.
        paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r["path"]) for r in chosen.select("path").collect()]
        scan = listing.sparkSession.read.format("binaryFile").load(paths)
    scan = scan.filter(F.col("modificationTime").between(F.timestamp_micros(F.lit(bounds["first"])), F.timestamp_micros(F.lit(bounds["last"]))))
    scan = scan.filter(F.col("length").between(bounds["least"], bounds["most"]))
    return scan if bounds["n"] <= at_once else scan.join(chosen.select(*LISTED), LISTED, "left_semi")


def scan_sheet(files: DataFrame, sheet: str = fixed.SHEET_NAME) -> DataFrame:
    """Sheet rows of each file (``path, content``): ``file_id, row_idx, cells, error``.

    Each file also gives one row with index 0 and no cells, so that empty sheets show up; its
    ``error`` says why a file cannot be read, in which case no other rows of it count.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                pending, error = [], None
                try:
                    for row_idx, cells in read_rows(content.as_py(), sheet):
                        pending.append((path, row_idx, [dict(zip(_CELL.names, c)) for c in cells], None))
                        if len(pending) == ROWS_PER_BATCH:
                            yield _batch(pending)
                            pending = []
                except Exception as broken:  # any broken file is reported, not fatal
                    error = f"{type(broken).__name__}: {broken}"
                pending.append((path, 0, None, error))
                yield _batch(pending)

    return files.select("path", "content").mapInArrow(decode, schemas.SHEET_ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, _ROW)], schema=_ROW
    )


def file_presence(uploads: DataFrame, directory_files: DataFrame) -> DataFrame:
    """Uploads with ``file_exists``: whether their source file is still listed."""
    listed = directory_files.select(F.col("path").alias("file_path"), F.lit(True).alias("file_exists"))
    return (
        uploads.select("upload_id", "filename", "file_path")
        .join(listed, "file_path", "left")
        .select("upload_id", "filename", "file_path", F.coalesce("file_exists", F.lit(False)).alias("file_exists"))
    )
