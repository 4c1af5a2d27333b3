"""Continuous loading with Structured Streaming."""

from __future__ import annotations

import hashlib

from pyspark.sql.streaming import StreamingQuery

from sheetstar import fixed
from sheetstar.plans.warehouse import Warehouse
from sheetstar.sources.workbooks import scan_sheet


def stream_directory(
    warehouse: Warehouse,
    directory: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int = 1_000,
    **options,
) -> StreamingQuery:
    """Load files as they land, each path once; for folders whose files never change.

    Takes what is there and stops, or keeps going ``every`` interval. A micro-batch that is run
    again after a failure gets the same batch id and replaces itself; other folders and other
    checkpoints have other ids. For files overwritten in place, call ``Warehouse.load_directory``
    from a scheduler.
    """
    stream = hashlib.sha256(f"{directory}\n{checkpoint}".encode()).hexdigest()[:16]
    files = (
        warehouse.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", fixed.WORKBOOK_GLOB)
        .option("maxFilesPerTrigger", max_files)
        .load(directory)
    )

    def load(batch, number: int) -> None:
        warehouse.load_rows(scan_sheet(batch), batch_id=f"stream-{stream}-{number:012d}", **options)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
