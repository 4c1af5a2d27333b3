"""Content fingerprints and the filter for content not loaded yet."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Files with more cell text than this are hashed as a stream instead of as one string.
STREAM_BYTES = 64 * 1024 * 1024


def fingerprints(rows: DataFrame, stream_bytes: int = STREAM_BYTES) -> DataFrame:
    """``file_id, file_sha256``: SHA-256 over the text of all cells in row, then column order,
    with nothing between them.

    One shuffle by file, of row texts. Files up to ``stream_bytes`` are joined and hashed in
    the JVM. A hash is sequential by nature, so a larger file is read in order off the
    (spilling) sort and fed to the hash batch by batch: memory stays flat at any size.
    """
    texts = rows.filter(F.col("cells").isNotNull()).select(
        "file_id", "row_idx", F.array_join(F.col("cells")["text"], "").alias("row_text")
    )
    sized = texts.withColumn("bytes", F.sum(F.octet_length("row_text")).over(W.partitionBy("file_id")))
    in_order = F.sort_array(F.collect_list(F.struct("row_idx", "row_text")))
    joined = F.array_join(in_order["row_text"], "")
    small = (
        sized.filter(F.col("bytes") <= stream_bytes)
        .groupBy("file_id")
        .agg(F.sha2(joined, 256).alias("file_sha256"))
    )
    large = (
        sized.filter(F.col("bytes") > stream_bytes)
        .sortWithinPartitions("file_id", "row_idx")
        .select("file_id", "row_text")
        .mapInArrow(_hash_in_order, small.schema)
    )
    return small.unionByName(large)


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash runs of equal file_id; a run may go on over any number of batches."""
    current, digest, schema = None, None, None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], schema.field("file_id").type), pa.array([digest.hexdigest()])],
            ["file_id", "file_sha256"],
        )

    for batch in batches:
        schema = batch.schema
        for file_id, text in zip(batch.column("file_id").to_pylist(), batch.column("row_text").to_pylist()):
            if digest is None or file_id != current:
                if digest is not None:
                    yield result()
                current, digest = file_id, hashlib.sha256()
            digest.update(text.encode("utf-8"))
    if digest is not None:
        yield result()


def completed_hashes(uploads: DataFrame) -> DataFrame:
    return uploads.filter(F.col("status") == "completed").select("file_sha256").distinct()


def new_files(files: DataFrame, uploads: DataFrame) -> DataFrame:
    """Files whose content has no completed upload. Pending and failed content comes again, and
    equal files of one batch all stay."""
    return files.join(completed_hashes(uploads), "file_sha256", "left_anti")
