"""Upload audit: current state over status events, listings and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.operators.companies import wanted


def current_uploads(events: DataFrame) -> DataFrame:
    """One row per upload: how it was registered plus its latest status.

    Events of one upload and time rank in the order of the status list. One aggregation, which
    combines before the shuffle.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in fixed.UPLOAD_STATUSES]), F.col("status"))
    ended = F.col("status").isin("completed", "failed")
    state = F.struct(
        "status",
        F.when(ended, F.col("event_at")).alias("processed_at"),
        "rows_extracted",
        "error_message",
    )
    return (
        events.groupBy("upload_id")
        .agg(
            F.max("filename").alias("filename"),
            F.max("file_sha256").alias("file_sha256"),
            F.max("file_path").alias("file_path"),
            F.min("event_at").alias("uploaded_at"),
            F.max_by(state, F.struct(F.col("event_at"), rank)).alias("state"),
        )
        .select(
            "upload_id",
            "filename",
            "file_sha256",
            "file_path",
            "uploaded_at",
            "state.processed_at",
            "state.status",
            "state.rows_extracted",
            "state.error_message",
            F.col("uploaded_at").alias("created_at"),
        )
    )


DETAIL_COLUMNS = [
    "upload_id", "filename", "file_sha256", "file_path", "uploaded_at",
    "processed_at", "status", "rows_extracted", "error_message",
]


def list_uploads(uploads: DataFrame) -> DataFrame:
    return uploads.select(*DETAIL_COLUMNS).orderBy(F.col("uploaded_at").desc_nulls_first())


def get_upload(uploads: DataFrame, upload_id) -> DataFrame:
    """Details of an upload, or of a list or DataFrame of uploads; unknown ids give no row."""
    return wanted(uploads.select(*DETAIL_COLUMNS), upload_id, "upload_id")


def upload_stats(uploads: DataFrame) -> DataFrame:
    """One row: totals by status, success rate, mean rows, mean processing seconds over uploads
    with both times, latest upload. Zeros where there is nothing to count."""
    seconds = (
        F.expr("timestampdiff(MICROSECOND, uploaded_at, processed_at)") / F.lit(1e6)
    )
    counted = uploads.agg(
        F.count("upload_id").alias("total_uploads"),
        *[F.count_if(F.col("status") == s).alias(s) for s in fixed.UPLOAD_STATUSES],
        F.avg("rows_extracted").alias("avg_rows_extracted"),
        F.avg(seconds).alias("avg_processing_seconds"),
        F.max("uploaded_at").alias("latest_upload_at"),
    )
    return counted.select(
        "total_uploads",
        *fixed.UPLOAD_STATUSES,
        F.when(F.col("total_uploads") > 0, F.col("completed") / F.col("total_uploads"))
        .otherwise(0.0)
        .alias("success_rate"),
        F.coalesce("avg_rows_extracted", F.lit(0.0)).alias("avg_rows_extracted"),
        F.coalesce("avg_processing_seconds", F.lit(0.0)).alias("avg_processing_seconds"),
        "latest_upload_at",
    )
