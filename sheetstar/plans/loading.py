"""What one batch of sheets adds to each table, as plain DataFrames.

``loads`` frames have one row per file that loads: ``file_id, upload_id`` and the columns of a
checked record. All times are the batch time, handed in as a literal.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.ids import stable_id
from sheetstar.operators import dims
from sheetstar.operators.metrics import metrics_document
from sheetstar.operators.sheets import repaired_sub_scores


def register_pending(files: DataFrame, batch_id: str, batch_at: datetime) -> DataFrame:
    """Upload events of newly arrived files (``file_id`` = path, ``file_sha256``)."""
    return files.select(
        stable_id("upload", F.col("file_id"), F.lit(batch_id)).alias("upload_id"),
        F.element_at(F.split("file_id", "/"), -1).alias("filename"),
        "file_sha256",
        F.col("file_id").alias("file_path"),
        F.lit("pending").alias("status"),
        F.lit(batch_at).alias("event_at"),
        F.lit(None).cast("int").alias("rows_extracted"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _closing_event(uploads: DataFrame, status: str, at: datetime, rows: Column, message: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return uploads.select(
        "upload_id",
        nothing.alias("filename"),
        nothing.alias("file_sha256"),
        nothing.alias("file_path"),
        F.lit(status).alias("status"),
        F.lit(at).alias("event_at"),
        rows.cast("int").alias("rows_extracted"),
        message.alias("error_message"),
    )


def mark_completed(loads: DataFrame, extracted: DataFrame, at: datetime) -> DataFrame:
    """``extracted``: upload_id, rows_extracted."""
    counted = loads.select("upload_id").join(extracted, "upload_id", "left")
    return _closing_event(
        counted, "completed", at, F.coalesce("rows_extracted", F.lit(0)), F.lit(None).cast("string")
    )


def mark_failed(failures: DataFrame, at: datetime) -> DataFrame:
    """``failures``: upload_id, error_message, cut to what the audit keeps."""
    message = F.substring("error_message", 1, fixed.ERROR_MESSAGE_MAX)
    return _closing_event(failures, "failed", at, F.lit(None), message)


def rows_extracted(raw: DataFrame, key: str = "file_id") -> DataFrame:
    """Number of different labels per file, off the lineage (one row per file and label)."""
    return raw.groupBy(key).agg(F.count("*").alias("rows_extracted"))


def load_failure() -> Column:
    """Why a record cannot be stored, null if it can."""
    weight = F.col("industry_weight")
    return F.when(F.col("rated_entity").isNull(), "null value in column entity_name").when(
        weight.isNotNull() & weight.try_cast("decimal(5,4)").isNull(),
        F.concat(F.lit("numeric field overflow: industry_weight "), weight.cast("string")),
    )


def load_log(loads: DataFrame, batch_at: datetime) -> DataFrame:
    return loads.select(
        "upload_id",
        dims.company_id(F.col("rated_entity")).alias("company_id"),
        F.col("rated_entity").alias("entity_name"),
        stable_id("version", F.col("upload_id")).alias("version_id"),
        stable_id("snapshot", F.col("upload_id")).alias("snapshot_id"),
        F.lit(batch_at).alias("loaded_at"),
    )


def facts(loads: DataFrame, batch_at: datetime) -> DataFrame:
    """Snapshot rows. Dimension keys are derived from the natural keys, so no lookup joins."""
    return loads.select(
        stable_id("snapshot", F.col("upload_id")).alias("snapshot_id"),
        stable_id("version", F.col("upload_id")).alias("version_id"),
        dims.company_id(F.col("rated_entity")).alias("company_id"),
        "upload_id",
        dims.country_id(F.col("country")).alias("country_id"),
        dims.currency_id(F.col("currency")).alias("currency_id"),
        F.col("rated_entity").alias("entity_name"),
        "corporate_sector",
        F.col("country").alias("country_name"),
        F.col("currency").alias("currency_code"),
        "accounting_principles",
        "business_year_end",
        "rating_methodologies",
        F.col("industry_risk").alias("industry_risk_name"),
        "industry_risk_score",
        F.col("industry_weight").cast("decimal(5,4)").alias("industry_weight"),
        "segmentation_criteria",
        "business_risk_profile",
        "financial_risk_profile",
        repaired_sub_scores(F.col("risk_sub_scores"), F.col("liquidity_values")).alias("risk_sub_scores"),
        metrics_document().alias("credit_metrics"),
        F.lit(batch_at).alias("snapshot_at"),
    )


def quality_reports(loads: DataFrame, batch_at: datetime) -> DataFrame:
    return loads.select(
        stable_id("report", F.col("upload_id")).alias("report_id"),
        "upload_id",
        stable_id("snapshot", F.col("upload_id")).alias("snapshot_id"),
        "completeness_score",
        "validity_score",
        "total_fields",
        "present_fields",
        "error_count",
        "warning_count",
        "errors",
        "warnings",
        F.lit(batch_at).alias("created_at"),
    )
