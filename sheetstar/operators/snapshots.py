"""Snapshot queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.functions.times import day_end, day_start
from sheetstar.operators.companies import top_one, wanted, with_empty_document
from sheetstar.operators.dims import country_attributes, currency_attributes
from sheetstar.operators.sheets import raw_document

ITEM_COLUMNS = [
    "snapshot_id", "company_id", "version_id", "upload_id", "entity_name", "corporate_sector",
    "country_name", "currency_code", "snapshot_at", "business_risk_profile", "financial_risk_profile",
]


def filter_snapshots(
    snapshots: DataFrame,
    company_id=None,
    from_date: date | None = None,
    to_date: date | None = None,
    sector: str | None = None,
    country: str | None = None,
    currency: str | None = None,
) -> DataFrame:
    """Snapshots newest first. Days are whole UTC days, both included; texts compare without
    case, and empty ones do not filter."""
    if from_date and to_date and from_date > to_date:
        raise ValueError("from_date must be <= to_date")
    found = wanted(snapshots, company_id)
    if from_date is not None:
        found = found.filter(F.col("snapshot_at") >= day_start(snapshots, "snapshot_at", from_date))
    if to_date is not None:
        found = found.filter(F.col("snapshot_at") <= day_end(snapshots, "snapshot_at", to_date))
    for column, text in (("corporate_sector", sector), ("country_name", country), ("currency_code", currency)):
        if text:
            found = found.filter(F.lower(column) == F.lower(F.lit(text)))
    return found.select(*ITEM_COLUMNS).orderBy(F.col("snapshot_at").desc_nulls_first())


def latest_per_company(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of each company (the larger id on ties), by company name."""
    newest = top_one(
        snapshots.select(*ITEM_COLUMNS), "company_id", F.col("snapshot_at").desc(), F.col("snapshot_id").desc()
    )
    return newest.orderBy("entity_name")


def snapshot_details(snapshots: DataFrame, ids=None, raw: DataFrame | None = None) -> DataFrame:
    """Full rows, null documents as empty ones.

    ``raw`` is the long lineage table (``upload_id, label, values``); given it, the lineage of
    the asked-for snapshots is put together as ``raw_data``.
    """
    rows = wanted(snapshots, ids, "snapshot_id")
    if raw is not None:
        documents = raw_document(raw.join(rows.select("upload_id"), "upload_id", "left_semi"), "upload_id")
        rows = rows.drop("raw_data").join(documents, "upload_id", "left")
    for name in ("risk_sub_scores", "raw_data"):
        if name in rows.columns:
            empty = F.create_map().cast(rows.schema[name].dataType)
            rows = rows.withColumn(name, F.coalesce(name, empty))
    return with_empty_document(rows) if "credit_metrics" in rows.columns else rows


def star(snapshots: DataFrame, companies: DataFrame, versions: DataFrame, uploads: DataFrame, reports: DataFrame) -> DataFrame:
    """The fact navigated to all its neighbours. Country, currency and report may be missing.

    A version belongs to one upload, as the fact does, so version, upload and report are met with one
    move of the fact. What is known of countries and currencies comes from the fixed lists that the
    dimensions hold, in the plan, so nothing is shuffled by these few and uneven values.
    """
    country, currency = country_attributes(F.col("country_name")), currency_attributes(F.col("currency_code"))
    return (
        snapshots.join(versions.select("upload_id", "version_number", "valid_from", "valid_to", "is_current"), "upload_id")
        .join(uploads.select("upload_id", "filename", "status", "uploaded_at", "rows_extracted"), "upload_id")
        .join(
            reports.select("upload_id", "completeness_score", "validity_score", "error_count", "warning_count"),
            "upload_id",
            "left",
        )
        .join(companies.select("company_id", "current_snapshot_id"), "company_id")
        .select("*", *[country[n].alias(n) for n in ("iso_alpha2", "iso_alpha3", "region")], *[currency[n].alias(n) for n in ("currency_name", "symbol")])
        .withColumn("is_current_snapshot", F.col("snapshot_id") == F.col("current_snapshot_id"))
    )
