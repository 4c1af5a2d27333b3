"""Table schemas. Keys are strings derived from natural keys, so a retried task repeats them."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B, _TS = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _table(*columns) -> T.StructType:
    """Columns as (name, type) where a trailing ``?`` on the name marks it nullable."""
    return T.StructType(
        [T.StructField(name.rstrip("?"), dtype, name.endswith("?")) for name, dtype in columns]
    )


# One cell or value: kind is str, int, float, bool or datetime; text is its written form and
# num its number where it has one.
VALUE = T.StructType(
    [
        T.StructField("kind", _S),
        T.StructField("text", _S),
        T.StructField("num", T.DoubleType()),
    ]
)
# A cell, and a value of a sheet row with the column it stood in.
CELL = T.StructType([T.StructField("col_idx", _I), *VALUE.fields])
VALUES = T.ArrayType(CELL)
FINDING = T.StructType(
    [
        T.StructField("field", _S),
        T.StructField("message", _S),
        T.StructField("severity", _S),
    ]
)
CREDIT_METRICS = T.StructType(
    [
        T.StructField("years", T.ArrayType(_S)),
        T.StructField("metrics", T.MapType(_S, T.MapType(_S, VALUE))),
        T.StructField("sentinels", T.MapType(_S, _S)),
    ]
)

SHEET_CELLS = _table(
    ("file_id", _S),
    ("row_idx", _I),
    ("col_idx", _I),
    ("kind", _S),
    ("text", _S),
    ("num?", T.DoubleType()),
)
SHEET_ROWS = _table(
    ("file_id", _S),
    ("row_idx?", _I),
    ("cells?", T.ArrayType(CELL)),
    ("error?", _S),
)

DIM_COMPANY = _table(
    ("company_id", _S),
    ("entity_name", _S),
    ("current_snapshot_id?", _S),
    ("created_at", _TS),
)
COMPANY_VERSIONS = _table(
    ("version_id", _S),
    ("company_id", _S),
    ("upload_id", _S),
    ("version_number", _I),
    ("valid_from", _TS),
    ("valid_to?", _TS),
    ("is_current", _B),
    ("created_at", _TS),
)
DIM_COUNTRY = _table(
    ("country_id", _S),
    ("country_name", _S),
    ("iso_alpha2?", _S),
    ("iso_alpha3?", _S),
    ("region?", _S),
    ("created_at", _TS),
)
DIM_CURRENCY = _table(
    ("currency_id", _S),
    ("currency_code", _S),
    ("currency_name?", _S),
    ("symbol?", _S),
    ("created_at", _TS),
)
DIM_DATE = _table(
    ("date_id", _S),
    ("year_value", _S),
    ("calendar_year?", _I),
    ("is_estimate", _B),
    ("sort_order", _I),
)
SNAPSHOT_FACT = _table(
    ("snapshot_id", _S),
    ("version_id", _S),
    ("company_id", _S),
    ("upload_id", _S),
    ("country_id?", _S),
    ("currency_id?", _S),
    ("entity_name", _S),
    ("corporate_sector?", _S),
    ("country_name?", _S),
    ("currency_code?", _S),
    ("accounting_principles?", _S),
    ("business_year_end?", _S),
    ("rating_methodologies?", T.ArrayType(_S)),
    ("industry_risk_name?", _S),
    ("industry_risk_score?", _S),
    ("industry_weight?", T.DecimalType(5, 4)),
    ("segmentation_criteria?", _S),
    ("business_risk_profile?", _S),
    ("financial_risk_profile?", _S),
    ("risk_sub_scores?", T.MapType(_S, _S)),
    ("credit_metrics?", CREDIT_METRICS),
    ("raw_data?", T.MapType(_S, VALUES)),
    ("snapshot_at", _TS),
)
DATA_QUALITY_REPORT = _table(
    ("report_id", _S),
    ("upload_id", _S),
    ("snapshot_id?", _S),
    ("completeness_score", T.DecimalType(4, 3)),
    ("validity_score", T.DecimalType(4, 3)),
    ("total_fields", _I),
    ("present_fields", _I),
    ("error_count", _I),
    ("warning_count", _I),
    ("errors", T.ArrayType(FINDING)),
    ("warnings", T.ArrayType(FINDING)),
    ("created_at", _TS),
)
UPLOAD_AUDIT = _table(
    ("upload_id", _S),
    ("filename", _S),
    ("file_sha256", _S),
    ("file_path", _S),
    ("uploaded_at", _TS),
    ("processed_at?", _TS),
    ("status", _S),
    ("rows_extracted?", _I),
    ("error_message?", _S),
    ("created_at", _TS),
)

# What a user reads.
TABLES = {
    "dim_company": DIM_COMPANY,
    "company_versions": COMPANY_VERSIONS,
    "dim_country": DIM_COUNTRY,
    "dim_currency": DIM_CURRENCY,
    "dim_date": DIM_DATE,
    "snapshot_fact": SNAPSHOT_FACT,
    "data_quality_report": DATA_QUALITY_REPORT,
    "upload_audit": UPLOAD_AUDIT,
}

# What is stored: append-only logs, from which dim_company, company_versions and upload_audit
# are derived. The full label -> values lineage of a sheet is a long table of its own, so no
# fact row grows with the number of rows in a sheet.
UPLOAD_EVENTS = _table(
    ("upload_id", _S),
    ("filename?", _S),
    ("file_sha256?", _S),
    ("file_path?", _S),
    ("status", _S),
    ("event_at", _TS),
    ("rows_extracted?", _I),
    ("error_message?", _S),
)
LOAD_LOG = _table(
    ("upload_id", _S),
    ("company_id", _S),
    ("entity_name", _S),
    ("version_id", _S),
    ("snapshot_id", _S),
    ("loaded_at", _TS),
)
# Of each batch: one row per company that it loads. They merge over batches.
COMPANY_STATES = _table(
    ("company_id", _S),
    ("entity_name", _S),
    ("loads", T.LongType()),
    ("first_at", _TS),
    ("last_at", _TS),
    ("version_id", _S),
    ("upload_id", _S),
    ("snapshot_id", _S),
)
RAW_VALUES = _table(
    ("upload_id", _S),
    ("label", _S),
    ("values", VALUES),
)
FACT_STORED = T.StructType([f for f in SNAPSHOT_FACT.fields if f.name != "raw_data"])

STORED = {
    "upload_events": UPLOAD_EVENTS,
    "load_log": LOAD_LOG,
    "company_states": COMPANY_STATES,
    "raw_values": RAW_VALUES,
    "snapshot_fact": FACT_STORED,
    "data_quality_report": DATA_QUALITY_REPORT,
    "dim_country": DIM_COUNTRY,
    "dim_currency": DIM_CURRENCY,
    "dim_date": DIM_DATE,
}
