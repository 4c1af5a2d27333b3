"""Queries by name over the given tables. Nested results are laid out as plain columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.times import instant
from sheetstar.operators import (
    audits, companies, dims, fingerprints, metrics, rules, sheets, snapshots, uploads, versions,
)
from sheetstar.plans import loading, views
from sheetstar.plans.warehouse import Warehouse
from sheetstar.session import shared_folder
from sheetstar.sources import workbooks

AS_OF = date(1997, 6, 30)
BATCH_AT = datetime(2026, 1, 1)
ARRIVAL_SPLIT = datetime(2024, 1, 15)
DIM_SPLIT = datetime(1995, 2, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _document_text(document) -> dict:
    """A metrics document in plain columns: its years, every value (``metric:year:hundredths``) and its sentinels."""
    def written(metric):
        year = lambda y: F.concat_ws(":", metric["key"], y["key"], F.round(y["value"]["num"] * 100).cast("bigint").cast("string"))
        return F.transform(F.map_entries(metric["value"]), year)

    values = F.flatten(F.transform(F.map_entries(document["metrics"]), written))
    meanings = F.transform(F.map_entries(document["sentinels"]), lambda s: F.concat_ws("=", s["key"], s["value"]))
    texts = {"years": document["years"], "values": values, "sentinels": meanings}
    return {name: F.array_join(F.array_sort(F.coalesce(x, F.array().cast("array<string>"))), "|") for name, x in texts.items()}


# -- companies -------------------------------------------------------------------------------


@query
def companies_page(spark, sf_dir):
    return companies.list_companies(views.companies(spark, sf_dir), limit=50, offset=20)


@query
def companies_after(spark, sf_dir):
    """The page behind a company, told by its name and id."""
    return companies.list_companies(views.companies(spark, sf_dir), limit=50, after=("Customer#000000070", 70))


@query
def company_detail(spark, sf_dir):
    current_only = versions.current_versions(views.load_log(spark, sf_dir))
    details = companies.company_details(views.companies(spark, sf_dir), current_only)
    current = F.col("current_version")
    return details.select(
        "company_id", "entity_name", "created_at", current["version_id"].alias("version_id"),
        current["version_number"].alias("version_number"), current["valid_from"].alias("valid_from"),
    )


@query
def company_by_id(spark, sf_dir):
    """Each supplier's number asked for as a company id."""
    asked = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("company_id"))
    return companies.get_company(views.companies(spark, sf_dir), asked)


@query
def company_versions(spark, sf_dir):
    found = versions.company_versions(views.load_log(spark, sf_dir))
    return companies.list_versions(views.companies(spark, sf_dir), found).drop("created_at")


@query
def company_snapshots(spark, sf_dir):
    return companies.list_snapshots_of(views.snapshots(spark, sf_dir)).select(
        "company_id", "snapshot_id", "version_id", "upload_id", "snapshot_at"
    )


@query
def company_history(spark, sf_dir):
    return companies.company_history(
        versions.company_versions(views.load_log(spark, sf_dir)), views.snapshots(spark, sf_dir),
        documents=views.metric_documents(spark, sf_dir), written=_document_text,
    )


def _wide(spark, sf_dir):
    """Wide rows of chosen snapshots: documents are made for these alone."""
    return lambda chosen: views.snapshots_with_metrics(spark, sf_dir, chosen)


@query
def company_series(spark, sf_dir):
    series = companies.latest_series(views.snapshots_with_metrics(spark, sf_dir), fetch=_wide(spark, sf_dir))
    return series.select("company_id", "snapshot_id", "metric", "pos", "year", "num")


@query
def company_series_documents(spark, sf_dir):
    """The same whole: years, values and sentinels of each company's last snapshot, empty where it has none."""
    last = companies.latest_documents(views.snapshots_with_metrics(spark, sf_dir), fetch=_wide(spark, sf_dir))
    return last.select("company_id", "snapshot_id", *[c.alias(n) for n, c in _document_text(F.col("credit_metrics")).items()])


def _request(spark, sf_dir) -> DataFrame:
    """Asks for every customer twice, and for a company that cannot exist per supplier."""
    customers = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"))
    suppliers = views.table(spark, sf_dir, "supplier")
    return (
        customers.select((F.col("company_id") * 3).alias("pos"), "company_id")
        .unionByName(customers.select((F.col("company_id") * 3 + 1).alias("pos"), "company_id"))
        .unionByName(
            suppliers.select((F.col("s_suppkey") * 3 + 2).alias("pos"), (-1 - F.col("s_suppkey")).alias("company_id"))
        )
    )


def _compared(spark, sf_dir, snapshots_of=views.snapshots) -> list[DataFrame]:
    return [views.companies(spark, sf_dir), views.load_log(spark, sf_dir), snapshots_of(spark, sf_dir)]


@query
def compare_as_of(spark, sf_dir):
    request = _request(spark, sf_dir)
    compared = companies.compare_companies(request, *_compared(spark, sf_dir, views.snapshots_with_metrics), AS_OF, _wide(spark, sf_dir))
    return compared.withColumns(_document_text(F.col("credit_metrics"))).drop("credit_metrics")


@query
def compare_not_found(spark, sf_dir):
    request = _request(spark, sf_dir)
    return companies.compare_not_found(request, *_compared(spark, sf_dir), AS_OF)


# -- snapshots -------------------------------------------------------------------------------


@query
def snapshots_latest(spark, sf_dir):
    return snapshots.latest_per_company(views.snapshots(spark, sf_dir))


@query
def snapshots_filtered(spark, sf_dir):
    return snapshots.filter_snapshots(
        views.snapshots(spark, sf_dir),
        from_date=date(1996, 1, 1),
        to_date=date(1999, 12, 31),
        sector="machinery",
        country="",
        currency="CHF",
    )


@query
def snapshot_detail(spark, sf_dir):
    """Every snapshot with its documents; a snapshot without line items has empty ones."""
    detail = snapshots.snapshot_details(views.snapshots_with_metrics(spark, sf_dir))
    return detail.withColumns(_document_text(F.col("credit_metrics"))).drop("credit_metrics")


@query
def snapshot_star(spark, sf_dir):
    facts = views.snapshots(spark, sf_dir)
    named = views.companies(spark, sf_dir)
    reported = _checked(spark, sf_dir).select(
        "file_id", "completeness_score", "validity_score", "error_count", "warning_count"
    ).join(
        named.select(F.col("company_id").alias("file_id"), F.col("current_snapshot_id").alias("upload_id")), "file_id"
    )
    found = snapshots.star(
        facts,
        named,
        versions.company_versions(views.load_log(spark, sf_dir)),
        views.uploads(spark, sf_dir),
        reported,
    )
    return found.select(
        "snapshot_id", "entity_name", "version_number", "is_current", "filename", "status", "rows_extracted",
        "iso_alpha2", "region", "currency_name", "symbol", "is_current_snapshot", "error_count", "warning_count",
    )


# -- uploads ---------------------------------------------------------------------------------


@query
def uploads_list(spark, sf_dir):
    return uploads.list_uploads(views.uploads(spark, sf_dir))


@query
def upload_detail(spark, sf_dir):
    """Details of the uploads behind each company's current snapshot."""
    current = versions.companies(views.load_log(spark, sf_dir)).select(F.col("current_snapshot_id").alias("upload_id"))
    return uploads.get_upload(views.uploads(spark, sf_dir), current)


@query
def upload_stats(spark, sf_dir):
    return uploads.upload_stats(views.uploads(spark, sf_dir))


# -- fingerprints and arrivals ----------------------------------------------------------------


@query
def file_fingerprint(spark, sf_dir):
    return fingerprints.fingerprints(_rows(spark, sf_dir))


@query
def document_fingerprint(spark, sf_dir):
    return fingerprints.fingerprints(views.document_rows(spark, sf_dir))


def _event_files(spark, sf_dir) -> DataFrame:
    """Events as one-row sheets of user, type and properties."""
    events = views.table(spark, sf_dir, "events")
    texts = [F.col("user_id").cast("string"), F.col("event_type"), F.col("props")]
    cells = F.array(*[F.struct(F.lit(i).alias("col_idx"), t.alias("text")) for i, t in enumerate(texts)])
    hashes = fingerprints.fingerprints(events.select(F.col("event_id").alias("file_id"), F.lit(1).alias("row_idx"), cells.alias("cells")))
    return events.join(hashes.withColumnRenamed("file_id", "event_id"), "event_id")


def _arrivals(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Earlier events as audited uploads, later ones as arriving files."""
    files = _event_files(spark, sf_dir)
    split = instant(files, "ts", ARRIVAL_SPLIT)
    status = F.when(F.col("value") < 20, "failed").otherwise("completed").alias("status")
    return (
        files.filter(F.col("ts") >= split).select(
            F.format_string("/landing/%s/%d.xlsm", "event_type", "event_id").alias("file_id"), "file_sha256"
        ),
        files.filter(F.col("ts") < split).select("file_sha256", status),
    )


@query
def completed_hashes(spark, sf_dir):
    return fingerprints.completed_hashes(_arrivals(spark, sf_dir)[1])


@query
def new_files(spark, sf_dir):
    return fingerprints.new_files(*_arrivals(spark, sf_dir))


@query
def registered_files(spark, sf_dir):
    new = fingerprints.new_files(*_arrivals(spark, sf_dir))
    return loading.register_pending(new, "b1", BATCH_AT).select("upload_id", "filename", "file_sha256", "file_path", "status")


@query
def file_presence(spark, sf_dir):
    """Uploads against a listing that has the files of orders with line items."""
    path = F.format_string("/landing/sheet_%d.xlsm", "l_orderkey").alias("path")
    listed = views.table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().select(path)
    return workbooks.file_presence(views.uploads(spark, sf_dir), listed)


# -- sheets ----------------------------------------------------------------------------------


def _rows(spark, sf_dir) -> DataFrame:
    return views.sheet_rows(spark, sf_dir)


def _records(spark, sf_dir) -> DataFrame:
    return metrics.with_series(sheets.records(_rows(spark, sf_dir)))


@query
def sheet_rows(spark, sf_dir):
    """From the cell table; the other sheet queries start from scanned rows."""
    rows = sheets.rows_from_cells(views.sheet_cells(spark, sf_dir))
    return sheets.sheet_rows(rows).select(
        "file_id", "label", F.size("values").alias("n_values"),
        F.array_join(F.col("values")["text"], "|").alias("texts"),
    )


@query
def sheet_wide(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "file_id", "rated_entity", "corporate_sector", F.array_join("rating_methodologies", "|").alias("methodologies"),
        "industry_risk", "industry_risk_score", "industry_weight", "segmentation_criteria", "currency", "country",
        "accounting_principles", "business_year_end", "business_risk_profile", "financial_risk_profile",
    )


@query
def sub_scores(spark, sf_dir):
    repaired = sheets.repaired_sub_scores(F.col("risk_sub_scores"), F.col("liquidity_values"))
    return _records(spark, sf_dir).select(
        "file_id", F.explode(F.map_zip_with("risk_sub_scores", repaired, lambda k, a, b: F.struct(a.alias("a"), b.alias("b")))).alias("label", "v")
    ).select("file_id", "label", F.col("v.a").alias("parsed"), F.col("v.b").alias("repaired"))


@query
def metric_series(spark, sf_dir):
    return metrics.metric_points(_records(spark, sf_dir))


@query
def metric_series_by_column(spark, sf_dir):
    records = sheets.records(_rows(spark, sf_dir))
    return metrics.metric_points(metrics.with_series(records, align="column"))


@query
def metrics_document(spark, sf_dir):
    """Every value of every document; a document with years but no values has one row without."""
    documents = _records(spark, sf_dir).withColumn("credit_metrics", metrics.metrics_document())
    documents = documents.filter(F.col("credit_metrics").isNotNull())
    years = F.array_join("credit_metrics.years", "|").alias("years")
    locked = F.element_at("credit_metrics.sentinels", "Locked").alias("locked_means")
    series = documents.select("file_id", years, locked, F.explode_outer("credit_metrics.metrics").alias("metric", "series"))
    return series.select("file_id", "years", "locked_means", "metric", F.explode_outer("series").alias("year", "v")).select(
        "file_id", "years", "locked_means", F.when(F.col("year").isNotNull(), F.col("metric")).alias("metric"), "year", "v.kind", "v.num", "v.text"
    ).distinct()


@query
def raw_lineage(spark, sf_dir):
    """Every value of every label; a label without values has one row without."""
    documents = sheets.raw_document(sheets.raw_values(_rows(spark, sf_dir)))
    labels = documents.select("file_id", F.explode("raw_data").alias("label", "values"))
    return labels.select("file_id", "label", F.posexplode_outer("values").alias("pos", "v")).select("file_id", "label", "pos", "v.kind", "v.text", "v.num")


@query
def rows_extracted(spark, sf_dir):
    return loading.rows_extracted(sheets.raw_values(_rows(spark, sf_dir)))


# -- validation ------------------------------------------------------------------------------


def _checked(spark, sf_dir) -> DataFrame:
    return rules.check(_records(spark, sf_dir))


@query
def findings(spark, sf_dir):
    return rules.findings(_checked(spark, sf_dir)).drop("seq")


@query
def finding_summary(spark, sf_dir):
    def messages(of):
        return F.array_join(of["message"], "\n")

    return _checked(spark, sf_dir).select(
        "file_id", "is_valid", "error_count", "warning_count",
        messages(F.col("errors")).alias("errors"), messages(F.col("warnings")).alias("warnings"),
    )


@query
def metrics_without_years(spark, sf_dir):
    """The rule on metrics without year headers, for sheets whose number says that their headers were lost."""
    lost = F.col("file_id") % 5 == 0
    told = _records(spark, sf_dir).withColumns(
        {"has_years": F.col("series").isNotNull() & ~lost, "has_metrics": F.coalesce(F.size("series") > 0, F.lit(False))}
    )
    found = rules.findings(rules.with_findings(told))
    return found.filter("rule = 'metrics_years'").select("file_id", "field", "message", "severity")


@query
def quality_scores(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        "file_id", "total_fields", "present_fields",
        F.col("completeness_score").cast("double").alias("completeness_score"),
        F.col("validity_score").cast("double").alias("validity_score"),
    )


@query
def load_failures(spark, sf_dir):
    records = _records(spark, sf_dir).withColumn("error_message", loading.load_failure())
    failed = records.filter("error_message is not null").select(F.col("file_id").alias("upload_id"), "error_message")
    return loading.mark_failed(failed, BATCH_AT).select("upload_id", "status", "error_message")


def _loads(spark, sf_dir) -> DataFrame:
    """Checked records of the sheets that load."""
    return _checked(spark, sf_dir).filter(loading.load_failure().isNull()).withColumn("upload_id", F.col("file_id").cast("string"))


@query
def loaded_facts(spark, sf_dir):
    """Snapshot rows of the sheets that load, all columns; documents are compared by their own queries."""
    stored = loading.facts(_loads(spark, sf_dir), BATCH_AT)
    scores = F.array_join(F.transform(
        F.array(*[F.lit(x) for x in fixed.SUB_SCORE_LABELS]), lambda x: F.concat_ws("=", x, F.element_at("risk_sub_scores", x))
    ), "|")
    return stored.select(
        *[c for c in stored.columns if c not in ("rating_methodologies", "industry_weight", "risk_sub_scores", "credit_metrics")],
        F.array_join("rating_methodologies", "|").alias("methodologies"), F.col("industry_weight").cast("double").alias("industry_weight"),
        scores.alias("sub_scores"), F.array_join("credit_metrics.years", "|").alias("years"),
    )


@query
def quality_report_rows(spark, sf_dir):
    reports = loading.quality_reports(_loads(spark, sf_dir), BATCH_AT)
    return reports.drop("errors", "warnings").withColumns({c: F.col(c).cast("double") for c in ("completeness_score", "validity_score")})


@query
def completion_events(spark, sf_dir):
    extracted = loading.rows_extracted(sheets.raw_values(_rows(spark, sf_dir))).select(F.col("file_id").cast("string").alias("upload_id"), "rows_extracted")
    return loading.mark_completed(_loads(spark, sf_dir), extracted, BATCH_AT).select("upload_id", "status", "event_at", "rows_extracted")


def _scanned(rows: DataFrame) -> DataFrame:
    """Sheets as a scan of their workbooks gives them: with paths, and a row of its own for each file."""
    path = F.concat(F.lit("/landing/sheet_"), "file_id", F.lit(".xlsm")).alias("file_id")
    cells = rows.select(path, F.col("row_idx").cast("int").alias("row_idx"), "cells", F.lit(None).cast("string").alias("error"))
    heads = cells.select("file_id").distinct().selectExpr("file_id", "0 AS row_idx", "NULL AS cells", "NULL AS error")
    return cells.unionByName(heads)


def _revised(rows: DataFrame) -> DataFrame:
    """The sheets of odd number with one more row."""
    added = rows.filter("file_id % 2 = 1").select("file_id").distinct()
    cell = "named_struct('col_idx', {}, 'kind', 'str', 'text', '{}', 'num', CAST(NULL AS DOUBLE))"
    return rows.select("file_id", "row_idx", "cells").unionByName(
        added.selectExpr("file_id", "1000 AS row_idx", f"array({cell.format(1, 'Revision')}, {cell.format(2, 'second')}) AS cells")
    )


@query
def loaded_warehouse(spark, sf_dir):
    """All sheets loaded into a warehouse as one batch; then all again, half of them revised, as a second; read back as
    uploads with their star. The second batch finds what is unchanged by its content, and tries again what failed.
    The warehouse is left in the shared folder."""
    root = shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    warehouse = Warehouse(spark, f"{root}/loaded-warehouse-{uuid.uuid4().hex}")
    rows = _rows(spark, sf_dir)
    warehouse.load_rows(_scanned(rows), BATCH_AT, "b1")
    warehouse.load_rows(_scanned(_revised(rows)), BATCH_AT + timedelta(days=1), "b2")
    star = warehouse.star().select(
        "upload_id", "snapshot_id", "company_id", "entity_name", "version_number", "valid_from", "valid_to", "is_current", "iso_alpha2", "currency_name",
        "error_count", "warning_count", "is_current_snapshot", F.get_json_object(metrics.document_json(), "$.years").alias("years"),
    )
    uploaded = warehouse.table("upload_audit").drop("file_path", "created_at")
    return uploaded.join(star, "upload_id", "left")


# -- audits ----------------------------------------------------------------------------------


@query
def integrity_unique(spark, sf_dir):
    return audits.duplicate_keys(views.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def integrity_fk(spark, sf_dir):
    return audits.orphans(
        views.table(spark, sf_dir, "events"), "user_id", views.table(spark, sf_dir, "supplier"), "s_suppkey"
    ).select("event_id", "user_id")


@query
def integrity_domain(spark, sf_dir):
    return audits.outside_domain(views.table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"]).select(
        "o_orderkey", "o_orderstatus"
    )


@query
def integrity_nulls(spark, sf_dir):
    broken = audits.missing_or_unfit(_records(spark, sf_dir), ["rated_entity"], {"industry_weight": (5, 4)})
    return broken.select("file_id", F.array_join("problems", "; ").alias("problems"))


# -- dimensions and versions -------------------------------------------------------------------


@query
def dim_country(spark, sf_dir):
    """Countries known before a date, then upserted with the later ones: first rows are kept."""
    facts = views.snapshots(spark, sf_dir)
    split = instant(facts, "snapshot_at", DIM_SPLIT)
    stored = dims.countries(facts.filter(F.col("snapshot_at") < split), "country_name", "snapshot_at")
    incoming = dims.countries(facts.filter(F.col("snapshot_at") >= split), "country_name", "snapshot_at")
    return dims.upsert(incoming, stored, "country_name")


@query
def dim_currency(spark, sf_dir):
    facts = views.snapshots(spark, sf_dir)
    return dims.currencies(facts, "currency_code", "snapshot_at")


@query
def dim_year(spark, sf_dir):
    records = _records(spark, sf_dir).withColumn("years", metrics.years(F.col("year_values")))
    return dims.year_dates(records, "years", ["file_id"])


@query
def year_upsert(spark, sf_dir):
    """All years met with the years that the even sheets stored before."""
    records = _records(spark, sf_dir).withColumn("years", metrics.years(F.col("year_values")))
    stored = dims.year_dates(records.filter("file_id % 2 = 0"), "years", ["file_id"])
    return dims.upsert(dims.year_dates(records, "years", ["file_id"]), stored, "date_id")


@query
def dim_company(spark, sf_dir):
    return views.companies(spark, sf_dir)


@query
def company_lookup(spark, sf_dir):
    """Every customer and supplier name looked up; only customers with loads are known."""
    names = views.table(spark, sf_dir, "customer").select(F.col("c_name").alias("entity_name")).unionByName(
        views.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("entity_name"))
    )
    return versions.lookup_companies(names, views.companies(spark, sf_dir), views.load_log(spark, sf_dir))


@query
def next_versions(spark, sf_dir):
    """Events as further loads of the company of their user."""
    names = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("entity_name"))
    loads = views.table(spark, sf_dir, "events").join(names, "user_id").select(
        "entity_name", F.col("ts").alias("loaded_at"), F.col("event_id").alias("upload_id")
    )
    lookup = versions.lookup_companies(loads, views.companies(spark, sf_dir), views.load_log(spark, sf_dir))
    return versions.next_versions(loads, lookup).select(
        "entity_name", "upload_id", "is_new_company", "company_id", "version_number"
    )


@query
def scd2_versions(spark, sf_dir):
    return versions.company_versions(views.load_log(spark, sf_dir))


@query
def merged_states(spark, sf_dir):
    """Companies and their open versions off states that were made month by month."""
    log = views.load_log(spark, sf_dir).withColumn("month", F.trunc("loaded_at", "month")).withColumn("entity_name", F.lit(None).cast("string"))
    merged = versions.merged_states(versions.company_states(log, "month"))
    found = versions.companies_of(merged).drop("entity_name")
    return found.join(versions.current_versions_of(merged).drop("created_at", "valid_to"), "company_id")


@query
def batch_versions(spark, sf_dir):
    """Versions opened and closed by the loads after a day, on the states of the loads before."""
    log = views.load_log(spark, sf_dir).withColumn("entity_name", F.lit(None).cast("string"))
    earlier = F.col("loaded_at") < instant(log, "loaded_at", datetime.combine(AS_OF, datetime.min.time()))
    return versions.batch_versions(log.filter(~earlier), versions.merged_states(versions.company_states(log.filter(earlier))))
