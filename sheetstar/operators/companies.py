"""Company queries. Each takes the tables it reads as DataFrames and returns a DataFrame.

``ids`` arguments accept one id, a list of ids, a DataFrame with a ``company_id`` column, or
None for all companies.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.times import day_end
from sheetstar.operators.metrics import explode_document
from sheetstar.operators.versions import held_versions

VERSION_COLUMNS = [
    "version_id", "upload_id", "version_number", "valid_from", "valid_to", "is_current", "created_at",
]


def wanted(df: DataFrame, ids, key: str = "company_id") -> DataFrame:
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key), key, "left_semi").select(*df.columns)
    return df.filter(F.col(key).isin(list(ids) if isinstance(ids, (list, tuple, set)) else [ids]))


def top_one(df: DataFrame, key: str, *order) -> DataFrame:
    """First row per key. The rank limit is applied before the shuffle as well, so a key with
    very many rows sends one row per input partition."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def list_companies(
    companies: DataFrame, limit: int = fixed.PAGE_LIMIT_DEFAULT, offset: int = 0, after: tuple | None = None
) -> DataFrame:
    """A page of companies by name, then id. Each task keeps its first ``offset + limit`` rows.

    ``after``: name and id of the last row of the page before. The page then starts behind it, by a range of
    names that reaches the scan, so a page however deep costs what the first one does.
    """
    if not 1 <= limit <= fixed.PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {fixed.PAGE_LIMIT_MAX}, not {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, not {offset}")
    page = companies.select("company_id", "entity_name", "current_snapshot_id", "created_at")
    if after is not None:
        name, company_id = after
        behind = (F.col("entity_name") > name) | (F.col("company_id") > company_id)
        page = page.filter((F.col("entity_name") >= name) & behind)
    return page.orderBy("entity_name", "company_id").offset(offset).limit(limit)


def get_company(companies: DataFrame, company_id) -> DataFrame:
    """0 or 1 row."""
    return wanted(companies, company_id)


def current_versions(versions: DataFrame, ids=None) -> DataFrame:
    """Current version of each company, the highest number should there be several."""
    return top_one(
        wanted(versions, ids).filter("is_current"), "company_id", F.col("version_number").desc(), F.col("version_id")
    )


def company_details(companies: DataFrame, versions: DataFrame, ids=None) -> DataFrame:
    """Companies with their current version as a struct, null where there is none."""
    current = current_versions(versions, ids).select(
        "company_id", F.struct(*VERSION_COLUMNS).alias("current_version")
    )
    return (
        wanted(companies, ids)
        .select("company_id", "entity_name", "created_at")
        .join(current, "company_id", "left")
    )


def list_versions(companies: DataFrame, versions: DataFrame, ids=None) -> DataFrame:
    """Versions by number; nothing for unknown companies."""
    names = wanted(companies, ids).select("company_id", "entity_name")
    return (
        names.join(wanted(versions, ids), "company_id")
        .select("company_id", "entity_name", *VERSION_COLUMNS)
        .orderBy("company_id", "version_number")
    )


def list_snapshots_of(snapshots: DataFrame, ids=None) -> DataFrame:
    return wanted(snapshots, ids).orderBy("company_id", "snapshot_at", "version_id")


def company_history(
    versions: DataFrame, snapshots: DataFrame, ids=None, documents: DataFrame | None = None,
    written: Callable[[Column], dict[str, Column]] | None = None,
) -> DataFrame:
    """Snapshots of companies in time with their version number, 0 where the version is unknown, and
    their metrics, a missing document as an empty one. Names are the facts' own.

    ``documents`` (``snapshot_id, credit_metrics``, one row per snapshot) are met after the numbers, so that only
    narrow rows move for these; without them ``snapshots`` hold them. ``written`` gives plain columns that stand for the
    document, made before rows are moved into order.
    """
    numbers = wanted(versions, ids).select("company_id", "version_id", "version_number")
    found = wanted(snapshots, ids).join(numbers, ["company_id", "version_id"], "left")
    if documents is not None:
        found = found.join(documents.select("snapshot_id", "credit_metrics"), "snapshot_id", "left")
    history = with_empty_document(found).select(
        "company_id",
        "entity_name",
        "snapshot_id",
        "version_id",
        F.coalesce("version_number", F.lit(0)).alias("version_number"),
        "upload_id",
        "snapshot_at",
        "credit_metrics",
    )
    if written is not None:
        history = history.withColumns(written(F.col("credit_metrics"))).drop("credit_metrics")
    return history.orderBy("company_id", "snapshot_at", "version_id")


def with_empty_document(df: DataFrame, column: str = "credit_metrics") -> DataFrame:
    """A null metrics document as one without years, metrics and sentinels."""
    kind = df.schema[column].dataType
    empty = F.struct(*[
        (F.array() if f.dataType.typeName() == "array" else F.create_map()).cast(f.dataType).alias(f.name) for f in kind.fields
    ])
    return df.withColumn(column, F.coalesce(column, empty))


#: Gives the wide rows of the snapshots whose ids it gets (``snapshot_id``).
Fetch = Callable[[DataFrame], DataFrame]


def _fetched(picked: DataFrame, snapshots: DataFrame, columns: list[str], fetch: Fetch | None) -> DataFrame:
    """``picked`` with ``columns`` of its snapshots: wide rows are read for picked ids only, after all ranking."""
    wide = snapshots if fetch is None else fetch(picked.select("snapshot_id"))
    return picked.join(wide.select("snapshot_id", *columns), "snapshot_id")


def latest_documents(snapshots: DataFrame, ids=None, fetch: Fetch | None = None) -> DataFrame:
    """``company_id, snapshot_id, credit_metrics`` of each company's last snapshot: years, metrics and
    sentinels, a missing document as an empty one.

    The last snapshot is an aggregate of three narrow columns, combined before the shuffle; documents are
    joined to it afterwards, or come from ``fetch``, so none is sorted or moved for the choice.
    """
    last = wanted(snapshots, ids).groupBy("company_id").agg(
        F.max_by("snapshot_id", F.struct("snapshot_at", "version_id")).alias("snapshot_id")
    )
    return with_empty_document(_fetched(last, snapshots, ["credit_metrics"], fetch)).select("company_id", "snapshot_id", "credit_metrics")


def latest_series(snapshots: DataFrame, ids=None, fetch: Fetch | None = None) -> DataFrame:
    """The values of ``latest_documents`` in long form; no rows where there are none."""
    return explode_document(latest_documents(snapshots, ids, fetch), ["company_id", "snapshot_id"])


COMPARED_COLUMNS = [
    "snapshot_id", "snapshot_at", "corporate_sector", "country_name", "currency_code",
    "business_risk_profile", "financial_risk_profile", "credit_metrics",
]


def as_of(companies: DataFrame, log: DataFrame, snapshots: DataFrame, day: date, ids=None) -> DataFrame:
    """Companies with the version holding at the end of ``day`` (UTC), off the log of loads, and its snapshots.

    Zero-length versions of loads at one time hold never, so one version holds at most: the last load's.
    """
    candidates = wanted(log, ids)
    holding = held_versions(candidates, day_end(log, "loaded_at", day))
    kept = [c for c in COMPARED_COLUMNS if c in snapshots.columns]
    facts = snapshots.select("version_id", *kept)
    return (
        wanted(companies, ids)
        .select("company_id", "entity_name")
        .join(holding.select("company_id", "version_id", "version_number"), "company_id")
        .join(with_empty_document(facts) if "credit_metrics" in kept else facts, "version_id")
    )


def as_of_pick(
    companies: DataFrame, log: DataFrame, snapshots: DataFrame, day: date, ids=None, fetch: Fetch | None = None
) -> DataFrame:
    """One row per company: highest version, then newest snapshot.

    Chosen on ids and times alone; all else of a snapshot is joined to the choice, or comes from ``fetch``.
    """
    picked = top_one(
        as_of(companies, log, snapshots.select("version_id", "snapshot_id", "snapshot_at"), day, ids),
        "company_id",
        F.col("version_number").desc(),
        F.col("snapshot_at").desc(),
        F.col("snapshot_id").desc(),
    )
    kept = [c for c in COMPARED_COLUMNS if c in snapshots.columns and c not in picked.columns]
    found = _fetched(picked, snapshots, kept, fetch)
    return with_empty_document(found) if "credit_metrics" in kept else found


def requested(companies: DataFrame, ids: list) -> DataFrame:
    """``pos, company_id`` of a list of ids, duplicates kept, typed as the table's ids."""
    id_type = companies.schema["company_id"].dataType.simpleString()
    return companies.sparkSession.createDataFrame(list(enumerate(ids)), f"pos int, company_id {id_type}")


def compare_companies(
    request: DataFrame, companies: DataFrame, log: DataFrame, snapshots: DataFrame, day: date, fetch: Fetch | None = None
) -> DataFrame:
    """One row per entry of ``request`` (``pos, company_id``) in its order, with ``found``."""
    picked = as_of_pick(companies, log, snapshots, day, request, fetch).withColumn("found", F.lit(True))
    return (
        request.select("pos", "company_id")
        .join(picked, "company_id", "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
        .orderBy("pos")
    )


def compare_not_found(
    request: DataFrame, companies: DataFrame, log: DataFrame, snapshots: DataFrame, day: date
) -> DataFrame:
    """Entries of ``request`` without a snapshot at ``day``, in request order."""
    present = as_of(companies, log, snapshots.select("version_id"), day, request)
    return request.select("pos", "company_id").join(present, "company_id", "left_anti").orderBy("pos")
