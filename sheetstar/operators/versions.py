"""Company versions (SCD Type 2), derived from the append-only log of loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.operators.sequence import number_rows


def company_versions(load_log: DataFrame) -> DataFrame:
    """One version per load. Numbers count up per company in load order (time, then upload); a
    version ends where the next one starts, and the last is open and current.

    Versions of a company can neither overlap nor leave gaps. Loads with one time give
    zero-length versions, which hold at no time.
    """
    numbered = number_rows(
        load_log.select("company_id", "version_id", "upload_id", F.col("loaded_at").alias("valid_from")),
        "company_id",
        ["valid_from", "upload_id"],
        "version_number",
        {"valid_to": "valid_from"},
    )
    return numbered.select(
        "version_id",
        "company_id",
        "upload_id",
        F.col("version_number").cast("int").alias("version_number"),
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        F.col("valid_from").alias("created_at"),
    )


def companies(load_log: DataFrame) -> DataFrame:
    """``dim_company`` with the pointer to the latest loaded snapshot. Aggregates combine before
    the shuffle, so a company with very many loads stays cheap. A log without ``entity_name``
    gives companies without it."""
    order = F.struct("loaded_at", "upload_id")
    names = [F.min("entity_name").alias("entity_name")] if "entity_name" in load_log.columns else []
    return load_log.groupBy("company_id").agg(
        *names,
        F.max_by("snapshot_id", order).alias("current_snapshot_id"),
        F.min("loaded_at").alias("created_at"),
    )


def lookup_companies(entities: DataFrame, companies: DataFrame, load_log: DataFrame) -> DataFrame:
    """``entity_name, is_new_company, company_id, version_number`` for each distinct entity asked
    for: its company and current version number, or new with number 0."""
    current = load_log.groupBy("company_id").agg(F.count("*").cast("int").alias("version_number"))
    known = companies.select("entity_name", "company_id").join(current, "company_id")
    return (
        entities.select("entity_name")
        .distinct()
        .join(known, "entity_name", "left")
        .select(
            "entity_name",
            F.col("company_id").isNull().alias("is_new_company"),
            "company_id",
            F.coalesce("version_number", F.lit(0)).alias("version_number"),
        )
    )


def next_versions(loads: DataFrame, lookup: DataFrame) -> DataFrame:
    """Version number each new load (``entity_name, loaded_at, upload_id``) will get: one above
    the current version, counting up over the loads of the batch.

    The lookup is joined first, so that numbering, which splits a hot entity, comes last.
    """
    known = loads.join(lookup, "entity_name")
    numbered = number_rows(known, "entity_name", ["loaded_at", "upload_id"], "_in_batch")
    return numbered.withColumn("version_number", (F.col("version_number") + F.col("_in_batch")).cast("int")).drop("_in_batch")


def held_versions(load_log: DataFrame, until=None) -> DataFrame:
    """``company_id, version_id, upload_id, version_number, valid_from`` of the version each company has
    after its loads up to ``until`` (a literal; None for all): the last load, numbered by their count.

    One aggregation that is combined before the shuffle, without numbering the other versions.
    """
    loads = load_log if until is None else load_log.filter(F.col("loaded_at") <= until)
    last = F.max_by(F.struct("version_id", "upload_id", F.col("loaded_at").alias("valid_from")), F.struct("loaded_at", "upload_id"))
    held = loads.groupBy("company_id").agg(last.alias("_last"), F.count("*").cast("int").alias("version_number"))
    return held.select("company_id", "_last.version_id", "_last.upload_id", "version_number", "_last.valid_from")


def company_states(load_log: DataFrame, *by: str) -> DataFrame:
    """What loads add to their companies, per company (and the columns ``by``): how many, the first time, the last load.

    States of disjoint sets of loads merge into the state of all, in any order and any number of steps, so a
    reader of the last version or of the company needs one row a batch and not the loads.
    """
    last = F.max_by(F.struct("version_id", "upload_id", "snapshot_id"), F.struct("loaded_at", "upload_id"))
    return load_log.groupBy(*by, "company_id").agg(
        F.min("entity_name").alias("entity_name"),
        F.count("*").alias("loads"),
        F.min("loaded_at").alias("first_at"),
        F.max("loaded_at").alias("last_at"),
        last.alias("_last"),
    ).select(*by, "company_id", "entity_name", "loads", "first_at", "last_at", "_last.*")


def merged_states(states: DataFrame) -> DataFrame:
    """One state per company of the states of disjoint sets of its loads."""
    last = F.max_by(F.struct("version_id", "upload_id", "snapshot_id"), F.struct("last_at", "upload_id"))
    return states.groupBy("company_id").agg(
        F.min("entity_name").alias("entity_name"),
        F.sum("loads").alias("loads"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        last.alias("_last"),
    ).select("company_id", "entity_name", "loads", "first_at", "last_at", "_last.*")


def companies_of(merged: DataFrame) -> DataFrame:
    """``companies`` of the loads, off one state per company."""
    return merged.select("company_id", "entity_name", F.col("snapshot_id").alias("current_snapshot_id"), F.col("first_at").alias("created_at"))


def current_versions_of(merged: DataFrame) -> DataFrame:
    """``current_versions`` of the loads, off one state per company: the last load, numbered by their count."""
    return _open_versions(merged.select(
        "company_id", "version_id", "upload_id", F.col("loads").cast("int").alias("version_number"), F.col("last_at").alias("valid_from")
    ))


def batch_versions(loads: DataFrame, merged: DataFrame) -> DataFrame:
    """Versions that a batch of later loads opens and closes, in the columns of ``company_versions``.

    ``merged``: the states before the batch. Only companies of the batch are read: its loads are numbered from
    their company's count, and the version open so far ends with its first load. All loads of the batch must come
    after those of the states in the order of ``company_versions``.
    """
    touched = merged.join(loads.select("company_id").distinct(), "company_id", "left_semi")
    before = current_versions_of(touched)
    own = company_versions(loads)
    base = before.select("company_id", F.col("version_number").alias("_before"))
    opened = own.join(base, "company_id", "left").withColumn(
        "version_number", (F.col("version_number") + F.coalesce("_before", F.lit(0))).cast("int")
    )
    starts = loads.groupBy("company_id").agg(F.min("loaded_at").alias("_ends"))
    closed = before.join(starts, "company_id").withColumns({"valid_to": F.col("_ends"), "is_current": F.lit(False)})
    return opened.select(*own.columns).unionByName(closed.select(*own.columns))


def current_versions(load_log: DataFrame) -> DataFrame:
    """The open version of each company, in the columns of ``company_versions``."""
    return _open_versions(held_versions(load_log))


def _open_versions(held: DataFrame) -> DataFrame:
    return held.select(
        "version_id", "company_id", "upload_id", "version_number", "valid_from",
        F.lit(None).cast(held.schema["valid_from"].dataType).alias("valid_to"), F.lit(True).alias("is_current"), F.col("valid_from").alias("created_at"),
    )
