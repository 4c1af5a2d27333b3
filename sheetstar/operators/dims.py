"""Country, currency, year and company dimensions.

Known attributes come from fixed lists of five and four rows, held as literal maps in the plan,
so conforming is a projection. Upserts keep the first row ever stored under a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.ids import stable_id
from sheetstar.functions.text import parse_int


def _known(rows: list[tuple], names: list[str]) -> Column:
    """Literal map: key -> struct of attributes."""
    return F.create_map(
        *[
            part
            for key, *attributes in rows
            for part in (F.lit(key), F.struct(*[F.lit(a).alias(n) for n, a in zip(names, attributes)]))
        ]
    )


def country_id(name: Column) -> Column:
    return F.when(name != "", stable_id("country", name))


def currency_id(code: Column) -> Column:
    return F.when(code != "", stable_id("currency", F.upper(code)))


def company_id(entity_name: Column) -> Column:
    return stable_id("company", entity_name)


def country_attributes(name: Column) -> Column:
    """What is known of a country by its name, null for others."""
    return _known(fixed.COUNTRIES, ["iso_alpha2", "iso_alpha3", "region"])[name]


def currency_attributes(code: Column) -> Column:
    """What is known of a currency by its code in any case, null for others."""
    return _known(fixed.CURRENCY_NAMES, ["currency_name", "symbol"])[F.upper(code)]


def countries(df: DataFrame, column: str, order: str) -> DataFrame:
    """Conformed countries of ``df[column]``, one row per name with the smallest ``order``; no row
    for a missing or empty name. Unlisted names are kept without attributes."""
    first = (
        df.filter(F.col(column) != "")
        .groupBy(F.col(column).alias("country_name"))
        .agg(F.min(order).alias("created_at"))
    )
    known = country_attributes(F.col("country_name"))
    return first.select(
        country_id(F.col("country_name")).alias("country_id"),
        "country_name",
        known["iso_alpha2"].alias("iso_alpha2"),
        known["iso_alpha3"].alias("iso_alpha3"),
        known["region"].alias("region"),
        "created_at",
    )


def currencies(df: DataFrame, column: str, order: str) -> DataFrame:
    """Conformed currencies, codes in upper case."""
    first = (
        df.filter(F.col(column) != "")
        .groupBy(F.upper(column).alias("currency_code"))
        .agg(F.min(order).alias("created_at"))
    )
    known = currency_attributes(F.col("currency_code"))
    return first.select(
        currency_id(F.col("currency_code")).alias("currency_id"),
        "currency_code",
        known["currency_name"].alias("currency_name"),
        known["symbol"].alias("symbol"),
        "created_at",
    )


def year_dates(df: DataFrame, years: str, order: list[str]) -> DataFrame:
    """Year dimension from arrays of year headers: a trailing E marks an estimate, which has no
    calendar year; ``sort_order`` is the position in the header of the first sheet by ``order``."""
    headers = df.select(*order, F.posexplode(years).alias("pos", "year_value"))
    first = headers.groupBy("year_value").agg(F.min(F.struct(*order, "pos"))["pos"].alias("sort_order"))
    is_estimate = F.col("year_value").endswith("E")
    return first.select(
        stable_id("date", F.col("year_value")).alias("date_id"),
        "year_value",
        F.when(~is_estimate, parse_int(F.col("year_value"))).alias("calendar_year"),
        is_estimate.alias("is_estimate"),
        "sort_order",
    )


def new_members(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows to append: keys not stored yet. Stored rows keep their attributes."""
    return incoming.join(existing.select(key), key, "left_anti").select(*incoming.columns)


def upsert(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The dimension after the upsert."""
    return existing.unionByName(new_members(incoming, existing, key).select(*existing.columns))
