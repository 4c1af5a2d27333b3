"""Constraint checks: Parquet enforces none of them, so each is a query for the rows that break it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values held by more than one row, with their count. Null keys are not compared."""
    present = df.select(*keys).dropna()
    return present.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti").select(*child.columns)


def outside_domain(df: DataFrame, column: str, accepted: list | None = None) -> DataFrame:
    """Rows whose value is none of the accepted ones; upload statuses by default. Null passes."""
    return df.filter(~F.col(column).isin(fixed.UPLOAD_STATUSES if accepted is None else accepted))


def missing_or_unfit(df: DataFrame, required: list[str], decimals: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Rows with nulls in required columns or numbers too large for their decimal type.

    Adds ``problems``, one text per broken column.
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    for c, (precision, scale) in (decimals or {}).items():
        unfit = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({precision},{scale})").isNull()
        checks.append(F.when(unfit, F.lit(f"{c} does not fit decimal({precision},{scale})")))
    problems = F.filter(F.array(*checks), lambda p: p.isNotNull())
    return df.withColumn("problems", problems).filter(F.size("problems") > 0)
