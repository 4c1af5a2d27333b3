"""Day bounds as literals of the column's own type, so comparisons stay cast-free and push down."""

from __future__ import annotations

from datetime import date, datetime, time, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(df: DataFrame, column: str, when: datetime) -> Column:
    """``when`` (UTC) as a literal comparable with ``df[column]`` without casting the column."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(when.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(when if when.tzinfo else when.replace(tzinfo=timezone.utc))


def day_start(df: DataFrame, column: str, day: date) -> Column:
    return instant(df, column, datetime.combine(day, time.min, tzinfo=timezone.utc))


def day_end(df: DataFrame, column: str, day: date) -> Column:
    return instant(df, column, datetime.combine(day, time.max, tzinfo=timezone.utc))
