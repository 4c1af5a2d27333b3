"""Numbering rows within a key when one key may hold a large share of all rows.

A plain window sorts a key in one task. That is right for keys of bounded size; rows of larger ones are
dealt into ranges of the whole order, numbered within (key, range), and the ranges' counts, one row
each, give what comes before. Rows that share their time are split like any others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheetstar.session import shared_folder

#: Rows of one key that a task may sort; and rows of a larger key that are dealt into one range.
HOT_ROWS = 250_000
RANGE_ROWS = 16_384
#: Spark's running ids hold the partition above this bit.
_PARTITION_BIT = 33


def number_rows(
    df: DataFrame, key: str, order: list[str], number: str, following: dict[str, str] | None = None,
    hot_rows: int = HOT_ROWS, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``number`` (1, 2, … within ``key`` by ``order``) and, per ``following`` entry
    (new column -> source column), the source value of the next row of the key, null on the last.

    ``order`` must be total within a key, but for rows equal in all columns, and free of nulls, as must
    the sources. Building the plan counts rows by key in one job that combines before its shuffle; keys above ``hot_rows``
    are written to the shared folder in ranges of about ``range_rows``. Results are the plain window's in any case.
    """
    following = following or {}
    counts = df.groupBy(key).agg(F.count("*").alias("__seq_rows")).filter(F.col("__seq_rows") > hot_rows)
    hot = counts.agg(F.count("*").alias("keys"), F.sum("__seq_rows").alias("rows")).first()
    if not hot["keys"]:
        return _in_window(df, key, order, number, following)
    counts = counts.select(key)
    large = df.join(counts, df[key].eqNullSafe(counts[key]), "left_semi")
    small = df.join(counts, df[key].eqNullSafe(counts[key]), "left_anti")
    ranged = _in_ranges(large, key, order, number, following, -(-hot["rows"] // range_rows))
    return _in_window(small, key, order, number, following).unionByName(ranged)


def _in_window(df: DataFrame, key: str, order: list[str], number: str, following: dict[str, str]) -> DataFrame:
    in_order = W.partitionBy(key).orderBy(*order)
    return df.select(
        "*", F.row_number().over(in_order).cast("bigint").alias(number),
        *[F.lead(source).over(in_order).alias(new) for new, source in following.items()],
    )


def _in_ranges(df: DataFrame, key: str, order: list[str], number: str, following: dict[str, str], ranges: int) -> DataFrame:
    spark = df.sparkSession
    folder = shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir") + "/_ranges").rstrip("/")
    path = f"{folder}/ranges-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(ranges, key, *order).sortWithinPartitions(key, *order)
    # Written, as another run of the same plan may draw other borders.
    dealt.withColumn("__seq_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("__seq_range", F.shiftright("__seq_at", _PARTITION_BIT))
    each = placed.groupBy(key, "__seq_range").agg(
        F.count("*").alias("__seq_rows"), F.min("__seq_at").alias("__seq_first"), *[F.min_by(source, "__seq_at").alias(f"__seq_first_{new}") for new, source in following.items()]
    )
    in_order = W.partitionBy(key).orderBy("__seq_range")
    before = F.coalesce(F.sum("__seq_rows").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = each.select(
        F.col(key).alias("__seq_key"), F.col("__seq_range").alias("__seq_in"), "__seq_first", before.alias("__seq_before"),
        *[F.lead(f"__seq_first_{new}").over(in_order).alias(f"__seq_after_{new}") for new in following],
    )
    if following:
        within = W.partitionBy(key, "__seq_range").orderBy("__seq_at")
        placed = placed.withColumns({f"__seq_next_{new}": F.lead(source).over(within) for new, source in following.items()})
    joined = placed.join(offsets, (F.col("__seq_range") == F.col("__seq_in")) & placed[key].eqNullSafe(F.col("__seq_key")))
    return joined.select(
        *[placed[c] for c in df.columns],
        (F.col("__seq_at") - F.col("__seq_first") + 1 + F.col("__seq_before")).cast("bigint").alias(number),
        *[F.coalesce(f"__seq_next_{new}", f"__seq_after_{new}").alias(new) for new in following],
    )
