"""Sheet rows to labelled values and one wide record per sheet.

Rows are the unit of work: a sheet row carries its cells in one array (bounded by the column
count of a sheet), and grouping happens by (file, label), so a single huge sheet spreads over
many tasks. Only the few known labels of a file are ever gathered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.text import parse_float, strip

KNOWN_LABELS = list(
    dict.fromkeys(
        [
            *fixed.SCALAR_LABELS.values(),
            fixed.METHODOLOGIES_LABEL,
            fixed.WEIGHT_LABEL,
            *fixed.SUB_SCORE_LABELS,
            fixed.YEARS_LABEL,
            *fixed.METRIC_LABELS,
        ]
    )
)


def rows_from_cells(cells: DataFrame) -> DataFrame:
    """``sheet_cells`` (one row per cell) to one row per sheet row with its cells in column order."""
    cell = F.struct("col_idx", "kind", "text", "num")
    return (
        cells.filter(F.col("text").isNotNull())
        .groupBy("file_id", "row_idx")
        .agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    )


def label_rows(rows: DataFrame) -> DataFrame:
    """Rows with a label: ``file_id, row_idx, label, values``.

    Blank cells are not in ``cells``, so later values move left over a gap; each value keeps
    the column it stood in. Cells are in column order, so the label is one of the first two.
    """
    cell, size = F.col("cells"), F.size("cells")
    first, second = F.get(cell, F.lit(0)), F.get(cell, F.lit(1))
    label = F.when(first["col_idx"] == fixed.LABEL_COLUMN, first["text"]).when(
        second["col_idx"] == fixed.LABEL_COLUMN, second["text"]
    )
    before_values = F.when(first["col_idx"] == fixed.LABEL_COLUMN, 1).otherwise(2)
    return rows.select(
        "file_id",
        "row_idx",
        strip(label).alias("label"),
        F.slice(cell, before_values + 1, F.greatest(size - before_values, F.lit(0))).alias("values"),
    ).filter(F.col("label").isNotNull())


def sheet_rows(rows: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """``file_id, label, values`` with the last row of a repeated label winning.

    ``labels`` keeps only those labels, before the shuffle.
    """
    labelled = label_rows(rows)
    if labels is not None:
        labelled = labelled.filter(F.col("label").isin(labels))
    return labelled.groupBy("file_id", "label").agg(F.max_by("values", "row_idx").alias("values"))


def single(values: Column) -> Column:
    return strip(F.get(values, F.lit(0))["text"])


def multiple(values: Column) -> Column:
    return F.transform(values, lambda v: strip(v["text"]))


def number(value: Column) -> Column:
    """Number of a value: its own for numeric and Boolean cells, parsed for text."""
    return F.when(value["kind"] == "str", parse_float(value["text"])).otherwise(value["num"])


def records(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One wide record per file, every field optional.

    ``files`` (column ``file_id``) lists files that must appear even if none of their rows
    carries a known label.
    """
    known = sheet_rows(rows, KNOWN_LABELS)
    # At most len(KNOWN_LABELS) entries per file.
    by_label = known.groupBy("file_id").agg(
        F.map_from_entries(F.collect_list(F.struct("label", "values"))).alias("sheet")
    )
    if files is not None:
        by_label = files.select("file_id").join(by_label, "file_id", "left")

    def values(label: str) -> Column:
        return F.col("sheet")[label]

    first_weight = F.get(values(fixed.WEIGHT_LABEL), F.lit(0))
    fields = [single(values(label)).alias(name) for name, label in fixed.SCALAR_LABELS.items()]
    sub_scores = [
        part for label in fixed.SUB_SCORE_LABELS for part in (F.lit(label), single(values(label)))
    ]
    return by_label.select(
        "file_id",
        *fields,
        F.coalesce(multiple(values(fixed.METHODOLOGIES_LABEL)), F.array().cast("array<string>")).alias(
            "rating_methodologies"
        ),
        number(first_weight).alias("industry_weight"),
        first_weight["text"].alias("industry_weight_text"),
        F.create_map(*sub_scores).alias("risk_sub_scores"),
        values(fixed.LIQUIDITY_LABEL).alias("liquidity_values"),
        values(fixed.YEARS_LABEL).alias("year_values"),
        F.array(
            *[
                F.struct(F.lit(label).alias("metric"), values(label).alias("values"))
                for label in fixed.METRIC_LABELS
            ]
        ).alias("metric_rows"),
    )


def repaired_sub_scores(sub_scores: Column, liquidity_values: Column) -> Column:
    """Sub-scores as stored: a text value on the liquidity row replaces its number, and the
    text ``None`` becomes null."""
    texts = F.filter(
        liquidity_values, lambda v: (v["kind"] == "str") & ~v["text"].isin(fixed.SENTINELS)
    )
    replacement = F.get(texts, F.lit(0))["text"]
    return F.transform_values(
        sub_scores,
        lambda k, v: F.nullif(
            F.when(k == fixed.LIQUIDITY_LABEL, F.coalesce(replacement, v)).otherwise(v), F.lit("None")
        ),
    )


def raw_values(rows: DataFrame) -> DataFrame:
    """Full lineage in long form: ``file_id, label, values`` for every label."""
    return sheet_rows(rows)


def raw_document(raw: DataFrame, key: str = "file_id") -> DataFrame:
    """``key, raw_data`` map; meant for the sheets of a detail read, not for whole tables."""
    return raw.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("label", "values"))).alias("raw_data")
    )
