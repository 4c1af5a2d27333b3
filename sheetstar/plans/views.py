"""The given tables seen as loads, snapshots, uploads and sheets.

Orders are the load log: each order is one upload of one company (its customer). Sheets are
laid out from customer columns with defects set by the customer key, so that every parsing and
validation rule is met. ``SHEET_LAYOUT`` is written in SQL both engines read, and is all that a
query and its oracle share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.operators import versions
from sheetstar.operators.uploads import current_uploads

CURRENCY_SQL = (
    "CASE c_custkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'chf' WHEN 2 THEN 'USD' WHEN 3 THEN 'GBP' ELSE 'JPY' END"
)
COUNTRY_SQL = (
    "CASE c_nationkey "
    + " ".join(f"WHEN {i} THEN '{name}'" for i, (name, *_) in enumerate(fixed.COUNTRIES))
    + " ELSE 'NATION_' || CAST(c_nationkey AS STRING) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``upload_id, company_id, version_id, snapshot_id, loaded_at``, straight off the orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("upload_id"),
        F.col("o_custkey").alias("company_id"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderdate").alias("loaded_at"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with loads; named after the log is aggregated."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("entity_name")
    )
    return versions.companies(load_log(spark, sf_dir)).join(names, "company_id")


def snapshots(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Snapshots, all or those with an id in ``only`` (``snapshot_id``)."""
    orders = _only(table(spark, sf_dir, "orders"), "o_orderkey", only)
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("corporate_sector"),
        F.expr(COUNTRY_SQL).alias("country_name"),
        F.expr(CURRENCY_SQL).alias("currency_code"),
    )
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_custkey").alias("company_id"),
        F.col("o_orderkey").alias("upload_id"),
        "entity_name",
        "corporate_sector",
        "country_name",
        "currency_code",
        F.col("o_orderpriority").alias("business_risk_profile"),
        F.col("o_orderstatus").alias("financial_risk_profile"),
        F.col("o_orderdate").alias("snapshot_at"),
    )


def _only(rows: DataFrame, key: str, ids: DataFrame | None) -> DataFrame:
    return rows if ids is None else rows.join(ids.select(F.col("snapshot_id").alias(key)), key, "left_semi")


def snapshot_points(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Metric values of a snapshot from its line items: metric by line number, year by ship date;
    the largest price stands for a year met twice."""
    largest = (
        _only(table(spark, sf_dir, "lineitem"), "l_orderkey", only)
        .groupBy("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"))
        .agg(F.max("l_extendedprice").alias("num"))
    )
    return largest.select(
        F.col("l_orderkey").alias("snapshot_id"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("metric"),
        F.col("year").cast("string").alias("year"),
        "num",
    )


def metric_documents(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """``snapshot_id, credit_metrics`` of snapshots with points. These are moved to their snapshot once, narrow, and
    series and documents are made where they then lie."""
    value = F.struct(F.lit("num").alias("kind"), F.lit(None).cast("string").alias("text"), F.col("num").alias("num"))
    series = snapshot_points(spark, sf_dir, only).repartition("snapshot_id").groupBy("snapshot_id", "metric").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", value.alias("value"))))).alias("values")
    )
    return series.groupBy("snapshot_id").agg(
        F.struct(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("values"))))).alias("years"),
            F.map_from_entries(F.collect_list(F.struct("metric", "values"))).alias("metrics"),
            F.create_map(*[F.lit(x) for pair in fixed.SENTINEL_MEANINGS.items() for x in pair]).alias("sentinels"),
        ).alias("credit_metrics")
    )


def snapshots_with_metrics(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Snapshots with their metrics document; with ``only``, no others' documents are made."""
    return snapshots(spark, sf_dir, only).join(metric_documents(spark, sf_dir, only), "snapshot_id", "left")


def upload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as registrations; filled (F) and partial (P) ones end completed and failed at their
    last ship date not before the order, with their line count as rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    nothing = F.lit(None).cast("string")
    registered = orders.select(
        F.col("o_orderkey").alias("upload_id"),
        F.concat(F.lit("sheet_"), F.col("o_orderkey").cast("string"), F.lit(".xlsm")).alias("filename"),
        F.sha2(F.concat_ws("|", F.col("o_custkey").cast("string"), F.col("o_orderstatus")), 256).alias("file_sha256"),
        F.concat(F.lit("/landing/sheet_"), F.col("o_orderkey").cast("string"), F.lit(".xlsm")).alias("file_path"),
        F.lit("pending").alias("status"),
        F.col("o_orderdate").alias("event_at"),
        F.lit(None).cast("bigint").alias("rows_extracted"),
        nothing.alias("error_message"),
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    ended = (
        orders.filter(F.col("o_orderstatus").isin("F", "P"))
        .join(lines, "o_orderkey", "left")
        .groupBy("o_orderkey", "o_orderstatus", "o_orderdate")
        .agg(
            F.max(F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate"))).alias("shipped"),
            F.count("l_shipdate").alias("lines"),
        )
    )
    completed = F.col("o_orderstatus") == "F"
    closing = ended.select(
        F.col("o_orderkey").alias("upload_id"),
        nothing.alias("filename"),
        nothing.alias("file_sha256"),
        nothing.alias("file_path"),
        F.when(completed, "completed").otherwise("failed").alias("status"),
        F.coalesce("shipped", "o_orderdate").alias("event_at"),
        F.when(completed, F.col("lines")).alias("rows_extracted"),
        F.when(~completed, F.concat(F.lit("partial order of "), F.col("lines").cast("string"), F.lit(" lines"))).alias(
            "error_message"
        ),
    )
    return registered.unionByName(closing)


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_uploads(upload_events(spark, sf_dir))


# -- sheets ----------------------------------------------------------------------------------

_NO_NUMBER = "CAST(NULL AS DOUBLE)"


def _sheet_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by key, spread out before each becomes a whole sheet.

    Moving the narrow rows once is a fraction of moving their cells later, and everything keyed
    by sheet is then already in place. Keys are unique and sheets have one size, so the
    partitions are even.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "customer").repartition(partitions, "c_custkey")


def _row(row: int, label: str | None, *values: tuple[str, str, str]) -> list[tuple]:
    """Layout of one sheet row: cells as (row, column, kind, text, number) in SQL."""
    cells = [] if label is None else [(row, 1, "'str'", label, _NO_NUMBER)]
    return cells + [(row, 2 + i, *value) for i, value in enumerate(values) if value]


def _s(sql: str) -> tuple[str, str, str]:
    return ("'str'", sql, _NO_NUMBER)


def _f(text: str, number: str) -> tuple[str, str, str]:
    return ("'float'", text, f"CAST({number} AS DOUBLE)")


def _i(sql: str) -> tuple[str, str, str]:
    return ("'int'", f"CAST({sql} AS STRING)", f"CAST({sql} AS DOUBLE)")


def _label(name: str) -> str:
    return f"'{name}'"


_MISSING = "CAST(NULL AS STRING)"
_BALANCE = _f("CAST(c_acctbal AS STRING)", "c_acctbal")

SHEET_LAYOUT: list[tuple] = [
    cell
    for row in [
        _row(1, "chr(9) || 'Rated entity' || chr(160)",
             _s("CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN repeat(c_name, 12) "
                "ELSE ' ' || c_name END")),
        _row(2, _label("CorporateSector"), _s("c_mktsegment")),
        _row(3, _label("Rating methodologies applied"),
             _s("CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE 'General' END"),
             _s("CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE 'Sector ' || c_mktsegment END")),
        _row(4, _label("Industry risk"), _s("CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_mktsegment || ' risk' END")),
        _row(5, _label("Industry risk score"), _s("CASE WHEN c_custkey % 29 = 0 THEN '' ELSE 'BB' END")),
        _row(6, _label("Industry weight"), (
            "CASE WHEN c_custkey % 11 IN (1, 4, 6) THEN 'str' ELSE 'float' END",
            "CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '1.2' WHEN 3 THEN '0.5' "
            "WHEN 4 THEN '1_000' WHEN 5 THEN '0.995' WHEN 6 THEN ' 0.75 ' ELSE '1.0' END",
            "CAST(CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 1.2 WHEN 3 THEN 0.5 "
            "WHEN 4 THEN NULL WHEN 5 THEN 0.995 WHEN 6 THEN NULL ELSE 1.0 END AS DOUBLE)")),
        _row(7, _label("Segmentation criteria"), _s("CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'Geography' END")),
        _row(8, _label("Reporting Currency/Units"), _s(CURRENCY_SQL)),
        _row(9, _label("Country of origin"), _s(COUNTRY_SQL)),
        _row(10, _label("Accounting principles"), _s("CASE WHEN c_custkey % 61 = 0 THEN '' ELSE 'IFRS' END")),
        _row(11, _label("End of business year"), _s("CASE WHEN c_custkey % 17 = 0 THEN 'Dec' ELSE 'December' END")),
        _row(12, _label("Business risk profile"),
             _s("CASE c_custkey % 13 WHEN 0 THEN '-1 Notch' WHEN 1 THEN 'ZZZ' WHEN 2 THEN NULL ELSE 'BBB+' END")),
        _row(13, _label("Financial risk profile"),
             _s("CASE c_custkey % 19 WHEN 0 THEN 'B++' WHEN 1 THEN NULL ELSE 'BB-' END")),
        *[
            _row(14 + i, _label(label), value)
            for i, (label, value) in enumerate(
                zip(
                    fixed.SUB_SCORE_LABELS,
                    [_s("'A'"), _s("'BB+'"), _s("CASE WHEN c_custkey % 7 = 0 THEN 'None' ELSE 'B' END"),
                     _s("'+1 notch'"), _i("c_nationkey"), _s(_MISSING), _s("'AA'"), _BALANCE, _s("'CCC'"),
                     _s("' D '"), _s("'-2 notches'")],
                )
            )
        ],
        _row(25, f"CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE '{fixed.YEARS_LABEL}' END",
             _i("2021"), _i("2022"), _i("CASE WHEN c_custkey % 31 = 0 THEN 2022 ELSE 2023 END"), _s("'2024E'")),
        *[
            _row(26 + i, _label(label), *values)
            for i, (label, values) in enumerate(
                zip(
                    fixed.METRIC_LABELS[:5],
                    [
                        [_BALANCE, _s("'Locked'"), _i("c_nationkey"), _s("'No data'")],
                        [_BALANCE, _i("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END"), _BALANCE],
                        [_s("CASE WHEN c_custkey % 23 = 0 THEN 'n.a.' ELSE '1.5' END"), _BALANCE, _i("7"), _i("8"), _i("9")],
                        [_s(_MISSING)],
                        [_s("' 2.25 '"), _s("'1e2'"), _s("'1d'"), _s("'1_0'")],
                    ],
                )
            )
        ],
        _row(31, "CASE WHEN c_custkey % 2 = 0 THEN 'Liquidity' ELSE NULL END",
             _f("'4.862'", "4.862"), _s("CASE WHEN c_custkey % 4 = 0 THEN 'Locked' ELSE NULL END"),
             _s("CASE WHEN c_custkey % 4 = 0 THEN '-3 notches' ELSE NULL END")),
        _row(32, None, _s("'no label'")),
        _row(33, "'Comment ' || c_mktsegment", _s("c_name"), _BALANCE, _i("c_custkey")),
    ]
    for cell in row
]


def _cell_sql(column: int, kind: str, text: str, number: str) -> str:
    return f"named_struct('col_idx', {column}, 'kind', {kind}, 'text', {text}, 'num', {number})"


def sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, row_idx, col_idx, kind, text, num`` of one sheet per customer; blank cells are
    left out. A narrow explode of each customer row."""
    cells = ", ".join(
        f"named_struct('row_idx', {row}, 'cell', {_cell_sql(*cell)})" for row, *cell in SHEET_LAYOUT
    )
    return (
        _sheet_owners(spark, sf_dir)
        .selectExpr("c_custkey AS file_id", f"inline(array({cells}))")
        .select("file_id", "row_idx", "cell.*")
        .filter(F.col("text").isNotNull())
    )


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sheets the way a workbook scan gives them: ``file_id, row_idx, cells``."""
    by_row: dict[int, list[str]] = {}
    for row, column, kind, text, number in SHEET_LAYOUT:
        cell = f"CASE WHEN {text} IS NOT NULL THEN {_cell_sql(column, kind, text, number)} END"
        by_row.setdefault(row, []).append(cell)
    rows = ", ".join(
        f"named_struct('row_idx', {row}, 'cells', array_compact(array({', '.join(cells)})))"
        for row, cells in by_row.items()
    )
    return _sheet_owners(spark, sf_dir).selectExpr("c_custkey AS file_id", f"inline(array({rows}))")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sheets of one column: each line of the text a row."""
    lines = F.posexplode(F.split("text", "\n"))
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").alias("file_id"), lines.alias("row_idx", "text"))
        .select(
            "file_id",
            "row_idx",
            F.array(
                F.struct(
                    F.lit(1).alias("col_idx"), F.lit("str").alias("kind"), "text", F.lit(None).cast("double").alias("num")
                )
            ).alias("cells"),
        )
    )
