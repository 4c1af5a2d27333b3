"""Parsing and validation on hand-built sheets."""

import hashlib
import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.text import float_text, parse_float, parse_int, round_exactly, round_number, strip
from sheetstar.operators import fingerprints, metrics, rules, sheets
from sheetstar.plans import loading
from sheetstar.sources import workbook_cells
from tests.sheets import CELLS, cell_rows, cells, clean

METRIC = fixed.METRIC_LABELS[0]


def records(spark, align="packed", **files):
    rows = sheets.rows_from_cells(cells(spark, **files))
    return metrics.with_series(sheets.records(rows), align)


def one(spark, rows, align="packed"):
    return rules.check(records(spark, align, f=rows)).first()


def points(spark, rows, align="packed"):
    found = metrics.metric_points(records(spark, align, f=rows)).filter(F.col("metric") == METRIC)
    return {r.year: (r.pos, r.kind, r.num, r.text) for r in found.collect()}


def messages(spark, **changes):
    checked = one(spark, clean(**{"Liquidity": ["Locked"], **changes}))
    return [f.message for f in checked.errors], [f.message for f in checked.warnings]


def evaluate(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip(spark):
    texts = ["\t a ", "　b\x1f", " ", "", "a b", "\x85c "]
    assert evaluate(spark, texts, strip) == [t.strip() for t in texts]


def test_parse_float_follows_python(spark):
    texts = ["1d", "1_000", " 1.5 ", "inf", "nan", "-Infinity", "1e5", ".5", "5.", "1__0", "", "+3", "1e", "2.5f", "_1", "1_", "0x1"]

    def python(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert [str(v) for v in evaluate(spark, texts, parse_float)] == [str(python(t)) for t in texts]
    assert evaluate(spark, ["2024", " 2_024 ", "2024.0", "n/a", "-5"], parse_int) == [2024, 2024, None, None, -5]


def test_float_text_follows_python(spark):
    numbers = [0.5, 1e-05, 1.5e-07, 123456789.125, 1e16, 1e7, 12.0, -3e-05, 0.001, 0.0005, math.nan, math.inf, -1e7, 1e100, 0.0]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    assert [r.t for r in df.select(float_text(F.col("x")).alias("t")).collect()] == [str(n) for n in numbers]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=-1000, max_value=10**9, places=3).map(float), min_size=50, max_size=50))
def test_float_text_property(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    assert [r.t for r in df.select(float_text(F.col("x")).alias("t")).collect()] == [str(n) for n in numbers]


def test_rounding(spark):
    df = spark.createDataFrame([(0.1234565,), (1.0000005,), (2.5,), (math.inf,)], "x double")
    exact = [r.y for r in df.select(round_exactly(F.col("x"), 6).alias("y")).collect()]
    assert exact == [round(x, 6) for x in (0.1234565, 1.0000005, 2.5, math.inf)]
    assert [r.y for r in df.select(round_number(F.col("x"), 6).alias("y")).collect()][2:] == [2.5, math.inf]


def test_clean_sheet(spark):
    checked = one(spark, clean(Liquidity=["Locked"]))
    assert checked.rated_entity == "Acme" and checked.rating_methodologies == ["General", "Chemicals"]
    assert checked.is_valid and checked.errors == []
    assert [w.field for w in checked.warnings] == ["Liquidity"]  # the sub-score "Locked"
    assert float(checked.completeness_score) == 1.0


def test_label_column_is_the_second(spark):
    raw = [("f", 1, 0, "str", "ignored", None), ("f", 1, 1, "str", "\tRated entity ", None), ("f", 1, 3, "str", " Acme ", None),
           ("f", 2, 0, "str", "CorporateSector", None), ("f", 2, 2, "str", "no label", None)]
    record = sheets.records(sheets.rows_from_cells(spark.createDataFrame(raw, CELLS))).first()
    assert record.rated_entity == "Acme" and record.corporate_sector is None


def test_last_duplicate_wins_even_when_empty(spark):
    rows = sheets.rows_from_cells(cells(spark, f=[["A", 1], ["A", 2], ["B", 1], ["B"]]))
    found = {r.label: [v.text for v in r["values"]] for r in sheets.sheet_rows(rows).collect()}
    assert found == {"A": ["2"], "B": []}


def test_raw_document(spark):
    rows = sheets.rows_from_cells(cells(spark, f=[["A", 1, None, "x"], ["B"]]))
    document = sheets.raw_document(sheets.raw_values(rows)).first().raw_data
    assert {k: [(v.col_idx, v.kind, v.text) for v in values] for k, values in document.items()} == {
        "A": [(2, "int", "1"), (4, "str", "x")], "B": [],
    }
    assert loading.rows_extracted(sheets.raw_values(rows)).first().rows_extracted == 2


def test_gap_moves_values_left_unless_aligned(spark):
    rows = clean(metric=[1.5, None, 2.5])
    assert {y: p[2] for y, p in points(spark, rows).items()} == {"2022": 1.5, "2023": 2.5}
    assert {y: p[2] for y, p in points(spark, rows, "column").items()} == {"2022": 1.5, "2024E": 2.5}
    with pytest.raises(ValueError):
        metrics.with_series(records(spark, f=rows), "diagonal")


def test_metric_values_are_typed(spark):
    found = points(spark, clean(metric=["Locked", "n.a.", " 1_0.1234567 ", True], years=[2021, 2022, "2023", "2024E"]))
    assert found["2021"] == (0, "sentinel", None, "Locked")
    assert found["2022"] == (1, "raw", None, "n.a.")
    assert found["2023"][1:3] == ("num", 10.123457)
    assert found["2024E"][1:3] == ("num", 1.0)


def test_repeated_year_keeps_last_value_at_first_place(spark):
    found = points(spark, clean(years=[2022, 2023, 2022], metric=[1.0, 2.0, 3.0]))
    assert found == {"2022": (0, "num", 3.0, "3.0"), "2023": (1, "num", 2.0, "2.0")}


def test_no_year_header(spark):
    record = records(spark, f=clean(years=None)).withColumn("doc", metrics.metrics_document()).first()
    assert record.series is None and record.doc is None
    assert "No credit metrics found in MASTER sheet" in messages(spark, years=None)[1]
    assert records(spark, f=clean(years=[])).first().series is None


def test_metrics_without_years_given_directly(spark):
    given_directly = records(spark, f=clean()).withColumns({"has_years": F.lit(False), "has_metrics": F.lit(True)})
    found = [r.rule for r in rules.findings(rules.with_findings(given_directly)).collect()]
    assert "metrics_years" in found and "metrics_missing" not in found


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([["Liquidity", "-2 notches"], ["Liquidity", 4.862]], "4.862"),
        ([["Liquidity", 4.862], ["Liquidity", "-2 notches"]], "-2 notches"),
        ([["Liquidity", 4.862, "Locked", "-2 notches"]], "-2 notches"),
        ([["Liquidity", "Locked"]], "Locked"),
        ([["Liquidity", "None"]], None),
    ],
)
def test_liquidity_repair(spark, rows, expected):
    repaired = sheets.repaired_sub_scores(F.col("risk_sub_scores"), F.col("liquidity_values"))
    assert records(spark, f=rows).select(repaired.alias("s")).first().s["Liquidity"] == expected


@pytest.mark.parametrize(
    "changes, errors, warnings",
    [
        ({"Industry weight": None}, [], ["Recommended field 'Industry weight' is missing", "Industry weight is missing — cannot validate range"]),
        ({"Industry weight": [1.2]}, ["Industry weight 1.2 is outside valid range [0, 1]"],
         ["Industry weight 1.2 deviates from 1.0 by 0.2000 (tolerance: 0.01)"]),
        ({"Industry weight": [0.5]}, [], ["Industry weight 0.5 deviates from 1.0 by 0.5000 (tolerance: 0.01)"]),
        ({"Industry weight": [0.995]}, [], []),
        ({"Industry weight": ["abc"]}, ["Industry weight must be numeric, got 'abc'"],
         ["Recommended field 'Industry weight' is missing", "Industry weight is missing — cannot validate range"]),
        ({"Industry weight": ["nan"]}, ["Industry weight nan is outside valid range [0, 1]"], []),
        ({"Financial risk profile": None},
         ["Required field 'Financial risk profile' is missing or empty",
          "Business risk profile present but financial risk profile is missing"], []),
        ({"Business risk profile": [""]},
         ["Required field 'Business risk profile' is missing or empty", "'' is not a valid rating notation",
          "Financial risk profile present but business risk profile is missing"], []),
        ({"Business risk profile": ["-1 Notch"]}, [], ["'-1 Notch' is a notch adjustment — not a standard rating notation"]),
        ({"Business risk profile": ["ZZZ"]}, ["'ZZZ' is not a valid rating notation"], []),
        ({"Reporting Currency/Units": ["eur"]}, [], []),
        ({"Reporting Currency/Units": ["JPY"]}, ["Invalid currency 'JPY'. Must be one of ['CHF', 'EUR', 'GBP', 'USD']"], []),
        ({"Rating methodologies applied": []}, ["At least one rating methodology must be specified"], []),
        ({"Rated entity": ["x" * 201]}, [], ["Entity name length 201 exceeds 200 characters"]),
        ({"Market share": ["it's 5"]}, [], ["Sub-score 'it's 5' is not standard notation"]),
        ({METRIC: [1.0, "n.a."]}, [], [f"Non-numeric value 'n.a.' for year 2023 in '{METRIC}'"]),
    ],
)
def test_rules(spark, changes, errors, warnings):
    found_errors, found_warnings = messages(spark, **changes)
    assert found_errors == errors
    assert [w for w in found_warnings if "'Locked'" not in w] == warnings


def test_extra_rule(spark):
    def no_gmbh():
        return [rules.finding("rated_entity LIKE '%GmbH'", "legal_form", "rated_entity", "Legal form in '{rated_entity}'", "warning")]

    checked = rules.check(records(spark, f=clean(Rated_entity=["Acme GmbH"])), [no_gmbh]).first()
    assert "Legal form in 'Acme GmbH'" in [w.message for w in checked.warnings]


def test_fingerprint_has_no_separators(spark):
    rows = sheets.rows_from_cells(cells(spark, a=[["ab", "c"]], b=[["a", "bc"]], c=[["a"], [None, "bc"]]))
    hashes = {r.file_sha256 for r in fingerprints.fingerprints(rows).collect()}
    assert hashes == {hashlib.sha256(b"abc").hexdigest()}


def test_large_files_hash_the_same_as_small_ones(spark):
    rows = cell_rows("a", [[f"label {i}", i, "ü"] for i in range(3000)]) + cell_rows("b", [["x", 1]]) + cell_rows("c", [["y"]] * 50)
    scanned = sheets.rows_from_cells(spark.createDataFrame(rows, CELLS).repartition(8))
    joined = {r.file_id: r.file_sha256 for r in fingerprints.fingerprints(scanned).collect()}
    streamed = {r.file_id: r.file_sha256 for r in fingerprints.fingerprints(scanned, stream_bytes=0).collect()}
    mixed = {r.file_id: r.file_sha256 for r in fingerprints.fingerprints(scanned, stream_bytes=20).collect()}
    assert joined == streamed == mixed
    text = "".join(f"label {i}{i}ü" for i in range(3000))
    assert joined["a"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("code, shown", [
    ("yyyy-mm-dd", "date"), ("d/m/yy h:mm", "date"), ("[h]:mm:ss", "duration"), ("[mm]:ss", "duration"), ("[Red]0.00", None), ("[$-409]d-mmm", "date"),
    ('0 "days"', None), (r"0\d", None), ("_d0", None), ("0.00E+00", None), ("General", None), ("0;[Red]d", None), ('"unclosed d', None), ("[unclosed d", None), ("", None),
])
def test_number_formats(code, shown):
    assert workbook_cells._shown_as(code) == shown


@pytest.mark.parametrize("serial, kind, from_1904, text", [
    (45657.0, "date", False, "2024-12-31 00:00:00"), (1.0, "date", False, "1900-01-01 00:00:00"), (59.5, "date", False, "1900-02-28 12:00:00"),
    (61.0, "date", False, "1900-03-01 00:00:00"), (0.25, "date", False, "06:00:00"), (0.0, "date", False, "00:00:00"), (0.9999999999, "date", False, "1900-01-01 00:00:00"),
    (1.0, "date", True, "1904-01-02 00:00:00"), (44195.75, "date", True, "2024-12-31 18:00:00"), (1.5, "duration", False, "1 day, 12:00:00"),
])
def test_serial_numbers(serial, kind, from_1904, text):
    assert workbook_cells._date_text(serial, kind, from_1904) == text


def test_documents_as_json(spark):
    rows = spark.createDataFrame(cell_rows("f", clean(metric=[1.5, "Locked"])), CELLS)
    records = metrics.with_series(sheets.records(sheets.rows_from_cells(rows))).withColumn("credit_metrics", metrics.metrics_document())
    row = records.select("credit_metrics", metrics.document_json().alias("text")).first()
    read = json.loads(row.text)
    assert read["years"] == row.credit_metrics["years"] and read["sentinels"] == row.credit_metrics["sentinels"]
    values = {m: {y: v.asDict() for y, v in s.items()} for m, s in row.credit_metrics["metrics"].items()}
    assert read["metrics"] == values and values
