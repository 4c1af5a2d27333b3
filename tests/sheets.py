"""Small workbook and cell-table writers for the tests."""

from __future__ import annotations

import zipfile
from datetime import datetime
from pathlib import Path
from xml.sax.saxutils import escape

from sheetstar import fixed

CELLS = "file_id string, row_idx int, col_idx int, kind string, text string, num double"


def value(v):
    """(kind, text, num) of a Python value, the way a scan reports it."""
    if isinstance(v, bool):
        return "bool", str(v), float(v)
    if isinstance(v, int):
        return "int", str(v), float(v)
    if isinstance(v, float):
        return "float", str(v), v
    if isinstance(v, datetime):
        return "datetime", str(v), None
    return "str", v, None


def cell_rows(file_id, rows):
    """Cells of ``rows``: lists starting at the label column; None is blank."""
    return [
        (file_id, r, c, *value(v))
        for r, row in enumerate(rows, 1)
        for c, v in enumerate(row, 1)
        if v is not None
    ]


def cells(spark, **files):
    return spark.createDataFrame([c for name, rows in files.items() for c in cell_rows(name, rows)], CELLS)


CLEAN = {
    "Rated entity": ["Acme"],
    "CorporateSector": ["Chemicals"],
    "Rating methodologies applied": ["General", "Chemicals"],
    "Industry risk": ["Specialty"],
    "Industry risk score": ["BB"],
    "Industry weight": [1.0],
    "Segmentation criteria": ["EBITDA"],
    "Reporting Currency/Units": ["EUR"],
    "Country of origin": ["Switzerland"],
    "Accounting principles": ["IFRS"],
    "End of business year": ["December"],
    "Business risk profile": ["BBB+"],
    "Financial risk profile": ["BB-"],
    **{label: ["A"] for label in fixed.SUB_SCORE_LABELS if label != "Liquidity"},
    fixed.YEARS_LABEL: [2022, 2023, "2024E"],
    fixed.METRIC_LABELS[0]: [1.5, "Locked", 2.5],
    "Liquidity": ["-2 notches"],
}


def clean(**changes):
    """Rows of a clean sheet; a change to None removes the label. Keys use ``_`` for blanks."""
    sheet = dict(CLEAN)
    for key, values in changes.items():
        label = {"years": fixed.YEARS_LABEL, "metric": fixed.METRIC_LABELS[0]}.get(key, key.replace("_", " "))
        if values is None:
            sheet.pop(label, None)
        else:
            sheet[label] = values
    return [[label, *values] for label, values in sheet.items()]


def _reference(row, column):
    letters = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        letters = chr(65 + rest) + letters
    return f"{letters}{row}"


def _cell(row, column, v, strings):
    ref = _reference(row, column)
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, datetime):
        return f'<c r="{ref}" s="1"><v>{(v - datetime(1899, 12, 30)).total_seconds() / 86400}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v}</v></c>'
    if v.startswith("inline:"):
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v[7:])}</t></is></c>'
    if v.startswith("="):
        return f'<c r="{ref}" t="str"><f>{escape(v[1:])}</f><v>formula text</v></c>'
    strings.setdefault(v, len(strings))
    return f'<c r="{ref}" t="s"><v>{strings[v]}</v></c>'


def write_workbook(path: Path, rows, sheet: str = fixed.SHEET_NAME) -> Path:
    """A workbook with another sheet in front; ``rows`` start at column B."""
    strings: dict[str, int] = {}
    body = "".join(
        f'<row r="{r}">' + "".join(_cell(r, c, v, strings) for c, v in enumerate(row, 1) if v is not None) + "</row>"
        for r, row in enumerate(rows, 1)
    )
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared = "".join(
        f'<si><r><t>{escape(s[:1])}</t></r><r><t xml:space="preserve">{escape(s[1:])}</t></r></si>' for s in strings
    )
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="Cover" sheetId="1" r:id="rId1"/>'
        f'<sheet name="{sheet}" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/>'
        "</Relationships>",
        "xl/sharedStrings.xml": f"<sst {main}>{shared}</sst>",
        "xl/styles.xml": f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="dd\\.mm\\.yyyy"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData/></worksheet>",
        "xl/worksheets/sheet2.xml": f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>",
    }
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return path
