"""Rows of one named sheet out of workbook bytes: stored values only, no formulas or macros.

A small decoder for one file, called inside the scan tasks of :mod:`sheetstar.sources.workbooks`.
Rows are produced one by one; only the shared strings of the workbook are held.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

Cell = tuple[int, str, str, float | None]  # column index from 0, kind, text, number

_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Fixed values of the file format: built-in number formats that show a point in time, and the one that shows a duration.
_BUILTIN = {i: "date" for i in (*range(14, 23), 45, 47)} | {46: "duration"}
_DAY_MS = 86_400_000


class SheetMissing(ValueError):
    pass


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _text(element) -> str:
    """Text of a string item, its runs joined, phonetic hints left out."""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(parts)


def _xml(archive: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(archive.read(name))


def _sheet_part(archive: zipfile.ZipFile, sheet: str) -> tuple[str, bool]:
    """Archive name of the sheet, and whether dates count from 1904."""
    workbook = _xml(archive, "xl/workbook.xml")
    from_1904 = any(
        _tag(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in workbook
    )
    for element in workbook.iter():
        if _tag(element) == "sheet" and element.get("name") == sheet:
            rels = _xml(archive, "xl/_rels/workbook.xml.rels")
            target = next(r.get("Target") for r in rels if r.get("Id") == element.get(_REL))
            return posixpath.normpath(posixpath.join("/xl", target)).lstrip("/"), from_1904
    raise SheetMissing(f"{sheet} sheet not found")


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    return [_text(item) for item in _xml(archive, "xl/sharedStrings.xml") if _tag(item) == "si"]


def _shown_as(code: str) -> str | None:
    """What a number format makes of a number: ``duration``, ``date`` or None for neither.

    Only the first section counts. Read left to right: text in quotes stands for itself, as does the
    character after a backslash; an underscore or asterisk takes the next character as filling; square
    brackets hold a run of one of h, m, s for elapsed time, or else a colour, condition or locale.
    Of what is left, the letters of year, month, day, hour and second show a date.
    """
    is_date, at = False, 0
    while at < len(code) and code[at] != ";":
        char = code[at].lower()
        if char == '"':
            end = code.find('"', at + 1)
            at = len(code) if end < 0 else end
        elif char == "[":
            end = code.find("]", at + 1)
            inside = code[at + 1 : len(code) if end < 0 else end].lower()
            if inside and len(inside) <= 2 and set(inside) in ({"h"}, {"m"}, {"s"}):
                return "duration"
            at = len(code) if end < 0 else end
        elif char in "\\_*":
            at += 1
        elif char in "ymdhs":
            is_date = True
        at += 1
    return "date" if is_date else None


def _date_styles(archive: zipfile.ZipFile) -> dict[int, str]:
    """Cell style index -> ``date`` or ``duration``, for the styles that show one."""
    if "xl/styles.xml" not in archive.namelist():
        return {}
    own, cell_formats = {}, []
    for group in _xml(archive, "xl/styles.xml"):
        if _tag(group) == "numFmts":
            own = {int(f.get("numFmtId")): _shown_as(f.get("formatCode", "")) for f in group}
        elif _tag(group) == "cellXfs":
            cell_formats = [int(f.get("numFmtId", 0)) for f in group]
    shown = {style: own.get(number, _BUILTIN.get(number)) for style, number in enumerate(cell_formats)}
    return {style: kind for style, kind in shown.items() if kind}


def _date_text(serial: float, kind: str, from_1904: bool) -> str:
    """A serial number as text: whole days from the epoch of the workbook, and the part of a day.

    In the 1900 system day 1 is 1 January 1900 and day 60 a 29 February that never was, so from there
    on days count one less. Numbers from 0 to below 1 are a time of day.
    """
    days, within = divmod(round(serial * _DAY_MS), _DAY_MS)
    part = timedelta(milliseconds=within)
    if kind == "duration":
        return str(timedelta(days=days) + part)
    if days == 0 and serial >= 0:
        return str((datetime.min + part).time())
    if from_1904:
        first = datetime(1904, 1, 1)
    else:
        first = datetime(1899, 12, 31) if 0 < days < 60 else datetime(1899, 12, 30)
    return str(first + timedelta(days=days) + part)


def _column(reference: str) -> int:
    index = 0
    for char in reference:
        if not char.isalpha():
            break
        index = index * 26 + ord(char.upper()) - 64
    return index - 1


def _value(cell, strings: list[str], styles: dict[int, str], from_1904: bool):
    """(kind, text, number) of a cell, None for a blank one."""
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = next((c for c in cell if _tag(c) == "is"), None)
        return None if inline is None else ("str", _text(inline), None)
    raw = next((c.text for c in cell if _tag(c) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return "str", strings[int(raw)], None
    if kind == "b":
        flag = bool(int(raw))
        return "bool", str(flag), float(flag)
    if kind == "d":
        return "datetime", str(datetime.fromisoformat(raw.removesuffix("Z"))), None
    if kind != "n":
        return "str", raw, None
    number = float(raw)
    style = styles.get(int(cell.get("s", 0)))
    if style:
        return "datetime", _date_text(number, style, from_1904), None
    if any(c in raw for c in ".eE"):
        return "float", str(number), number
    return "int", str(int(raw)), number


def read_rows(content: bytes, sheet: str) -> Iterator[tuple[int, list[Cell]]]:
    """(row index, non-blank cells) of each row with any, in sheet order."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        part, from_1904 = _sheet_part(archive, sheet)
        strings, styles = _shared_strings(archive), _date_styles(archive)
        row_idx, rows = 0, None
        with archive.open(part) as stream:
            for event, element in ElementTree.iterparse(stream, events=("start", "end")):
                if event == "start":
                    if _tag(element) == "sheetData":
                        rows = element
                    continue
                if _tag(element) != "row":
                    continue
                row_idx = int(element.get("r", row_idx + 1))
                cells, column = [], -1
                for cell in element:
                    if _tag(cell) != "c":
                        continue
                    column = _column(cell.get("r")) if cell.get("r") else column + 1
                    value = _value(cell, strings, styles, from_1904)
                    if value is not None:
                        cells.append((column, *value))
                # Off the tree, so that memory doesn't grow with the rows.
                if rows is not None:
                    rows.remove(element)
                if cells:
                    yield row_idx, cells
