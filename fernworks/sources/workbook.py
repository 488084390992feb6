"""Spreadsheets (Office Open XML workbooks) as tables, from any file system that Spark reads, and tables as workbooks.

A workbook is one file and has a million rows a sheet at most, so a file is a task's work and many files are many tasks.
Cells are streamed from the sheet's XML, written once as a table, and typed by what all of a column's cells hold.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workers import prepare
from .files import _fs, kept

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: The built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
#: What a column holds, by the kinds of its cells: whole numbers, numbers, truth values, dates, text.
_TYPES = [({"i"}, "long"), ({"i", "n"}, "double"), ({"n"}, "double"), ({"b"}, "boolean"), ({"d"}, "timestamp")]


def _text(item) -> str:
    """The text of a string item, of all its runs but the phonetic ones."""
    said = "".join(t.text or "" for part in item if part.tag != f"{_MAIN}rPh" for t in ([part] if part.tag == f"{_MAIN}t" else part.iter(f"{_MAIN}t")))
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), said)


def _shows_dates(code: str) -> bool:
    return bool(re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", code.lower())))


def _date(serial: float, since_1904: bool) -> str:
    """Day numbers count from 1900-01-01 as day 1, with a 29 February 1900 that never was, or from 1904-01-01 as day 0."""
    start = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 31) if serial < 60 else datetime(1899, 12, 30)
    return (start + timedelta(milliseconds=round(serial * 86_400_000))).isoformat(sep=" ")


def _column(place: str) -> int:
    out = 0
    for c in place:
        if not c.isalpha():
            break
        out = out * 26 + ord(c.upper()) - 64
    return out - 1


def rows_of(content: bytes, sheet: str | None = None) -> Iterator[tuple[int, list[str | None], str]]:
    """(row, texts, kinds) of the rows of a sheet (the first unless named) that hold anything. Kinds has a letter for each
    cell: i whole number, n number, b truth value, d date, s text, - empty or an error."""
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    top = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = {s.get("name"): s.get(_LINK) for s in top.iter(f"{_MAIN}sheet")}
    if sheet is not None and sheet not in sheets:
        raise ValueError(f"there is no sheet {sheet!r}, only {list(sheets)}")
    link = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
    target = next(x.get("Target") for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")) if x.get("Id") == link)
    properties = top.find(f"{_MAIN}workbookPr")
    since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        for _, item in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
            if item.tag == f"{_MAIN}si":
                shared.append(_text(item))
                item.clear()
    dates: list[bool] = []
    if "xl/styles.xml" in names:
        styles = ElementTree.fromstring(book.read("xl/styles.xml"))
        codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_MAIN}numFmt")}
        formats = [int(x.get("numFmtId", 0)) for x in styles.findall(f"{_MAIN}cellXfs/{_MAIN}xf")]
        dates = [f in _DATE_FORMATS or f in codes and _shows_dates(codes[f]) for f in formats]
    number = 0
    for _, row in ElementTree.iterparse(book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}")):
        if row.tag != f"{_MAIN}row":
            continue
        number = int(row.get("r") or number + 1)
        texts: list[str | None] = []
        kinds: list[str] = []
        for cell in row.iter(f"{_MAIN}c"):
            at = _column(cell.get("r")) if cell.get("r") else len(texts)
            texts += [None] * (at + 1 - len(texts))
            kinds += ["-"] * (at + 1 - len(kinds))
            kind, v = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
            if kind == "inlineStr":
                texts[at], kinds[at] = _text(cell.find(f"{_MAIN}is")), "s"
            elif v is None or kind == "e":
                continue
            elif kind == "s":
                texts[at], kinds[at] = shared[int(v)], "s"
            elif kind == "b":
                texts[at], kinds[at] = "true" if v == "1" else "false", "b"
            elif kind == "d":
                texts[at], kinds[at] = v.replace("T", " ").rstrip("Z"), "d"
            elif kind == "n":
                style = int(cell.get("s", 0))
                if style < len(dates) and dates[style]:
                    texts[at], kinds[at] = _date(float(v), since_1904), "d"
                else:
                    texts[at], kinds[at] = v, "i" if re.fullmatch(r"-?\d{1,18}", v) else "n"
            else:
                texts[at], kinds[at] = re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), v), "s"
        row.clear()
        if any(k != "-" for k in kinds):
            yield number, texts, "".join(kinds)


def _named(header: list[str | None]) -> list[str]:
    """Names of columns: an empty one is `Unnamed: k`, a repeated one gets `.1`, `.2`, ..."""
    out: list[str] = []
    for i, h in enumerate(header):
        name, k = (h or "").strip() or f"Unnamed: {i}", 0
        while (name if not k else f"{name}.{k}") in out:
            k += 1
        out.append(name if not k else f"{name}.{k}")
    return out


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The rows of one sheet (the first unless named) of all workbooks at path, under the names in their first row.

    A column is long, double, boolean or timestamp if all its cells are; else text. Empty cells and errors are null, rows
    without any cell are left out, and so are columns beyond the header. Workbooks whose first rows differ, and a sheet
    that is not there, are errors. No workbook, or an empty sheet: no columns.
    """
    prepare(spark)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                found = list(rows_of(content.as_py(), sheet))
                for k in range(0, len(found), 4096):
                    n, texts, kinds = zip(*found[k : k + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(n)), pa.array(n, pa.int64()), pa.array([k + i == 0 for i in range(len(n))]), pa.array(texts, pa.list_(pa.string())), pa.array(kinds)], names=["path", "row", "first", "texts", "kinds"])

    read = spark.read.format("binaryFile").load(path).select("path", "content")
    cells = kept(read.mapInArrow(run, "path string, row long, first boolean, texts array<string>, kinds string"))
    headers = [r[0] for r in cells.filter("first").select("texts").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"workbooks differ in their first rows: {headers}")
    if not headers:
        return spark.createDataFrame([], "struct<>")
    names = _named(headers[0])
    rows = cells.filter(~F.col("first"))
    held = rows.select(F.posexplode(F.split("kinds", ""))).filter("col not in ('-', '')").groupBy("pos").agg(F.collect_set("col").alias("kinds"))
    kinds = {r["pos"]: set(r["kinds"]) for r in held.filter(F.col("pos") < len(names)).collect()}  # a row for each column
    typed = [next((t for k, t in _TYPES if kinds.get(i) == k), "string") for i in range(len(names))]
    at = lambda i, t: F.try_element_at("texts", F.lit(i + 1)).cast(t)
    return rows.select(*[at(i, t).alias(n) for i, (n, t) in enumerate(zip(names, typed, strict=True))])


def _cell(value, at: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    if isinstance(value, datetime):
        days = (value.replace(tzinfo=None) - datetime(1899, 12, 30)) / timedelta(days=1)
        return f'<c r="{at}" s="1"><v>{days!r}</v></c>'
    said = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]|_x[0-9A-Fa-f]{4}_", lambda m: f"_x{ord(m[0][0]):04X}_" + m[0][1:], str(value))
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(said)}</t></is></c>'


def _letters(i: int) -> str:
    return (_letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)


def workbook(names: list[str], rows: list[tuple], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet: the names, then the rows."""
    lines = [f'<row r="{k}">' + "".join(_cell(v, f"{_letters(i)}{k}") for i, v in enumerate(r)) + "</row>" for k, r in enumerate([tuple(names), *rows], 1)]
    head, main = '<?xml version="1.0" encoding="UTF-8"?>', _MAIN[1:-1]
    office = _LINK[1:-3]
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'{head}<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def write_workbooks(df: DataFrame, folder: str, sheet: str = "Sheet1", rows_each: int = 100_000) -> int:
    """df as workbooks of at most rows_each rows below folder, on any file system; how many. Made by tasks; the driver
    passes them on one at a time, as Spark has no sink for bytes."""
    if not 0 < rows_each < 1 << 20:
        raise ValueError("a sheet has at most 1048576 rows")
    prepare(df.sparkSession)
    names, columns = df.columns, [f"c{i}" for i in range(len(df.columns))]

    def run(batches):
        held: list[tuple] = []

        def book(rows):
            return pa.RecordBatch.from_arrays([pa.array([workbook(names, rows, sheet)], pa.binary())], names=["content"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= rows_each:
                yield book(held[:rows_each])
                held = held[rows_each:]
        if held:
            yield book(held)

    n = 0
    for r in df.toDF(*columns).mapInArrow(run, "content binary").toLocalIterator():
        fs, p = _fs(df.sparkSession, f"{folder}/part-{n:05d}.xlsx")
        out = fs.create(p, True)
        out.write(bytearray(r[0]))
        out.close()
        n += 1
    return n
