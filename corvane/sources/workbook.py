"""Workbooks (XLSX) as tables, with nothing but the standard library.

A workbook is one file with a million rows at most, so one task reads it and the
driver writes it; larger tables belong in CSV or Parquet. Cells are text: numbers
as they stand in the file, and the blank cell as the empty text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.phrases import squeeze

#: Rows of a sheet, its header included.
ROWS = 1_048_576
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheets(raw: bytes) -> dict[str, str]:
    """Names of a workbook's sheets, in order, and the part that holds each."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = {x.get("Id"): x.get("Target") for x in links}
        found = ElementTree.fromstring(book.read("xl/workbook.xml")).iterfind("m:sheets/m:sheet", _NS)
        return {x.get("name"): "xl/" + target[x.get(_REL)].removeprefix("/xl/") for x in found}


def cells(raw: bytes, part: str) -> Iterator[list[str]]:
    """Rows of a sheet as texts, short rows as they are."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            strings = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in x.iterfind(".//m:t", _NS)) for x in strings.iterfind("m:si", _NS)]
        with book.open(part) as file:
            for _, row in ElementTree.iterparse(file):
                if not row.tag.endswith("}row"):
                    continue
                out: list[str] = []
                for at, c in enumerate(row.iterfind("m:c", _NS)):
                    at = _column(c.get("r")) if c.get("r") else at
                    value = c.find("m:v", _NS)
                    text = (value.text or "") if value is not None else "".join(t.text or "" for t in c.iterfind(".//m:t", _NS))
                    out += [""] * (at + 1 - len(out))
                    out[at] = shared[int(text)] if c.get("t") == "s" and text else text
                yield out
                row.clear()


def pick(names: list[str], preferred: str = "Results") -> str:
    """The preferred sheet, whatever its case, else the first."""
    return next((n for n in names if n.strip().lower() == preferred.lower()), names[0])


def read(spark: SparkSession, path: str, sheet: str = "Results") -> DataFrame:
    """A sheet as a table of texts: headers and cells cleaned, rows without any cell left out, ``seq`` the row's place.

    Where there is no such sheet the first one is read.
    """
    content = spark.read.format("binaryFile").load(path).select("content")
    head = content.select(F.udf(lambda raw: _head(bytes(raw), sheet), "array<string>")("content").alias("h")).first()["h"]
    table = F.udf(lambda raw: _body(bytes(raw), sheet, len(head)), "array<array<string>>")
    rows = content.select(F.posexplode(table("content")).alias("seq", "row"))
    found = rows.select(*(F.col("row")[i].alias(n) for i, n in enumerate(head)), F.col("seq").cast("long").alias("_seq"))
    filled = F.concat(*(F.col(f"`{c}`") for c in head)) != ""
    return found.where(filled).withColumnRenamed("_seq", "seq")


def _head(raw: bytes, sheet: str) -> list[str]:
    names = sheets(raw)
    return [squeeze(x) for x in next(cells(raw, names[pick(list(names), sheet)]), [])]


def _body(raw: bytes, sheet: str, width: int) -> list[list[str]]:
    names = sheets(raw)
    rows = cells(raw, names[pick(list(names), sheet)])
    next(rows, None)
    return [[squeeze(x) for x in (r + [""] * width)[:width]] for r in rows]


def resolve(columns: list[str], aliases: dict[str, list[str]], optional: tuple[str, ...] = ()) -> dict[str, str]:
    """The column that stands for each need, by its letters and digits; an error names what is missing."""

    def key(name: str) -> str:
        return re.sub("[^a-z0-9]+", "", name.lower())

    plain = {key(c): c for c in reversed(columns)}
    found = {need: next((plain[key(a)] for a in names if key(a) in plain), None) for need, names in aliases.items()}
    if missing := [n for n, c in found.items() if c is None and n not in optional]:
        raise ValueError("missing columns: " + ", ".join(missing))
    return {n: c for n, c in found.items() if c}


def write(path: str, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Writes one sheet for each table, its header in bold; the number of rows of each. Too many rows raise an error.

    The driver streams the rows, so it holds a partition of them at a time.
    """
    counts: dict[str, int] = {}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for k, (name, df) in enumerate(tables.items(), 1):
            with book.open(f"xl/worksheets/sheet{k}.xml", "w") as part:
                part.write(f'<worksheet xmlns="{_NS["m"]}"><sheetData>'.encode())
                part.write(_row(df.columns, 1))
                n = 0
                for row in df.toLocalIterator():
                    n += 1
                    if n >= ROWS:
                        raise ValueError(f"{name}: a sheet holds {ROWS - 1} rows")
                    part.write(_row(row))
                part.write(b"</sheetData></worksheet>")
            counts[name] = n
        for part, text in _frame(list(tables)).items():
            book.writestr(part, text)
    return counts


def _row(values, style: int = 0) -> bytes:
    def cell(v) -> str:
        if v is None or v == "":
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        text = escape(_ILLEGAL.sub("", str(v)))
        return f'<c t="inlineStr" s="{style}"><is><t xml:space="preserve">{text}</t></is></c>'

    return ("<row>" + "".join(map(cell, values)) + "</row>").encode()


def _frame(names: list[str]) -> dict[str, str]:
    """The parts around the sheets."""
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    n = range(1, len(names) + 1)
    types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kinds}.worksheet+xml"/>' for i in n)
    links = "".join(f'<Relationship Id="r{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
    listed = "".join(f'<sheet name={quoteattr(x[:31])} sheetId="{i}" r:id="r{i}"/>' for i, x in zip(n, names))
    return {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{kinds}.styles+xml"/>{types}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}<Relationship Id="styles" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>',
        "xl/styles.xml": f'<styleSheet xmlns="{_NS["m"]}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
        '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
    }
