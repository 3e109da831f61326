"""Excel workbooks as a data source and a sink, with the standard library only."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_name(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def read_rows(data: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as text; cells that are left out are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        sheet = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))[0]
        for row in ElementTree.fromstring(z.read(sheet)).iter(f"{MAIN}row"):
            out: list[str | None] = []
            for cell in row.iter(f"{MAIN}c"):
                at = column_number(cell.get("r")) if cell.get("r") else len(out)
                out += [None] * (at - len(out))
                v, kind = cell.find(f"{MAIN}v"), cell.get("t")
                if kind == "inlineStr":
                    out.append("".join(t.text or "" for t in cell.iter(f"{MAIN}t")))
                else:
                    out.append(None if v is None else shared[int(v.text)] if kind == "s" else v.text)
            yield out


def workbook(header: list[str], rows: list[list], links: dict[int, str] | None = None) -> bytes:
    """A workbook of one sheet with inline strings; links: targets by number of the row, from 1, for the cells of the second column.

    Control characters that XML has no place for become blanks."""
    clean = lambda x: escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", str(x)))
    lines = []
    for r, row in enumerate([header, *rows], 1):
        cells = "".join(f'<c r="{column_name(k)}{r}" t="inlineStr"><is><t xml:space="preserve">{clean(x)}</t></is></c>' for k, x in enumerate(row) if x is not None)
        lines.append(f'<row r="{r}">{cells}</row>')
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    files = {
        "[Content_Types].xml": f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook {space} xmlns:r="{rel}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet {space}><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    if links:
        marks = "".join(f'<hyperlink ref="B{n + 1}" r:id="rId{n}"/>' for n in links)
        files["xl/worksheets/sheet1.xml"] = f'{head}<worksheet {space} xmlns:r="{rel}"><sheetData>{"".join(lines)}</sheetData><hyperlinks>{marks}</hyperlinks></worksheet>'
        targets = "".join(f'<Relationship Id="rId{n}" Type="{rel}/hyperlink" Target={quoteattr(url)} TargetMode="External"/>' for n, url in links.items())
        files["xl/worksheets/_rels/sheet1.xml.rels"] = f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), body, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def read_links(data: bytes) -> list[str]:
    """Targets of the hyperlinks of the first sheet, in order of their rows."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if "xl/worksheets/_rels/sheet1.xml.rels" not in z.namelist():
            return []
        target = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/worksheets/_rels/sheet1.xml.rels"))}
        return [target[x.get(RELATION_ID)] for x in ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter(f"{MAIN}hyperlink")]


def read_excel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Workbooks under path, by header; columns that a workbook lacks are null. Files come through Spark's own reader, so any store will do."""
    names = schema.fieldNames()

    def run(frames):
        import pandas as pd

        for f in frames:
            found = []
            for data in f["content"]:
                rows = read_rows(bytes(data))
                header = [(x or "").strip() for x in next(rows, [])]
                for row in rows:
                    held = dict(zip(header, row))
                    found.append([held.get(n) for n in names])
            yield pd.DataFrame(found, columns=names, dtype=object)

    text = ", ".join(f"`{n}` string" for n in names)
    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, text)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.dataType != T.StringType() else F.col(f.name) for f in schema.fields])
