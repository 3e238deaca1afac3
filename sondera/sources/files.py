"""File sources: notes, tables in several encodings, workbooks; and a workbook writer."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("md", "csv", "xlsx", "xls")
ENCODINGS = ("utf-8", "gbk")
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def scan(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """path, dir_name, suffix, content (bytes) of eligible files, found recursively; ``limit`` keeps the first by path (0 or None: all)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    out = files.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("dir_name"), suffix.alias("suffix"), "content").filter(suffix.isin(*SUFFIXES))
    return out.orderBy("path").limit(limit) if limit else out


def notes(files: DataFrame) -> DataFrame:
    """Text of the Markdown files; content is null where it is not UTF-8."""
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return files.filter(F.col("suffix") == "md").select("path", "dir_name", text.alias("content"))


def read_table(content: bytes) -> pd.DataFrame:
    """A CSV in the first encoding that fits; otherwise no rows."""
    for encoding in ENCODINGS:
        try:
            return pd.read_csv(io.StringIO(content.decode(encoding)), dtype=str)
        except (UnicodeDecodeError, ValueError):
            continue
    return pd.DataFrame()


def read_workbook(content: bytes) -> pd.DataFrame:
    """The first sheet of an XLSX file, first row as header; anything else has no rows."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = z.namelist()
            shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in s.iter(f"{_NS}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
            sheet = ElementTree.fromstring(z.read(min(n for n in names if n.startswith("xl/worksheets/sheet"))))
    except (zipfile.BadZipFile, ElementTree.ParseError, ValueError):
        return pd.DataFrame()
    rows = []
    for r in sheet.iter(f"{_NS}row"):
        cells: dict[int, str] = {}
        for c in r.iter(f"{_NS}c"):
            letters = re.match("[A-Z]+", c.get("r", "A"))[0]
            at = 0
            for x in letters:
                at = at * 26 + ord(x) - 64
            value, inline = c.find(f"{_NS}v"), "".join(t.text or "" for t in c.iter(f"{_NS}t"))
            text = inline or (value.text if value is not None else None)
            cells[at - 1] = shared[int(text)] if c.get("t") == "s" and text is not None else text
        rows.append(cells)
    if not rows:
        return pd.DataFrame()
    width = max(max(r, default=-1) for r in rows) + 1
    grid = [[r.get(i) for i in range(width)] for r in rows]
    return pd.DataFrame(grid[1:], columns=[str(x) for x in grid[0]])


def table_rows(files: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """path, suffix, row_index and one string column per synonym that any of ``fields`` names, for CSV and workbook files."""
    names = list(dict.fromkeys(n for group in fields.values() for n in group))
    schema = "path string, suffix string, row_index long, " + ", ".join(f"`{n}` string" for n in names)

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                found = read_table(r.content) if r.suffix == "csv" else read_workbook(r.content)
                out = found.reindex(columns=names).astype(object)
                out = out.where(out.notna(), None)
                out.insert(0, "row_index", range(len(out)))
                out.insert(0, "suffix", r.suffix)
                out.insert(0, "path", r.path)
                yield out

    return files.filter(F.col("suffix").isin("csv", "xlsx", "xls")).select("path", "suffix", "content").mapInPandas(run, schema)


def write_workbook(sheets: dict[str, pd.DataFrame], path: str) -> None:
    """A plain XLSX file with inline strings. Sheets are report-sized and already collected."""
    column = lambda i: (column(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    def sheet(df: pd.DataFrame) -> str:
        grid = [list(df.columns), *df.itertuples(index=False, name=None)]
        rows = "".join(
            f'<row r="{n}">' + "".join(f'<c r="{column(i)}{n}" t="inlineStr"><is><t>{escape("" if v is None else str(v))}</t></is></c>' for i, v in enumerate(values)) + "</row>"
            for n, values in enumerate(grid, 1)
        )
        return f'<worksheet xmlns="{_NS[1:-1]}"><sheetData>{rows}</sheetData></worksheet>'

    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    numbers = range(1, len(sheets) + 1)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{kinds}.worksheet+xml"/>' for n in numbers)
        z.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>{overrides}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(name[:31])}" sheetId="{n}" r:id="r{n}"/>' for n, name in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS[1:-1]}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="r{n}" Type="{rel}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in numbers) + "</Relationships>")
        for n, df in zip(numbers, sheets.values(), strict=True):
            z.writestr(f"xl/worksheets/sheet{n}.xml", sheet(df))
