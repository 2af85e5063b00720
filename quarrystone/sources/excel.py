"""Excel workbooks as a distributed ingest: one workbook per task, cells out as rows."""

from __future__ import annotations

import datetime
import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ref, require
from ..plans.scratch import written
from .files import MISSING_TEXTS, _inferred, _names_in_order, validate_exists

# Executors need no copy of the package to parse workbooks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_ROWS = "path string, sheet_no int, sheet string, row_no int, cells array<string>"
# Namespaces of the workbook format and its built-in date formats.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def column_number(letters: str) -> int:
    """0-based column of a reference such as ``A`` or ``BC``."""
    place = 0
    for letter in letters.upper():
        place = place * 26 + ord(letter) - ord("A") + 1
    return place - 1


def _texts(root) -> str:
    return "".join(t.text or "" for t in root.iter(f"{MAIN}t"))


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    if "xl/styles.xml" not in book.namelist():
        return []
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId")): bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode").lower())))
        for f in styles.iter(f"{MAIN}numFmt")
    }
    formats = styles.find(f"{MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
    return [custom.get(i, i in DATE_FORMATS) for i in ids]


def _date_text(serial: str, epoch: datetime.datetime) -> str:
    moment = epoch + datetime.timedelta(milliseconds=round(float(serial) * 86_400_000))
    return moment.isoformat(sep=" ")


def workbook_rows(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """``(sheet number, sheet name, row number, cells)`` of one ``.xlsx`` file."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        layout = ElementTree.fromstring(book.read("xl/workbook.xml"))
        targets = {
            r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/")
            for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        }
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_texts(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        dates = _date_styles(book)
        properties = layout.find(f"{MAIN}workbookPr")
        late = properties is not None and properties.get("date1904") in ("1", "true")
        epoch = datetime.datetime(1904, 1, 1) if late else datetime.datetime(1899, 12, 30)

        def text(cell) -> str | None:
            kind, found = cell.get("t", "n"), cell.find(f"{MAIN}v")
            if kind == "inlineStr":
                return _texts(cell)
            if found is None or found.text is None or kind == "e":
                return None
            if kind == "s":
                return shared[int(found.text)]
            if kind == "b":
                return "True" if found.text == "1" else "False"
            style = int(cell.get("s", 0))
            if kind == "n" and style < len(dates) and dates[style]:
                return _date_text(found.text, epoch)
            return found.text

        for number, sheet in enumerate(layout.iter(f"{MAIN}sheet")):
            with book.open(f"xl/{targets[sheet.get(RELATION)]}") as stream:
                at = -1
                for _, row in ElementTree.iterparse(stream):
                    if row.tag != f"{MAIN}row":
                        continue
                    at = int(row.get("r", at + 2)) - 1
                    cells: list[str | None] = []
                    for cell in row.iter(f"{MAIN}c"):
                        name = re.match(r"[A-Za-z]+", cell.get("r", ""))
                        place = column_number(name.group()) if name else len(cells)
                        cells += [None] * (place - len(cells)) + [text(cell)]
                    yield number, sheet.get("name"), at, cells
                    row.clear()


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "sheet_no", "sheet", "row_no", "cells"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = []
            for row in workbook_rows(content):
                rows.append((path, *row))
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)


def read_workbooks(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Every row of every sheet of every workbook under ``path``: the long form of an ingest.

    Workbooks that already are in a table, such as attachments or downloads, are given as that table, with the columns
    ``path`` (any name, one a workbook) and ``content``; rows without content are left out.
    """
    if isinstance(path, DataFrame):
        require(path, ("path", "content"))
        return path.select("path", "content").where("content is not null").mapInPandas(_parse, CELL_ROWS)
    validate_exists(spark, path)
    if str(path).lower().endswith(".xls"):
        raise ValueError("Legacy .xls workbooks are not supported; save them as .xlsx")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_parse, CELL_ROWS)


def _headings(cells: Column) -> Column:
    """Names of one header row: empty ones by place, repeated ones numbered."""
    named = F.transform(cells, lambda c, i: F.coalesce(c, F.concat(F.lit("Unnamed: "), i.cast("string"))))

    def numbered(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(named, F.lit(1), i), lambda other: other == name))
        return F.when(before == 0, name).otherwise(F.concat(name, F.lit("."), before.cast("string")))

    return F.transform(named, numbered)


def _sheet_table(rows: DataFrame, header: int | None, usecols, parse_dates) -> DataFrame:
    if header is None:
        width = rows.agg(F.max(F.size("cells"))).first()[0] or 0
        names: list[str] = [str(i) for i in range(width)]
        body = rows
    else:
        # Every workbook has its own header; a name is one column wherever it stands.
        heads = written(rows.where(F.col("row_no") == header).select("path", _headings(F.col("cells")).alias("names")))
        places = heads.select(F.posexplode("names").alias("place", "name"))
        names = _names_in_order(places)
        if not names:
            raise ValueError(f"No header at row {header}")
        body = rows.where(F.col("row_no") > header).join(heads, "path")
        at = lambda n: F.get("cells", F.array_position("names", F.lit(n)).cast("int") - 1)
        body = body.select(F.array(*[at(n) for n in names]).alias("cells"))
    texts = body.select(
        *[
            F.when(~F.get("cells", F.lit(i)).isin(*MISSING_TEXTS), F.get("cells", F.lit(i))).alias(n)
            for i, n in enumerate(names)
        ]
    )
    texts = texts.where(F.coalesce(*[ref(c) for c in texts.columns]).isNotNull())
    if isinstance(usecols, str):
        chosen: list[str] = []
        for part in usecols.split(","):
            first, _, last = part.strip().partition(":")
            span = range(column_number(first), column_number(last or first) + 1)
            chosen += [names[i] for i in span if i < len(names)]
        usecols = chosen
    if usecols is not None:
        wanted = set(require(texts, usecols))
        texts = texts.select(*[ref(c) for c in names if c in wanted])
    dates = set(require(texts, parse_dates))
    kinds = _inferred(texts, [c for c in texts.columns if c not in dates])
    return texts.select(
        *[ref(c).try_cast("timestamp_ntz" if c in dates else kinds[c]).alias(c) for c in texts.columns]
    )


def load_excel(
    spark: SparkSession,
    path: str | DataFrame,
    *,
    sheet_name: str | int = 0,
    header: int | None = 0,
    usecols: str | Sequence[str] | None = None,
    parse_dates: Sequence[str] | None = None,
) -> DataFrame:
    """One sheet, by name or 0-based place, of a workbook or of many, whose columns meet by name.

    ``path`` may be a table of workbooks, as in :func:`read_workbooks`.

    ``usecols`` is a list of names or letters such as ``"A:C,F"``.
    """
    rows = written(read_workbooks(spark, path))
    key = "sheet_no" if isinstance(sheet_name, int) else "sheet"
    return _sheet_table(rows.where(F.col(key) == F.lit(sheet_name)), header, usecols, parse_dates)


def load_excel_all_sheets(spark: SparkSession, path: str | DataFrame) -> dict[str, DataFrame]:
    """Every sheet by name."""
    rows = written(read_workbooks(spark, path))
    sheets = rows.groupBy("sheet").agg(F.min("sheet_no").alias("place")).orderBy("place", "sheet").collect()
    return {s["sheet"]: _sheet_table(rows.where(F.col("sheet") == s["sheet"]), 0, None, None) for s in sheets}
