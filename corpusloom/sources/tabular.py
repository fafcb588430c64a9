"""Spreadsheets, SQLite databases and JSON files as narrated sections."""

from __future__ import annotations

import json
import re
import sqlite3
import zipfile
from collections.abc import Callable
from datetime import date, timedelta
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import full_clean, is_meaningful
from corpusloom.operators.narrate import canonical_names, describe_frame, describe_records, describe_table, drop_empty, narrate

POS = "__pos"
SECTION = "section_order string, title string, text string, num_exercises long, part string, content_type string"


def _with_pos(df: DataFrame) -> DataFrame:
    """Row order of a file: ids grow with the splits of one file in order."""
    return df.withColumn(POS, F.monotonically_increasing_id())


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    suffix = Path(path).suffix.lower()
    if suffix not in (".csv", ".tsv"):
        raise ValueError(f"unsupported file type: {suffix}")
    sep = "\t" if suffix == ".tsv" else ","
    quotes = spark.read.text(path).filter((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).limit(1).count()
    # a line that leaves a quote open continues on the next; only then must one task read a whole file
    return spark.read.csv(path, header=True, inferSchema=True, sep=sep, multiLine=bool(quotes))


#: Numbers of the built-in cell formats that show dates or times; fixed values.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def is_date_format(code: str) -> bool:
    """Whether a cell format shows a date or time: a letter for one outside quotes, escapes and brackets."""
    plain = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|_.|\*.', "", code.split(";")[0])
    return bool(re.search("[ymdhs]", plain, re.IGNORECASE)) and "general" not in plain.lower()


def date_text(serial: float, from_1904: bool) -> str:
    """A workbook's day number as date, date and time, or time of day. The first epoch counts a day that never was."""
    days, seconds = divmod(round(serial * 86_400), 86_400)
    time = str(timedelta(seconds=seconds)).zfill(8)
    if not days:
        return time
    epoch = date(1904, 1, 1) if from_1904 else date(1899, 12, 30) if days > 60 else date(1899, 12, 31)
    day = (epoch + timedelta(days=days)).isoformat()
    return f"{day} {time}" if seconds else day


def date_styles(book: zipfile.ZipFile) -> set[int]:
    """Which cell styles of a workbook show dates or times."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    name = lambda e: e.tag.rpartition("}")[2]
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(e.attrib["numFmtId"]): e.attrib.get("formatCode", "") for e in root.iter() if name(e) == "numFmt"}
    formats = [int(x.attrib.get("numFmtId", 0)) for e in root if name(e) == "cellXfs" for x in e if name(x) == "xf"]
    return {i for i, f in enumerate(formats) if (is_date_format(own[f]) if f in own else f in DATE_FORMATS)}


def _cell(text: str | None, kind: str | None, shared: list[str]):
    if text is None:
        return None
    if kind == "s":
        return shared[int(text)]
    if kind in ("str", "inlineStr"):
        return text
    if kind == "b":
        return text == "1"
    number = float(text)
    return int(number) if number.is_integer() else number


def xlsx_sheets(path: str) -> dict[str, list[list]]:
    """Sheet name -> rows of cell values; the first row holds the names. Workbooks are read on the driver."""
    name = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter() if name(t) == "t") for si in root if name(si) == "si"]
        links = {e.attrib["Id"]: e.attrib["Target"] for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        out, dated = {}, date_styles(book)
        workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
        from_1904 = any(e.attrib.get("date1904") in ("1", "true") for e in workbook.iter() if name(e) == "workbookPr")
        for sheet in (e for e in workbook.iter() if name(e) == "sheet"):
            target = links[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
            rows = []
            for row in (e for e in ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}")).iter() if name(e) == "row"):
                cells: dict[int, object] = {}
                for c in (e for e in row if name(e) == "c"):
                    letters = re.match("[A-Z]+", c.attrib.get("r", "")) or re.match("[A-Z]+", "A")
                    at = 0
                    for ch in letters[0]:
                        at = at * 26 + ord(ch) - 64
                    value = next((e.text for e in c if name(e) == "v"), None)
                    if c.attrib.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter() if name(t) == "t")
                    cell = _cell(value, c.attrib.get("t"), shared)
                    if int(c.attrib.get("s", 0)) in dated and isinstance(cell, (int, float)) and not isinstance(cell, bool):
                        cell = date_text(cell, from_1904)
                    cells[at - 1] = cell
                rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
            out[sheet.attrib["name"]] = rows
    return out


def frame(spark: SparkSession, names: list[str], rows: list[list]) -> DataFrame:
    """A table of string, long or double columns from driver rows, with POS."""
    width = len(names)
    rows = [(list(r) + [None] * width)[:width] for r in rows]
    kinds = []
    for i in range(width):
        values = [r[i] for r in rows if r[i] is not None]
        if values and all(isinstance(v, int) and not isinstance(v, bool) for v in values):
            kinds.append(("long", int))
        elif values and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values):
            kinds.append(("double", float))
        else:
            kinds.append(("string", str))
    data = [(n, *[None if v is None else kinds[i][1](v) for i, v in enumerate(r)]) for n, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join([f"{POS} long", *[f"`{c}` {k}" for c, (k, _) in zip(names, kinds, strict=True)]]))


def narrated(df: DataFrame, part: str | None, describe, title: str) -> DataFrame:
    """Narrated sections of a table with POS, or its description where narration gives none (dates all null)."""
    rest = df.drop(POS)
    dates = [c for c, n in canonical_names(rest.columns).items() if n == "date"]
    part_col = F.lit(part).cast("string").alias("part")
    if not dates or df.filter(F.col(f"`{dates[0]}`").isNotNull()).limit(1).count():
        made = narrate(df, POS)
        return made.select(F.col("date").alias("section_order"), "title", "text", "num_exercises", part_col, F.lit("tabular").alias("content_type"))
    if describe is None:
        return df.sparkSession.createDataFrame([], SECTION)
    made = describe(df, POS).filter(is_meaningful(F.col("text"), 5))
    return made.select(F.lit("").alias("section_order"), F.lit(title).alias("title"), "text", F.lit(None).cast("long").alias("num_exercises"), part_col, F.lit("tabular").alias("content_type"))


def spreadsheet_sections(spark: SparkSession, path: str, sheet: int | str | None = 0, xls_reader: Callable[[str], dict[str, list[list]]] | None = None) -> DataFrame:
    """Sections of a CSV, TSV or XLSX file; `sheet` None takes all sheets, each named in `part`.

    Old binary workbooks (.xls) need a plugged-in reader: path -> sheet name -> rows of cell values.
    """
    stem, suffix = Path(path).stem, Path(path).suffix.lower()
    if suffix == ".xls" and xls_reader is None:
        raise ValueError("unsupported file type: .xls without a reader for it")
    if suffix in (".xlsx", ".xls"):
        sheets = xlsx_sheets(path) if suffix == ".xlsx" else xls_reader(path)
        chosen = list(sheets) if sheet is None else [sheet if isinstance(sheet, str) else list(sheets)[sheet]]
        tables = [(name if sheet is None else None, frame(spark, [str(c) for c in sheets[name][0]], sheets[name][1:])) for name in chosen if sheets[name]]
    else:
        tables = [(None, _with_pos(read_delimited(spark, path)))]
    out = spark.createDataFrame([], SECTION)
    for part, df in tables:
        if df.limit(1).count():
            out = out.unionByName(narrated(drop_empty(df, (POS,)), part, describe_frame, stem))
    return out


def sqlite_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sections of every table of a SQLite file, a driver-side file format; `part` names the table."""
    out = spark.createDataFrame([], SECTION)
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        for (table,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'").fetchall():
            quoted = table.replace('"', '""')
            cursor = db.execute(f'SELECT * FROM "{quoted}"')
            rows = cursor.fetchall()
            if rows:
                df = frame(spark, [c[0] for c in cursor.description], [list(r) for r in rows])
                out = out.unionByName(narrated(df, table, lambda d, pos, t=table: describe_table(d, pos, t), f"Table: {table}"))
    return out


def json_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sections of a JSON file: a list of records, or an object of record lists and texts (`part` names the key)."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    out = spark.createDataFrame([], SECTION)

    def table(records: list[dict]) -> DataFrame:
        names = list(dict.fromkeys(k for r in records for k in r))
        return frame(spark, names, [[r.get(c) for c in names] for r in records])

    if isinstance(data, list):
        return out.unionByName(narrated(table(data), None, describe_records, Path(path).stem)) if data else out
    for key, value in data.items():
        if isinstance(value, list) and value and isinstance(value[0], dict):
            out = out.unionByName(narrated(table(value), key, None, key))
        elif isinstance(value, str):
            text = spark.createDataFrame([(key, value)], "part string, raw string").filter(is_meaningful(F.col("raw")))
            out = out.unionByName(text.select(F.lit("").alias("section_order"), F.col("part").alias("title"), full_clean(F.col("raw")).alias("text"), F.lit(None).cast("long").alias("num_exercises"), "part", F.lit("prose").alias("content_type")))
    return out


def database_sections(spark: SparkSession, path: str) -> DataFrame:
    suffix = Path(path).suffix.lower()
    if suffix in (".sqlite", ".db", ".sqlite3"):
        return sqlite_sections(spark, path)
    if suffix == ".json":
        return json_sections(spark, path)
    raise ValueError(f"unsupported database type: {suffix}")
