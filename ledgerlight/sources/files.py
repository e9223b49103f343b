"""Raw files as DataFrames: ragged delimited text, archives of parts, spreadsheets, metadata.

Every reader goes through Spark's binaryFile source, so any Hadoop file system works and files spread over tasks; only the
format itself is read in Python, in Arrow batches. A file is read whole by one task.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

csv.field_size_limit(1 << 30)


def raw_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, content) of a folder's files; file is the name without its folder."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def area_of(file: Column) -> Column:
    """A file's name without its extension: the code of its area."""
    return F.regexp_extract(file, r"^(.+)\.[^.]+$", 1)


def delimited_rows(files: DataFrame) -> DataFrame:
    """(file, line, cols) of headerless delimited text with any number of columns per row, blank rows included.

    UTF-8 with or without a byte order mark; bad bytes become U+FFFD; quotes may hold separators and line ends. line
    counts rows from 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = content.as_py().decode("utf-8-sig", errors="replace")
                lines, cols = [], []
                for line, row in enumerate(csv.reader(io.StringIO(text, newline="")), 1):
                    lines.append(line)
                    cols.append(row)
                    if len(lines) == 10_000:
                        yield _rows(file, lines, cols)
                        lines, cols = [], []
                yield _rows(file, lines, cols)

    def _rows(file: str, lines: list[int], cols: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file] * len(lines), pa.string()), pa.array(lines, pa.int64()), pa.array(cols, pa.list_(pa.string()))], ["file", "line", "cols"])

    return files.mapInArrow(run, "file string, line long, cols array<string>")


def archive_members(files: DataFrame, pattern: str = r".*") -> DataFrame:
    """(file, member, content) of the members of zip archives whose whole name fits the pattern."""
    wanted = re.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    for member in sorted(archive.namelist()):
                        if wanted.fullmatch(member):
                            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([member]), pa.array([archive.read(member)], pa.binary())], ["file", "member", "content"])

    return files.mapInArrow(run, "file string, member string, content binary")


def member_part(member: Column) -> Column:
    """Part id in a member's name ``part<id>.<ext>``; '' where there is none."""
    return F.regexp_extract(member, r"^part(\w+)\.\w+$", 1)


def member_number(member: Column) -> Column:
    """First run of digits of a member's base name; null where there is none."""
    return F.nullif(F.regexp_extract(F.regexp_extract(member, r"([^/]*)$", 1), r"(\d+)", 1), F.lit("")).try_cast("int")


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def spreadsheet_rows(files: DataFrame) -> DataFrame:
    """(file, row, cells) of the first sheet of xlsx files, as text; row counts from 1, missing cells are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers, cells = [], []
                for number, row in _sheet(content.as_py()):
                    numbers.append(number)
                    cells.append(row)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(numbers), pa.string()), pa.array(numbers, pa.int64()), pa.array(cells, pa.list_(pa.string()))], ["file", "row", "cells"])

    return files.mapInArrow(run, "file string, row long, cells array<string>")


def _sheet(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{_SHEET}t")))
        sheet = sorted(n for n in names if n.startswith("xl/worksheets/sheet"))[0]
        for i, row in enumerate(ElementTree.fromstring(book.read(sheet)).iter(f"{_SHEET}row"), 1):
            cells: list[str | None] = []
            for cell in row.iter(f"{_SHEET}c"):
                at = _column(cell.get("r") or "") if cell.get("r") else len(cells)
                cells += [None] * (at - len(cells))
                value, kind = cell.find(f"{_SHEET}v"), cell.get("t")
                if kind == "inlineStr":
                    cells.append("".join(t.text or "" for t in cell.iter(f"{_SHEET}t")))
                else:
                    text = value.text if value is not None else None
                    cells.append(shared[int(text)] if kind == "s" and text else text)
            yield int(row.get("r") or i), cells


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def constituencies(spark: SparkSession, path: str) -> DataFrame:
    """(ac_code, ac_name, district, total_parts, extra) of a JSON list of areas; other fields go to extra as text."""
    raw = spark.read.option("multiLine", True).json(path)
    own = ["ac_code", "ac_name", "district", "total_parts"]
    other = [c for c in raw.columns if c not in own]
    as_text = lambda c: F.to_json(c) if raw.schema[c].dataType.typeName() in ("array", "struct") else F.col(c).cast("string")
    extra = F.map_from_arrays(F.array(*[F.lit(c) for c in other]), F.array(*[as_text(c) for c in other])) if other else F.create_map().cast("map<string,string>")
    parts = F.col("total_parts").cast("int") if "total_parts" in raw.columns else F.lit(0)
    return raw.select("ac_code", "ac_name", "district", F.coalesce(parts, F.lit(0)).alias("total_parts"), extra.alias("extra"))


def roll_years(spark: SparkSession, path: str) -> DataFrame:
    """(code, roll_year, source, format) of a JSON object keyed by state code."""
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,struct<state:string,roll_year:int,source:string,format:string>>")
    return text.select(F.explode(parsed).alias("code", "v")).select("code", "v.state", "v.roll_year", "v.source", "v.format")
