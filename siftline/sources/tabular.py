"""Raw tables: discovery, format by content, header aliases and workbooks, on any storage that Spark reads."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.sources.listing import files, qualified

SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
# Header spellings of each field, first match wins.
ALIASES = {
    "compound_id": ["TSID", "HITId", "HitId", "ID"],
    "cas": ["CAS", "cas"],
    "name": ["name", "Name"],
    "original_mol_weight": ["Mol Weight", "MolWeight", "MW"],
    "original_formula": ["Formula"],
    "original_smiles": ["SMILES", "Smiles", "Smile", "smiles"],
}


def discover(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    """The active file and the candidate files below a folder: the only file with "2w" in its name is active, else the
    only XLSX file. Candidates come in path order and there must be one."""
    listed = [r["path"] for r in files(spark, folder).where(F.lower("path").rlike(r"\.(csv|xlsx)$")).select("path").collect()]  # source files
    paths = sorted(listed, key=lambda p: PurePosixPath(p).parts)
    named = [p for p in paths if "2w" in PurePosixPath(p).name.lower()]
    active = named or [p for p in paths if p.lower().endswith(".xlsx")]
    if len(active) != 1:
        raise ValueError(f"exactly one active file is needed, found {len(active)}")
    rest = [p for p in paths if p != active[0]]
    if not rest:
        raise ValueError("no candidate file")
    return active[0], rest


def is_xlsx(spark: SparkSession, path: str) -> bool:
    """By the first bytes, whatever the name."""
    first = spark.read.text(path).limit(1).collect()
    return bool(first) and first[0]["value"].startswith("PK")


def _cell_text(cell: ET.Element, shared: list[str]) -> str:
    kind = cell.get("t", "")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
    value = cell.findtext(f"{SHEET}v") or ""
    return shared[int(value)] if kind == "s" and value else value


def xlsx_rows(data: bytes) -> Iterator[tuple[str, dict[str, str]]]:
    """(sheet row id, header -> text) of the first worksheet by name; its first row with cells is the header."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in root.iter(f"{SHEET}si")]
        sheets = sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        if not sheets:
            raise ValueError("no worksheet")
        header: dict[str, str] = {}
        with book.open(sheets[0]) as sheet:
            for _, row in ET.iterparse(sheet):
                if row.tag != f"{SHEET}row":
                    continue
                cells = {m[0]: _cell_text(c, shared) for c in row.iter(f"{SHEET}c") if (m := re.match("[A-Z]+", c.get("r", "")))}
                if header:
                    yield row.get("r", ""), {header[k]: v for k, v in cells.items() if k in header}
                else:
                    header = cells
                row.clear()


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """file, source_row, fields (map) of workbooks, a task per workbook: it is one compressed stream, and its format ends
    at 1,048,576 rows. Rows are handed on while the sheet is read."""

    def rows(batches):
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"], strict=True):
                held: list[tuple] = []
                for row, fields in xlsx_rows(data):
                    held.append((file, row, fields))
                    if len(held) == 1000:
                        yield pd.DataFrame(held, columns=["file", "source_row", "fields"])
                        held = []
                yield pd.DataFrame(held, columns=["file", "source_row", "fields"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, "file string, source_row string, fields map<string,string>")


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, and source_row: 2 for the first row behind the header. Rows are numbered by a single read
    of one file; a multi-line CSV file is one partition in any case."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False, mode="PERMISSIVE")
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.withColumn("source_row", (F.monotonically_increasing_id() + 2).cast("string"))


def _plain(name: str) -> str:
    return name.strip().lower().replace(" ", "")


def aliased(df: DataFrame, file: str, pool: str, source_index: int) -> DataFrame:
    """The nine raw fields of a table: each from the first alias that is a column, whatever its letter case and spaces,
    even where its value is blank."""
    have = {_plain(c): c for c in df.columns}
    fields = []
    for out, names in ALIASES.items():
        hit = next((have[_plain(n)] for n in names if _plain(n) in have), None)
        fields.append((F.trim(F.coalesce(F.col(f"`{hit}`"), F.lit(""))) if hit else F.lit("")).alias(out))
    return df.select(F.lit(source_index).alias("source_index"), F.lit(file).alias("source_file"), "source_row", F.lit(pool).alias("source_pool"), *fields)


def read_raw(spark: SparkSession, path: str, pool: str, source_index: int, root: str) -> DataFrame:
    name = path.removeprefix(qualified(spark, root) + "/")
    if is_xlsx(spark, path):
        rows = read_xlsx(spark, path)
        keys = [r[0] for r in rows.select(F.explode(F.map_keys("fields"))).distinct().collect()]  # header cells
        rows = rows.select("source_row", *[F.coalesce(F.element_at("fields", F.lit(k)), F.lit("")).alias(k) for k in keys])
    else:
        rows = read_csv_rows(spark, path)
    return aliased(rows, name, pool, source_index)


def read_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All raw records: the active file first, then candidates in path order (source_index)."""
    active, rest = discover(spark, folder)
    out = read_raw(spark, active, "activity_recorded", 0, folder)
    for i, path in enumerate(rest, start=1):
        out = out.unionByName(read_raw(spark, path, "unlabeled", i, folder))
    return out
