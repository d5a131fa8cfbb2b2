"""Readers of vendor formats: gzip CSV bars, NDJSON with fixed schemas, capped pipe files, sectioned CSV, XML filings."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BARS = "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions long"


def bars_csv(spark: SparkSession, path: str, date: dt.date) -> DataFrame:
    """Bars of one session from (gzip) CSV with a header; window_start is in nanoseconds since 1970."""
    rows = spark.read.option("header", True).schema(BARS).csv(path)
    return rows.withColumn("window_start_utc", F.timestamp_micros(F.expr("window_start div 1000"))).drop("window_start").withColumn("date", F.lit(date))


def ndjson(spark: SparkSession, path: str, schema: T.StructType, date: dt.date | None = None, column: str = "date") -> DataFrame:
    """JSON lines under a fixed schema: absent fields are null, and values of another type are null too."""
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.schema(loose).json(path)
    out = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
    return out.withColumn(column, F.lit(date)) if date else out


def newest_copy(rows: DataFrame, key: str, updated: str) -> DataFrame:
    """One row per key: the copy that was updated last."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(F.coalesce(F.col(updated), F.lit("")), F.to_json(F.struct(*rows.columns)))).alias("r"))
    return best.select("r.*")


def pulled_csv(spark: SparkSession, glob: str, pattern: str = r"([A-Za-z0-9]+)/pull=(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """Series CSV files (date, value) of many pulls; the series and the date of the pull are in the path."""
    rows = spark.read.option("header", True).schema("date date, value string").csv(glob)
    path = F.col("_metadata.file_path")
    return rows.select(F.regexp_extract(path, pattern, 1).alias("series_id"), "date", F.col("value").try_cast("double").alias("value"), F.regexp_extract(path, pattern, 2).cast("date").alias("vendor_pull_date"))


def borrow_file(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A pipe-delimited snapshot without quoting: lines that start with # are not rows; ``>n`` states a capped number."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    cells = F.split("value", r"\|")
    rows = lines.select(*[F.nullif(F.trim(F.get(cells, F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)])
    if "available" not in names:
        return rows
    capped = F.col("available").startswith(">")
    return rows.withColumn("available_capped", F.coalesce(capped, F.lit(False))).withColumn("available", F.regexp_replace("available", "^>", "").try_cast("long"))


def percent(value: Column, missing: tuple[float, ...] = (-99.99, -999.0)) -> Column:
    """A percentage as a fraction; the vendor's codes for missing are null."""
    return F.when(~value.isin(*missing), F.round(value / 100, 8))


def first_section(text: str) -> tuple[list[str], list[tuple[str, list[str]]]]:
    """(columns, [(date, values)]) of the first table in a sectioned CSV: a header line with an empty first cell, then
    lines that start with a date of 6 or 8 digits, up to the first line that does not."""
    columns: list[str] = []
    rows: list[tuple[str, list[str]]] = []
    for line in text.splitlines():
        cells = [c.strip() for c in line.split(",")]
        if re.fullmatch(r"\d{6}|\d{8}", cells[0]) and columns:
            rows.append((cells[0], cells[1 : len(columns) + 1]))
        elif rows:
            break
        elif len(cells) > 1 and not cells[0]:
            columns = cells[1:]
    return columns, rows


def sections(text: str) -> list[tuple[str, list[str], list[tuple[str, list[str]]]]]:
    """Every table of a sectioned CSV: (title, columns, rows). A title is the last line of text before a header line."""
    found: list[tuple[str, list[str], list[tuple[str, list[str]]]]] = []
    title, dated = "", re.compile(r"\d{4}|\d{6}|\d{8}")
    for line in text.splitlines():
        cells = [c.strip() for c in line.split(",")]
        if dated.fullmatch(cells[0]) and len(cells) > 1 and found:
            found[-1][2].append((cells[0], cells[1 : len(found[-1][1]) + 1]))
        elif len(cells) > 1 and not cells[0] and any(cells):
            found.append((title, cells[1:], []))
        elif cells[0]:
            title = " ".join(line.split())
    return [f for f in found if f[2]]


def sections_zip(spark: SparkSession, glob: str) -> DataFrame:
    """All tables of all members of zipped CSV files in long form: file, member, section, date, name, value (a fraction, null if missing).

    Yearly rows are dated 1 January. One file is one row of binaryFile, parsed on the executors.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in z.namelist():
                        out = []
                        for title, columns, rows in sections(z.read(member).decode("latin-1")):
                            for date, values in rows:
                                day = dt.date(int(date[:4]), int(date[4:6] or 1), int(date[6:] or 1))
                                out += [(path.rsplit("/", 1)[-1], member, title, day, c, float(v)) for c, v in zip(columns, values) if v]
                        yield pd.DataFrame(out, columns=["file", "member", "section", "date", "name", "value"])

    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    rows = files.mapInPandas(parse, "file string, member string, section string, date date, name string, value double")
    return rows.withColumn("value", percent(F.col("value")))


def workbook_rows(content: bytes, sheet: str) -> Iterator[tuple[int, dict[str, str]]]:
    """(row number, cells by column letter) of a sheet in an XLSX file, from its XML; shared strings are resolved, values are text."""
    from xml.etree import ElementTree as tree

    main, rel = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = []
        if "xl/sharedStrings.xml" in z.namelist():
            strings = ["".join(t.text or "" for t in item.iter(f"{main}t")) for item in tree.fromstring(z.read("xl/sharedStrings.xml"))]
        ids = {s.get("name"): s.get(f"{rel}id") for s in tree.fromstring(z.read("xl/workbook.xml")).iter(f"{main}sheet")}
        targets = {r.get("Id"): r.get("Target") for r in tree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        place = targets[ids[sheet]].lstrip("/")
        for row in tree.fromstring(z.read(place if place.startswith("xl/") else f"xl/{place}")).iter(f"{main}row"):
            cells = {}
            for cell in row.iter(f"{main}c"):
                value = cell.findtext(f"{main}v")
                if cell.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in cell.iter(f"{main}t"))
                elif cell.get("t") == "s" and value is not None:
                    value = strings[int(value)]
                if value is not None:
                    cells[re.match("[A-Z]+", cell.get("r"))[0]] = value
            yield int(row.get("r")), cells


def workbook(spark: SparkSession, glob: str, sheet: str, columns: dict[str, str], first_row: int) -> DataFrame:
    """Rows of one sheet of XLSX files from ``first_row`` on: file, line, and a string column for each column letter named."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = [(path.rsplit("/", 1)[-1], n, *[cells.get(c) for c in columns]) for n, cells in workbook_rows(content, sheet) if n >= first_row and cells]
                yield pd.DataFrame(rows, columns=["file", "line", *columns.values()])

    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    return files.mapInPandas(parse, "file string, line int" + "".join(f", `{c}` string" for c in columns.values()))


def newest_vintage(page: str, pattern: str) -> str | None:
    """The link of a page that matches ``pattern`` and whose first group, a vintage, is the largest; None without any."""
    links = [m for link in re.findall(r"href=[\"']([^\"']+)", page) if (m := re.search(pattern, link))]
    return max(links, key=lambda m: m[1]).string if links else None


def sectioned_zip(spark: SparkSession, glob: str) -> DataFrame:
    """The first sections of zipped CSV files in long form: file, date, name, value (a fraction, null if missing).

    One small file is one row of binaryFile, parsed on the executors.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    columns, rows = first_section(z.read(z.namelist()[0]).decode("latin-1"))
                for date, values in rows:
                    day = dt.date(int(date[:4]), int(date[4:6]), int(date[6:] or 1))
                    out += [(path.rsplit("/", 1)[-1], day, c, float(v)) for c, v in zip(columns, values) if v]
            yield pd.DataFrame(out, columns=["file", "date", "name", "value"])

    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    rows = files.mapInPandas(parse, "file string, date date, name string, value double")
    return rows.withColumn("value", percent(F.col("value")))


HOLDING = "title string, name string, cusip string, balance double, units string, valUSD double, pctVal double, assetCat string, issuerCat string, invCountry string, payoffProfile string"


def filing_xml(spark: SparkSession, path: str) -> DataFrame:
    """Positions of fund filings: one row per invstOrSec element; a CUSIP of zeros or N/A is null."""
    rows = spark.read.format("xml").option("rowTag", "invstOrSec").option("ignoreNamespace", True).schema(HOLDING).load(path)
    cusip = F.when(~F.col("cusip").rlike(r"^(0+|N/?A)$"), F.col("cusip"))
    return rows.withColumn("cusip", cusip)


def ticker_symbol(raw: Column) -> Column:
    """A share class as point suffix: ``BRK B`` and ``BRK/B`` are ``BRK.B``; empty and dashes are null."""
    joined = F.regexp_replace(F.upper(F.trim(raw)), r"[ /]+", ".")
    return F.when(~joined.isin("", "-", "--"), joined)


def preamble_csv(spark: SparkSession, path: str, first: str = "Ticker") -> DataFrame:
    """A table inside a CSV file: lines before the header (which starts with ``first``) and from the first blank line or
    footnote after it are left out. All columns are strings, with ``file``; thousands separators are kept for the caller.

    One file is one row of binaryFile, parsed on the executors into rows of a map and then projected.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        for batch in batches:
            out = []
            for file, content in zip(batch["path"], batch["content"]):
                header: list[str] | None = None
                for at, cells in enumerate(csv.reader(io.StringIO(content.decode("utf-8-sig")))):
                    if header is None:
                        header = [c.strip() for c in cells] if cells and cells[0].strip() == first else None
                    elif len(cells) < len(header) or not any(c.strip() for c in cells):
                        break
                    else:
                        out.append((file.rsplit("/", 1)[-1], at, dict(zip(header, (c.strip() for c in cells)))))
            yield pd.DataFrame(out, columns=["file", "line", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInPandas(parse, "file string, line int, cells map<string,string>")
    names = sorted(r[0] for r in rows.select(F.explode(F.map_keys("cells"))).distinct().collect())
    return rows.select("file", "line", *[F.nullif(F.col("cells")[n], F.lit("")).alias(n) for n in names])


def category_tree(tree: dict, above: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(member, path of names) of a nested tree of categories: nodes have name, members and children."""
    path = (*above, tree.get("name", ""))
    found = [(m, "/".join(p for p in path if p)) for m in tree.get("members", [])]
    for child in tree.get("children", []):
        found += category_tree(child, path)
    return found


def best_listing(rows: DataFrame, code: str = "cusip") -> DataFrame:
    """One listing per code: US composites first, then shares before other kinds, then by symbol."""
    order = F.struct(F.coalesce(F.col("exchange") != "US", F.lit(True)), F.coalesce(F.col("security_type") != "Common Stock", F.lit(True)), F.coalesce("ticker", F.lit("~")))
    return rows.groupBy(code).agg(F.min_by(F.struct(*[c for c in rows.columns if c != code]), order).alias("r")).select(code, "r.*")


def filing_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an Atom list of filings: accession, form, filed; newest first by value, not by place."""
    kind = "id string, updated string, `filing-date` string, `filing-type` string, `accession-number` string, content struct<`accession-number`:string,`filing-date`:string,`filing-type`:string>"
    rows = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", True).schema(kind).load(path)
    pick = lambda n: F.coalesce(F.col(f"content.`{n}`"), F.col(f"`{n}`"))
    return rows.select(pick("accession-number").alias("accession"), pick("filing-type").alias("form"), pick("filing-date").try_cast("date").alias("filed"))
