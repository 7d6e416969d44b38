"""Reading a folder of mixed CSV exports, and plain file sources."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acrewise.operators.sampling import concat_tables
from acrewise.sources.adapters import from_blob, from_listing_export, from_semicolon, from_wide

log = logging.getLogger(__name__)

# Files the job itself writes into the folder.
OUTPUT_NAMES = {"texas_houston_raw.csv", "texas_houston_scraped.csv", "usa_real_estate.csv"}
_PEEK_BYTES = 1 << 16
_ORDER = ("__file", "__block", "__row")
_PATH = "__path"


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, sep: str = ",", multi_line: bool = True) -> DataFrame:
    """Header CSV with a declared schema; no inference pass over the data. ``multi_line=False`` reads parts of large files in parallel."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"').option("multiLine", multi_line).csv(paths)


def is_skipped(name: str) -> bool:
    """Own outputs, metro index files and numbered file copies are not listings."""
    low = name.lower()
    stem = name.rsplit(".", 1)[0]
    return name in OUTPUT_NAMES or low.startswith("metro_") or "zhvi" in low or bool(re.search(r" \(\d+\)$", stem))


def _first_line(stream) -> str:
    """The first line of a file however long it is; the rest is not read."""
    held = b""
    while b"\n" not in held and (more := stream.read(_PEEK_BYTES)):
        held += more
    return held.decode("utf-8", "ignore").splitlines()[0]


def _peek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        lines = []
        for path in batch["path"]:
            try:
                files, inner = fs.FileSystem.from_uri(quote(path, safe="/:"))
                with files.open_input_stream(inner) as stream:
                    lines.append(_first_line(stream))
            except (OSError, ValueError, IndexError):
                lines.append(None)
        names = batch["path"].str.rsplit("/", n=1).str[-1]
        families = [",".join(families_of(line)) if line else None for line in lines]
        yield pd.DataFrame({"path": batch["path"], "name": names, "skipped": names.map(is_skipped), "first_line": lines, "families": families})


def sniff_exports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, name, skipped, first_line and families of each CSV file of the folder, found in the tasks; bodies are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    return files.mapInPandas(_peek, "path string, name string, skipped boolean, first_line string, families string")


def list_exports(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str]]:
    """(path, first line) of each usable CSV file of the folder, in name order: the paths that a read must name.

    The driver holds a path and a first line for each file, as the reader's own file listing does: about a kilobyte each.
    """
    found = []
    for r in sniff_exports(spark, path).where("not skipped").orderBy("name", "path").collect():
        if r["first_line"]:
            found.append((r["path"], r["first_line"]))
        else:
            log.warning("skipping unreadable or empty file %s", r["name"])
    return found


def families_of(first_line: str) -> list[str]:
    """Layouts to try for a file with this first line, in order."""
    columns = set(next(csv.reader([first_line.lstrip("﻿")])))
    semicolons = first_line.count(";")
    if "property" in columns and len(columns) <= 6:
        return ["blob"]
    if semicolons > first_line.count(",") and semicolons > 8:
        return ["semicolon", "wide"]
    if "detailUrl" in columns or any(c.startswith("hdpData/") for c in columns):
        return ["wide"]
    if any("listing" in c.lower() and "url" in c.lower() for c in columns):
        return ["export"]
    return ["wide", "blob", "semicolon", "export"]


_ADAPTERS = {"blob": from_blob, "semicolon": from_semicolon, "wide": from_wide, "export": from_listing_export}


def _read_family(spark: SparkSession, paths: list[str], first_line: str, family: str, multi_line: bool) -> DataFrame:
    """All files sharing one header, read as text columns in one scan, through the family's adapter."""
    sep = ";" if family == "semicolon" else ","
    header = next(csv.reader([first_line.lstrip("﻿")], delimiter=sep))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _unique(header)])
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
    raw = reader.option("mode", "DROPMALFORMED" if family == "semicolon" else "PERMISSIVE").csv(paths)
    raw = raw.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
        F.col("_metadata.file_path").alias(_PATH),
    )
    # a file with quoted line breaks is read by one task; its rows are dealt out before the costly parsing of cells
    return _ADAPTERS[family](raw.repartition("__file", "__block", "__row"), keep=(*_ORDER, _PATH))


def _plain(path: str) -> str:
    """A listed path in the spelling of a row's path: one slash behind the scheme where no host follows."""
    return re.sub(r"^(\w+):/+(?=[^/])", r"\1:/", path)


def _first_fitting(spark: SparkSession, files: list[str], line: str, options: list[str], multi_line: bool) -> list[DataFrame]:
    """Rows of files that share a header of several possible layouts: per file, the first layout that yields a row.

    One job for each layout, however many files there are.
    """
    parts, left = [], files
    for family in options:
        if not left:
            break
        part = _read_family(spark, left, line, family, multi_line)
        if not set(_ORDER) <= set(part.columns):
            continue
        fitting = {_plain(unquote(r[0])) for r in part.select(_PATH).distinct().collect()}
        if fitting:
            parts.append(_read_family(spark, [f for f in left if _plain(f) in fitting], line, family, multi_line))
            left = [f for f in left if _plain(f) not in fitting]
    return parts


def _unique(header: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for name in header:
        seen[name] = seen.get(name, -1) + 1
        out.append(name if not seen[name] else f"{name}.{seen[name]}")
    return out


def ingest_folder(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Every listing export of the folder in canonical columns, stamped ``real_raw``.

    Files with the same header share one scan. ``ingest_seq`` orders rows by file name and position. Quoted cells may
    hold line breaks; ``multi_line=False`` is for files known to have none, whose parts may then be read in parallel.
    """
    groups: dict[str, list[str]] = {}
    for file, line in list_exports(spark, path):
        groups.setdefault(line, []).append(file)
    parts = []
    for line, files in groups.items():
        options = families_of(line)
        if len(options) == 1:
            parts.append(_read_family(spark, files, line, options[0], multi_line))
            continue
        parts.extend(_first_fitting(spark, files, line, options, multi_line))
    parts = [p for p in parts if set(_ORDER) <= set(p.columns)]
    if not parts:
        return spark.createDataFrame([], "price double")
    merged = concat_tables(*parts).withColumn("data_tier", F.lit("real_raw"))
    return merged.withColumn("ingest_seq", F.struct(*_ORDER)).drop(*_ORDER, _PATH)
