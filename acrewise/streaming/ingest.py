"""Incremental folder ingest: new export files are appended to a table, micro-batch by micro-batch.

The stream carries files, not rows: a name and a fingerprint each, so its state is small whatever the exports hold. A file
delivered again under the same name with the same bytes (in another folder, or copied anew) is dropped while the watermark
remembers it; a changed file passes. Rows keep the ``ingest_seq`` of a batch run, whose order is by file name and position,
so keeping the first row of a key over the table gives what one batch run over all files gives.

Each micro-batch overwrites its own ``batch=<number>`` folder, so a batch that is run again after a failure leaves no rows
twice. Files without usable rows, and an empty folder, add nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from acrewise.operators.dedupe import dedupe_listings
from acrewise.schema import LISTING_COLUMNS, LISTING_SCHEMA, ensure_columns
from acrewise.sources.folder import ingest_folder

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_CHUNK = 1 << 20
_SEQ = T.StructType([T.StructField("__file", T.StringType()), T.StructField("__block", T.LongType()), T.StructField("__row", T.LongType())])
TABLE_SCHEMA = T.StructType([*LISTING_SCHEMA.fields, T.StructField("ingest_seq", _SEQ), T.StructField("batch", T.LongType())])


def _fingerprint(path: str) -> str:
    """SHA-256 of a file, read in chunks. An unreadable file is known by its path, so the ingest decides about it."""
    from pyarrow import fs

    digest = hashlib.sha256()
    try:
        files, inner = fs.FileSystem.from_uri(quote(path, safe="/:"))
        with files.open_input_stream(inner) as stream:
            while chunk := stream.read(_CHUNK):
                digest.update(chunk)
    except (OSError, ValueError):
        return path
    return digest.hexdigest()


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(name=b["path"].str.rsplit("/", n=1).str[-1], fingerprint=b["path"].map(_fingerprint))


def new_files(spark: SparkSession, path: str, max_files: int = 1000, known_for: str = "7 days") -> DataFrame:
    """Stream of path, arrived, name and fingerprint of the CSV files below ``path``, repeated deliveries left out.

    The event time is the arrival, not the file's own time: a file copied with an old time is new and never late.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select("path", F.current_timestamp().alias("arrived"))
    )
    named = files.mapInPandas(_fingerprints, "path string, arrived timestamp, name string, fingerprint string")
    return named.withWatermark("arrived", known_for).dropDuplicatesWithinWatermark(["name", "fingerprint"])


def ingest_stream(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    max_files: int = 1000,
    known_for: str = "7 days",
    multi_line: bool = True,
    **trigger,
) -> StreamingQuery:
    """Start appending the exports below ``path`` to the Parquet ``table``; by default until all present files are done.

    ``max_files`` bounds the paths that one micro-batch names on the driver. ``trigger`` is that of the stream writer,
    ``availableNow=True`` if none is given.
    """

    def append(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]
        rows = ingest_folder(batch.sparkSession, paths, multi_line) if paths else None
        if rows is not None and "ingest_seq" in rows.columns:
            rows = ensure_columns(rows).select(*LISTING_COLUMNS, "ingest_seq")
            rows.write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = new_files(spark, path, max_files, known_for).writeStream.foreachBatch(append)
    return stream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ingested(spark: SparkSession, table: str) -> DataFrame:
    """All rows appended so far, with the number of their micro-batch."""
    return spark.read.schema(TABLE_SCHEMA).parquet(table)


def current_listings(spark: SparkSession, table: str) -> DataFrame:
    """One row per url, or address and price: the first by file name and position, as in one batch run over all files."""
    rows = dedupe_listings(ingested(spark, table), ("address", "price"), ("ingest_seq", "batch"))
    return rows.select(*LISTING_COLUMNS)
