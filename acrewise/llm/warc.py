"""WARC archives compressed record by record with a shared Zstandard dictionary.

* Dictionary: trained on at most ``SAMPLE_RECORDS`` whole records of at most ``SAMPLE_CHARS`` characters (taken in the order of a
  hash of their id; the bound holds for the dictionary alone, every record is archived). It stands at the head of every
  archive in a skippable frame, so each archive can be read by itself; too few records give archives without one.
* Every record is one frame. An archive is one row of bytes of about ``ARCHIVE_BYTES``, built inside a task, and Spark's own
  writer stores each row as a file: archives reach any store that Spark reaches, and a task that is run again
  replaces its files. The writer ends a file with an empty skippable frame, which readers pass over.
* Payloads are compared by SHA-256. Of equal payloads of at least ``least_bytes`` bytes the largest page_id is the response and the
  others are revisits of it; smaller ones are all responses. The largest id of a payload is combined in the tasks,
  and a payload that a third of all pages share is a key that adaptive execution splits.

Null html counts as empty. Rows that share the largest page_id of a payload are all responses; a null page_id is a revisit
where another row of its payload has an id, else a response. A null url is written as ``urn:x-page:<id>``, unsafe
characters of a url are percent-encoded. Extra columns are ignored; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acrewise.llm.common import bounded_sample
from acrewise.scale import shared_folder

SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 65_536, 65_536
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
#: fixed values of the formats
_DICTIONARY_MAGIC, _FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
_END_FRAME = "P*M\x18\x00\x00\x00\x00"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "!#$%&'()*+,/:;=?@[]~"
#: WARC-Date of records, unless another is given; a fixed one keeps archives reproducible
DATE = "1970-01-01T00:00:00Z"


def _urn(page_id: int | None) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """The uncompressed WARC record of one page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    uri = _urn(page_id) if url is None else quote(url, safe=_SAFE)
    fields = [("WARC-Record-ID", f"<{_urn(page_id)}>"), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        fields += [("WARC-Refers-To", f"<{_urn(refers_to)}>"), ("WARC-Profile", _PROFILE)]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record("revisit" if revisit else "response", fields, http if revisit else http + payload)


def _frame_end(data: memoryview, at: int) -> int:
    """End of the Zstandard frame at ``at``: header, blocks, checksum."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    size_bytes = (single, 2, 4, 8)[flags >> 6]
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size_bytes
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * (flags >> 2 & 1)


def frames(archive: bytes):
    """The uncompressed records of one archive, by the dictionary at its head."""
    import zstandard

    data, at, reader = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic == _FRAME_MAGIC:
            end = _frame_end(data, at)
            yield reader.decompress(data[at:end])
        elif magic >> 4 == 0x184D2A5:
            end = at + 8 + size
            if magic == _DICTIONARY_MAGIC and at == 0:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[at + 8 : end])))
        else:
            raise ValueError(f"no frame at byte {at}")
        at = end


def parse(record: bytes) -> dict:
    """page_id, url, record_type, payload (None in a revisit), payload_bytes, payload_digest, refers_to; {} for others."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if fields["WARC-Type"] not in ("response", "revisit"):
        return {}
    number = lambda name: int(x) if (x := fields[name].strip("<>").rpartition(":")[2]) else None
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    said = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload": None if revisit else body,
        "payload_bytes": int(said[b"Content-Length"]),
        "payload_digest": digest,
        "refers_to": number("WARC-Refers-To") if revisit else None,
    }


def _typed(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """page_id, url, payload, refers_to, revisit."""
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    held = rows.where(F.octet_length("payload") >= least_bytes)
    same = held.groupBy("sha").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(same, "sha", "left").select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def dictionary(pages: DataFrame, id_col: str, url_col: str, html_col: str, date: str = DATE) -> bytes:
    """A dictionary trained on a bounded sample of records; empty if the sample is too small for one."""
    import zstandard

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{url_col}`").cast("string").alias("u"), F.col(f"`{html_col}`").cast("string").alias("h"))
    rows = bounded_sample(rows, F.col("i"), 4 * SAMPLE_RECORDS).where(F.length("h") <= SAMPLE_CHARS).orderBy(F.xxhash64("i"), "i", "u", "h").limit(SAMPLE_RECORDS).collect()
    samples = [page_record(r["i"], r["u"], r["h"].encode(), None, False, date) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = DATE
) -> None:
    """Archive every row of ``pages`` under ``path`` (a folder that all executors reach)."""
    trained = dictionary(pages, id_col, url_col, html_col, date)

    def run(batches):
        import zstandard

        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        lead = struct.pack("<II", _DICTIONARY_MAGIC, len(trained)) + trained if trained else b""
        info = _record("warcinfo", [("WARC-Record-ID", "<urn:x-archive:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        head = lead + packer.compress(info)
        parts, size = [head], 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])
        for b in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(b.column(i) for i in range(5)), strict=True):
                record = page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py(), date)
                parts.append(packer.compress(record))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield row()
                    parts, size = [head], 0
        if size:
            yield row()

    archives = _typed(pages, id_col, url_col, html_col, least_bytes).mapInArrow(run, "archive binary")
    text = archives.select(F.col("archive").cast("string").alias("value"))  # the writer stores the bytes as they are
    text.write.option("lineSep", _END_FRAME).option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``; every payload is checked against its digest."""
    schema = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for b in batches:
            for archive in b.column(0):
                rows = [r for x in frames(archive.as_py()) if (r := parse(x))]
                if not payloads:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def archived(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and read the archives back, without the payloads."""
    path = shared_folder(pages.sparkSession, "warc")
    write(pages, path, **how)
    return read(pages.sparkSession, path, payloads=False)
