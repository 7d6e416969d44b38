"""Fill-in-middle transformation by secondary sort: pieces keyed by document and output position, streamed into digests.

* A text is cut into units (a run of ASCII letters, or one other code point). Two hashes of the id choose where the middle begins
  and ends; a third whether the text stays plain, a fourth the order of the parts. A task emits each part in pieces of
  whole units, ``PIECE`` bytes or so, with the document and the place in the output; part marks open their part.
* Pieces are dealt by document and sorted inside each partition by document and place (the DataFrame form of
  ``repartitionAndSortWithinPartitions``), so a task reads an output from its first to its last piece and feeds an incremental digest.
* Restoration reads only output and form: it finds the marks in the stream of pieces, also where a mark is cut by a piece
  border, gives each part its place in the text, sorts the pieces again inside the partition (no second shuffle) and
  feeds a second digest.

No task holds more than a batch of pieces, however long the text; the sort spills. A document is dealt by id, text hash and the
input partition, and equal rows of an input batch travel once with their count, so repeated rows do not pile up.

Null text counts as empty; an empty text is plain, with no units. A null id is hashed as no digits. Rows with the same id and
different text are documents of their own, repeated rows give a row each. Only the two named columns are read. An empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import slim

PIECE = 1 << 15
#: percent of the texts that stay plain, and of the others that put the suffix first
PLAIN, SUFFIX_FIRST = 10, 20
#: part marks, and the parts of each form in output order; a part's place in the text is its place in ``PARTS``
PARTS = ("prefix", "middle", "suffix")
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
_BLOCK = 1 << 20

_KEY = ["doc_id", "th", "part"]
PIECES = "doc_id long, th long, part int, pos int, chunk binary, copies long, form string, n long, prefix_chars long, middle_chars long"
_RESTORED = "doc_id long, th long, part int, place int, pos int, chunk binary, copies long, form string, n long, prefix_chars long, middle_chars long"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, copies long"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _unit_starts(data: np.ndarray, at: int) -> np.ndarray:
    """Where units start in the block of UTF-8 bytes from ``at``, in bytes of the whole text."""
    block = data[at : at + _BLOCK]
    letter = _LETTER[block]
    inside = np.empty_like(letter)
    inside[0] = at > 0 and _LETTER[data[at - 1]]
    inside[1:] = letter[:-1]
    return at + np.flatnonzero(((block & 0xC0) != 0x80) & ~(letter & inside))


def units(data: np.ndarray) -> int:
    return sum(len(_unit_starts(data, at)) for at in range(0, len(data), _BLOCK))


def unit_offsets(data: np.ndarray, wanted: list[int]) -> list[int]:
    """Byte offset at which each of the ``wanted`` units (ascending) starts; the length of the text for one past the last."""
    found, before = [], 0
    for at in range(0, len(data), _BLOCK):
        starts = _unit_starts(data, at)
        while len(found) < len(wanted) and wanted[len(found)] < before + len(starts):
            found.append(int(starts[wanted[len(found)] - before]))
        before += len(starts)
    return found + [len(data)] * (len(wanted) - len(found))


def chars(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


def _chunks(data: np.ndarray, start: int, end: int) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end`` in pieces that end before a unit, unless a unit is longer than a piece."""
    while start < end:
        stop = min(start + PIECE, end)
        if stop < end:
            near = _unit_starts(data[start : stop + 1], 0)
            stop = start + int(near[-1]) if near[-1] else stop
            while stop < end and data[stop] & 0xC0 == 0x80:  # never inside a code point
                stop += 1
        yield data[start:stop].tobytes()
        start = stop


def cut(text: bytes, plain: bool, spm: bool, h1: int, h2: int) -> tuple[str, int, int | None, int | None, Iterator[bytes]]:
    """Form, number of units, characters of prefix and middle, and the output in pieces (at least one)."""
    data = np.frombuffer(text, np.uint8)
    n = units(data)
    if plain:
        return "plain", n, None, None, (_chunks(data, 0, len(data)) if text else iter([b""]))
    low, high = unit_offsets(data, sorted((h1 % (n + 1), h2 % (n + 1))))
    bounds = {"prefix": (0, low), "middle": (low, high), "suffix": (high, len(data))}
    form = "spm" if spm else "psm"

    def output() -> Iterator[bytes]:
        for part in ORDERS[form]:
            mark = MARKS[part]
            for chunk in _chunks(data, *bounds[part]):
                yield mark + chunk
                mark = b""
            if mark:
                yield mark

    return form, n, chars(data[:low]), chars(data[low:high]), output()


def placed(chunks: Iterable[bytes], form: str) -> Iterator[tuple[int, bytes]]:
    """The output's pieces without marks, each with the place of its part in the text; pieces may be cut anywhere."""
    if form == "plain":
        yield from ((0, c) for c in chunks)
        return
    order = list(ORDERS[form])
    mark, place, held = MARKS[order[0]], None, b""
    for chunk in chunks:
        held += chunk
        while mark is not None and (at := held.find(mark)) >= 0:
            if at:
                yield place, held[:at]
            held, place = held[at + len(mark) :], PARTS.index(order.pop(0))
            mark = MARKS[order[0]] if order else None
        # the last bytes may be the beginning of a mark
        keep = len(mark) - 1 if mark else 0
        if len(held) > keep:
            yield place, held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield place, held


def rebuilt(output: bytes, form: str) -> bytes:
    """The text an output was made from."""
    return b"".join(c for _, c in sorted(placed([output], form), key=lambda x: x[0]))


def _word(group: int, digest: Column) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(*(lambda n, k: (n, kinds[k]))(*f.split())) for f in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=pa.schema(fields))


def _in_parts(rows: Iterable[tuple], schema: str, size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about 4 MiB; ``size`` is the column of the bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += 128 + len(row[size] or b"")
        if total >= 1 << 22:
            yield _batch(held, schema)
            held, total = [], 0
    yield _batch(held, schema)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1:") -> DataFrame:
    """The outputs: ``chunk`` number ``pos`` of each document, in order inside the partitions.

    ``copies`` (rows with this id and text), ``form``, ``n``, ``prefix_chars`` and ``middle_chars`` stand on the first piece.
    """
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    marked = F.lit(False)
    for m in MARKS.values():
        marked = marked | F.contains("text", F.lit(m.decode()))
    plain = (F.col("text") == "") | marked | (_word(2, digest) % 100 >= 100 - PLAIN)
    spm = _word(3, digest) % 100 < SUFFIX_FIRST
    keyed = slim(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("th"), F.spark_partition_id().alias("part"), "text",
        plain.alias("plain"), spm.alias("spm"), _word(0, digest).alias("h1"), _word(1, digest).alias("h2"),
    )

    def run(batches):
        for b in batches:
            ids, ths, parts = (b.column(i).to_pylist() for i in range(3))
            copies: dict[tuple, list[int]] = {}
            for at, key in enumerate(zip(ids, ths, strict=True)):
                copies.setdefault(key, []).append(at)

            def rows(b=b, copies=copies, part=parts[0] if parts else 0):
                for (i, th), where in copies.items():
                    text = b.column(3)[where[0]].as_buffer().to_pybytes()
                    form, n, prefix, middle, chunks = cut(text, *(b.column(c)[where[0]].as_py() for c in range(4, 8)))
                    for pos, chunk in enumerate(chunks):
                        first = (len(where), form, n, prefix, middle) if pos == 0 else (None,) * 5
                        yield (i, th, part, pos, chunk, *first)

            yield from _in_parts(rows(), PIECES, 4)

    return keyed.mapInArrow(run, PIECES).repartition(*_KEY).sortWithinPartitions(*_KEY, "pos")


def _documents(batches, order: list[str]) -> Iterator[tuple[dict, Iterator[tuple]]]:
    """Each document's first row, and all its rows without repeats of a place (copies met in several batches), in the order given."""

    def rows():
        for b in batches:
            names = b.schema.names
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield dict(zip(names, row, strict=True))

    stream = rows()
    ahead = next(stream, None)
    while ahead is not None:
        key = [ahead[k] for k in _KEY]
        first = dict(ahead)

        def own(first=first, key=key):
            nonlocal ahead
            last = None
            while ahead is not None and [ahead[k] for k in _KEY] == key:
                at = [ahead[k] for k in order]
                if at != last:
                    yield ahead
                elif ahead["copies"] is not None:
                    first["copies"] += ahead["copies"]
                last, ahead = at, next(stream, None)

        yield first, own()


def digests(assembled: DataFrame) -> DataFrame:
    """One row per document of :func:`pieces`: its facts, the digest of the output and that of the text rebuilt from it."""

    def read(batches):
        def rows():
            for first, own in _documents(batches, ["pos"]):
                total = hashlib.sha256()
                key = [first[k] for k in _KEY]

                def fed(own=own, total=total):
                    for row in own:
                        total.update(row["chunk"])
                        yield row["chunk"]

                pos = 0
                for place, chunk in placed(fed(), first["form"]):
                    yield (*key, place, pos, chunk, *[None] * 5)
                    pos += 1
                # the last row of a document: its facts, and the digest of the output
                yield (*key, len(PARTS), pos, total.hexdigest().encode(), *[first[k] for k in ("copies", "form", "n", "prefix_chars", "middle_chars")])

        return _in_parts(rows(), _RESTORED, 5)

    def rebuild(batches):
        def rows():
            for _, own in _documents(batches, ["place", "pos"]):
                total = hashlib.sha256()
                for row in own:
                    if row["place"] < len(PARTS):
                        total.update(row["chunk"])
                    else:
                        facts = [row[k] for k in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
                        yield (*facts, row["chunk"].decode(), total.hexdigest(), row["copies"])

        return _in_parts(rows(), DIGESTS, 5)

    again = assembled.mapInArrow(read, _RESTORED).sortWithinPartitions(*_KEY, "place", "pos")
    found = again.mapInArrow(rebuild, DIGESTS)
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return found.select("*", each.alias("__each")).drop("__each", "copies")


def texts(assembled: DataFrame) -> DataFrame:
    """doc_id, form, copies and the whole ``output`` of each document of :func:`pieces`."""
    schema = "doc_id long, form string, copies long, output string"

    def run(batches):
        def rows():
            for first, own in _documents(batches, ["pos"]):
                whole = b"".join(row["chunk"] for row in own).decode()
                yield first["doc_id"], first["form"], first["copies"], whole

        return _in_parts(rows(), schema, 3)

    return assembled.mapInArrow(run, schema)
