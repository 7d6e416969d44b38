"""Secret scan with a recursive decoding worklist.

* Base: assignments, access keys and hex keys by pattern (:func:`scan`), on the text as it stands. They always stay.
* Worklist: a layer is a text with a map of its positions to those of the layer it came from. Percent escapes and ``\\uXXXX``
  escapes are decoded in place over a whole layer; each base64 run gives layers of its own: from all four alignments, since
  what stands before the payload may belong to the alphabet, and with lines joined where it is wrapped. Bytes are read as
  UTF-8 with replacement, as UTF-16 of both orders where they hold a zero byte, and through all members of the gzip or zlib
  data found at any offset. Every new layer is scanned and unwrapped again until none is new. Bytes and texts that were seen
  for the same place are not entered again, which also ends compressed data that unpack to themselves.
* A secret found in a layer is reported at the span of the document that its characters came from.

Documents are independent rows: nothing is shuffled. Unpacked data are scanned in layers of ``UNPACK_BYTES`` at most, which overlap
by ``OVERLAP``: memory is bounded, nothing is refused; an encoded run longer than the overlap may be cut between two layers.
Compressed data are entered to a depth of ``DEPTH``, which only data made to unpack for ever exceed. Null text counts as empty and has no
span; repeated rows get the same spans; extra columns are ignored. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from acrewise.llm.common import slim

KINDS = ("assign", "access", "hex")
UNPACK_BYTES = 64 << 20
OVERLAP = 1 << 20
DEPTH = 64

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
#: lines of the alphabet, behind quote marks or with escaped line ends too
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t>]*(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*[A-Za-z0-9+/_-]++)++={0,2}")
_BREAK = re.compile(r"[\x20\t>]*(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*")
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]", re.S)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base secrets of one text."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


class _Layer:
    """A text and the segments (first position, first and end position in the parent, one to one or not)."""

    def __init__(self, text: str, parent: _Layer | None = None, segments: list[tuple[int, int, int, bool]] | None = None):
        self.text, self.parent, self.segments = text, parent, segments or []
        self.starts = [s[0] for s in self.segments]

    def place(self, start: int, end: int) -> tuple[int, int]:
        """The span of the document that [start, end) of this layer came from."""
        if self.parent is None:
            return start, end
        a0, a, _, direct = self.segments[bisect_right(self.starts, start) - 1]
        first = a + start - a0 if direct else a
        b0, b, b_end, direct = self.segments[bisect_right(self.starts, end - 1) - 1]
        last = b + end - b0 if direct else b_end
        return self.parent.place(first, last)


def _percent_chars(run: str) -> list[tuple[str, int]]:
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in raw.decode()]
    except UnicodeDecodeError:
        return [(c, 3) for c in raw.decode("latin-1")]


def _escape_chars(run: str) -> list[tuple[str, int]]:
    units = [int(run[k + 2 : k + 6], 16) for k in range(0, len(run), 6)]
    out, k = [], 0
    while k < len(units):
        u = units[k]
        if 0xD800 <= u < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1] < 0xE000:
            out.append((chr(0x10000 + ((u - 0xD800) << 10) + units[k + 1] - 0xDC00), 12))
            k += 2
        else:
            out.append(("�" if 0xD800 <= u < 0xE000 else chr(u), 6))
            k += 1
    return out


def _in_place(layer: _Layer, pattern: re.Pattern, chars) -> _Layer | None:
    """The layer with every escape of ``pattern`` decoded."""
    parts, segments, at, length = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        if m.start() > at:
            segments.append((length, at, m.start(), True))
            parts.append(layer.text[at : m.start()])
            length += m.start() - at
        at = m.start()
        for c, width in chars(m[0]):
            segments.append((length, at, at + width, False))
            parts.append(c)
            length, at = length + 1, at + width
    if not parts and not at:
        return None
    if at < len(layer.text):
        segments.append((length, at, len(layer.text), True))
        parts.append(layer.text[at:])
    return _Layer("".join(parts), layer, segments)


def _members(raw: bytes, at: int):
    """The output of the gzip or zlib members from ``at`` on, in overlapping parts; returns where they end."""
    kind = 31 if raw[at : at + 1] == b"\x1f" else 15
    held, view = b"", memoryview(raw)
    stream, rest, some, fresh = zlib.decompressobj(kind), view[at:], False, False
    while True:
        try:
            out = stream.decompress(rest, UNPACK_BYTES - len(held))
        except zlib.error:
            break
        rest = stream.unconsumed_tail
        held += out
        some, fresh = some or bool(out), fresh or bool(out)
        if len(held) >= UNPACK_BYTES:
            yield held
            held, fresh = held[-min(OVERLAP, UNPACK_BYTES // 2) :], False
        elif stream.eof:
            at = len(raw) - len(stream.unused_data)
            again = _PACKED.match(raw, at)
            if again is None:
                break
            stream, rest = zlib.decompressobj(31 if raw[at] == 0x1F else 15), view[at:]
        elif not out and not rest:
            break
    if fresh:
        yield held
    return at


def _texts(raw: bytes, new, depth: int = 0):
    """What ``raw`` reads as, and what the compressed data in it read as."""
    if not raw or not new(raw):
        return
    yield raw.decode("utf-8", "replace")
    if b"\0" in raw:
        for code in ("utf-16-le", "utf-16-be"):
            for at in (0, 1):
                yield raw[at:].decode(code, "replace")
    at = 0
    while depth < DEPTH and (m := _PACKED.search(raw, at)):
        parts, end = _members(raw, m.start()), m.start()
        while True:
            try:
                part = next(parts)
            except StopIteration as done:
                end = done.value
                break
            yield from _texts(part, new, depth + 1)
        at = max(end, m.start() + 1)


def _children(layer: _Layer, seen: set):
    text = layer.text
    if "%" in text and (child := _in_place(layer, _PERCENT, _percent_chars)):
        yield child
    if "\\u" in text and (child := _in_place(layer, _ESCAPE, _escape_chars)):
        yield child
    for pattern in (_BASE64, _WRAPPED):
        for m in pattern.finditer(text):
            run = (m[0] if pattern is _BASE64 else _BREAK.sub("", m[0])).rstrip("=").translate({45: 43, 95: 47})
            if len(run) < 16:
                continue
            place = layer.place(m.start(), m.end())

            def new(raw, place=place):
                return _first(seen, raw, place)

            for at in range(4):
                part = run[at : len(run) - ((len(run) - at) % 4 == 1)]
                for found in _texts(base64.b64decode(part + "=" * (-len(part) % 4)), new):
                    yield _Layer(found, layer, [(0, m.start(), m.end(), False)])


def _first(seen: set, raw: bytes, place: tuple[int, int]) -> bool:
    """Whether these bytes come up for this place for the first time."""
    mark = (hashlib.blake2b(raw, digest_size=16).digest(), place)
    known = mark in seen
    seen.add(mark)
    return not known


def all_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, base) of every secret, by start, then kind."""
    root = _Layer(text)
    base = scan(text)
    found = {s: True for s in base}
    texts, seen = set(), set()
    work = [_children(root, seen)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
        elif child.text and _first(texts, child.text.encode("utf-8", "surrogatepass"), child.place(0, len(child.text))):
            for start, kind, end in scan(child.text):
                a, b = child.place(start, end)
                found.setdefault((a, kind, b), False)
            work.append(_children(child, seen))
    return sorted((a, k, b, own) for (a, k, b), own in found.items())


_FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``: (kind, start, end, base) of every span, by start, then kind; one row per row of ``docs``."""

    def run(batches):
        for b in batches:
            found = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": own} for s, k, e, own in all_spans(t)] for t in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _FOUND_TYPE)], ["doc_id", "found"])

    return slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, found array<struct<kind: string, start: int, end: int, base: boolean>>")
