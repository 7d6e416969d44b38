"""Byte-level BPE: Spark higher-order functions fold ranked merges over the bytes of distinct words.

* A text is cut into words by the tokenizer's pattern, each encoded by itself. :func:`merged` starts from the bytes of a word
  and folds over them: each step joins the adjacent pair of the lowest rank, until no pair is in the rank map. The map is a
  literal of the plan: pieces are written as their ranks, and the pairs that join are dealt by hash into short rows, laid into
  one array so that no two meet; a lookup reads the start of a row and one element.
* A word that is a piece itself needs no merge. Of the others, each is folded once, in the row where its task meets it first;
  later rows of the task refer to it, until GROUP words are kept. Nothing is shuffled or broadcast.
* Words of more than ``LONG_BYTES`` bytes take the same merges from a heap in the task, because a fold over them
  would cost the square of their length.
* Spark runs the pattern. Texts with characters that its Unicode version does not know are cut in the Python worker.
* Decoding looks each id up in the list of pieces and concatenates the bytes.

Null text counts as empty and has no ids. Rows are independent: repeated rows get the same ids; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import random
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import slim, worker_store

LONG_BYTES = 512
#: folded words that a task keeps before it starts anew
GROUP = 1 << 19
# Rows that a task turns into Python objects at once, words it looks up at once, bits of a rank, factor of a hash.
_ROWS, _WORDS, _BITS, _SPREAD = 512, 1 << 22, 20, 1021
# A state of the fold: bits of a place, and the value from which on a piece does not join with the one before it.
_PLACE, _APART = (1 << 2 * _BITS) - (1 << _BITS), 1 << 3 * _BITS


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def _pairs(path: str) -> tuple[list[int], list[int]]:
    """For each row of pairs its start, and the array of all rows.

    If pieces ``a`` and ``b`` join to a piece, they are in row ``(a + b * _SPREAD) % number of rows``, and the element ``b``
    behind the start of that row holds a, b and the rank in ``_BITS`` bits each.
    """
    table = ranks(path)
    width = max(table.values(), default=0) + 1
    if width >= 1 << _BITS or any(bytes([b]) not in table for b in range(256)):
        raise ValueError(f"{path}: each byte must be a piece, and ranks be below {1 << _BITS}")
    found = []
    for piece, rank in table.items():
        for cut in range(1, len(piece)):
            a, b = table.get(piece[:cut]), table.get(piece[cut:])
            if a is not None and b is not None:
                found.append((a, b, rank))
    rows: list[list[tuple[int, int]]] = [[] for _ in range(max(len(found), width))]
    for a, b, rank in found:
        rows[(a + b * _SPREAD) % len(rows)].append((b, (a << _BITS | b) << _BITS | rank))
    if (0, 0) not in {(a, b) for a, b, _ in found}:
        rows[0].append((0, 1 << 62))  # else an unused element, 0, would be taken for it
    start, held, place = [0] * len(rows), [0] * (2 * len(found) + width + 1), random.Random(0)
    for k in sorted(range(len(rows)), key=lambda k: -len(rows[k])):
        if rows[k]:
            while any(held[start[k] + b] for b, _ in rows[k]):
                start[k] = place.randrange(2 * len(found) + 1)
            for b, value in rows[k]:
                held[start[k] + b] = value
    return start, held


@lru_cache(maxsize=4)
def _unreached(path: str) -> dict[str, int]:
    """Pieces, in hexadecimal digits, that the merges of their bytes do not lead to, and their ranks."""
    table = ranks(path)
    return {p.hex().upper(): r for p, r in table.items() if _heap_merges(p, table) != [r]}


def _numbers(values: list[int], kind: str) -> Column:
    """array of numbers, folded to a literal by the optimizer."""
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)")


def merged(word: Column, path: str) -> Column:
    """ids of one word (binary, or string as UTF-8), or of each word if ``word`` is an array."""
    table, (start, held), known = ranks(path), _pairs(path), _unreached(path)

    def bound(value: Column, body: Callable[[Column], Column]) -> Column:
        # a one-element array binds a value that is used more than once
        return F.transform(F.array(value), body)[0]

    def pair(m: Column, a: Column, b: Column) -> Column:
        """Rank of the piece that ``a`` and ``b`` join to, in its place in a state; ``_APART`` if there is none."""
        key = F.shiftleft(F.shiftleft(a + F.lit(0).cast("long"), _BITS) + b, _BITS)
        found = F.get(m["held"], (F.get(m["start"], ((a + b * _SPREAD) % len(start)).cast("int")) + b).cast("int"))
        return F.shiftleft(F.least(found.bitwiseXOR(key), F.lit(1 << _BITS).cast("long")), 2 * _BITS)

    def piece(s: Column, at: Column) -> Column:
        return F.get(s, at).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))

    def step(m: Column, s: Column) -> Column:
        def join(least: Column, at: Column) -> Column:
            # at counts from 1: pieces at - 1 and at become x, and the rest of the state of at - 1 and at + 1 stays
            x = F.shiftright(least, 2 * _BITS)
            one = pair(m, piece(s, at - 3), x) + F.get(s, at - 2).bitwiseAND(F.lit(_PLACE)) + x
            behind = pair(m, x, piece(s, at)) + F.get(s, at).bitwiseAND(F.lit(_PLACE | (1 << _BITS) - 1))
            rest = F.filter(s, lambda _, i: i != at - 1)
            return F.transform(rest, lambda y, i: F.when(i == at - 2, one).when(i == at - 1, behind).otherwise(y))

        def joined(least: Column) -> Column:
            return F.when(least < _APART, bound(F.array_position(s, least).cast("int"), lambda at: join(least, at))).otherwise(s)

        return bound(F.array_min(s), joined)

    def run(m: Column, pieces: Column) -> Column:
        # element of a state: rank with the piece before it, place of its first byte, piece. The least one is the
        # leftmost of the lowest rank. The last piece, with all bits set, joins with nothing.
        def first(b: Column, i: Column) -> Column:
            rank = F.when(i > 0, pair(m, F.get(pieces, i - 1), b)).otherwise(F.lit(_APART))
            return rank + F.shiftleft(i.cast("long"), _BITS) + b

        ends = F.concat(F.transform(pieces, first), F.array(F.lit(_APART + _PLACE + (1 << _BITS) - 1)))
        done = F.aggregate(F.slice(pieces, 2, F.size(pieces)), ends, lambda s, _: step(m, s))
        ids = F.transform(done, lambda y: y.bitwiseAND(F.lit((1 << _BITS) - 1).cast("long")).cast("int"))
        return bound(ids, lambda p: F.slice(p, 1, F.size(p) - 1))

    def fold(m: Column, w: Column) -> Column:
        digits = F.hex(w.cast("binary"))
        hexed = F.transform(F.regexp_extract_all(digits, F.lit(".."), F.lit(0)), lambda x: F.get(m["bytes"], F.conv(x, 16, 10).cast("int")))
        plain = F.transform(F.split(w.cast("string"), ""), lambda c: F.coalesce(F.get(m["ascii"], F.ascii(c)), F.lit(-1)))
        pieces = bound(plain, lambda x: F.when(F.array_min(x) < 0, hexed).otherwise(x))
        ids = F.when(F.octet_length(w) == 0, F.array().cast("array<int>")).otherwise(bound(pieces, lambda x: run(m, x)))
        if known:
            whole = F.try_element_at(F.create_map(*[F.lit(x) for item in known.items() for x in item]), digits)
            ids = F.when(whole.isNotNull(), F.array(whole)).otherwise(ids)
        return ids

    single = [table[bytes([b])] for b in range(256)]
    parts = {"start": (start, "int"), "held": (held, "long"), "bytes": (single, "int"), "ascii": (single[:128], "int")}
    literal = F.struct(*[_numbers(values, kind).alias(name) for name, (values, kind) in parts.items()])
    return bound(literal, lambda m: F.transform(word, lambda w: fold(m, w)))


def long_word(word: bytes, table: dict[bytes, int]) -> list[int]:
    """The same merges for one long word, by a heap over linked pieces."""
    return [table[word]] if word in table else _heap_merges(word, table)


def _heap_merges(word: bytes, table: dict[bytes, int]) -> list[int]:
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n and (rank := table.get(word[a : end[b]])) is not None:
            heapq.heappush(heap, (rank, a, end[b]))

    for a in range(n):
        offer(a)
    while heap:
        _, a, stop = heapq.heappop(heap)
        b = end[a] if alive[a] else n
        if b >= n or end[b] != stop:
            continue  # one of the two has changed since
        alive[b], end[a] = False, stop
        if stop < n:
            before[stop] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    return [table[word[a : end[a]]] for a in range(n) if alive[a]]


def _few(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, _ROWS):
            yield b.slice(at, _ROWS)


def _gathered(which: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``flat`` one behind the other, and the end of each, from 0."""
    many = sizes[which]
    ends = np.concatenate([[0], np.cumsum(many)])
    return flat[np.repeat(starts[which] - ends[:-1], many) + np.arange(ends[-1])], ends


def _vocabulary(path: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces that are text, and their ranks; once for each worker."""
    store = worker_store("bpe-pieces")
    if path not in store:
        texts = {}
        for piece, rank in ranks(path).items():
            try:
                texts[piece.decode()] = rank
            except UnicodeDecodeError:  # a part of a character
                continue
        store[path] = pa.array(list(texts), pa.string()), np.array(list(texts.values()), "<i4")
    return store[path]


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", then: tuple[Callable, str] | None = None
) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row of ``docs``.

    ``then``: a function over the record batches of this result, and its schema. It runs in the same Python workers, where a
    ``mapInArrow`` behind this one would start another worker for each task.
    """
    rows = slim(docs, id_col, text_col)
    size = max(ranks(path).values()) + 1
    # characters that the JVM's Unicode version does not know may be letters to the tokenizer
    new = (F.octet_length("text") != F.length("text")) & F.col("text").rlike(r"\p{Cn}")
    words = F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))
    rows = rows.select("doc_id", F.when(new, F.col("text")).alias("text"), F.when(~new, words).alias("words"))

    def coded(ids: pa.Array, words: pa.Array, lengths: np.ndarray, kept: pa.Array, fresh: bool) -> tuple[pa.RecordBatch, pa.Array]:
        """Codes of the words of some rows, and the kept words with the new ones.

        A code is an id, or ``size`` plus the number of a kept word. New words are listed in the row that has them first.
        """
        coder = words.dictionary_encode()
        at, distinct = coder.indices.to_numpy(), coder.dictionary
        pieces, numbers = _vocabulary(path)
        spot = pc.index_in(distinct, pieces).fill_null(-1).to_numpy()
        old = pc.index_in(distinct, kept).fill_null(-1).to_numpy()
        long = (pc.binary_length(distinct).to_numpy() > LONG_BYTES) & (spot < 0)
        first = (spot < 0) & (old < 0) & ~long
        code = np.where(spot >= 0, numbers[spot], size + np.where(first, len(kept) + np.cumsum(first) - 1, old)).astype("<i4")
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # distinct words are numbered as they appear
        seen = np.concatenate([[0], np.maximum.accumulate(at) + 1])[ends]
        listed = np.concatenate([[0], np.cumsum(first)])[seen].astype("<i4")
        if long.any():
            flat = [np.array([x], "<i4") for x in code]
            for k in np.flatnonzero(long).tolist():
                flat[k] = np.array(long_word(distinct[k].as_py().encode(), ranks(path)), "<i4")
            sizes = np.array([len(x) for x in flat])
            codes, cuts = _gathered(at, np.concatenate(flat), np.cumsum(sizes) - sizes, sizes)
            ends = cuts[ends]
        else:
            codes = code[at]
        added = distinct.filter(pa.array(first))
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer((4 * ends).astype("<i8")), pa.py_buffer(codes.tobytes())])
        starts = pa.array(np.arange(len(ids)) == 0 if fresh else np.zeros(len(ids), bool))
        rare = pa.ListArray.from_arrays(pa.array(listed), added)
        return pa.RecordBatch.from_arrays([ids, starts, held.cast(pa.binary()), rare], ["doc_id", "fresh", "held", "rare"]), pa.concat_arrays([kept, added])

    def run(batches):
        import regex

        find = regex.compile(pattern).findall
        kept, fresh = pa.array([], pa.string()), True
        for b in batches:
            cut = b.column(2).is_valid()
            lists = [(b.column(0).filter(cut), b.column(2).filter(cut))]
            if len(lists[0][0]) < b.num_rows:
                rest = pc.invert(cut)
                found = [find(x) for x in b.column(1).filter(rest).to_pylist()]
                lists.append((b.column(0).filter(rest), pa.array(found, pa.list_(pa.string()))))
            for ids, found in lists:
                lengths = pc.list_value_length(found).to_numpy()
                turn = np.cumsum(lengths, dtype="int64") // _WORDS
                bounds = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(ids)]
                for x, y in zip(bounds, bounds[1:], strict=False):
                    if x == y:
                        continue
                    out, kept = coded(ids[x:y], found[x:y].flatten().cast(pa.string()), lengths[x:y], kept, fresh)
                    yield out
                    fresh = len(kept) > GROUP
                    if fresh:
                        kept = kept[:0]

    def join(batches):
        single = np.arange(size, dtype="<i4")
        flat, sizes = single, np.ones(size, int)
        for b in batches:
            begins = np.flatnonzero(b.column(1).to_numpy(zero_copy_only=False)).tolist()
            for x, y in zip([0, *begins], [*begins, b.num_rows], strict=True):
                if x in begins:
                    flat, sizes = single, np.ones(size, int)
                part = b.slice(x, y - x)
                folded = part.column(3).flatten()
                flat = np.concatenate([flat, folded.flatten().to_numpy()])
                sizes = np.concatenate([sizes, pc.list_value_length(folded).to_numpy()])
                starts = np.cumsum(sizes) - sizes
                for few in _few([part]):
                    held = few.column(2)
                    codes = np.frombuffer(b"".join(held.to_pylist()), "<i4")
                    ids, cuts = _gathered(codes, flat, starts, sizes)
                    ends = cuts[np.concatenate([[0], np.cumsum(pc.binary_length(held).to_numpy() // 4)])]
                    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids.astype("<i4")))
                    yield pa.RecordBatch.from_arrays([few.column(0), lists.cast(pa.list_(pa.int32()))], ["doc_id", "ids"])

    cut = rows.mapInArrow(run, "doc_id long, fresh boolean, held binary, rare array<string>")
    cut = cut.select("doc_id", "fresh", "held", F.when(F.size("rare") > 0, merged(F.col("rare"), path)).alias("folded"))
    finish, schema = then or (iter, "doc_id long, ids array<int>")
    return cut.mapInArrow(lambda batches: finish(join(batches)), schema)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` (doc_id, ids) with ``decoded``: the pieces of the ids, concatenated."""

    def run(batches):
        pieces = {rank: piece for piece, rank in ranks(path).items()}
        for b in _few(batches):
            out = [b"".join(map(pieces.__getitem__, x.values.to_numpy().tolist())) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(path: str) -> tuple[Callable, str]:
    """For ``then`` of :func:`encode`: doc_id, n_tokens, and SHA-256 of the ids in decimal digits and of the decoded bytes."""
    import hashlib

    def run(batches):
        table = ranks(path)
        pieces, digits = {r: p for p, r in table.items()}, {r: str(r) for r in table.values()}
        for b in _few(batches):
            n, shown, back = [], [], []
            for x in b.column(1):
                ids = x.values.to_numpy().tolist()
                n.append(len(ids))
                shown.append(hashlib.sha256(" ".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(pieces.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(shown), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
