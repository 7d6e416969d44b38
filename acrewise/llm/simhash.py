"""SimHash near-dedup: pigeonhole blocks, a join on blocks, a Hamming check, connected components.

* Fingerprint: 64 bits, each 1 if it is set in over half of the XXH64 hashes (seed 42) of the word shingles.
* Blocks: 64 bits are cut into six blocks. Two fingerprints that differ in at most three bits agree on at least three
  blocks, so each fingerprint is filed under its twenty choices of three blocks, about 32 bits each. Keys that hold
  one fingerprint are dropped by a count; keys that hold many are filed again by three of six parts of the
  remaining bits, which leaves at most 2**17 fingerprints to a key however the data are made.
* Distinct fingerprints are linked, not documents: copies never meet each other. A key yields the edges of a spanning forest of
  its links (each found by comparing fingerprints), never all its pairs; the forests of all keys connect exactly
  what the links connect.
* Components: alternating large-star and small-star joins over those edges, settled in the shared checkpoint folder.

Null and empty texts, and texts without a word, have fingerprint zero and are linked like any other. Repeated rows
share a fingerprint and so a component. ``component_id`` is the smallest id that is not null (null if there is none).
Long texts are hashed in pieces of bounded size. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import slim
from acrewise.scale import settle, stage

MAX_BITS = 3
WIDTHS = (11, 11, 11, 11, 10, 10)
CROWDED = 512
_PIECE = 1 << 16


def _masks(widths, inside: int = (1 << 64) - 1) -> list[int]:
    """Masks of the bits of ``inside`` cut into parts of these widths, from the lowest bit."""
    bits = [i for i in range(64) if inside >> i & 1]
    found, at = [], 0
    for w in widths:
        found.append(sum(1 << i for i in bits[at : at + w]))
        at += w
    return found


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_masks(max_bits: int) -> list[int]:
    blocks = _masks(WIDTHS)
    return [sum(c) for c in combinations(blocks, len(blocks) - max_bits)]


def _inner_masks(mask: int, max_bits: int) -> list[int]:
    """The same again over the bits outside ``mask``."""
    rest = ~mask & (1 << 64) - 1
    n = rest.bit_count()
    blocks = _masks([n // 6 + (i < n % 6) for i in range(6)], rest)
    return [sum(c) for c in combinations(blocks, 6 - max_bits)]


def fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of a UTF-8 text, as a signed 64-bit number."""
    import xxhash

    words = text.lower().split()  # on bytes both know ASCII only: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _PIECE):
        spans = zip(starts[at : at + _PIECE].tolist(), ends[at : at + _PIECE].tolist(), strict=True)
        raw = b"".join([digest(joined[a:b], 42) for a, b in spans])  # big-endian, so bits come highest first
        counts += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(starts)).tobytes()
    return int.from_bytes(bits, "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and ``fp``, one row per row of ``docs``."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most ``max_bits`` differing bits connect among distinct ``fps``."""
    edges, left = [], fps
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                edges += [(int(x), int(y)) for y in found]
                todo += list(found)
                left = left[~near]
    return edges


def _link_keys(rows: DataFrame, max_bits: int) -> DataFrame:
    """Edges inside each (t, k, s, j); the rows of a key are adjacent and bounded in number."""

    def run(batches):
        key, held = None, []

        def flush():
            return _forest(np.unique(np.array(held, np.int64)).view(np.uint64), max_bits) if len(held) > 1 else []

        for b in batches:
            out = []
            t, k, s, j, fp = (b.column(i).to_pylist() for i in range(5))
            for i, mark in enumerate(zip(t, k, s, j, strict=True)):
                if mark != key:
                    out += flush()
                    key, held = mark, []
                held.append(fp[i])
            yield _edges(out)
        yield _edges(flush())

    def _edges(found):
        at = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], ["a", "b"])

    spread = rows.repartition("t", "k", "s", "j").sortWithinPartitions("t", "k", "s", "j")
    return spread.select("t", "k", "s", "j", "fp").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect every pair within ``max_bits`` bits."""
    masks = _block_masks(max_bits)
    outer = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks)])
    filed = fps.select("fp", F.explode(outer).alias("x")).select("fp", "x.t", "x.k")
    shared = filed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = settle(filed.join(shared, ["t", "k"]))

    nothing = [F.lit(-1).alias("s"), F.lit(0).cast("long").alias("j")]
    few = met.where(F.col("n") <= crowded).select("t", "k", *nothing, "fp")
    inner = None
    for t, m in enumerate(masks):
        parts = [F.struct(F.lit(s).alias("s"), F.col("fp").bitwiseAND(F.lit(_signed(x))).alias("j")) for s, x in enumerate(_inner_masks(m, max_bits))]
        inner = F.when(F.col("t") == t, F.array(*parts)) if inner is None else inner.when(F.col("t") == t, F.array(*parts))
    many = met.where(F.col("n") > crowded).select("t", "k", "fp", F.explode(inner).alias("x")).select("t", "k", "x.s", "x.j", "fp")
    return _link_keys(few.unionByName(many), max_bits).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b) but the roots: alternating star joins."""

    def stars(pairs: DataFrame) -> DataFrame:
        # large: every larger neighbour of u goes to the smallest of u and its neighbours
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return down.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    pairs = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    mark = None
    while True:
        pairs = settle(stars(pairs))
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``fp`` and ``component_id``."""
    held = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = held.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(fps, max_bits)).select(F.col("node").alias("fp"), "root")
    rooted = settle(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    # only fingerprints with a link differ from their own first id
    linked = rooted.join(rooted.where("root != fp").select("root").distinct(), "root", "left_semi")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    of = rooted.join(least, "root", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"))
    # a fingerprint may hold a third of all rows: adaptive execution splits that key of the left side
    return held.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, columns unchanged; rows without an id stay."""
    first = near_duplicates(docs, id_col, text_col, **how).where("doc_id = component_id").select(F.col("doc_id").alias("__kept_id")).distinct()
    id_is = F.col(f"`{id_col}`").cast("long")
    named = docs.join(first, id_is == F.col("__kept_id"), "left_semi")
    return named.unionByName(docs.where(id_is.isNull()))
