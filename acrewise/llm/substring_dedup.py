"""Substring dedup: repeated word windows found by anchors at the positions of a difference cover.

A word is removed if a window of ``WINDOW`` words that covers it also starts in a document with a smaller id.

* ``COVER`` is a difference cover modulo ``PERIOD``: for any two residues there is a shift below ``PERIOD`` that brings both into
  the cover. So two equal windows, wherever they start, share an anchor of ``ANCHOR = WINDOW - PERIOD + 1`` words that stands at a
  cover position in both documents, at the same place of the window. Only these anchors (6 of 31 positions) are hashed and
  shuffled; an anchor found in one text alone is of no use.
* A shared anchor extends to the windows around it. Only documents that hold one come into the second step, and only windows
  around such anchors: a 128-bit hash of the whole window meets its equals, and the smallest id among them decides. A window is
  a row and a text an anchor at most once; no pair of documents or windows is ever formed.
* Texts with the same words are one text for this: the row with the smallest id stands for all. Of the others every word
  is removed if they have a window at all. A task sends the anchors of equal texts once.
* Anchors that very many documents share are found on a sixty-fourth of the texts, ``HOT`` at most. They are taken as shared, and
  the windows that contain one (at any position, so that equal windows agree) meet in as many parts as there are partitions, the
  least of the parts then once more. Other windows meet in one partition. Both ways give the same rows; the list only spreads the work.

Long texts are worked on in pieces of about ``PIECE`` bytes that overlap by a window. Null and empty texts have no words.
Rows with equal id are never smaller than each other; a null id is larger than every other id. Repeated rows get a result each.
Only the two named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acrewise.llm.common import SPACE, partitions, slim
from acrewise.scale import stage

WINDOW = 50
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1
PIECE = 1 << 20
#: frequent anchors dealt with aside: how many at most, and from which share of the sampled texts on
HOT, HOT_SHARE, SAMPLE = 4096, 0.01, 64
_SEEN = 1 << 17
_LAST = (1 << 63) - 1

_RANDOM = np.random.default_rng(12)
#: two hashes: a number for each byte, and an odd base that is 3 modulo 8, so that swapped bytes never agree
_BYTE = _RANDOM.integers(0, 1 << 64, (2, 256), np.uint64)
_BASE = (_RANDOM.integers(0, 1 << 64, 2, np.uint64) & ~np.uint64(7)) | np.uint64(3)
_UNDO = [np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASE]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE >> 4), base, np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(steps)
    return have[:n]


class Words:
    """Words of some texts laid end to end: where they start and end in ``data`` (one blank between words), and whose they are."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        blank = _IS_SPACE[raw]
        before = np.concatenate([[True], blank[:-1]])
        keep = ~(blank & before)
        self.data = np.where(blank[keep], np.uint8(32), raw[keep])
        ends = np.flatnonzero(self.data == 32)
        self.ends = ends
        self.starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        begin = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        first_word = np.flatnonzero(before & ~blank)  # in raw bytes
        self.owner = np.searchsorted(begin, first_word, "right") - 1
        self.first = np.searchsorted(self.owner, np.arange(len(texts)))  # number of each text's first word
        self.sums: dict[int, np.ndarray] = {}

    def hashes(self, at: np.ndarray, size: int, which: int) -> np.ndarray:
        """Hash number ``which`` of the ``size`` words from each word number in ``at``."""
        if which not in self.sums:
            values = _BYTE[which][self.data] * _power(_BASE[which], len(self.data))
            self.sums[which] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        sums, start, end = self.sums[which], self.starts[at], self.ends[at + size - 1]
        x = (sums[end] - sums[start]) * _power(_UNDO[which], len(self.data))[start]
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return (x ^ (x >> np.uint64(29))).view(np.int64)


def _cut(text: bytes) -> Iterator[tuple[int, bytes, int]]:
    """Pieces of a text: number of the first word, the piece, and how many words from it on start a window or anchor here.

    Pieces overlap by ``WINDOW - 1`` words; the last one owns all its words.
    """
    at, first, size = 0, 0, PIECE
    while True:
        end = at + size
        blank = _BLANK.search(text, end) if end < len(text) else None
        if blank is None:
            piece = text[at:]
            yield first, piece, len(piece.split()) if at else 1 << 62
            return
        piece = text[at : blank.start()]
        marks = Words([piece])
        own = len(marks.owner) - WINDOW + 1
        if own <= 0:
            size *= 2
            continue
        yield first, piece, own
        # bytes of the piece before word number ``own``
        raw = np.frombuffer(piece, np.uint8)
        blank_at = _IS_SPACE[raw]
        at += int(np.flatnonzero(np.concatenate([[True], blank_at[:-1]]) & ~blank_at)[own])
        first, size = first + own, PIECE


def _grouped(rows: Iterable[tuple[tuple, bytes]]) -> Iterator[tuple[list, list[int], list[int], Words]]:
    """Texts together as long as they are short: keys, first word numbers, words each may start from, and the words."""
    keys, firsts, owns, texts, total = [], [], [], [], 0
    for key, text in rows:
        for first, piece, own in _cut(text):
            keys.append(key)
            firsts.append(first)
            owns.append(own)
            texts.append(piece)
            total += len(piece)
            if total >= PIECE:
                yield keys, firsts, owns, Words(texts)
                keys, firsts, owns, texts, total = [], [], [], [], 0
    if texts:
        yield keys, firsts, owns, Words(texts)


def _whole(words: Words, size: int, owns: list[int]) -> np.ndarray:
    """Whether ``size`` words of one text start at each word, and the piece owns that start."""
    n = len(words.owner)
    inside = np.zeros(n, bool)
    if n >= size:
        inside[: n - size + 1] = words.owner[: n - size + 1] == words.owner[size - 1 :]
        inside &= np.arange(n) - words.first[words.owner] < np.array(owns)[words.owner]
    return inside


def _bytes(cell: pa.Scalar) -> bytes:
    return cell.as_buffer().to_pybytes()


def anchors(keyed: DataFrame) -> DataFrame:
    """th, at, a: the anchors of every text (columns th, text) at cover positions; texts too short for a window have none."""
    in_cover = np.isin(np.arange(PERIOD), COVER)

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            fresh = []
            for th, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if th not in seen:
                    seen.add(th)
                    fresh.append((th, text))
            if len(seen) > _SEEN:
                seen = set()
            for keys, firsts, owns, words in _grouped((th, _bytes(t)) for th, t in fresh):
                number = np.arange(len(words.owner)) - words.first[words.owner] + np.array(firsts)[words.owner] if len(words.owner) else np.zeros(0, int)
                at = np.flatnonzero(_whole(words, ANCHOR, owns) & in_cover[number % PERIOD])
                cols = [np.array(keys, np.int64)[words.owner[at]], number[at].astype(np.int32), words.hashes(at, ANCHOR, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["th", "at", "a"])

    return keyed.mapInArrow(run, "th long, at int, a long")


def _hot(texts: DataFrame) -> np.ndarray:
    """The anchors that more than a hundredth of the sampled texts hold, the most frequent ones, sorted."""
    some = texts.where(F.pmod(F.xxhash64("th", F.lit(7)), F.lit(SAMPLE)) == 0)
    enough = max(8.0, HOT_SHARE * some.count())
    often = anchors(some.select("th", "text")).groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
    return np.sort(np.array([r["a"] for r in often.orderBy(F.desc("n")).limit(HOT).collect()], np.int64))


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _salt(hot: Column, spark: SparkSession) -> Column:
    """-1, or for frequent keys a part of the rows of a key, as many parts as there are shuffle partitions."""
    return F.when(hot, F.pmod(F.xxhash64("th", F.lit(3)), F.lit(partitions(spark)))).otherwise(F.lit(-1))


def _shared(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """th, ats: cover positions of each text whose anchor another text has too."""

    def mark(batches):
        for b in batches:
            yield b.append_column("hot", pa.array(_member(b.column(2).to_numpy(), hot)))

    found = anchors(texts.select("th", "text")).mapInArrow(mark, "th long, at int, a long, hot boolean")
    group = Window.partitionBy("a", "salt")
    met = found.select("th", "at", "a", _salt(F.col("hot"), texts.sparkSession).alias("salt"))
    met = met.withColumn("low", F.min("th").over(group)).withColumn("high", F.max("th").over(group))
    both = met.where((F.col("low") != F.col("high")) | (F.col("salt") >= 0)).select("th", "at")
    return both.groupBy("th").agg(F.collect_set("at").alias("ats"))


def _windows(candidates: DataFrame, hot: np.ndarray) -> DataFrame:
    """id, th, at, h1, h2, hot: the windows around shared anchors."""

    def run(batches):
        for b in batches:
            ids, ths, ats = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)

            def rows(b=b, ids=ids, ths=ths, ats=ats):
                for i, cell in enumerate(b.column(3)):
                    yield (ids[i], ths[i], np.sort(ats[i].values.to_numpy())), _bytes(cell)

            for keys, firsts, owns, words in _grouped(rows()):
                near = np.zeros(len(words.owner), bool)
                for k, (key, first) in enumerate(zip(keys, firsts, strict=True)):
                    begin = words.first[k]
                    n = (words.first[k + 1] if k + 1 < len(keys) else len(words.owner)) - begin
                    at = key[2] - first
                    at = at[(at >= 0) & (at < n + PERIOD)]
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, np.clip(at - PERIOD + 1, 0, n), 1)
                    np.add.at(change, np.clip(at + 1, 0, n), -1)
                    near[begin : begin + n] = np.cumsum(change)[:n] > 0
                at = np.flatnonzero(near & _whole(words, WINDOW, owns))
                often = np.zeros(len(at), bool)
                if len(hot) and len(at):
                    starts = np.flatnonzero(_whole(words, ANCHOR, [1 << 62] * len(keys)))
                    counts = np.zeros(len(words.owner) + 1, np.int64)
                    counts[starts + 1] = _member(words.hashes(starts, ANCHOR, 0), hot)
                    counts = np.cumsum(counts)
                    often = counts[at + PERIOD] > counts[at]
                owner = words.owner[at]
                number = at - words.first[owner] + np.array(firsts)[owner] if len(at) else at
                cols = [
                    np.array([k[0] for k in keys], np.int64)[owner], np.array([k[1] for k in keys], np.int64)[owner], number.astype(np.int32),
                    words.hashes(at, WINDOW, 0), words.hashes(at, WINDOW, 1), often,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "th", "at", "h1", "h2", "hot"])

    return candidates.mapInArrow(run, "id long, th long, at int, h1 long, h2 long, hot boolean")


def _later(windows: DataFrame) -> DataFrame:
    """id, th, starts: the windows that also start in a text with a smaller id."""
    rows = windows.select("id", "th", "at", "h1", "h2", _salt(F.col("hot"), windows.sparkSession).alias("salt"))
    met = rows.withColumn("least", F.min("id").over(Window.partitionBy("h1", "h2", "salt")))
    # a larger id is settled; of a frequent window the least of each part are left, and keep their hash
    open_yet = F.col("id") == F.col("least")
    left = [F.when(open_yet, F.col(c)).alias(c) for c in ("h1", "h2")]
    held = stage(met.where(~open_yet | (F.col("salt") >= 0)).select("id", "th", "at", *left), "met")
    parts = held.where("h1 is not null").withColumn("first", F.min("id").over(Window.partitionBy("h1", "h2"))).where("id > first")
    found = held.where("h1 is null").select("id", "th", "at").unionByName(parts.select("id", "th", "at"))
    return found.groupBy("id", "th").agg(F.collect_set("at").alias("starts"))


def kept_words(text: bytes, starts: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """The words outside the windows at ``starts`` (sorted), joined by one blank, in pieces, and the number removed in each."""
    at, first, lead = 0, 0, b""
    while at < len(text):
        blank = _BLANK.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = blank.start() if blank else len(text)
        words = text[at:end].split()
        change = np.zeros(len(words) + 1, np.int64)
        near = starts[(starts > first - WINDOW) & (starts < first + len(words))] - first
        np.add.at(change, np.maximum(near, 0), 1)
        np.add.at(change, np.minimum(near + WINDOW, len(words)), -1)
        gone = np.cumsum(change)[:-1] > 0
        piece = b" ".join([w for w, x in zip(words, gone.tolist(), strict=True) if not x])
        yield (lead + piece if piece else b""), int(gone.sum())
        lead = b" " if piece else lead
        at, first = end, first + len(words)


def _facts(texts: DataFrame) -> DataFrame:
    """id, th, n_words and ``sha`` (of the words joined by a blank) of every row; ``least``, the smallest id with the same words."""
    joined = F.trim(F.regexp_replace("text", SPACE + "+", " "))
    n = F.when(joined == "", 0).otherwise(F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit(""))) + 1)
    facts = stage(texts.select("id", "th", n.cast("long").alias("n_words"), F.sha2(joined, 256).alias("sha")), "facts")
    least = facts.where(F.col("n_words") >= WINDOW).groupBy("sha").agg(F.min("id").alias("least"))
    return stage(facts.join(least, "sha", "left"), "facts")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The facts of every row, and id, th, text, starts of the texts with windows to be removed (equal texts once, under their least id)."""
    thin = slim(docs, id_col, text_col)
    texts = thin.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("th"), "text")
    facts = _facts(texts)
    hot = _hot(texts)
    firsts = facts.where("id = least").select("id", "th").distinct()
    wanted = stage(_shared(texts, hot).join(firsts, "th"), "anchors")
    candidates = stage(texts.join(wanted, ["id", "th"]).select("id", "th", "ats", "text"), "candidates")
    later = stage(_later(_windows(candidates, hot)), "windows")
    return facts, candidates.join(later, ["id", "th"]).select("id", "th", "text", "starts")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a blank)."""
    facts, repeated = repeated_windows(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            out = []
            for cell, starts in zip(b.column(2), b.column(3), strict=True):
                total, removed = hashlib.sha256(), 0
                for piece, gone in kept_words(_bytes(cell), np.sort(starts.values.to_numpy())):
                    total.update(piece)
                    removed += gone
                out.append((removed, total.hexdigest()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["id", "th", "removed", "kept"])

    cut = repeated.mapInArrow(run, "id long, th long, removed long, kept string").dropDuplicates(["id", "th"])
    whole = F.col("id") > F.col("least")
    removed = F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long")
    sha = F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha"))
    number = F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id")
    return facts.join(cut, ["id", "th"], "left").select(number, "n_words", removed.alias("n_removed"), sha.alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id (null: the largest long), th (XXH64 of the text) and ``text``, the kept words joined by a blank, of the texts that lose a part.

    Texts whose words all stay, and later texts with the same words as another (they lose all), are not in it.
    """
    _, repeated = repeated_windows(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            kept = [b"".join(p for p, _ in kept_words(_bytes(c), np.sort(s.values.to_numpy()))).decode() for c, s in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kept, pa.string())], ["id", "th", "text"])

    return repeated.mapInArrow(run, "id long, th long, text string").dropDuplicates(["id", "th"])
