"""Line dedup over a suffix array of line ids, built by distributed prefix doubling.

A document is its sequence of lines that hold a word. A run is repeated if the same lines, ``min_words`` words or more
together, stand at an earlier place (order: id, then line); a line that lies in such a later run is deleted.

* Round 0 ranks the lines that occur twice or more. Round k+1 ranks a start by the ranks of its first and second 2**k
  lines; a start whose prefix occurs once leaves the table, so the rounds shrink, and at most log2(min_words) of them
  are needed, because ``min_words`` lines always hold ``min_words`` words. Ranks are unique numbers of a stored
  table; which of two different prefixes comes first has no influence.
* Suffixes that share their first e lines form an interval of the suffix array with a longest common prefix of at least
  e. The interval of a window is found from two overlapping ranks of its length. The earliest member stays.
* Windows are the shortest ones that reach ``min_words``, once from each first and once to each last line: together they
  cover exactly the maximal repeated runs, and each costs one row, however long the runs and many the copies.

Joins are on (document, line) or on ranks with one row on the other side; a line that a third of all documents share
is one partial count per task and a split key in the rank joins (adaptive execution). Texts meet no other text: they
are shuffled once, to apply the deletions.

Null text counts as empty, which has no lines and stays as it is. Rows with equal id and equal text are one document
and get the same result. A null id is ordered last. A run that repeats inside its own document counts too, also where it
overlaps itself. Lines without a word are deleted inside a deleted run only. Other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acrewise.scale import settle, stage

MIN_WORDS = 50
_LAST = (1 << 63) - 1


def _windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest window with ``least`` words from each line, and up to each line; 0 if there is none."""
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(total, total[:-1] + least, "left")
    from_here = np.where(end <= len(words), end - np.arange(len(words)), 0)
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    up_to = np.where(start >= 0, np.arange(1, len(words) + 1) - start, 0)
    return from_here, up_to


def _line_rows(keyed: DataFrame, min_words: int) -> DataFrame:
    """One row per line with a word: document key, ``at`` among these lines, ``raw`` among all, content, windows."""
    schema = "id long, th long, at int, raw int, h1 long, h2 long, ahead int, back int"

    def run(batches):
        import xxhash

        for b in batches:
            out = [[] for _ in range(8)]
            for i, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                lines = text.as_buffer().to_pybytes().split(b"\n")
                counts = [len(x.split()) for x in lines]
                raw = [k for k, n in enumerate(counts) if n]
                if not raw:
                    continue
                ahead, back = _windows(np.array([counts[k] for k in raw]), min_words)
                marks = np.frombuffer(b"".join([xxhash.xxh3_128_digest(lines[k]) for k in raw]), np.int64)
                for col, part in zip(out, ([i] * len(raw), [th] * len(raw), range(len(raw)), raw, marks[::2], marks[1::2], ahead, back), strict=True):
                    col.extend(part)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return keyed.mapInArrow(run, schema)


def _ranked(rows: DataFrame, prefix: list[str]) -> DataFrame:
    """id, th, at, rank for the rows whose ``prefix`` occurs more than once."""
    names = rows.groupBy(*prefix).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    names = settle(names.select(*prefix, F.monotonically_increasing_id().alias("new_rank")))
    return settle(rows.join(names, prefix).select("id", "th", "at", F.col("new_rank").alias("rank")))


def _later_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """id, th, first, last: windows with an equal window before them, in numbers of lines with a word."""
    ranks = _ranked(lines.select("id", "th", "at", "h1", "h2"), ["h1", "h2"])
    levels, size = ranks.withColumn("k", F.lit(0)), 1
    while 2 * size <= min_words:
        after = ranks.select("id", "th", (F.col("at") - size).alias("at"), F.col("rank").alias("rank2"))
        ranks = _ranked(ranks.join(after, ["id", "th", "at"]), ["rank", "rank2"])
        size *= 2
        levels = levels.unionByName(ranks.withColumn("k", F.lit(size.bit_length() - 1)))

    ahead = lines.where("ahead > 0").select("id", "th", F.col("at").alias("first"), F.col("ahead").alias("e"))
    back = lines.where("back > 0").select("id", "th", (F.col("at") - F.col("back") + 1).alias("first"), F.col("back").alias("e"))
    spans = ahead.unionByName(back).distinct()
    k = F.floor(F.log2(F.col("e") + F.lit(0.5))).cast("int")
    tail = (F.col("first") + F.col("e") - F.pow(F.lit(2), F.col("k"))).cast("int")
    spans = spans.withColumn("k", k).withColumn("tail", tail)
    head_rank = levels.select("id", "th", "k", F.col("at").alias("first"), F.col("rank").alias("r1"))
    tail_rank = levels.select("id", "th", "k", F.col("at").alias("tail"), F.col("rank").alias("r2"))
    found = spans.join(head_rank, ["id", "th", "k", "first"]).join(tail_rank, ["id", "th", "k", "tail"])
    found = settle(found.select("id", "th", "first", "e", "k", "r1", "r2"))
    interval = ["e", "k", "r1", "r2"]
    earliest = found.groupBy(*interval).agg(F.min(F.struct("id", "th", "first")).alias("keep"), F.count(F.lit(1)).alias("n"))
    later = found.join(earliest.where("n > 1"), interval).where(F.struct("id", "th", "first") > F.col("keep"))
    return later.select("id", "th", "first", (F.col("first") + F.col("e") - 1).alias("last"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The deleted runs of each document: id, th (hash of the text), ``runs`` as (first, last) raw line numbers, n_deleted."""
    keyed = docs.select(*_key(id_col, text_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    lines = stage(_line_rows(keyed, min_words), "lines").dropDuplicates(["id", "th", "at"])
    later = _later_windows(lines, min_words)
    # windows that overlap or touch become one run
    order = Window.partitionBy("id", "th").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = later.distinct().withColumn("new", F.coalesce(F.col("first") > before + 1, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("new").over(order)).groupBy("id", "th", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    at_first = lines.select("id", "th", F.col("at").alias("first"), F.col("raw").alias("raw_first"))
    at_last = lines.select("id", "th", F.col("at").alias("last"), F.col("raw").alias("raw_last"))
    runs = runs.join(at_first, ["id", "th", "first"]).join(at_last, ["id", "th", "last"])
    span = F.struct(F.col("raw_first").alias("first"), F.col("raw_last").alias("last"))
    return runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(span)).alias("runs"), F.sum(F.col("last") - F.col("first") + 1).alias("n_deleted"))


def _key(id_col: str, text_col: str):
    number = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("id")
    return number, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("th")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` as ``__row``, with the remaining ``__text`` and the number ``__deleted`` of deleted lines with a word."""
    runs = repeated_runs(docs, id_col, text_col, min_words).withColumnsRenamed({"id": "__id", "th": "__th", "runs": "__runs", "n_deleted": "__n"})
    number, mark = _key(id_col, text_col)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), text.alias("__text"), number.alias("__id"), mark.alias("__th"))
    inside = lambda i: F.exists("__runs", lambda r: (i >= r["first"]) & (i <= r["last"]))
    left = F.array_join(F.filter(F.split("__text", "\n"), lambda _, i: ~inside(i)), "\n")
    cut = F.when(F.col("__runs").isNull(), F.col("__text")).otherwise(left)
    return rows.join(runs, ["__id", "__th"], "left").select("__row", cut.alias("__text"), F.coalesce("__n", F.lit(0)).cast("long").alias("__deleted"))


def without_repeats(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **how) -> DataFrame:
    """``docs`` with the later copies cut out of the texts, ``length_col`` brought up to date where it exists, and
    without the documents of which nothing but white space is left after a deletion."""
    cut = dedup_lines(docs, text_col=text_col, **how)
    cut = cut.where((F.col("__deleted") == 0) | F.col("__text").rlike(r"[^\x20\x09-\x0D]"))
    new = {text_col: F.col("__text")}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("__deleted") > 0, F.length("__text")).otherwise(F.col("__row")[length_col])
    kinds = dict(docs.dtypes)
    return cut.select(*[(new[c].cast(kinds[c]) if c in new else F.col("__row")[c]).alias(c) for c in docs.columns])
