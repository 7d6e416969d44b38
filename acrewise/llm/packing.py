"""Best-fit packing of documents into sequences, after a Martello-Toth dominance reduction.

* Documents become token ids and a closing id; those longer than a sequence are cut from their end into full pieces, so
  the first piece may be shorter.
* Only the number of pieces of each length decides how they are packed: at most ``capacity`` numbers, however many
  pieces there are. The reduction and the best-fit run on that histogram on the driver and give a plan of rows "so many
  sequences of this content"; each step of either uses up a length or a group of equal sequences, so the plan is bounded
  by the lengths too, and it is broadcast.
* Pieces find their place by their number among the pieces of their length: a count for each (length, block of ids),
  offsets of the blocks, and a row number inside a block. No length or block is gathered in one task.

Reduction (Martello and Toth): take the pieces from the longest on; all that are left may stand beside it. If nothing fits beside it, it is placed alone. If one more piece at
most fits beside it, or its best partner fills the sequence exactly, or at most two
fit and the best partner is at least as long as the best two together, that pair dominates every other choice and is fixed. Otherwise the piece is left to best-fit.

Null text counts as empty: one piece that holds the closing id only. Repeated rows are packed as often as they
occur; the order among identical rows has no influence. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acrewise.llm.common import slim, worker_store
from acrewise.scale import stage

CAPACITY = 2048
END_ID = 0
#: pieces to a block of the numbering
BLOCK_ROWS = 20_000
#: words in each of the two generations that a worker remembers
CACHE_WORDS = 500_000
_MARKS = "!\"#$%&'()*,-./:;?"


def _encoder(path: str):
    """A function from a text to its ids as little-endian bytes, by the tokenizers library; words are remembered.

    The tokenizer's pattern always cuts before a single space between characters that are not white space, around a
    single line break between such characters, and between letters and the marks behind them, so the text can be encoded
    word by word there; other texts are encoded whole. A worker remembers the words of two generations: when the
    younger is full it becomes the older one, and words that are met again move back.
    """
    import array

    from tokenizers import Tokenizer

    store = worker_store(f"packing:{path}")
    if not store:
        loaded = Tokenizer.from_file(path)
        loaded.encode_special_tokens = True  # their strings in a text are ordinary text
        store.update(tokenizer=loaded, young={}, old={}, marks={})
    tokenizer, marks = store["tokenizer"], store["marks"]

    def ids(text: str) -> bytes:
        return array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def fresh(word: str) -> bytes | None:
        """ids of a word, or None if the text may not be cut around it."""
        core = word[1:] if word[:1] == "\n" else word
        if not core or core[0].isspace() or core[-1].isspace():
            return None
        if core is not word:
            return ids(word)
        letters = word.rstrip(_MARKS)
        tail = word[len(letters) :]
        if not tail or len(tail) > 8 or not letters.isalpha() or max(letters) >= "\u0800":
            return ids(" " + word)
        if tail not in marks:
            marks[tail] = ids(tail)
        return known(letters) + marks[tail]

    def known(word: str) -> bytes | None:
        got = store["young"].get(word)
        if got is None:
            got = store["old"].get(word) or fresh(word)
            if got is not None and len(word) <= 64:
                if len(store["young"]) >= CACHE_WORDS:
                    store["old"], store["young"] = store["young"], {}
                store["young"][word] = got
        return got

    def encode(text: str) -> bytes:
        first, *rest = text.replace("\n", " \n").split(" ")
        if not first or first[0].isspace() or first[-1].isspace():
            return ids(text)
        young = store["young"].get
        out = [ids(first)]
        for word in rest:
            got = young(word) or known(word)
            if got is None:
                return ids(text)
            out.append(got)
        return b"".join(out)

    return encode


def pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length and ``ids`` (little-endian unsigned 32-bit) of every piece."""
    schema = "doc_id long, piece int, start long, length long, ids binary"
    batch_bytes = 16 << 20

    def run(batches):
        encode, end = _encoder(tokenizer_path), end_id.to_bytes(4, "little")
        rows, held = [], 0

        def out():
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                start = 0
                for piece in range(-(-total // capacity)):
                    length = (total % capacity or capacity) if piece == 0 else capacity
                    rows.append((doc_id, piece, start, length, ids[4 * start : 4 * (start + length)]))
                    start += length
                held += len(ids)
                if held >= batch_bytes:
                    yield out()
                    rows, held = [], 0
        yield out()

    return slim(docs, id_col, text_col).mapInArrow(run, schema)


def _reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """Dominating sets as (times, lengths), and the counts that are left for best-fit."""
    counts, fixed = dict(counts), []
    for longest in sorted(counts, reverse=True):
        while counts.get(longest):
            lengths = sorted(x for x, n in counts.items() if n)
            room = capacity - longest

            def free(x: int, used: int = longest) -> int:
                return counts[x] - (x == used)

            fitting = [x for x in lengths if x <= room and free(x) > 0]
            if not fitting:
                times = counts[longest]
                fixed.append((times, [longest]))
                counts[longest] -= times
                continue
            best, least = fitting[-1], fitting[0]
            least_two = 2 * least if free(least) > 1 else least + (fitting[1] if len(fitting) > 1 else capacity)
            dominates = best == room or least_two > room
            if not dominates:
                # the best two that fit together, by two pointers over the lengths
                two, i, j = 0, 0, len(fitting) - 1
                while i <= j and two < room:
                    x, y = fitting[i], fitting[j]
                    if x + y > room or (i == j and free(x) < 2):
                        j -= 1
                    else:
                        two = max(two, x + y)
                        i += 1
                # three pieces beside it would have to be weighed too
                dominates = best >= two and 3 * least > room
            if not dominates:
                break
            # the verdict holds while the partner lasts; then it is asked again
            times = counts[longest] // 2 if best == longest else min(counts[longest], counts[best])
            fixed.append((times, [longest, best]))
            counts[longest] -= times
            counts[best] -= times
    return fixed, {x: n for x, n in counts.items() if n}


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing over groups of equal sequences."""
    groups: dict[int, list[tuple[int, list[int]]]] = {}
    rooms: list[int] = []

    def add(room: int, times: int, content: list[int]) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append((times, content))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, times, content = capacity, left, []
            else:
                room = rooms[at]
                times, content = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            # the fullest sequence takes pieces until no more fit, then the next one
            each = room // length
            whole = min(times, left // each)
            if whole:
                add(room - each * length, whole, content + [length] * each)
            rest = left - whole * each if whole < times else 0
            if rest:
                add(room - rest * length, 1, content + [length] * rest)
                whole += 1
            if content and times > whole:
                add(room, times - whole, content)
            left -= (whole - bool(rest)) * each + rest
    return [g for same in groups.values() for g in same]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from, to, first sequence, pieces of the length to a sequence, offset): which numbers go where."""
    fixed, later = _reduce({x: n for x, n in counts.items() if n}, capacity)
    rows, used, sequence = [], {}, 0
    for times, content in fixed + _best_fit(later, capacity):
        if not times:
            continue
        offset = 0
        for length in dict.fromkeys(content):
            each = content.count(length)
            start = used.get(length, 0)
            used[length] = start + times * each
            rows.append((length, start, used[length], sequence, each, offset))
            offset += each * length
        sequence += times
    return rows


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (doc_id, piece, length, ...) with sequence_id and offset; they are stored once and keep their columns."""
    spark = rows.sparkSession
    held = stage(rows, "pieces")
    total = held.count()
    blocks = total // BLOCK_ROWS + 1
    held = held.withColumn("__block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int"))
    counted = held.groupBy("length", "__block").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = "length long, from long, to long, sequence long, each long, at long"
    places = F.broadcast(spark.createDataFrame(plan(histogram, capacity), schema).withColumnRenamed("length", "__length"))

    before = Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "__block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__block").orderBy(*[F.col(f"`{c}`") for c in rows.columns if c != "length"])
    numbered = held.withColumn("__n", F.row_number().over(inside) - 1).join(offsets, ["length", "__block"])
    numbered = numbered.withColumn("__n", F.col("__n") + F.col("__before"))
    # the plan is an interval lookup; equal lengths make it a hash join on a broadcast side
    placed = numbered.join(places, (F.col("length") == F.col("__length")) & (F.col("__n") >= F.col("from")) & (F.col("__n") < F.col("to")))
    k = F.col("__n") - F.col("from")
    return placed.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("sequence") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the concatenated ``ids`` of its pieces; a sequence holds at most ``capacity`` ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(rows, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
