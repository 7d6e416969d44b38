"""Language-model scores: base unigram scores of words, and the marginal likelihood over a subword lattice.

* Vocabulary: the pieces of an existing SentencePiece model. Its scores rank the pieces, and the first weights follow
  the rank (Zipf). ``ROUNDS`` rounds of expectation maximisation over all distinct training words, each weighted by
  its count, turn them into unigram probabilities with one added to every piece.
* Score: every segmentation of a word (behind its word mark) into pieces counts. A forward recursion in log space
  sums them, characters outside the vocabulary go through the byte pieces. A text scores the sum over its words plus its end.
* Corpus statistics are distributed: word counts are combined in the tasks, then by word; the lattice runs once
  for each distinct word. Documents look up the most frequent words, at most HEAD, in a broadcast table and join the
  others by word, where no word can be hot.

Training texts are those whose crc32 of the id (as text; null: empty) mod 7 is not 2. Null text counts as empty: its end
is its only token. Repeated rows are trained on and scored as often as they occur. Extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import most_frequent, slim
from acrewise.scale import stage

HEAD = 1 << 17
#: longer words are joined, so that the broadcast table has a bound in bytes
HEAD_CHARS = 64
FOLDS, HELD_FOLD = 7, 2
#: rounds of expectation maximisation
ROUNDS = 2
_FLUSH = 150_000
_OUT_ROWS = 50_000
_CELLS = 1 << 18
#: starts whose edges are held at a time
_STRETCH = 4096
_MARK = "▁"


def load_pieces(path: str) -> dict:
    """Pieces of a SentencePiece file: ``ranks`` by piece, ``bytes`` as the 256 byte pieces in order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks, of_bytes = {}, [""] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            of_bytes[int(piece[3:5], 16)] = piece
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            ranks[piece] = -sp.get_score(i)
    return {"ranks": ranks, "bytes": of_bytes}


class Lattice:
    """Natural-log weights of pieces, and the recursions over all segmentations for many words of one length at a time.

    The pieces form a trie in sorted arrays. An edge joins the places before and behind a piece; a character that is no
    piece of its own has an edge for its bytes (piece -1). Within one (start, length) a word has one edge at most, so each
    step of a recursion is one vector operation over the words.
    """

    def __init__(self, weights: dict[str, float], of_bytes: list[str]):
        self.names = list(weights)
        self.weights = np.array(list(weights.values()))
        index = {p: i for i, p in enumerate(self.names)}
        self.byte_piece = np.array([index[p] for p in of_bytes])
        nodes: dict[str, int] = {"": 0}
        steps: dict[int, int] = {}
        for piece in weights:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    steps[nodes[piece[: k - 1]] << 21 | ord(piece[k - 1])] = nodes[piece[:k]]
        self.keys = np.array(sorted(steps))
        self.to = np.array([steps[k] for k in self.keys.tolist()])
        self.piece_of = np.full(len(nodes), -1)
        for piece, i in index.items():
            if i not in self.byte_piece:
                self.piece_of[nodes[piece]] = i

    def _edges(self, codes: np.ndarray, lo: int, hi: int) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """By start from ``lo`` to before ``hi``, then length from 1: rows, weights and pieces."""
        rows, n = codes.shape
        row, start = (x.ravel() for x in np.indices((rows, hi - lo)))
        start = start + lo
        node, out, length = np.zeros(len(row), np.int64), [[] for _ in range(hi - lo)], 0
        while len(row):
            key = node << 21 | codes[row, start + length]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[at] == key
            length += 1
            if length == 1:
                lone = np.ones(len(row), bool)
                lone[alive] = self.piece_of[self.to[at[alive]]] < 0
                bytes_row, bytes_start = row[lone], start[lone]
            row, start, node = row[alive], start[alive], self.to[at[alive]]
            piece = self.piece_of[node]
            hit = piece >= 0
            parts = [(row[hit], start[hit], self.weights[piece[hit]], piece[hit])]
            if length == 1:
                chars, back = np.unique(codes[bytes_row, bytes_start], return_inverse=True)
                of = np.array([self.weights[self._bytes(c)].sum() for c in chars.tolist()])
                parts.append((bytes_row, bytes_start, of[back] if len(chars) else np.zeros(0), np.full(len(bytes_row), -1)))
            r, s, w, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(s, kind="stable")
            cuts = np.searchsorted(s[order], np.arange(lo, hi + 1))
            for i in range(hi - lo):
                mine = order[cuts[i] : cuts[i + 1]]
                out[i].append((r[mine], w[mine], p[mine]))
            more = start + length < n
            row, start, node = row[more], start[more], node[more]
        return out

    def _bytes(self, code: int) -> np.ndarray:
        return self.byte_piece[list(chr(code).encode("utf-8", "surrogatepass"))]

    def _stretches(self, codes: np.ndarray, back: bool = False):
        """First start and edges of each bounded stretch of starts, so that a long word needs no more memory than a short one."""
        n = codes.shape[1]
        for lo in sorted(range(0, n, _STRETCH), reverse=back):
            yield lo, self._edges(codes, lo, min(lo + _STRETCH, n))

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """Log weights up to each place, and the edges of the last stretch, which a word of one stretch uses again."""
        alpha, edges = np.full((codes.shape[0], codes.shape[1] + 1), -np.inf), []
        alpha[:, 0] = 0.0
        for lo, edges in self._stretches(codes):
            for i, mine in enumerate(edges, lo):
                for k, (r, w, _) in enumerate(mine, i + 1):
                    if not len(r):
                        continue
                    alpha[r, k] = np.logaddexp(alpha[r, k], alpha[r, i] + w)
        return alpha, edges

    @staticmethod
    def _by_length(words: list[str]):
        """For each length of a marked word: the numbers of the words, and their characters."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            # the characters of one call are bounded, also for long words
            for part in np.array_split(at, min(len(at), -(-len(at) * (size + 1) // _CELLS))):
                text = "".join(_MARK + words[i] for i in part)
                yield part, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64).reshape(len(part), size + 1)

    def scores(self, words: list[str]) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        out = np.zeros(len(words))
        for at, codes in self._by_length(words):
            out[at] = self._forward(codes)[0][:, -1]
        return out

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected number of each piece when each word occurs ``times`` times."""
        found = np.zeros(len(self.names))
        for at, codes in self._by_length(words):
            n = codes.shape[1]
            alpha, last = self._forward(codes)
            beta = np.full_like(alpha, -np.inf)
            beta[:, n] = 0.0
            for lo, edges in [(0, last)] if n <= _STRETCH else self._stretches(codes, back=True):
                pieces, shares = [], []
                for i in range(lo + len(edges) - 1, lo - 1, -1):
                    for k, (r, w, p) in enumerate(edges[i - lo], i + 1):
                        if not len(r):
                            continue
                        beyond = w + beta[r, k]
                        beta[r, i] = np.logaddexp(beta[r, i], beyond)
                        share = np.exp(alpha[r, i] + beyond - alpha[r, n]) * times[at[r]]
                        whole = p >= 0
                        pieces.append(p[whole])
                        shares.append(share[whole])
                        for code, part in zip(codes[r[~whole], i].tolist(), share[~whole].tolist(), strict=True):
                            np.add.at(found, self._bytes(code), part)
                found += np.bincount(np.concatenate(pieces), np.concatenate(shares), len(found))
        return found


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return slim(docs, id_col, text_col).select("doc_id", (digest % FOLDS == HELD_FOLD).alias("held_out"), "text")


def _words(text: pa.Scalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().lower().split()  # on bytes both know ASCII only


def _word_counts(keyed: DataFrame) -> DataFrame:
    """word, c (in training texts), n (in all texts)."""

    def run(batches):
        train, every = Counter(), Counter()

        def out():
            words = list(every)
            cols = [pa.array([w.decode() for w in words], pa.string()), pa.array([train[w] for w in words], pa.int64()), pa.array([every[w] for w in words], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, ["word", "c", "n"])

        for b in batches:
            for held_out, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = _words(text)
                every.update(words)
                if not held_out:
                    train.update(words)
                if len(every) >= _FLUSH:
                    yield out()
                    train, every = Counter(), Counter()
        yield out()

    parts = keyed.select("held_out", "text").mapInArrow(run, "word string, c long, n long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _estimated(words: DataFrame, pieces: dict, train_docs: int, rounds: int) -> tuple[dict[str, float], float]:
    """Natural-log weights of the pieces after ``rounds`` rounds over all training words, and that of the end."""
    names = [*pieces["ranks"], *pieces["bytes"]]
    order = sorted(pieces["ranks"], key=lambda p: (pieces["ranks"][p], p))
    mass = {p: 1.0 / (k + 2) for k, p in enumerate(order)} | {p: 1.0 / (len(order) + 2) for p in pieces["bytes"]}
    total = sum(mass.values())
    weights = {p: math.log(m / total) for p, m in mass.items()}
    for _ in range(rounds):
        # at most one row for each piece of the vocabulary reaches the driver
        rows = _expected(words, weights, pieces["bytes"]).groupBy("piece").agg(F.sum("times").alias("times"))
        times = {r["piece"]: r["times"] for r in rows.collect()}
        total = sum(times.values()) + train_docs + len(names) + 1
        weights = {p: math.log((times.get(p, 0.0) + 1) / total) for p in names}
    return weights, math.log((train_docs + 1) / total)


def _expected(words: DataFrame, weights: dict[str, float], of_bytes: list[str]) -> DataFrame:
    """Expected counts of the pieces under ``weights``, summed in each task."""
    shared = _broadcast(words, (weights, of_bytes))

    def run(batches):
        lattice = Lattice(*shared.value)
        found = np.zeros(len(lattice.names))
        for b in batches:
            found += lattice.expected(b.column(0).to_pylist(), b.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(lattice.names, pa.string()), pa.array(found, pa.float64())], ["piece", "times"])

    return words.where("c > 0").select("word", "c").mapInArrow(run, "piece string, times double")


def _broadcast(df: DataFrame, value):
    return df.sparkSession.sparkContext.broadcast(value)


def _scored(words: DataFrame, weights: dict[str, float], of_bytes: list[str]) -> DataFrame:
    """word, c, n, lm (log10 of the word's marginal probability)."""
    shared = _broadcast(words, (weights, of_bytes))

    def run(batches):
        lattice = Lattice(*shared.value)
        for b in batches:
            lm = lattice.scores(b.column(0).to_pylist()) / math.log(10)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lm, pa.float64())], ["word", "c", "n", "lm"])

    return words.select("word", "c", "n").mapInArrow(run, "word string, c long, n long, lm double")


def _looked_up(keyed: DataFrame, head: dict[bytes, tuple[bool, float, float]]) -> DataFrame:
    """For each text a row (word null) with the sums over its frequent words, and a row for each other word."""
    shared = _broadcast(keyed, head)
    schema = "row long, doc_id long, held_out boolean, word string, n long, known long, base double, lm double"

    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        table = shared.value
        row = TaskContext.get().partitionId() << 40  # unique once it is stored
        texts, others = [], []

        def out():
            rows = texts + [(r, None, None, word.decode(), n, None, None, None) for r, word, n in others]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)], names)

        for b in batches:
            for doc_id, held_out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                row += 1
                known, base, lm, tokens = 0, 0.0, 0.0, 0
                for word, n in Counter(_words(text)).items():
                    tokens += n
                    got = table.get(word)
                    if got is None:
                        others.append((row, word, n))
                    else:
                        known += n * got[0]
                        base += n * got[1]
                        lm += n * got[2]
                texts.append((row, doc_id, held_out, None, tokens, known, base, lm))
                if len(others) >= _OUT_ROWS:
                    yield out()
                    texts, others = [], []
        yield out()

    return keyed.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def scores(docs: DataFrame, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    pieces = load_pieces(pieces_path)
    keyed = _keyed(docs, id_col, text_col)
    words = stage(_word_counts(keyed), "word-counts")
    train_docs = keyed.where("not held_out").count()
    sums = words.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    in_training, distinct = (x or 0 for x in sums)
    train_tokens = in_training + train_docs
    vocabulary = distinct + bool(train_docs)
    floor = math.log10(train_tokens + vocabulary + 1)

    weights, end = _estimated(words, pieces, train_docs, rounds)
    words = stage(_scored(words, weights, pieces["bytes"]), "word-scores")
    common = most_frequent(words, "n", HEAD) & (F.length("word") <= HEAD_CHARS)
    head = {r["word"].encode(): (r["c"] > 0, math.log10(r["c"] + 1), r["lm"]) for r in words.where(common).collect()}
    found = stage(_looked_up(keyed, head), "document-words")

    tail = found.where("word is not null").select("row", "word", F.col("n").alias("times"))
    tail = tail.join(words.where(~common).select("word", "c", F.col("lm").alias("word_lm")), "word")
    rest = tail.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known2"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("base2"),
        F.sum(F.col("times") * F.col("word_lm")).alias("lm2"),
    )
    whole = found.where("word is null").join(rest, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    n_tokens = F.col("n") + 1
    return whole.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (plus("known", "known2") + F.lit(int(train_docs > 0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (plus("base", "base2") + F.lit(math.log10(train_docs + 1)) - n_tokens * F.lit(floor)).alias("base_score"),
        (plus("lm", "lm2") + F.lit(end / math.log(10))).alias("score"),
    )
