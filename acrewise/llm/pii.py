"""Personal data: exact patterns, and a skip-chain conditional random field that adds what repeats or continues them.

* Base: emails, ip addresses, card and phone numbers by pattern and check (:func:`base_spans`). They always stay.
* Field: the nodes are the tokens that hold a digit or an ``@``; all other tokens are known to be outside. Neighbouring
  tokens share a chain potential; tokens of equal or similar spelling, however far apart in the document, share a
  skip potential (each is joined to the next one like it, so the edges grow with the tokens). Loopy sum-product
  messages give each node its marginal, and a token whose best kind reaches ``threshold`` becomes a span.
* Fit: node weights by multinomial logistic regression, chain and skip potentials by agreement counts, on the tokens of at
  most ``sample`` documents with such tokens and at most ``sample_chars`` characters each, taken in the order of a hash
  of their id from about ``LOOK_AT`` times as many; the labels are the base spans. The bound holds for the fit alone: every document is scanned whole.

Documents are independent rows: nothing is shuffled but the fit's sample. Null text counts as empty and has no span;
repeated rows get the same spans; extra columns are ignored; without labelled tokens the field adds nothing.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import bounded_sample, slim

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS, THRESHOLD, ROUNDS = 3000, 20_000, 0.95, 6

#: documents that are looked at for each one that the fit may take
LOOK_AT = 20

# no pattern starts inside a run that an earlier start has failed on, so long runs cost linear time
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str):
    floor, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        if m:
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                floor = m.end()
                yield start, floor
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0]) if m.end() - m.start() < 64 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


_EDGE = "\"'`,;:!?()[]{}<>#*$%&|."


def nodes(text: str) -> list[tuple[int, int, int]]:
    """(number among the document's words, start, end) of the tokens that hold a digit or an @, without outer marks."""
    if not _DIGIT.search(text) and "@" not in text:
        return []
    found = []
    for k, m in enumerate(_TOKEN.finditer(text)):
        word = m[0]
        if "@" in word or _DIGIT.search(word):
            core = word.strip(_EDGE)
            start = m.start() + word.find(core) if core else m.start()
            found.append((k, start, start + (len(core) or len(word))))
    return found


def _features(word: str) -> list[float]:
    n = len(word)
    digits = sum(c in "0123456789" for c in word)
    letters = sum(c.isalpha() for c in word)
    parts = word.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)
    plain = re.sub(r"[-]", "", word)
    return [
        1.0,
        "@" in word,
        "@" in word and "." in word[word.find("@") :],
        quad,
        word.startswith("+"),
        letters > 0,
        digits == n,
        digits / n if n else 0.0,
        min(n, 40) / 20,
        digits < 4,
        4 <= digits <= 8,
        9 <= digits <= 12,
        13 <= digits <= 19,
        digits > 19,
        plain.isdigit() and 13 <= len(plain) <= 19 and _luhn(plain),
        word.count("-") / 4,
        word.count(".") / 4,
    ]


def _like(word: str) -> str:
    """Tokens with an equal value here count as similar: digits alone when there are many, else the folded spelling."""
    digits = "".join(c for c in word if c in "0123456789")
    return digits if len(digits) >= 7 and "@" not in word else word.casefold()


def _graph(docs: list[tuple[str, list[tuple[int, int, int]]]]):
    """Features, and chain and skip edges of the nodes of several documents, numbered through."""
    feats, chain, skip, base = [], [], [], 0
    for text, found in docs:
        last: dict[str, int] = {}
        for k, (at, a, b) in enumerate(found):
            word = text[a:b]
            feats.append(_features(word))
            if k and found[k - 1][0] == at - 1:
                chain.append((base + k - 1, base + k))
            like = _like(word)
            if like in last:
                skip.append((last[like], base + k))
            last[like] = base + k
        base += len(found)
    x = np.array(feats, float).reshape(-1, len(_features("0")))
    return x, np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2)


def _context(x: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Own features, then those of the chain neighbours on both sides (zero where there is none)."""
    left, right = np.zeros_like(x), np.zeros_like(x)
    left[chain[:, 1]], right[chain[:, 0]] = x[chain[:, 0]], x[chain[:, 1]]
    return np.hstack([x, left, right])


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def marginals(model: dict, x: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product in log space; all messages of a round at once."""
    unary = _log_softmax(_context(x, chain) @ model["weights"])
    ends = np.vstack([chain, chain[:, ::-1], skip, skip[:, ::-1]])
    if not len(ends):
        return np.exp(unary)
    c, s, kinds = len(chain), len(skip), unary.shape[1]
    pair = np.empty((len(ends), kinds, kinds))
    pair[:c], pair[c : 2 * c], pair[2 * c :] = model["chain"], model["chain"].T, model["skip"]
    back = np.concatenate([np.arange(c, 2 * c), np.arange(c), 2 * c + np.arange(s, 2 * s), 2 * c + np.arange(s)])
    sent = np.zeros((len(ends), kinds))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, ends[:, 1], sent)
        carried = belief[ends[:, 0]] - sent[back]
        new = np.logaddexp.reduce(carried[:, :, None] + pair, axis=1)
        sent = 0.5 * sent + 0.5 * (new - new.max(1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, ends[:, 1], sent)
    return np.exp(_log_softmax(belief))


def _labels(found, spans) -> list[int]:
    """Label of each node: 0 outside, else 1 + kind of a base span that covers it."""
    out = []
    for _, a, b in found:
        out.append(next((1 + k for k, s, e in spans if s < b and a < e), 0))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> dict:
    """Weights of the field; see the module for the bounded sample."""
    chosen = bounded_sample(slim(docs, id_col, text_col), F.col("doc_id"), LOOK_AT * sample)
    rows = chosen.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= sample_chars))
    texts = [r["text"] for r in rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(sample).select("text").collect()]
    held = [(t, nodes(t)) for t in texts]
    x, chain, skip = _graph(held)
    y = np.array([k for t, found in held for k in _labels(found, base_spans(t))], int)
    kinds = len(KINDS) + 1
    full = _context(x, chain)
    weights = np.zeros((full.shape[1], kinds))
    if not len(y):
        return {"weights": weights, "chain": np.zeros((kinds, kinds)), "skip": np.zeros((kinds, kinds))}
    target = np.eye(kinds)[y]
    velocity = np.zeros_like(weights)
    for _ in range(600):
        gap = full.T @ (np.exp(_log_softmax(full @ weights)) - target) / len(y) + 1e-4 * weights
        velocity = 0.9 * velocity - 0.5 * gap
        weights = weights + velocity

    def agreement(edges: np.ndarray) -> np.ndarray:
        joint = np.full((kinds, kinds), 0.5)
        np.add.at(joint, (y[edges[:, 0]], y[edges[:, 1]]), 1)
        joint /= joint.sum()
        return np.clip(np.log(joint / joint.sum(1, keepdims=True) / joint.sum(0, keepdims=True)), -3, 3)

    return {"weights": weights, "chain": agreement(chain), "skip": agreement(np.vstack([skip, skip[:, ::-1]]))}


def _added(held, model: dict, threshold: float) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds to each (text, nodes, base spans)."""
    x, chain, skip = _graph([(t, found) for t, found, _ in held])
    if not len(x):
        return [[] for _ in held]
    p = marginals(model, x, chain, skip)
    best, out, at = p.argmax(1), [], 0
    for text, found, spans in held:
        mine: list[tuple[int, int, int]] = []
        previous = None
        for k, (word, a, b) in enumerate(found):
            kind = int(best[at + k])
            if not kind or p[at + k, kind] < threshold or any(s < b and a < e for _, s, e in spans):
                continue
            if previous == (word - 1, kind):  # the same kind continues in the next word
                mine[-1] = (mine[-1][0], mine[-1][1], b)
            else:
                mine.append((kind - 1, a, b))
            previous = (word, kind)
        at += len(found)
        out.append(mine)
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and ``found``: (kind, start, end, base) of every span, by kind, then start; one row per row of ``docs``."""
    model = fit(docs, id_col, text_col) if model is None else model
    return slim(docs, id_col, text_col).mapInArrow(_finder(model, threshold), f"doc_id long, {_FOUND}")


_FOUND = "found array<struct<kind: string, start: int, end: int, base: boolean>>"
_FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _scan(texts: list[str], model: dict, threshold: float) -> list[list[dict]]:
    bases = [base_spans(t) for t in texts]
    busy = [(i, nodes(t)) for i, t in enumerate(texts)]
    busy = [(i, found) for i, found in busy if found]
    extra = dict(zip([i for i, _ in busy], _added([(texts[i], found, bases[i]) for i, found in busy], model, threshold), strict=True))
    out = []
    for i, spans in enumerate(bases):
        rows = sorted([(*s, True) for s in spans] + [(*s, False) for s in extra.get(i, [])])
        out.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in rows])
    return out


def _finder(model: dict, threshold: float):
    def run(batches):
        for b in batches:
            found = _scan(b.column(1).to_pylist(), model, threshold)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _FOUND_TYPE)], ["doc_id", "found"])

    return run


def masked(text: str, spans: list[dict]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the kind of its first: ``<EMAIL>``."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def without_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with personal data masked, ``length_col`` brought up to date where it exists; null texts stay null."""
    model = fit(docs, id_col, text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    row_type = packed.schema["__row"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            found = _scan([t or "" for t in texts], model, threshold)
            new = [masked(t, s) if s else t for t, s in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], ["__row", "__text"])

    done = packed.mapInArrow(run, f"__row {row_type}, __text string")
    kinds = dict(docs.dtypes)
    new = {text_col: F.col("__text")}
    if length_col in docs.columns:
        same = F.col("__text").eqNullSafe(F.col("__row")[text_col].cast("string"))
        new[length_col] = F.when(same, F.col("__row")[length_col]).otherwise(F.length("__text"))
    return done.select(*[(new[c].cast(kinds[c]) if c in new else F.col("__row")[c]).alias(c) for c in docs.columns])
