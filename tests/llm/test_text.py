"""Quality rules, secrets, personal data and language-model scores."""

import base64
import gzip
import itertools
import math
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from acrewise.llm import lm, pii, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_equals_brute_force(clashing, rows):
    got = quality.quality(clashing).collect()
    want = Counter((i, *brute_quality(t)) for i, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert {1, 2, 7, 8} <= kept and not kept & {4, 5, 6, 11, 13, 14, 15}


def test_quality_keeps_rows_as_they_were(clashing):
    kept = quality.keep_good(clashing)
    assert kept.dtypes == clashing.dtypes
    assert Counter(map(str, kept.collect())) <= Counter(map(str, clashing.collect()))


def test_quality_agrees_with_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality(docs).join(labels, "doc_id").where("not base_failed")
    clean = judged.where("quality = 1")
    assert clean.where("not kept").count() == 0


SECRET = 'password="hunter2secret99"'


@pytest.mark.parametrize(
    "wrapped",
    [
        urllib.parse.quote(SECRET, safe=""),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        base64.b64encode(SECRET.encode()).decode(),
        base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        base64.b64encode(gzip.compress(zlib.compress(SECRET.encode()))).decode(),
        urllib.parse.quote(base64.b64encode(zlib.compress(urllib.parse.quote(SECRET).encode())).decode(), safe=""),
        base64.b64encode(base64.b64encode(SECRET.encode())).decode(),
    ],
)
def test_secret_in_layers_is_found_at_its_place(wrapped):
    text = f"é before {wrapped} after"
    found = [s for s in secrets.all_spans(text) if not s[3]]
    assert len(found) == 1 and secrets.KINDS[found[0][1]] == "assign"
    start, _, end, _ = found[0]
    assert text.index(wrapped) == start and end <= start + len(wrapped) and end - start >= 0.8 * len(wrapped)


def test_secret_layers_end_and_keep_the_base(rows):
    quine = "%25" * 50 + base64.b64encode(zlib.compress(b"plain words only, nothing hidden")).decode()
    assert secrets.all_spans(quine) == []
    for _, text in rows:
        spans = secrets.all_spans(text or "")
        assert sorted(secrets.scan(text or "")) == sorted((a, k, b) for a, k, b, own in spans if own)
    assert [(secrets.KINDS[k], own) for _, k, _, own in secrets.all_spans(rows[9][1])] == [("assign", True), ("access", True), ("hex", True)]
    assert secrets.all_spans("a" * 200_000 + "%4" + "\\u00" * 1000) == [(0, 2, 200_000, True)]


def test_secrets_of_a_table(clashing, empty):
    got = {r["doc_id"]: r["found"] for r in secrets.find(clashing).collect()}
    assert got[4] == [] and len(got[10]) == 3 and secrets.find(empty).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(BASE[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda m, digits: True,
                "ip": lambda m, digits: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda m, digits: 13 <= len(digits) <= 19
                and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda m, digits: 9 <= len(digits) <= 15,
            }[kind]
            if ok(m, digits):
                out.append((k, m.start(), m.end()))
    return out


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e x@y z@w.v. .@-.-",
        "1.2.3.4.5.6.7.8 001.002.3.255 256.1.1.1 1.2.3",
        "4111-1111 1111-1111 4111111111111111 0000000000000000 12",
        "+1 (407) 555-7710 +12 +1234567890 1 + +1((((((((2 ++49 30 1234567",
        "a..b@c.d,e_f%g@h-i.j-k.l é@ü.com ab@cd.ef@gh.ij",
    ],
)
def test_base_patterns_equal_the_plain_ones(text):
    assert pii.base_spans(text) == brute_pii(text)


def test_personal_data_of_a_table(clashing, empty, rows):
    found = {r["doc_id"]: r["found"] for r in pii.find(clashing).collect()}
    texts = dict(rows)
    for i, text in texts.items():
        assert [(s["kind"], s["start"], s["end"]) for s in found[i] if s["base"]] == [(pii.KINDS[k], a, b) for k, a, b in brute_pii(text or "")]
    assert {s["kind"] for s in found[9]} == set(pii.KINDS) and found[1] == []
    assert pii.find(empty).count() == 0


def test_messages_give_exact_marginals_on_a_chain():
    r = np.random.default_rng(3)
    n, kinds = 4, 3
    model = {"weights": r.normal(size=(3 * 2, kinds)), "chain": r.normal(size=(kinds, kinds)), "skip": np.zeros((kinds, kinds))}
    x, chain, none = r.normal(size=(n, 2)), np.array([[0, 1], [1, 2], [2, 3]]), np.zeros((0, 2), int)
    unary = pii._log_softmax(pii._context(x, chain) @ model["weights"])
    want = np.zeros((n, kinds))
    for labels in itertools.product(range(kinds), repeat=n):
        p = math.exp(sum(unary[i, k] for i, k in enumerate(labels)) + sum(model["chain"][labels[a], labels[b]] for a, b in chain))
        for i, k in enumerate(labels):
            want[i, k] += p
    want /= want.sum(1, keepdims=True)
    assert np.allclose(pii.marginals(model, x, chain, none, rounds=60), want, atol=1e-6)


def test_skip_edges_carry_a_label_to_a_distant_like_token():
    kinds = len(pii.KINDS) + 1
    agree = 3 * np.eye(kinds) - 1
    model = {"weights": np.zeros((2 * 3, kinds)), "chain": np.zeros((kinds, kinds)), "skip": agree}
    model["weights"][0, 4] = 8.0
    x = np.array([[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]])
    none = np.zeros((0, 2), int)
    p = pii.marginals(model, x, none, np.array([[0, 1]]))
    assert p[0].argmax() == p[1].argmax() == 4 and p[1, 4] > 0.8 and np.allclose(p[2], 1 / kinds)


def test_field_adds_a_repeat_that_the_pattern_misses(spark):
    rows = [(i, f"Call +1 (2{i:02d}) 555-{1000 + i} now or mail us{i}@mail.example.com please") for i in range(60)]
    rows += [(100, "The number 555-1001-777 is known. " * 2), (101, "no 12 or 7 here")]
    found = {r["doc_id"]: r["found"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.5).collect()}
    assert all(len(found[i]) == 2 for i in range(60)) and found[101] == []


def test_masking_changes_only_the_spans(docs):
    got = pii.without_personal_data(docs)
    assert got.dtypes == docs.dtypes
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[9]["text"].startswith("Mail <EMAIL> or <PHONE>, host <IP> and 999.1.1.1, card <CARD>, not ")
    assert by_id[9]["n_chars"] == len(by_id[9]["text"]) and by_id[4]["text"] is None
    assert pii.masked("ab cd", [{"kind": "ip", "start": 0, "end": 4}, {"kind": "card", "start": 3, "end": 5}]) == "<IP>"


def segmentations(word, weights):
    if not word:
        yield 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in weights:
            for rest in segmentations(word[k:], weights):
                yield weights[word[:k]] + rest


def test_lattice_sums_all_segmentations():
    pieces = {p: math.log(q) for p, q in {"▁": 0.1, "▁a": 0.2, "a": 0.1, "b": 0.1, "ab": 0.2, "aba": 0.05, "▁ab": 0.1}.items()}
    of_bytes = [f"<{b}>" for b in range(256)]
    lattice = lm.Lattice(pieces | {p: math.log(0.001) for p in of_bytes}, of_bytes)
    for word in ("", "a", "ab", "ababab", "bbaab"):
        want = math.log(sum(math.exp(x) for x in segmentations("▁" + word, pieces)))
        assert lattice.scores([word])[0] == pytest.approx(want)
        counts = dict(zip(lattice.names, lattice.expected([word], np.array([2.0])), strict=True))
        assert sum(len(p) * n for p, n in counts.items()) == pytest.approx(2.0 * (len(word) + 1))
    assert lattice.scores(["é"])[0] == pytest.approx(math.log(0.1) + 2 * math.log(0.001))
    counts = dict(zip(lattice.names, lattice.expected(["aé", "b", "é"], np.array([1.0, 1.0, 3.0])), strict=True))
    assert counts["<195>"] == counts["<169>"] == pytest.approx(4.0) and counts["b"] == pytest.approx(1.0)


def test_scores_equal_brute_force(clashing, empty, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = lm.scores(clashing, path).collect()
    assert len(got) == len(rows)
    lower = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in lower(t))
    ends = sum(not held[i] for i, _ in rows)
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    texts = dict(rows)
    for r in got:
        words = lower(texts[r["doc_id"]])
        base = sum(math.log10((c + 1) / (total + distinct + 1)) for c in [*[counts[w] for w in words], ends])
        assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(words) + 1 and r["train_tokens"] == total
        assert r["n_known"] == sum(w in counts for w in words) + 1
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert lm.scores(empty, path).count() == 0
