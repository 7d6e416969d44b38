"""Fill-in-middle, substring dedup and centroid clusters against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from acrewise.llm import centroids, middle, substring_dedup

LAST = 1 << 70


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def seeded(i):
    return sha("1:" + ("" if i is None else str(i)))


# fill-in-middle ------------------------------------------------------------------------------------------


def brute_middle(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), [int(seeded(i)[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, n, "plain", None, None, sha(text), sha(text)), text
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{mid}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{mid}"
    return (i, n, form, len(prefix), len(mid), sha(output), sha(text)), output


def middle_rows(rows):
    return [*rows, (100, "a<P>b"), (101, "<" * 50 + "S>"), (102, "S>M>P><<S" * 9), (None, None), (None, None), (103, "é日本🎉" * 30_000 + "abc" * 40_000)]


def test_middle_equals_brute_force(spark, rows):
    rows = middle_rows(rows)
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, th string, pos int").repartition(3)
    got = [tuple(r) for r in middle.digests(middle.pieces(docs)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(brute_middle(*r)[0]) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_middle_outputs_are_the_texts_and_restore(spark, rows):
    rows = middle_rows(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = middle.texts(middle.pieces(docs)).collect()
    got = [(r["doc_id"], r["output"]) for r in made for _ in range(r["copies"])]
    assert sorted(map(repr, got)) == sorted(repr((i, brute_middle(i, t)[1])) for i, t in rows)
    assert sorted({middle.rebuilt(r["output"].encode(), r["form"]).decode() for r in made}) == sorted({t or "" for _, t in rows})


def test_middle_of_nothing(empty):
    assert middle.digests(middle.pieces(empty)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 1000])
@pytest.mark.parametrize("form", ["psm", "spm"])
def test_marks_are_found_across_piece_borders(size, form):
    parts = {"prefix": "<P" + "é<S", "middle": "", "suffix": "M><<M"}
    output = "".join(middle.MARKS[p].decode() + parts[p] for p in middle.ORDERS[form]).encode()
    chunks = [output[k : k + size] for k in range(0, len(output), size)]
    found = {p: b"" for p in range(3)}
    for place, chunk in middle.placed(chunks, form):
        found[place] += chunk
    assert [found[k].decode() for k in range(3)] == [parts[p] for p in middle.PARTS]


def test_pieces_are_bounded_and_end_at_units(monkeypatch):
    monkeypatch.setattr(middle, "PIECE", 10)
    monkeypatch.setattr(middle, "_BLOCK", 7)
    text = "abc déf🎉 " * 20 + "x" * 35 + " 日本"
    data = np.frombuffer(text.encode(), np.uint8)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert middle.units(data) == len(units)
    ends = [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]
    assert middle.unit_offsets(data, list(range(len(units) + 1))) == ends
    chunks = list(middle._chunks(data, 0, len(data)))
    assert b"".join(chunks) == text.encode() and max(map(len, chunks)) <= 14
    for c in chunks:
        c.decode()


# substring dedup -----------------------------------------------------------------------------------------


def brute_windows(rows, size=50):
    split = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            mark = hashlib.md5(b" ".join(w[k : k + size])).digest()
            least[mark] = min(least.get(mark, LAST + 1), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if least[hashlib.md5(b" ".join(w[k : k + size])).digest()] < i:
                gone[k : k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if i == LAST else i, len(w), sum(gone), sha(kept), kept.decode()))
    return out


def shared_texts(rows):
    """Passages cut out of a few sources at all offsets, some texts over a million bytes, copies that differ in white space."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    sources = [[r.choice(words) for _ in range(r.randrange(30, 400))] for _ in range(12)]
    out = list(rows)
    for k in range(120):
        parts = []
        for _ in range(r.randrange(1, 4)):
            s = r.choice(sources)
            at = r.randrange(len(s))
            parts += s[at : at + r.randrange(20, 120)] + [r.choice(words) for _ in range(r.randrange(30))]
        out.append((200 + k, r.choice([" ", "\n", " \t "]).join(parts)))
    big = " ".join(f"{r.choice(words)}{r.randrange(50)}" for _ in range(260_000))
    assert len(big) > 1_200_000
    middle_part = big[1_000_000 : 1_000_000 + 120_000]
    out += [(900, big), (901, "x " * 77 + middle_part + " y" * 60), (None, middle_part), (903, "q" * 70_000 + " " + big[:9000])]
    out += [(904, out[-1][1].replace(" ", "\n ")), (904, out[-1][1]), (210, "same id " + out[30][1])]
    # exactly a window, one word less, and a window that only its own text repeats
    passage = " ".join(f"p{k}" for k in range(50))
    out += [(920, "a b " + passage), (921, passage + " c"), (922, passage[: passage.rindex(" ")]), (923, "u " + " ".join(["own"] * 120))]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_substring_dedup_equals_brute_force(spark, rows, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    rows = shared_texts(rows)
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, th string, at int").repartition(5)
    if hot:
        texts = docs.selectExpr("xxhash64(coalesce(text, '')) AS th", "coalesce(text, '') AS text")
        assert len(substring_dedup._hot(texts)) > 2
    got = sorted(repr(tuple(r)) for r in substring_dedup.dedup_substrings(docs).collect())
    want = brute_windows(rows)
    assert got == sorted(repr(w[:4]) for w in want)
    removed = {w[0]: w[2] for w in want}
    assert removed[921] == 50 and removed[920] == removed[922] == removed[923] == 0 and removed[901] > 1000


def test_substring_dedup_gives_the_texts(spark, rows):
    rows = shared_texts(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {w[4] for w in brute_windows(rows) if w[2]}
    got = {r["text"] for r in substring_dedup.without_repeats(docs).collect()}
    assert got | {""} == want | {""}


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.dedup_substrings(empty).collect() == []


def test_cover_and_pieces(monkeypatch):
    pairs = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert pairs == set(range(substring_dedup.PERIOD))
    text = " ".join(f"w{k}" for k in range(3000)).encode() + b" \n" + b"z" * 2000 + b" end"
    whole = substring_dedup.Words([text])
    every = {k: int(h) for k, h in enumerate(whole.hashes(np.arange(len(whole.owner) - 49), 50, 1))}
    for size in (700, 5000):
        monkeypatch.setattr(substring_dedup, "PIECE", size)
        found = {}
        for keys, firsts, owns, words in substring_dedup._grouped([(0, text), (1, b"a b"), (2, b"")]):
            at = np.flatnonzero(substring_dedup._whole(words, 50, owns))
            for k, h in zip(at, words.hashes(at, 50, 1), strict=True):
                place = int(k - words.first[words.owner[k]] + firsts[words.owner[k]])
                assert keys[words.owner[k]] == 0 and place not in found
                found[place] = int(h)
        assert found == every
        starts = np.array([3, 40, 1000, 2950])
        kept = list(substring_dedup.kept_words(text, starts))
        words = text.split()
        gone = {x for s in starts.tolist() for x in range(s, s + 50)}
        assert b"".join(p for p, _ in kept) == b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert sum(n for _, n in kept) == len(gone)


# centroid clusters ---------------------------------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3, dims=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    centers = [v for _, v in sorted(kept, key=lambda r: (seeded(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        own = [[] for _ in centers]
        for _, v in kept:
            own[near(v)[1]].append(v)
        centers = [[sum(z) // len(m) for z in zip(*m, strict=True)] if m else c for m, c in zip(own, centers, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = [sum(d for _, c, d in found if c == j) for j in range(len(centers))]
    return sorted(repr((i, c, d, total[c], sum(total), sha(",".join(map(str, centers[c]))))) for i, c, d in found)


def odd_vectors():
    r = random.Random(1)
    bad = [(5, None), (6, []), (7, [1.0, None, 2.0, 3.0]), (8, [float("nan")] * 4), (9, [float("inf"), 0.0, 0.0, 0.0]), (11, [1.0] * 5)]
    return [(i, [float(r.randrange(3)) for _ in range(4)]) for i in range(100, 160)] + [(None, [1.0, 2.0, 3.0, 4.0])] * 3 + [*bad, (10, [1e5, -1e5, 0.3, -0.3])]


@pytest.mark.parametrize("k", [1, 2, 16, 100])
def test_clusters_equal_brute_force_on_ties_and_odd_rows(spark, k):
    rows = odd_vectors()
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(3)
    got = sorted(repr(tuple(r)) for r in centroids.clusters(table, k=k, dims=4).collect())
    assert got == brute_clusters(rows, k=k, dims=4)


def test_clusters_equal_brute_force_on_embeddings(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert sorted(repr(tuple(r)) for r in centroids.clusters(table).collect()) == brute_clusters(rows)


def test_clusters_of_nothing_and_of_too_large_components(spark):
    table = spark.createDataFrame(odd_vectors(), "vec_id long, embedding array<double>")
    assert centroids.clusters(table.limit(0), dims=4).collect() == []
    with pytest.raises(Exception, match="too large"):
        centroids.clusters(spark.createDataFrame([(1, [1e9, 0.0])], table.schema), dims=2).collect()


def test_bounds_are_never_too_high_and_spare_distances():
    r = np.random.default_rng(3)
    for scale in (3, 300, 1 << 26):
        centers = r.integers(-scale, scale, (16, 64))
        x = centers[r.integers(0, 16, 3000)] + r.integers(-scale // 3 - 1, scale // 3 + 1, (3000, 64))
        pivots = centroids.pivots_of(centers)
        cached = np.sqrt(np.stack([centroids._squared(x, p) for p in pivots], 1).astype(float))
        of = np.sqrt(np.stack([centroids._squared(centers, p) for p in pivots], 1).astype(float))
        between = np.sqrt(np.stack([centroids._squared(pivots, p) for p in pivots], 1).astype(float))
        exact = np.stack([centroids._squared(x, c) for c in centers], 1)
        assert (centroids.bounds(cached, of, between) ** 2 * (1 - 1e-13) <= exact).all()
        cluster, distance, checked = centroids.nearest(x, cached, centers, pivots)
        assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
        assert checked < 0.8 * exact.size
