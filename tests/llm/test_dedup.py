"""Exact, near and line dedup against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from cases import PASSAGE
from check_oracle import compare

from acrewise.llm import exact_dedup, line_dedup, simhash
from acrewise.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, sf, duck):
    assert compare(QUERIES[name](spark, sf), duck, ORACLES[name]) == ""


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits


def brute_components(fps, max_bits=3):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def test_simhash_equals_brute_force(clashing, rows):
    got = sorted((r["doc_id"] or -1, r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(clashing).collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    group = brute_components(fps)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted((i or -1, f, least.get(g)) for (i, _), f, g in zip(rows, fps, group, strict=True))
    assert got == want
    assert len({c for i, _, c in got if i in (1, 3, 16)}) == 1 and len({c for i, _, c in got if i in (4, 5, 6)}) == 1


@pytest.mark.parametrize("crowded", [512, 4])
def test_links_lose_nothing_in_crowded_keys(spark, crowded):
    r = random.Random(5)
    fps = set()
    for _ in range(6):  # dense balls, whose keys are crowded, and far points
        centre = r.getrandbits(64)
        fps |= {centre ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) & (1 << 64) - 1 for _ in range(40)}
        fps.add(r.getrandbits(64))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {f: f - (1 << 64) if f >> 63 else f for f in fps} | {x["node"] & (1 << 64) - 1: x["root"] for x in simhash.components(simhash.links(df, crowded=crowded)).collect()}
    group = brute_components(fps)
    for i in range(len(fps)):
        for j in range(i):
            assert (roots[fps[i]] == roots[fps[j]]) == (group[i] == group[j])


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(1, 61)) and roots[101] == 100


def test_exact_equals_brute_force(clashing, rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    want = []
    for (i, _), t in zip(rows, norm, strict=True):
        ids = [j for (j, _), u in zip(rows, norm, strict=True) if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.duplicates(clashing).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_exact_splits_a_hot_text(spark):
    df = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, 'the  same\ttext', concat('t', id)) as text")
    got = exact_dedup.duplicates(df).where("group_size > 1")
    assert got.selectExpr("min(keep_id)", "max(keep_id)", "min(group_size)", "count(*)", "count_if(kept)").first() == (0, 0, 300, 300, 1)


def brute_lines(rows, least=50):
    """Later copies of maximal repeated runs, over all pairs of windows."""
    docs = []
    for i, t in sorted({(float("inf") if i is None else i, t) for i, t in rows if t}, key=str):
        docs.append((i, t, [(k, x) for k, x in enumerate(t.split("\n")) if WORD.search(x)]))
    docs.sort(key=lambda d: d[0])
    seen, out = set(), {}
    for i, t, lines in docs:
        gone = set()
        spans = []
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(WORD.findall(x)) for _, x in lines[a:b]) >= least:
                    spans.append((a, b))
        # in order of the start, so that an equal window of the same document counts from its second place on
        for a, b in sorted(spans):
            key = tuple(x for _, x in lines[a:b])
            if key in seen:
                gone |= set(range(a, b))
            seen.add(key)
        out[i, t] = gone
    return out, {(i, t): lines for i, t, lines in docs}


def test_line_dedup_equals_brute_force(clashing, rows):
    gone, lines = brute_lines(rows)
    got = line_dedup.dedup_lines(clashing).select("__row.doc_id", "__row.text", "__text", "__deleted").collect()
    assert len(got) == len(rows)
    for r in got:
        key = (float("inf") if r["doc_id"] is None else r["doc_id"], r["text"])
        cut = gone.get(key, set())
        assert r["__deleted"] == len(cut)
        if not cut:
            assert r["__text"] == r["text"]
            continue
        kept = [x for k, (_, x) in enumerate(lines[key]) if k not in cut]
        assert [x for x in r["__text"].split("\n") if WORD.search(x)] == kept
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[8]["__deleted"] > 0 and by_id[7]["__deleted"] == 0 and by_id[15]["__deleted"] == 0
    assert by_id[3]["__text"] == "" or by_id[3]["__deleted"] > 10


def test_line_dedup_stage_keeps_columns_and_drops_what_is_empty(docs):
    cut = line_dedup.without_repeats(docs)
    assert cut.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in cut.collect()}
    assert 3 not in got and 5 in got and 4 in got and got[4]["text"] is None
    assert got[8]["n_chars"] == len(got[8]["text"]) < len(PASSAGE) + 700


@pytest.mark.parametrize("run", [simhash.near_duplicates, exact_dedup.duplicates, line_dedup.dedup_lines, line_dedup.without_repeats, simhash.keep_first_of_group])
def test_empty_table(empty, run):
    assert run(empty).count() == 0
