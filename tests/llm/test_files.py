"""Packing, byte-level BPE, archives and the pipeline."""

import base64
import hashlib
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from cases import similar_groups
from pyspark.sql import functions as F

from acrewise.llm import bpe, packing, pii, quality, warc

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="session")
def tokens(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows]


def test_pieces_and_places(clashing, tokens, empty):
    cut = packing.pieces(clashing, JSON)
    got = packing.pack(cut).collect()
    whole = {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 2048 and (r["piece"] == 0 or r["length"] == 2048)
        whole.setdefault(r["doc_id"], []).append((r["start"], ids))
    for i, ids in tokens:
        parts = sorted(whole[i])
        want = (ids + [0]) * (len([1 for j, _ in tokens if j == i]))
        if i == 16:  # two equal rows
            assert len(parts) % 2 == 0 and sorted(sum((p for _, p in parts), [])) == sorted(want)
            continue
        assert sum((p for _, p in parts), []) == want and [s for s, _ in parts] == [sum(len(q) for _, q in parts[:k]) for k in range(len(parts))]
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    for parts in used.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(used) <= -(-total // 2048) + 1
    assert packing.pack(packing.pieces(empty, JSON)).count() == 0


def test_sequences_join_their_pieces(docs):
    packed = packing.pack(packing.pieces(docs, JSON))
    want = {}
    for r in sorted(packed.collect(), key=lambda r: r["offset"]):
        want[r["sequence_id"]] = want.get(r["sequence_id"], b"") + r["ids"]
    assert {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()} == want


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 50, 2048])
    counts = {r.randint(1, capacity): r.choice([1, 2, 3, 50, 1000]) for _ in range(r.randint(1, 60))}
    bins, seen = {}, {}
    for length, start, stop, sequence, each, offset in packing.plan(counts, capacity):
        assert seen.get(length, 0) == start
        seen[length] = stop
        for k in range(stop - start):
            bins.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert seen == counts
    for parts in bins.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    assert sorted(bins) == list(range(len(bins)))


def fewest(lengths, capacity):
    """Fewest sequences by search over set partitions of a few pieces."""
    best = [len(lengths)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[k] and rooms[j] not in rooms[:j]:
                go(k + 1, rooms[:j] + [rooms[j] - lengths[k]] + rooms[j + 1 :])
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_fewest_sequences_reachable():
    r = random.Random(9)
    for _ in range(150):
        lengths = sorted((r.randint(2, 20) for _ in range(8)), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        fixed, later = packing._reduce(counts, 20)
        rest = [x for x, n in later.items() for _ in range(n)]
        assert sum(times for times, _ in fixed) + fewest(sorted(rest, reverse=True), 20) == fewest(lengths, 20)


def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library_and_comes_back(clashing, rows, empty):
    enc = reference()
    got = bpe.decode(bpe.encode(clashing, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == enc.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_digests_run_in_the_workers_that_join_the_ids(clashing, rows):
    enc, texts = reference(), dict(rows)
    out = bpe.encode(clashing, RANKS, public_tokenizers.PATTERN, then=bpe.digests(RANKS))
    # the words are looked up in one worker of a task and the folded ones put in by a second; no third one
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = enc.encode_ordinary(texts[r["doc_id"]] or "")
        shown, back = " ".join(map(str, ids)).encode(), (texts[r["doc_id"]] or "").encode()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(back).hexdigest())


def test_fold_and_heap_merge_alike(spark):
    r = random.Random(4)
    words = ["".join(r.choice("abcdehilnorst 日é") for _ in range(r.randint(1, 40))) for _ in range(60)]
    enc, table = reference(), bpe.ranks(RANKS)
    got = spark.createDataFrame([(words,)], "w array<string>").select(bpe.merged(F.col("w"), RANKS).alias("ids")).first()["ids"]
    for w, ids in zip(words, got, strict=True):
        assert ids == bpe.long_word(w.encode(), table) == enc._encode_single_piece(w)


def test_bpe_keeps_no_words_of_the_whole_table(spark, monkeypatch):
    """Nothing is counted over the table or broadcast; words kept in a task, and dropped, are invisible in the result."""
    texts = ["the then\u0378 thenner " + "aaa" * 300, None, "", "thenner  zzyzx\n the", "\u0378 thenner \u65e5\u672c"] * 3
    docs, enc = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), reference()
    for group in (bpe.GROUP, 0):
        monkeypatch.setattr(bpe, "GROUP", group)
        out = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
        assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert {r["doc_id"]: r["ids"] for r in out.collect()} == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert not hasattr(bpe, "_known_words")


PAGES = [(1, "http://a/b c", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://é/\r\nX: y", None), (4, "u", ""), (None, "v", "<p>x</p>"), (5, "w", "z" * 70_000), (6, "w", "ü日"), (6, "w2", "ü日")]


def test_archives_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES * 1, "page_id long, url string, html string").withColumn("sha", F.lit(1))
    pages = pages.union(spark.range(100, 400).selectExpr("id", "concat('http://h/', id)", "concat('<html><body>page ', id, ' of the same kind</body></html>')", "1"))
    path = f"file://{tmp_path}/warc"
    warc.write(pages, path)
    got = warc.read(spark, path).collect()
    assert len(got) == pages.count()
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    x = base64.b32encode(hashlib.sha1(b"<p>x</p>").digest()).decode()
    assert [(r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for i in (1, 2, None) for r in by[i]] == [
        ("revisit", 2, x, 8),
        ("response", None, x, 8),
        ("revisit", 2, x, 8),
    ]
    assert by[3][0]["refers_to"] == 4 and by[4][0]["payload_bytes"] == 0 and bytes(by[5][0]["payload"]) == b"z" * 70_000
    assert [r["record_type"] for r in by[6]] == ["response"] * 2 and "\r" not in by[3][0]["url"] and by[2][0]["url"] == "urn:x-page:2"
    archives = [f.read_bytes() for f in tmp_path.glob("warc/part-*")]
    assert archives and all(a[:4] == b"\x5d\x2a\x4d\x18" for a in archives)
    records = [x for a in archives for x in warc.frames(a)]
    assert sum(x.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for x in records) == len(archives)


def test_archives_of_small_payloads_and_none(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write(pages, f"file://{tmp_path}/a", least_bytes=9)
    assert {r["record_type"] for r in warc.read(spark, f"file://{tmp_path}/a").collect()} == {"response"}
    assert warc.archived(pages.limit(0)).count() == 0


def test_pipeline_stages_equal_their_operators(spark, docs, rows, tokens):
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    good = {(r["doc_id"], r["text"]) for r in quality.quality(docs).where("kept").join(docs, "doc_id").select("doc_id", "text").collect()}
    # a join on ids drops the row without one, which passes the rules
    good |= {(i, t) for i, t in rows if i is None}
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(repr(r) for r in rows if r in good)
    cut = corpus_pipeline.line_dedup_stage(spark, kept, "")
    assert cut.columns == docs.columns and cut.count() < kept.count()
    alone = corpus_pipeline.near_dedup(spark, docs, "")
    firsts, _ = similar_groups([r for r in rows if r[0] is not None])
    assert {r["doc_id"] for r in alone.collect()} == firsts | {None}
    clean = corpus_pipeline.personal_data(spark, docs, "")
    assert clean.columns == docs.columns and all(not pii.base_spans(r["text"] or "") for r in clean.collect())
    packed = corpus_pipeline.pack(spark, docs, "").collect()
    crc = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in packed}
    for i, ids in tokens:
        if len(ids) < 2048:
            assert crc[i, 0] == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())


def test_pipeline_of_an_empty_table(spark, empty):
    step = empty
    for _, apply in corpus_pipeline.STAGES:
        step = apply(spark, step, "")
    assert step.count() == 0
