"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acrewise.llm import bpe, centroids, exact_dedup, line_dedup, lm, middle, packing, pii, quality, secrets, simhash, substring_dedup, warc
from acrewise.llm.registry import ORACLES, QUERIES, query, table


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    thin = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(thin)


_STOPS = ", ".join(f"'{w}'" for w in quality._stop_words())

_QUALITY_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest([0, 1, 2, 3, 4]) AS k FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_STOPS}))) AS stops, len(lines) AS n_lines
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 15.0
       AND n_symbols / greatest(word_chars, 1) <= 0.04
       AND (n_words < 40 OR stops / greatest(n_words, 1) >= 0.02)
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
FROM b
"""


@query("op3_quality", _QUALITY_SQL)
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_LINES_SQL = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines, text FROM documents),
u AS (SELECT doc_id, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS raw FROM t),
l AS (
  SELECT doc_id, raw, line, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS pos,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM u WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l),
w AS (
  SELECT a.doc_id, a.pos AS first, min(b.pos) AS last FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.n >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.pos) AS first, b.pos AS last FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.n >= 50 GROUP BY b.doc_id, b.pos),
x AS (
  SELECT w.doc_id, first, last, string_agg(line, chr(10) ORDER BY pos) AS content, min(raw) AS raw_first, max(raw) AS raw_last
  FROM w JOIN l ON l.doc_id = w.doc_id AND l.pos BETWEEN first AND last GROUP BY ALL),
later AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS copy FROM x QUALIFY copy > 1),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN later ON l.doc_id = later.doc_id AND l.pos BETWEEN later.first AND later.last),
cut AS (
  SELECT DISTINCT u.doc_id, u.raw FROM u JOIN gone a ON a.doc_id = u.doc_id JOIN l la ON la.doc_id = a.doc_id AND la.pos = a.pos
  WHERE la.raw = u.raw
  UNION
  SELECT u.doc_id, u.raw FROM u JOIN l la ON la.doc_id = u.doc_id JOIN l lb ON lb.doc_id = la.doc_id AND lb.pos = la.pos + 1
  JOIN gone a ON a.doc_id = la.doc_id AND a.pos = la.pos JOIN gone b ON b.doc_id = lb.doc_id AND b.pos = lb.pos
  WHERE u.raw > la.raw AND u.raw < lb.raw),
kept AS (
  SELECT u.doc_id, string_agg(u.line, chr(10) ORDER BY u.raw) AS text FROM u
  LEFT JOIN cut ON cut.doc_id = u.doc_id AND cut.raw = u.raw WHERE cut.raw IS NULL GROUP BY u.doc_id),
n AS (SELECT doc_id, count(*) AS n_deleted FROM gone GROUP BY doc_id)
SELECT t.doc_id, coalesce(n.n_deleted, 0)::BIGINT AS n_deleted,
       CASE WHEN n.n_deleted IS NULL THEN t.text ELSE coalesce(kept.text, '') END AS text
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN kept ON kept.doc_id = t.doc_id
"""


@query("op6_line_dedup", _LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("__row.doc_id", F.col("__deleted").alias("n_deleted"), F.col("__text").alias("text"))


_EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


@query("op7_exact_dedup", _EXACT_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> list[Column]:
    base = F.filter("found", lambda x: x["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    return [*counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")]


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_span_digest(found, pii.KINDS))


@query("op4_lm")
def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_span_digest(found, secrets.KINDS))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p GROUP BY html),
h AS (SELECT p.*, g.first, upper(sha1(p.html)) AS hex FROM p JOIN g ON g.html = p.html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


@query("op9_warc", _WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archived(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, then=bpe.digests(path))


_MIDDLE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM t),
c AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
         least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS low, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
         WHEN 'psm' THEN substr(output, 4, strpos(output, '<S>') - 4) || substr(output, strpos(output, '<M>') + 3)
           || substr(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
         ELSE substr(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3)
           || substr(output, strpos(output, '<M>') + 3) || substr(output, 4, strpos(output, '<P>') - 4) END) AS restored_sha256
FROM o
"""


@query("op11_middle", _MIDDLE_SQL)
def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(middle.pieces(table(spark, sf_dir, "documents")))


_WINDOWS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
x AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
later AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY content) AS least FROM x) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM later, (SELECT unnest(range(50)) AS k)),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS text FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.pos = p.pos
  WHERE gone.pos IS NULL GROUP BY p.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


@query("op12_substring_dedup", _WINDOWS_SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Each round in long form: assignment ``a``, then the next centroids ``c``, by component."""
    steps = [
        f"""k AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
v AS (SELECT vec_id, unnest(range(64)) AS pos, unnest(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)) AS x FROM k),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS c FROM k QUALIFY c < {k}),
c0 AS (SELECT s.c, v.pos, v.x FROM s JOIN v ON v.vec_id = s.vec_id)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS (
  SELECT vec_id, c, d FROM (
    SELECT v.vec_id, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c ON c.pos = v.pos GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} AS (
  SELECT a.c, v.pos, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
  FROM a{r} a JOIN v ON v.vec_id = a.vec_id GROUP BY ALL),
c{r + 1} AS (SELECT c.c, c.pos, coalesce(m.x, c.x)::BIGINT AS x FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c AND m.pos = c.pos)"""
            )
    return f"""WITH {", ".join(steps)},
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT a.vec_id, a.c::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN h ON h.c = a.c"""


@query("op13_centroids", _clusters_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLES", "QUERIES"]
