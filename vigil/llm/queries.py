"""Registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (byte_bpe, collocations, decontaminate, fingerprints, hard_negatives, langid, licenses,
                       line_dedup, mixing, near_dedup, passages, token_counts, warc)
from vigil.llm.base import set_batch_rows, table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    set_batch_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"), table_path(spark, "warc"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("items")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.duplicate_lines(_table(spark, sf_dir, "documents")).drop("n_rows")
    return out.withColumn("removed_lines", F.concat_ws(",", F.col("removed_lines").cast("array<string>")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vector are moved on by one: near rows of another label then exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = byte_bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), vocabulary)
    return byte_bpe.digests(byte_bpe.decode(encoded, vocabulary))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_near_dedup, op2_warc, op3_decontaminate, op4_fingerprints, op5_langid, op6_passages,
    op7_licenses, op8_mixing, op9_token_counts, op10_line_dedup, op11_collocations, op12_hard_negatives,
    op13_byte_bpe, pipeline)}


# -- DuckDB oracles --------------------------------------------------------------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = f"coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), [])"
_ALNUM_WORDS = f"coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP1_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS} AS w FROM documents),
sh AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i+2], ' ') for i in range(1, len(w) - 1)] END) AS s FROM w),
d AS (SELECT DISTINCT doc_id, s FROM sh),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN d USING (doc_id) GROUP BY 1),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM d a JOIN d b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m.b, n.doc_id)) AS component_id,
       n.doc_id <= coalesce(m.b, n.doc_id) AS kept
FROM n LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY 1) m ON m.a = n.doc_id
"""

OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""

OP3_SQL = f"""
WITH w AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, s, len(string_split(s, ' ')) AS k FROM (SELECT item_id, unnest([array_to_string(w[i:i+9], ' ')
          for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS s FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM w, ks WHERE len(w) >= k),
spot AS (SELECT doc_id, k, i, array_to_string(w[i:i+k-1], ' ') AS s FROM pos),
occ AS (SELECT doc_id, i, spot.k, item_id FROM spot JOIN win ON spot.s = win.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM occ) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM occ) GROUP BY 1)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, text, coalesce(len({_SPACE_WORDS}), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
      FROM d GROUP BY 1),
tot AS (SELECT 1.5 * sum(n) AS t, sum(w) AS w FROM s),
-- rounds: sources whose share by weight is above twice their words stop there; the rest is reshared
fill(round, capped, level) AS (
  SELECT 0, []::VARCHAR[], t / w FROM tot
  UNION ALL
  SELECT round + 1, c, (t - used) / free FROM (
    SELECT f.round, any_value(f.capped) AS old, tot.t,
           list(coalesce(s.source, '~null')) FILTER (WHERE level * s.w > 2 * s.n) AS c,
           coalesce(sum(2 * s.n) FILTER (WHERE level * s.w > 2 * s.n), 0) AS used,
           sum(s.w) FILTER (WHERE NOT level * s.w > 2 * s.n) AS free
    FROM fill f, s, tot GROUP BY f.round, tot.t) WHERE len(coalesce(c, [])) > len(old) AND free > 0),
lvl AS (SELECT max_by(level, round) AS level FROM fill),
t AS (SELECT source, n, least(2 * n, level * w) AS target FROM s, lvl),
z AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS bits,
             (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
      FROM d),
-- size classes of a source: with all longer classes at two copies, the others share the rest by their bits
g AS (SELECT source, bits, sum(size)::DOUBLE AS n FROM z WHERE size > 0 GROUP BY 1, 2),
lv AS (SELECT a.source, a.bits, (any_value(t.target) - 2 * coalesce(sum(b.n) FILTER (WHERE b.bits > a.bits), 0))
              / sum(b.n * b.bits) FILTER (WHERE b.bits <= a.bits) AS level
       FROM g a JOIN g b ON a.source IS NOT DISTINCT FROM b.source JOIN t ON a.source IS NOT DISTINCT FROM t.source GROUP BY 1, 2),
lm AS (SELECT source, max(level) FILTER (WHERE level * bits < 2) AS level FROM lv GROUP BY 1),
e AS (SELECT g.*, floor(c + 1e-12) AS whole, greatest(c - floor(c + 1e-12), 0) AS p
      FROM (SELECT g.*, coalesce(least(2.0, level * bits), 2.0) AS c FROM g JOIN lm ON g.source IS NOT DISTINCT FROM lm.source) g),
r AS (SELECT e.source, any_value(target) - sum(whole * e.n) AS rest FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source GROUP BY 1),
x AS (SELECT z.doc_id, z.source, z.size, t.n, t.target, r.rest, coalesce(e.whole, 0) AS whole, coalesce(e.p, 0) AS p,
             CASE WHEN e.p > 0 THEN u / (1 - u) * (1 - e.p) / e.p END AS odds
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source LEFT JOIN e ON z.source IS NOT DISTINCT FROM e.source AND z.bits = e.bits
      LEFT JOIN r ON z.source IS NOT DISTINCT FROM r.source),
y AS (SELECT *, sum(size) OVER (PARTITION BY source, p > 0 ORDER BY odds / (1 + odds), doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto FROM x)
SELECT doc_id, size, n::BIGINT AS source_size, round(target, 4) AS target,
       (size * (whole + CASE WHEN p > 0 AND (upto <= rest OR (upto - size < rest AND upto - rest <= rest - (upto - size)))
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM y
"""

OP10_SQL = f"""
WITH l AS (SELECT doc_id, no - 1 AS no, lines[no] AS text FROM (
             SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no
             FROM documents WHERE text <> '')),
k AS (SELECT doc_id, no, w, array_to_string(w, ' ') AS line FROM (SELECT doc_id, no, {_SPACE_WORDS} AS w FROM l) WHERE len(w) > 0),
f AS (SELECT line, any_value(w) AS w, min((doc_id, no)) AS spot FROM k GROUP BY 1),
v AS (SELECT line, spot, unnest(range(0, len(w) + 1)) AS pos, w FROM f WHERE len(w) >= 5),
vk AS (SELECT line, spot, pos, CASE WHEN pos = 0 THEN line ELSE array_to_string(list_concat(w[1:pos-1], w[pos+1:]), ' ') END AS key FROM v),
near AS (SELECT DISTINCT x.line FROM vk x JOIN vk y ON x.key = y.key AND x.line <> y.line
         AND (x.pos = y.pos OR x.pos = 0 OR y.pos = 0) WHERE y.spot < x.spot),
gone AS (SELECT k.doc_id, k.no FROM k JOIN f USING (line) LEFT JOIN near USING (line)
         WHERE near.line IS NOT NULL OR (k.doc_id, k.no) <> f.spot)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(c.n, 0) - coalesce(g.n, 0) AS n_kept, coalesce(g.nos, '') AS removed_lines
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM l GROUP BY 1) c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(no::VARCHAR, ',' ORDER BY no) AS nos FROM gone GROUP BY 1) g USING (doc_id)
"""

OP11_SQL = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
tot AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY 1),
gram AS (SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase FROM
          (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM gram GROUP BY 1, 2, 3 HAVING count(*) >= 100),
c AS (SELECT lang, k AS words, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2),
cut AS (SELECT lang, phrase, w, words, a, unnest(range(1, words)) AS k FROM c),
s AS (SELECT cut.lang, cut.phrase, cut.words, a, cut.k, x.f AS l, y.f AS r, n, 1000::HUGEINT * a * n // (x.f * y.f) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:cut.k], ' ')
      JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cut.k+1:], ' ') JOIN tot ON tot.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
long AS (SELECT lang, a, array_to_string(w[i:i+m-1], ' ') AS phrase FROM
          (SELECT lang, w, a, m, unnest(range(1, words - m + 2)) AS i FROM
            (SELECT lang, w, a, words, unnest(range(2, words)) AS m FROM c))),
gone AS (SELECT DISTINCT best.lang, best.phrase FROM best JOIN long USING (lang, phrase) WHERE 100 * long.a >= 100 * best.a),
kept AS (SELECT best.* FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""

OP12_SQL = """
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) <= 5
"""

ORACLES: dict[str, str] = {
    "op1_near_dedup": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op8_mixing": OP8_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
