"""Queries over the training-data tables and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_rotation, conv_trie, decontam, html_template, lang_id, license_scan, line_dedup, mih, mixing, ngram_join, pii, spelling
from .common import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_text(table(spark, sf_dir, "pages"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"), declared=F.col("lang"), host=F.col("source"), carry={"doc_id": F.col("doc_id")})


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The method of op3 where all its evidence exists: markup language, address suffix and host of every page."""
    visible = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", visible.alias("text"), F.regexp_extract("html", "(?is)<html[^>]*\\blang\\s*=\\s*[\"']?([a-z]+)", 1).alias("lang"))
    return lang_id.identify(pages, declared=F.col("lang"), url=F.col("url"), host=html_template.host_of(F.col("url")), carry={"page_id": F.col("page_id")})


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op6_ann_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return mih.nearest(vectors, vectors.filter("vec_id % 50 = 0").select("vec_id"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_rotation.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.withColumn("mask", spans)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.load_vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocabulary, carry={"doc_id": F.col("doc_id")}, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.count_words(table(spark, sf_dir, "documents"), F.col("text"), F.col("doc_id")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_trie.trie(*conv_trie.rebuilt(conv_trie.positions(table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_html_extract, op2_ngram_jaccard, op3_lang_id, pages_language, op4_source_mix, op5_pii, op6_ann_mih, op7_line_dedup,
        op8_decontaminate, op9_chat_rotation, op10_license_scan, op11_bpe_codec, op12_spelling_variants, op13_conversation_trie)}


#: crc32 of the characters of ``x``, all below U+0100, in UTF-8; ``tab`` is the table of CRC.
CRC_TABLE = "(SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) FROM range(256) r(i))"
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({x}, ''), lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
    ELSE [195::BIGINT, unicode(s)::BIGINT - 64] END))), lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295)"""

SQL = {
    "op12_spelling_variants": r"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT """ + CRC_TABLE + r""" AS tab),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
d AS (SELECT doc_id, w, count(*) AS c FROM r WHERE length(w) >= 6 GROUP BY ALL),
h AS (SELECT w, c, """ + CRC.format(x="coalesce(doc_id::VARCHAR, '') || ':' || w") + r""" AS h FROM d, tab),
x AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM h),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM x WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
k AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v) t),
l AS MATERIALIZED (SELECT x.word AS word, y.word AS other FROM k x JOIN k y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
      UNION SELECT k.word, v.word FROM k JOIN v ON v.word = k.a || k.b UNION SELECT v.word, k.word FROM k JOIN v ON v.word = k.a || k.b),
s AS (SELECT l.word, count(*) AS n_near, arg_min(l.other, (-v.n, l.other)) AS best, max(v.n) AS m FROM l JOIN v ON v.word = l.other GROUP BY l.word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(s.n_near, 0) AS n_near, CASE WHEN s.m >= 5 * v.n THEN s.best END AS form, CASE WHEN s.m >= 5 * v.n THEN s.m END AS form_n FROM v LEFT JOIN s USING (word)),
go(word, root) AS (SELECT word, word FROM f UNION ALL SELECT g.word, f.form FROM go g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN go g ON g.word = f.word JOIN f e ON e.word = g.root AND e.form IS NULL""",
    "op13_conversation_trie": """
WITH tab AS MATERIALIZED (SELECT """ + CRC_TABLE + """ AS tab),
o AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT i.conv_id, """ + CRC.format(x="i.conv_id::VARCHAR") + """ % 6 AS h FROM (SELECT DISTINCT conv_id FROM o) i, tab),
b AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND p <= h
      UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN o USING (conv_id) WHERE p > h),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth FROM b),
path AS MATERIALIZED (SELECT conv_id, depth, length(text) AS n, list(role || chr(1) || text) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM t
      UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM c),
size AS (SELECT conv_id, max(depth) AS size FROM path GROUP BY conv_id),
node AS MATERIALIZED (SELECT path, depth, max(n) AS n, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CASE WHEN depth = size THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
      FROM path JOIN size USING (conv_id) GROUP BY path, depth),
kids AS MATERIALIZED (SELECT path[1:depth - 1] AS path, count(*) AS k FROM node WHERE depth > 0 GROUP BY ALL),
up AS (SELECT n.*, coalesce(k.k, 0) AS k, unnest(range(0, n.depth + 1)) AS d FROM node n LEFT JOIN kids k ON k.path = n.path),
below AS (SELECT path[1:d] AS path, d, count(*) FILTER (k = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved FROM up GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.k, 0) AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM node n JOIN below s ON s.path = n.path AND s.d = n.depth LEFT JOIN kids k ON k.path = n.path LEFT JOIN node q ON n.depth > 0 AND q.path = n.path[1:n.depth - 1] AND q.depth = n.depth - 1""",
    "op2_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id
          GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id FROM s
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id""",
    "op7_line_dedup": r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM l WHERE len(l) >= 3),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY l[p], l[p + 1], l[p + 2] ORDER BY doc_id, p) AS k FROM p),
gone AS (SELECT DISTINCT doc_id, p + d AS p FROM r, (VALUES (0), (1), (2)) v(d) WHERE k > 1),
every AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM l),
kept AS (SELECT e.doc_id, string_agg(line, chr(10) ORDER BY e.p) AS text, count(*) AS n FROM every e
         ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(l.l), 0)::BIGINT AS n_lines,
       (coalesce(len(l.l), 0) - coalesce(k.n, 0))::BIGINT AS n_removed
FROM l LEFT JOIN kept k ON k.doc_id = l.doc_id""",
    "op9_chat_rotation": r"""
WITH u AS (SELECT conv_id, turn,
             CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE regexp_replace(role, '[^A-Za-z0-9_-]', '_', 'g') END AS who,
             replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' AS body FROM conversations),
t AS (SELECT *, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, body) - 1) // 512)::BIGINT AS part FROM u),
v AS (SELECT DISTINCT conv_id, who AS perspective FROM t WHERE who <> 'system'),
m AS (SELECT t.conv_id, v.perspective, part, turn, who, body, who = perspective AS own,
        '<|im_start|>' || CASE WHEN who = perspective THEN 'assistant' WHEN who = 'system' THEN 'system' ELSE 'user name=' || who END || chr(10) AS head
      FROM t JOIN v ON t.conv_id = v.conv_id),
o AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part
        ORDER BY turn NULLS FIRST, who, body ROWS UNBOUNDED PRECEDING) AS stop FROM m)
SELECT conv_id, perspective, part, count(*) AS n_turns, sum(CASE WHEN own THEN length(body) ELSE 0 END)::BIGINT AS n_masked,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, who, body) AS text,
       coalesce(string_agg((stop - 1 - length(body))::BIGINT || ':' || (stop - 1)::BIGINT, ',' ORDER BY turn NULLS FIRST, who, body) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, perspective, part""",
}


def oracle_sql() -> dict[str, str]:
    names = queries()
    return {k: v for k, v in SQL.items() if k in names}
