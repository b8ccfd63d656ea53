"""One query for each operator, over whole tables, and its SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import decontaminate, htmltext, jaccard, language, lexical, merkle, pieces, pii, quality, rules, scoring, toxicity, warc

#: The tokenizer's file, a parameter of the queries that use it.
PIECES = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out("doc_id", 4, 2))
    model = language.train(documents.where("not held_out"))
    return language.identify(documents.select("doc_id", "held_out", "text"), model).drop("text", "spans")


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", language.held_out("doc_id", 7, 2))
    model, counts = scoring.train(documents.where("not held_out"))
    return scoring.score(documents, model, counts)


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = language.held_out("doc_id", 5, 0)
    model = quality.train(documents, table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(documents.withColumn("held_out", held_out), model).drop("text")


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(documents, pieces.Vocabulary.load(PIECES)).drop("text")


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op6_ngram_jaccard"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
overlap AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT o.a, o.b FROM overlap o JOIN sized x ON x.doc_id = o.a JOIN sized y ON y.doc_id = o.b
  WHERE 100 * o.o >= 85 * (x.n + y.n - o.o)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sized s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.verdicts(documents, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.contamination(documents, table(spark, sf_dir, "benchmark")))


SQL["op8_decontamination"] = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
window_of AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS seq
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM doc),
opening AS (SELECT DISTINCT size, seq, split_part(seq, ' ', 1) AS word FROM window_of),
hit AS (
  SELECT DISTINCT p.doc_id, p.i, p.size, p.seq
  FROM (SELECT k.doc_id, k.i, o.size, o.seq FROM word k JOIN opening o ON k.word = o.word) p
  JOIN doc d ON d.doc_id = p.doc_id
  WHERE array_to_string(d.w[p.i : p.i + p.size - 1], ' ') = p.seq),
hit_word AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hit) GROUP BY doc_id),
hit_item AS (
  SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hit JOIN window_of USING (size, seq) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN hit_word h USING (doc_id) LEFT JOIN hit_item t USING (doc_id)"""


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("url", "payload")


SQL["op10_warc"] = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digested AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM page),
marked AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response
  FROM digested)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM marked"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = language.held_out("doc_id", 5, 0)
    model = toxicity.train(documents, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(documents.withColumn("held_out", held_out), model).drop("text", "neighbours")


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
# The polynomial of CRC-32, bit by bit over the bytes of the id.
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: [ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""
_BEFORE, _AFTER = (" || ".join(_FIELD.format(c) for c in part) for part in (("doc_id", "source", "lang"), ("text",)))
SQL["op13_merkle"] = f"""
WITH RECURSIVE leafs AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         sha256({_BEFORE} || {_FIELD.format("n_chars")} || {_AFTER}) AS leaf,
         sha256({_BEFORE} || {_FIELD.format("(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END)")} || {_AFTER}) AS shown
  FROM (SELECT *, {_CRC} AS crc FROM documents)),
lower_node(lang, l, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM leafs
  UNION ALL SELECT lang, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM lower_node WHERE n > 1 GROUP BY lang, l, n, i // 2),
root_of AS (SELECT lang, l AS top, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM lower_node WHERE n = 1),
upper_node(l, i, n, h) AS (
  SELECT 0, i, n, h FROM root_of
  UNION ALL SELECT l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM upper_node WHERE n > 1 GROUP BY l, n, i // 2),
climb(doc_id, lang, pos, l, i, s, f) AS (
  SELECT doc_id, lang, i, 0, i, '', shown FROM leafs
  UNION ALL
  SELECT c.doc_id, c.lang, c.pos, c.l + 1, c.i // 2, c.s || coalesce(o.h, ''),
         sha256(CASE WHEN c.i % 2 = 1 THEN coalesce(o.h, '') || c.f ELSE c.f || coalesce(o.h, '') END)
  FROM climb c JOIN root_of r ON r.lang IS NOT DISTINCT FROM c.lang AND c.l < r.top
  LEFT JOIN lower_node o ON o.lang IS NOT DISTINCT FROM c.lang AND o.l = c.l AND o.i = xor(c.i, 1)),
ascent(lang, pos, l, i, s, f) AS (
  SELECT c.lang, c.pos, 0, r.i, c.s, c.f FROM climb c JOIN root_of r ON r.lang IS NOT DISTINCT FROM c.lang AND c.l = r.top
  UNION ALL
  SELECT a.lang, a.pos, a.l + 1, a.i // 2, a.s || coalesce(o.h, ''),
         sha256(CASE WHEN a.i % 2 = 1 THEN coalesce(o.h, '') || a.f ELSE a.f || coalesce(o.h, '') END)
  FROM ascent a LEFT JOIN upper_node o ON o.l = a.l AND o.i = xor(a.i, 1) WHERE a.l < (SELECT max(l) FROM upper_node))
SELECT d.doc_id, d.leaf, r.h AS subroot, u.h AS root, sha256(a.s) AS proof_sha256, a.f AS folded_root, a.f = u.h AS verified
FROM leafs d JOIN root_of r ON r.lang IS NOT DISTINCT FROM d.lang
JOIN ascent a ON a.lang IS NOT DISTINCT FROM d.lang AND a.pos = d.i AND a.l = (SELECT max(l) FROM upper_node)
CROSS JOIN (SELECT h FROM upper_node WHERE n = 1) u"""


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = lexical.index(table(spark, sf_dir, "documents"))
    return lexical.search(indexed, lexical.query_terms(table(spark, sf_dir, "benchmark")))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL["op12_lexical_search"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc WHERE len(w) > 0),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY r, term),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT a.item_id, d.doc_id, d.r, CAST(sum(g.weight * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * len(d.w) * t.n_docs) // t.n_terms)))) AS BIGINT) AS score
  FROM asked a JOIN weighed g USING (term) JOIN held h USING (term) JOIN doc d ON d.r = h.r, total t
  GROUP BY a.item_id, d.doc_id, d.r)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10"""


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.train(pages)).select("page_id", "url", "text", "n_chars")


# Says it for pages whose main text is one article, without nested parts, and of the references found there.
SQL["op11_html_extraction"] = r"""
WITH inside AS (
  SELECT page_id, url, regexp_extract(regexp_replace(coalesce(html, ''), '<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'gs'),
         '<article>(.*)</article>', 1, 's') AS t FROM pages),
stripped AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?(p|h1|br|div|ul|li)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM inside),
spaced AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'),
         '[\s\x{00A0}]+', ' ', 'g')) AS text FROM stripped)
SELECT page_id, url, text, length(text) AS n_chars FROM spaced"""
