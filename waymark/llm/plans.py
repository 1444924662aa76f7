"""Registered queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, decontaminate, language, lines, near, periodic, quality, search, secrets, sharding, substrings, webtext
from .common import Query, table


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontamination(spark: SparkSession, root: str) -> DataFrame:
    marked = decontaminate.contamination(
        spark, table(spark, root, "documents"), table(spark, root, "benchmark")
    )
    return decontaminate.digest(marked)


ORACLES["op1_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
tests AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS n, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM tests WHERE len(words) > 0)),
tokens AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT DISTINCT doc_id, tokens.n AS n, i, item_id FROM tokens JOIN windows USING (w)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op2_search(spark: SparkSession, root: str) -> DataFrame:
    return search.digest(spark, table(spark, root, "documents"))


ORACLES["op2_search"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
total AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM docs),
tf AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS w FROM docs) GROUP BY ALL),
idf AS (
  SELECT w, ln(1 + (max(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, total GROUP BY w),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id AS doc_id,
         round(sum(q.tf * idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len(words) / mean))), 6) AS score
  FROM tf q JOIN tf d USING (w) JOIN idf USING (w) JOIN docs ON docs.doc_id = d.doc_id, total
  WHERE q.doc_id % 50 = 0 AND q.doc_id <> d.doc_id GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10"""


@query
def op3_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near.digest(spark, table(spark, root, "documents"))


ORACLES["op3_near_dedup"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 1, 1) + 1)) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM sets x JOIN sets y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


@query
def op4_language(spark: SparkSession, root: str) -> DataFrame:
    return language.digest(table(spark, root, "documents"))


@query
def op5_substrings(spark: SparkSession, root: str) -> DataFrame:
    return substrings.digest(table(spark, root, "documents"))


ORACLES["op5_substrings"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM docs)),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (w) WHERE first_doc < doc_id),
kept AS (
  SELECT d.doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs) d
  ANTI JOIN gone USING (doc_id, p) GROUP BY d.doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


@query
def op6_secrets(spark: SparkSession, root: str) -> DataFrame:
    return secrets.digest(spark, table(spark, root, "documents"))


@query
def op7_sharding(spark: SparkSession, root: str) -> DataFrame:
    placed = sharding.shard_documents(spark, table(spark, root, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op8_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe.token_digests(table(spark, root, "documents"), corpus_pipeline.TOKENIZER)


@query
def op9_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.digest(table(spark, root, "documents"), table(spark, root, "labels"))


@query
def op10_webtext(spark: SparkSession, root: str) -> DataFrame:
    return webtext.extracted(table(spark, root, "pages"))


@query
def op11_periodic(spark: SparkSession, root: str) -> DataFrame:
    return periodic.digest(table(spark, root, "documents"))


# Words d apart that begin six equal words, in a row without a gap, are one stretch of period d.
ORACLES["op11_periodic"] = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM documents
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(s[i // 8 + 1]) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE i < 8 * length(s))),
hashes AS (SELECT doc_id, xor(c, CAST(4294967295 AS BIGINT)) AS h FROM crc WHERE i = 8 * length(s)),
texts AS (
  SELECT doc_id, h, h // 10 AS g, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'),
           lambda x: x <> '') AS w FROM documents JOIN hashes USING (doc_id)),
loops AS (
  SELECT *, len(w) AS n, g % greatest(len(w), 1) AS a,
         1 + (len(w) - g % greatest(len(w), 1)) // (3 + g % 8) AS p FROM texts),
docs AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i:
           w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS words FROM loops),
grams AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 6], ' ') AS gram
  FROM (SELECT *, unnest(range(greatest(len(words) - 5, 0))) AS i FROM docs)),
pairs AS (
  SELECT x.doc_id, y.i - x.i AS d, x.i AS i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS part
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
runs AS (
  SELECT doc_id, start, length, min(d) AS period
  FROM (SELECT doc_id, d, min(i) AS start, count(*) + 5 + d AS length FROM pairs GROUP BY doc_id, d, part)
  WHERE length >= 2 * d AND length >= 12 GROUP BY ALL),
best AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_runs,
         row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS place FROM runs),
listed AS (
  SELECT doc_id, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS x
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS x
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, CAST(length AS BIGINT) AS length, period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed.x, '')) AS runs_sha256, sha256(coalesce(kept.x, '')) AS collapsed_sha256
FROM docs LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (doc_id)
  LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query
def op12_alignment(spark: SparkSession, root: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digest(spark, table(spark, root, "documents"), *paths)


@query
def op13_lines(spark: SparkSession, root: str) -> DataFrame:
    return lines.digest(spark, table(spark, root, "documents"))


ORACLES["op13_lines"] = r"""
WITH lines AS (
  SELECT doc_id, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
repeated AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT lines.*, coalesce(doc_id <> last, false) AS gone FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query
def pipeline(spark: SparkSession, root: str) -> DataFrame:
    return corpus_pipeline.run(spark, root)
