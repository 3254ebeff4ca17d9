"""Queries of this subpackage, with the DuckDB SQL that checks them where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (additive_quality, attention_lm, byte_bpe, collocations, embedding_pairs, language_id, ngram_groups, quality_lists, site_lines,
               source_mix, target_sample, token_counts, transcripts)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@_query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Round trip of every text through the 50k rank file."""
    return byte_bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


@_query
def op6_quality_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document, learned from ``labels.quality``."""
    return quality_lists.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op1_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text of every page without the boilerplate lines of its host."""
    pages = _table(spark, folder, "pages")
    out = site_lines.drop_site_lines(pages.withColumn("host", site_lines.url_host(F.col("url"))), F.col("host"),
                                     site_lines.html_lines(F.col("html")), share=0.2, least_pages=3)
    return out.select("page_id", "host", "n_lines", (F.col("n_lines") - F.size("kept_lines")).cast("long").alias("n_dropped"),
                      F.array_join("kept_lines", "\n").alias("clean_text"))


SQL["op1_site_lines"] = r"""
WITH p AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(html, ''),
      '(?i)</?(?:a|b|i|u|em|strong|small|span)(?:\s[^>]*)?>', '', 'g'), '<[^>]*>|\n'),
      lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS lines FROM pages),
n AS (SELECT host, count(*) AS pages FROM p WHERE host IS NOT NULL GROUP BY host),
c AS (SELECT host, line, count(*) AS k FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p WHERE host IS NOT NULL) GROUP BY ALL),
d AS (SELECT host, list(line) AS gone FROM c JOIN n USING (host) WHERE k >= 3 AND k > 0.2 * pages GROUP BY host),
r AS (SELECT page_id, p.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS kept
  FROM p LEFT JOIN d ON p.host = d.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  coalesce(array_to_string(kept, chr(10)), '') AS clean_text FROM r"""


@_query
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed by source: at most two passes over the smallest one."""
    docs = _table(spark, folder, "documents")
    mixed = source_mix.mix(docs.select("doc_id", "source", "text"), most_passes=2.0)
    return mixed.select("doc_id", "source", "epoch", F.col("block_rank").cast("long").alias("block_rank"), "weight")


SQL["op2_source_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
b AS (SELECT *, (('0x' || substr(k, 1, 8))::BIGINT % 256) AS block FROM d),
s AS (SELECT source, sum(tokens)::BIGINT AS t FROM b GROUP BY source),
m AS (SELECT max(t)::DOUBLE AS hi, min(t)::DOUBLE AS lo FROM s WHERE t > 0),
a AS (SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL
  SELECT i + 1, CASE WHEN pow(m.hi / m.lo, 1 - (low + high) / 2) > 2.0 THEN (low + high) / 2 ELSE low END,
    CASE WHEN pow(m.hi / m.lo, 1 - (low + high) / 2) > 2.0 THEN high ELSE (low + high) / 2 END FROM a, m WHERE i < 60),
x AS (SELECT CASE WHEN m.hi / m.lo <= 2.0 THEN 0.0 ELSE (SELECT high FROM a WHERE i = 60) END AS e FROM m),
w AS (SELECT source, t, CASE WHEN t > 0 THEN greatest(1.0, pow(m.hi / t, 1 - e)) ELSE 1.0 END AS passes,
  CASE WHEN t > 0 THEN pow(t / (SELECT sum(t) FROM s), e) ELSE 0 END AS p FROM s, m, x),
g AS (SELECT source, t, p / (SELECT sum(p) FROM w) AS weight, round_even(t * passes, 0)::BIGINT AS budget FROM w),
f AS (SELECT *, CASE WHEN t > 0 THEN budget // t ELSE 1 END AS full_passes, CASE WHEN t > 0 THEN budget % t ELSE 0 END AS rest FROM g),
e AS (SELECT source, weight, full_passes, rest, unnest(generate_series(1, full_passes + (rest > 0)::BIGINT)) AS epoch FROM f),
o AS (SELECT e.source, e.epoch, r.block, row_number() OVER (PARTITION BY e.source, e.epoch ORDER BY
  md5('17:' || coalesce(e.source, '') || ':' || e.epoch || ':' || r.block)) - 1 AS block_rank FROM e, range(256) AS r(block)),
q AS (SELECT b.*, e.epoch, e.weight, e.full_passes, e.rest, o.block_rank FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source
  JOIN o ON o.source IS NOT DISTINCT FROM e.source AND o.epoch = e.epoch AND o.block = b.block),
z AS (SELECT *, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY block_rank, k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  - sum(tokens) OVER (PARTITION BY source, epoch, block_rank, k) AS before FROM q)
SELECT doc_id, source, epoch::BIGINT AS epoch, block_rank::BIGINT AS block_rank, weight FROM z WHERE epoch <= full_passes OR before < rest"""


@_query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the 32k piece model."""
    return token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@_query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the labelled ones that are not held out."""
    return language_id.identify(_table(spark, folder, "documents"))


@_query
def op7_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and attention-model scores of every document, learned from those not held out."""
    return attention_lm.score_texts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                    public_tokenizers.PATTERN)


@_query
def op8_ngram_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-gram sets are at least 0.9 similar."""
    return ngram_groups.similar_documents(_table(spark, folder, "documents"))


SQL["op8_ngram_groups"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM t),
n AS (SELECT doc_id, len(s)::BIGINT AS n_shingles, list_sort(s) AS s FROM g),
u AS (SELECT min(doc_id) AS rep, any_value(n_shingles) AS n, s FROM n WHERE n_shingles > 0 GROUP BY s),
x AS (SELECT rep, n, unnest(s) AS k FROM u),
p AS (SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.k = b.k AND a.rep < b.rep AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT rep AS v, rep AS w FROM u UNION SELECT r.v, e.b FROM r JOIN e ON r.w = e.a),
c AS (SELECT v, min(w) AS component_id FROM r GROUP BY v)
SELECT n.doc_id, n.n_shingles, coalesce(c.component_id, n.doc_id) AS component_id
FROM n LEFT JOIN u ON n.s = u.s LEFT JOIN c ON c.v = u.rep"""


@_query
def op4_embedding_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of the same label with a cosine of at least 0.93: links and components."""
    return embedding_pairs.near_vectors(_table(spark, folder, "embeddings"), least=0.93)


SQL["op4_embedding_pairs"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT vec_id AS v, vec_id AS w FROM embeddings UNION SELECT r.v, e.b FROM r JOIN e ON r.w = e.a),
c AS (SELECT v, min(w) AS component_id FROM r GROUP BY v),
n AS (SELECT a, count(*) AS k FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n.k, 0)::BIGINT AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN c ON c.v = m.vec_id LEFT JOIN n ON n.a = m.vec_id"""


@_query
def op5_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Roles of all conversation turns by Viterbi, and the turns in canonical form."""
    return transcripts.format_chats(_table(spark, folder, "conversations"))


@_query
def op11_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by an additive model with interactions, learned from ``labels.quality``."""
    return additive_quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op12_target_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn by importance towards the benchmark texts."""
    return target_sample.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """First collocations of two to five words of every language."""
    return collocations.collocations(_table(spark, folder, "documents"))


SQL["op13_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS ph FROM p, range(1, 6) AS r(m) WHERE len(w) >= m),
f AS (SELECT lang, m, ph, count(*) AS c FROM g GROUP BY ALL HAVING count(*) >= 100),
k AS (SELECT x.lang, x.m, x.ph, x.c AS a, k, l.c AS l, r.c AS r, ((1000::HUGEINT * x.c * t.n) // (l.c::HUGEINT * r.c))::BIGINT AS score, t.n
  FROM f x, range(1, 5) AS q(k), f l, f r, t WHERE x.m > 1 AND k < x.m AND l.lang = x.lang AND r.lang = x.lang AND t.lang = x.lang
    AND l.m = k AND r.m = x.m - k AND l.ph = x.ph[1:k] AND r.ph = x.ph[k + 1:x.m]),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
i AS (SELECT lang, ph[s:s + z - 1] AS ph, max(c) AS most FROM f, range(2, 5) AS r(z), range(1, 5) AS o(s) WHERE z < m AND s + z - 1 <= m GROUP BY ALL),
o AS (SELECT b.*, array_to_string(b.ph, ' ') AS phrase FROM b LEFT JOIN i ON b.lang = i.lang AND b.ph = i.ph WHERE i.most IS NULL OR 100 * i.most < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n, score FROM o
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") <= 2000"""
