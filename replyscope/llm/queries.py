"""Registered queries of the training-data operators, each over its whole
table with production parameters, and SQL for those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .html_extract import extract_text
from .license_scan import scan_licenses
from .near_dedup import near_duplicates
from .packing import pack
from .piece_dropout import segmentations
from .pseudo_likelihood import pseudo_likelihood
from .quality import judge, train_field
from .substring_dedup import remove_repeats
from .token_counts import count_tokens
from .token_overlap import overlaps
from .url_filter import filter_urls
from .weighted_sampling import fingerprints
from .whitening import whiten


def op1_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(read_table(spark, sf, "pages"))


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_urls(read_table(spark, sf, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return judge(docs, train_field(docs, read_table(spark, sf, "labels")))


def op5_weighted_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(read_table(spark, sf, "documents"))


def op6_piece_dropout(spark: SparkSession, sf: str) -> DataFrame:
    return segmentations(read_table(spark, sf, "documents"),
                         public_tokenizers.path("piece_bpe_32k.model"))


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(read_table(spark, sf, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf, "documents"))


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf, "documents"))


def op10_pseudo_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    return pseudo_likelihood(read_table(spark, sf, "documents"))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read_table(spark, sf, "embeddings"))


def op12_token_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return overlaps(read_table(spark, sf, "documents"),
                    public_tokenizers.path("byte_bpe_50k.json"),
                    public_tokenizers.path("piece_bpe_32k.model"))


def op13_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extract, op2_url_filter, op3_best_fit_packing,
                            op4_line_quality, op5_weighted_sampling, op6_piece_dropout,
                            op7_token_counts, op8_substring_dedup, op9_near_dedup,
                            op10_pseudo_likelihood, op11_whitening, op12_token_overlap,
                            op13_license_scan)}

OP2_SQL = """
WITH u AS (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN
             regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END, '') AS rest
           FROM pages),
     p AS (SELECT page_id,
             translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM u),
     r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
             ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
     hit AS (SELECT page_id, host, path, verdict, rhost || rpath AS rule
             FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost))
                               AND starts_with(path, rpath)
             QUALIFY row_number() OVER (PARTITION BY page_id
                     ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hit"""

OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
     s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3
                THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 1),
                     lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
     c AS (SELECT min(doc_id) AS rep, list_sort(sh) AS sh, len(sh) AS n FROM s
           WHERE len(sh) > 0 GROUP BY 2, 3),
     e AS (SELECT rep, n, unnest(sh) AS g FROM c),
     p AS (SELECT a.rep AS a, b.rep AS b FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep
             AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
           GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
     y AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
     r(node, low) AS (SELECT rep, rep FROM c UNION
                      SELECT y.b, r.low FROM r JOIN y ON y.a = r.node WHERE r.low < y.b),
     g AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(g.low, s.doc_id) AS component_id,
       coalesce(g.low, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON list_sort(s.sh) = c.sh LEFT JOIN g ON g.node = c.rep"""

OP8_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                      lambda x: x <> '') AS ws FROM documents),
     x AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
     y AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM x),
     l AS (SELECT win, min(doc_id) AS low FROM y GROUP BY win),
     h AS (SELECT doc_id, list(i) AS starts FROM y JOIN l USING (win) WHERE low < doc_id
           GROUP BY doc_id),
     c AS (SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 13))))
                  AS gone FROM h),
     p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
     g AS (SELECT doc_id, unnest(gone) AS i, true AS lost FROM c),
     k AS (SELECT p.doc_id, count(*) AS n_words, count(lost) AS n_removed,
                  string_agg(word, ' ' ORDER BY p.i) FILTER (lost IS NULL) AS kept
           FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id"""

ORACLES: dict[str, str] = {"op2_url_filter": OP2_SQL, "op8_substring_dedup": OP8_SQL,
                           "op9_near_dedup": OP9_SQL}
