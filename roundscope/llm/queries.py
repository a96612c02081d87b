"""Queries over the test tables, one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundscope.llm import align, classifier, dedup, extract, fingerprints, language, lexical, packing, quality, simhash, tokens, toxicity, urls
from roundscope.llm.common import fold, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op10_urls"] = r"""
WITH RECURSIVE parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query,
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS canonical,
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) AS redirect
  FROM pages),
links AS (
  SELECT page_id, host, path, link FROM parts, LATERAL (SELECT unnest([canonical, redirect]) AS link) WHERE coalesce(link, '') <> '' AND host <> ''),
full_links AS (
  SELECT page_id, CASE WHEN starts_with(link, '#') THEN NULL WHEN contains(link, '://') THEN link
    WHEN starts_with(link, '//') THEN 'http:' || link WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(link, '/') THEN 'http://' || host || link
    ELSE 'http://' || host || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || link END AS target
  FROM links),
targets AS (
  SELECT page_id,
    translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(target, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(target, '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query
  FROM full_links WHERE target IS NOT NULL),
places AS (SELECT page_id, true AS own, host, path, query FROM parts UNION ALL SELECT page_id, false, host, path, query FROM targets),
addressed AS (
  SELECT *, CASE WHEN host <> '' THEN host || path ||
    CASE WHEN regexp_replace(regexp_replace(query, '(^|&)utm_[^&]*', '', 'g'), '^&', '') <> ''
      THEN '?' || regexp_replace(regexp_replace(query, '(^|&)utm_[^&]*', '', 'g'), '^&', '') ELSE '' END END AS address
  FROM places),
rules(rule, host, path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (
  SELECT a.host, a.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM addressed) a JOIN rules r
    ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)
  GROUP BY a.host, a.path),
edges AS (
  SELECT DISTINCT o.address AS a, t.address AS b FROM addressed o JOIN addressed t USING (page_id)
  WHERE o.own AND NOT t.own AND o.address IS NOT NULL AND t.address IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(address) AS (
  SELECT DISTINCT d.address FROM addressed d JOIN fits f ON d.host = f.host AND d.path = f.path AND f.verdict = 'block' WHERE d.address IN (SELECT a FROM both_ways)
  UNION
  SELECT e.b FROM reached r JOIN both_ways e ON e.a = r.address)
SELECT o.page_id, o.host, o.path, f.rule,
  coalesce(f.verdict, CASE WHEN o.address IN (SELECT address FROM reached) THEN 'block' ELSE 'allow' END) AS verdict
FROM addressed o LEFT JOIN fits f ON o.host = f.host AND o.path = f.path WHERE o.own
"""


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(read(spark, sf_dir, "documents")).drop("clean_text")


ORACLE["op6_quality"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, [x FOR x IN string_split(regexp_replace(t, '[\x20\x09-\x0D]', ' ', 'g'), ' ') IF x <> ''] AS ws,
    [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls
  FROM d),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS met
  FROM (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i))),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS v(k) WHERE met > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, l, [x FOR x IN string_split(regexp_replace(l, '[\x20\x09-\x0D]', ' ', 'g'), ' ') IF x <> ''] AS lw
  FROM (SELECT doc_id, unnest(ls) AS l FROM w)),
judged AS (
  SELECT doc_id, list_sum([length(x) FOR x IN lw]) AS chars,
    (len(lw) < 8 AND NOT contains('.!?…。！？:;"''”’»)]', right(rtrim(l, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1)))
    OR len([x FOR x IN lw IF regexp_matches(x, '[!?][!?]$')]) * 3 > len(lw)
    OR len([x FOR x IN lw IF regexp_full_match(x, '[|»«›‹•·>/\\-]+')]) * 5 >= greatest(1, len(lw))
    OR len([x FOR x IN lw IF regexp_matches(x, '[#*$%&|<>]')]) * 4 > len(lw)
    OR regexp_matches(lower(l), 'cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|copyright|released under|licensed under|subscribe|newsletter|sign in|sign up|log in|login|click here|read more|lorem ipsum') AS failed
  FROM lines),
kept AS (SELECT doc_id, count(*) FILTER (NOT failed) AS n, coalesce(sum(chars) FILTER (NOT failed), 0) AS chars FROM judged GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(ls)::BIGINT AS n_lines,
    coalesce(k.n, 0) AS n_kept_lines, coalesce(k.chars, 0)::BIGINT AS kept_chars
  FROM w LEFT JOIN repeats r USING (doc_id) LEFT JOIN kept k USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_chars >= 0.5 * word_chars AS kept
FROM counted
"""


def _judged(scores: DataFrame, folds: int, held: int, threshold: float) -> DataFrame:
    """The scores with their fold and verdict; a row without an id is never learned from, nor held out."""
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


@query
def op1_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    net = classifier.learn(docs, labels, "quality", fold(F.col("doc_id"), 5) != 0)
    return _judged(classifier.score(docs, net), 5, 0, classifier.THRESHOLD)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, "toxic", fold(F.col("doc_id"), 4) != 2)
    return _judged(toxicity.score(docs, model), 4, 2, toxicity.THRESHOLD)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learned = language.prototypes(docs, fold(F.col("doc_id"), 4) != 2)
    found = language.predict(docs, learned)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def byte_bpe_ranks() -> dict[bytes, int]:
    return tokens.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def word_bpe_json() -> str:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@query
def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(read(spark, sf_dir, "documents"), byte_bpe_ranks(), public_tokenizers.PATTERN)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), word_bpe_json())


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited(read(spark, sf_dir, "documents"))
    own, changed = F.col("packed"), F.col("edited_packed")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprints.shown(own).alias("fingerprint"),
        fingerprints.shown(changed).alias("edited_fingerprint"),
        fingerprints.likeness(own, changed).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_packed")).alias("near_next"),
    )


@query
def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.kept_digests(read(spark, sf_dir, "documents"))


@query
def op11_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


@query
def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        a_json = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        b_model = file.read()
    return align.align(read(spark, sf_dir, "documents"), a_json, b_model)


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))
