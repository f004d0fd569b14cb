"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, html_extract, lm_score, mixing, odd_sketch, quality_fm, quality_rules, simhash, spelling, suffix_dedup,
    url_filter, warc, whitening,
)
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(spark, read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the URLs of pages whose document is labelled toxic or of quality 0."""
    pages = read_table(spark, sf_dir, "pages")
    listed = url_filter.urls_of_labelled(pages, read_table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut
), canon AS (
  SELECT *, list_sort(list_filter(string_split(query, '&'),
              lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept,
         regexp_extract(path, '/([0-9]{1,18})[^/]*/?$', 1) AS doc
  FROM parts
), named AS (
  SELECT *, CASE WHEN host <> '' THEN concat(regexp_replace(host, '^www\.', ''), regexp_replace(path, '/+$', ''),
                   CASE WHEN len(kept) > 0 THEN concat('?', array_to_string(kept, '&')) ELSE '' END) END AS canonical
  FROM canon
), listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE doc <> '' AND canonical IS NOT NULL
    AND CAST(doc AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0)
), rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ruled AS (
  SELECT n.*, (SELECT max_by(struct_pack(r := rhost || rpath, v := rverdict), length(rhost || rpath)) FROM rules
               WHERE (n.host = rhost OR suffix(n.host, '.' || rhost)) AND starts_with(n.path, rpath)) AS best
  FROM named n
)
SELECT page_id, host, path, best.r AS rule,
       coalesce(best.v, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(read_table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return mixing.mix(docs).select("doc_id", "source", "mix_block", "mix_slot", "mix_position", "mix_shard")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("covered", 6).alias("covered"), "longest_repeat")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=3, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    machine = quality_fm.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, machine)
    return scored.select("doc_id", quality_fm.held_out().alias("held_out"), "score", "predicted")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm_score.score(docs, *lm_score.train(docs))


def op11_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_warc_archive": op2_warc_archive,
    "op3_url_filter": op3_url_filter,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_odd_sketch_near_dedup": op11_odd_sketch_near_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {"op3_url_filter": OP3_SQL}
