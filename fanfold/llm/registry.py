"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, conversations, fingerprints, jaccard, language_id, mixing, pii, quality, secrets, simhash, substring_dedup, token_alignment, url_filter
from .common import read

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Rules of op6: the rule and what it says.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
PII_BASE = ("email", "ip", "card", "phone")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(n(k) for k in PII_BASE),
        F.sha2(pii.spans_text(F.col("pii"), PII_BASE).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs, "doc_id", "text", "lang")).drop("doc")


def op3_language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(read(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return language_id.identify(language_id.pages_as_documents(read(spark, sf_dir, "pages")), model, "page_id").drop("doc")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_i_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


OP6_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
    ELSE regexp_extract(substr(url, position('://' IN url) + 3), '^([^?#]*)', 1) END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM cut),
rules(rhost, rpath, rule, says) AS (VALUES
  ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
  ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'), ('com', '/de/', 'com/de/', 'block')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    both = byte_bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_decoded=True)
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
        F.sha2(secrets.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("found")).alias("spans"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(read(spark, sf_dir, "conversations")), gone="gone")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii": op2_pii,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_i_match": op5_i_match,
    "op6_url_filter": op6_url_filter,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_mix_sources": op8_mix_sources,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_secrets": op10_secrets,
    "op11_token_alignment": op11_token_alignment,
    "op12_simhash": op12_simhash,
    "op13_conversation_repair": op13_conversation_repair,
}
#: Queries that read further tables; op3 finds hosts with suffixes and declarations only in ``pages``.
FURTHER: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_language_of_pages": op3_language_of_pages}
ORACLE_SQL: dict[str, str] = {"op1_quality_rules": quality.JUDGE_SQL, "op6_url_filter": OP6_SQL, "op8_mix_sources": mixing.MIX_SQL}
