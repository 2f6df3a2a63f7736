"""The queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, langid, mpegts, pii, quality, secret_scan, simhash, urlfilter, warc
from .common import materialise, table


def _held_out() -> Column:
    """Whether a document is held out from learning; one without an id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~_held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


#: (verdict, rule) in the order of the rules' list.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpegts.digests(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages as WARC records in files of 1,000 ids, and a replica of those files with planted damage.

    By the id modulo 97: one record of 97 has a character altered, one is cut in half, one is missing.
    """
    fate = F.pmod(F.col("page_id"), F.lit(97))
    text = warc.record(F.col("url"), F.col("html"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    named = pages.select("page_id", F.coalesce(F.floor(F.col("page_id") / 1000).cast("string"), F.lit("none")).alias("file"), fate.alias("fate"), text.alias("record"))
    half = F.floor(F.length("record") / 2).cast("int")
    damaged = F.when(F.col("fate") == 5, F.concat(F.substring(F.col("record"), F.lit(1), half), F.lit("~"), F.substring(F.col("record"), half + 2, F.length("record")))).when(F.col("fate") == 6, F.substring(F.col("record"), F.lit(1), half))
    hashed = named.select(
        "page_id", "file", "fate",
        F.octet_length("record").cast("bigint").alias("record_length"), F.sha2(F.col("record"), 256).alias("digest"),
        F.octet_length(damaged).cast("bigint").alias("damaged_length"), F.sha2(damaged, 256).alias("damaged_digest"),
    )
    primary, _ = materialise(warc.laid_out(hashed, "file", ["page_id", "digest"]), "archive")
    replica = primary.where("fate is null or fate <> 7").select(
        "file", "record_offset", F.coalesce("damaged_length", "record_length").alias("record_length"), F.coalesce("damaged_digest", "digest").alias("digest")
    )
    return primary, replica


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page: where its record lies, and what the audit says of the replica."""
    primary, replica = warc_replicas(table(spark, sf_dir, "pages"))
    found = warc.audit(primary, replica).select("file", "record_offset", "status")
    told = primary.join(found, ["file", "record_offset"], "left")
    return told.select("page_id", "file", "record_offset", "record_length", F.col("digest").alias("record_sha256"), F.coalesce("status", F.lit("same")).alias("status"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_personal_data, op2_language_id, op3_quality, op4_url_filter, op5_secret_scan, op6_media_columns, op7_simhash, op8_decontamination, op9_warc_fixity, op10_byte_bpe)}

#: DuckDB SQL for those that SQL can express.
ORACLE_SQL: dict[str, str] = {
    # holds for pages without canonical links and refreshing tags, whose components are the canonical forms
    "op4_url_filter": r"""
        WITH split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(regexp_extract(rest, '^[^#]*'), '\?(.*)$', 1) AS query
            FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
        rules(verdict, rule, name, start) AS (VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'),
            ('allow', 'net/de/', 'net', '/de/'), ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
        places AS (SELECT DISTINCT host, path FROM split),
        ruled AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM places JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY host, path),
        formed AS (SELECT page_id, split.host, split.path, rule, verdict,
                   regexp_replace(regexp_replace(split.host, '^(www|m)\.([^.]+\.[^.])', '\2'), ':(80|443)$', '') || regexp_replace(split.path, '(/index)?(\.html?)?/*$', '') || '?'
                   || array_to_string(list_filter(string_split(query, '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_\w+|ref|fbclid|gclid)(=|$)')), '&') AS form
            FROM split LEFT JOIN ruled ON split.host = ruled.host AND split.path = ruled.path),
        decided AS (SELECT form, bool_or(verdict = 'block') AS block, bool_or(verdict = 'allow') AS allow FROM formed WHERE verdict IS NOT NULL GROUP BY form)
        SELECT page_id, host, path, rule, COALESCE(verdict, CASE WHEN block AND NOT allow THEN 'block' ELSE 'allow' END) AS verdict
        FROM formed LEFT JOIN decided ON formed.form = decided.form
    """,
    "op9_warc_fixity": """
        WITH named AS (
            SELECT page_id, COALESCE(CAST(CAST(floor(page_id / 1000) AS BIGINT) AS VARCHAR), 'none') AS file,
                   'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || COALESCE(url, '')
                   || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || COALESCE(CAST(page_id AS VARCHAR), 'none') || '>' || chr(13) || chr(10)
                   || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(COALESCE(html, '')) AS VARCHAR)
                   || chr(13) || chr(10) || chr(13) || chr(10) || COALESCE(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
            FROM pages),
        hashed AS (SELECT page_id, file, CAST(strlen(record) AS BIGINT) AS record_length, sha256(record) AS record_sha256 FROM named)
        SELECT page_id, file, CAST(COALESCE(SUM(record_length) OVER (PARTITION BY file ORDER BY page_id, record_sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset,
               record_length, record_sha256, CASE page_id % 97 WHEN 5 THEN 'changed' WHEN 6 THEN 'changed' WHEN 7 THEN 'missing' ELSE 'same' END AS status
        FROM hashed
    """,
}
