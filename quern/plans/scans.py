"""Queries that write files and read them back through the sources, and scans of an API."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from quern.functions import text
from quern.sources import api, archive, files, labels, manifest

from .derived import BOXES, boxes, laid_apart, scratch, table, tokens_of
from .registry import query

INDEXES = [f"Work {n}" for n in (0, 5, 7, 40)]
_TOLD = "told AS (SELECT 'Work ' || n AS index, unnest(range(n)) AS i, n FROM (VALUES (0), (5), (7), (40)) t(n))"


@query(f"WITH {_TOLD} SELECT index, index || '/' || i AS title, 1000 * n + i AS pageid, CAST(i % 5 AS INT) AS quality FROM told WHERE i % 6 <> 5 AND i % 5 >= 3")
def index_scan(spark, sf):
    """Every index is a partition, which follows its continuation to the end."""
    spark.dataSource.register(api.PageIndex)
    return spark.read.format("page_index").option("indexes", json.dumps(INDEXES)).option("transport", "quern.plans.derived:rehearsal").load()


@query("""SELECT DISTINCT title, CASE WHEN failed THEN NULL ELSE 'text of ' || title END AS text, CASE WHEN failed THEN NULL ELSE 7 * n END AS revid, CASE WHEN failed THEN 'RuntimeError: the API says: no such page' END AS error
    FROM (SELECT source || '/' || (doc_id % 100) AS title, doc_id % 100 AS n, doc_id % 10 = 3 AS failed FROM documents WHERE doc_id % 7 <> 0) WHERE title NOT IN (SELECT source || '/' || (doc_id % 100) FROM documents WHERE doc_id % 7 = 0)""")
def crawl_with_errors(spark, sf):
    titled = table(spark, sf, "documents").select("doc_id", F.concat("source", F.lit("/"), (F.col("doc_id") % 100).cast("string")).alias("title"))
    return api.crawl(titled.where("doc_id % 7 <> 0"), "quern.plans.derived:rehearsal", done=titled.where("doc_id % 7 = 0"))


@query("""SELECT p.title, d.text, 7 * d.doc_id AS revid FROM (SELECT source || '/' || doc_id AS title FROM documents WHERE doc_id % 3 = 0) p JOIN (SELECT source || '/' || doc_id AS title, text, doc_id FROM documents) d ON p.title = d.title""")
def page_lookup(spark, sf):
    stored = table(spark, sf, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("title"), "text", (7 * F.col("doc_id")).alias("revid"), "doc_id")
    return stored.where("doc_id % 3 = 0").select("title").join(stored.drop("doc_id"), "title")


@query("SELECT doc_id AS page, text FROM documents")
def archive_texts(spark, sf):
    docs = table(spark, sf, "documents")
    held = docs.select((F.col("doc_id") % 16).alias("path"), F.concat(F.lit("text/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), F.col("text").alias("body"))
    return archive.texts(archive.packed(held, "path").withColumn("path", F.col("path").cast("string"))).select("page", "text")


@query(f"WITH {BOXES} SELECT page, place, text, l, t, r, b, CAST(0.9 AS DOUBLE) AS conf FROM boxes WHERE page % 1000 = 0")
def archive_detections(spark, sf):
    docs = table(spark, sf, "documents")
    first = boxes(tokens_of(docs)).where("page % 1000 = 0")
    tars = archive.packed(archive.prediction_files(first, laid_apart(docs)).withColumn("path", (F.floor(F.col("page") / 1000) % 16).cast("string")), "path")
    return archive.detections(tars).select("page", "place", "text", "l", "t", "r", "b", "conf")


def _half_packed(rows):
    """(doc_id, content): the texts' bytes, of every other document packed."""
    held = rows.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return archive.rewritten(held, lambda i, x: gzip.compress(x) if i % 2 else x)


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def gzip_by_magic(spark, sf):
    packed = _half_packed(table(spark, sf, "documents").select("doc_id", "text"))
    return archive.unpacked(packed).select("doc_id", F.sha2("content", 256).alias("sha"))


@query("""SELECT 'd' || doc_id || '.png' AS filename, words FROM (SELECT doc_id, regexp_replace(substr(text, 1, 200), '[\\r\\n]+', ' ', 'g') AS words FROM documents)""")
def label_files(spark, sf):
    path = scratch(spark, "labels")
    labels.write_labels(table(spark, sf, "documents").select(F.format_string("d%d.png", "doc_id").alias("filename"), F.regexp_replace(F.substring("text", 1, 200), r"[\r\n]+", " ").alias("words")), path)
    return labels.read_labels(spark, path)


@query("SELECT o_orderkey AS file, CAST(o_custkey AS INT) AS family, NULLIF(o_orderpriority, '1-URGENT') AS face FROM orders")
def table_files(spark, sf):
    path = scratch(spark, "faces")
    files.write_table(table(spark, sf, "orders").select(F.col("o_orderkey").alias("file"), F.col("o_custkey").alias("family"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("face")), path, tab=True)
    return files.read_table(spark, path, "file bigint, family int, face string", tab=True)


@query("SELECT conv_id, CAST(turn AS INT) AS turn, text AS greedy, [text, translate(text, 'aeo', 'eoa')] AS cands, [CAST(-0.5 AS DOUBLE), -1.25] AS logps FROM conversations")
def nbest_lines(spark, sf):
    path = scratch(spark, "nbest")
    said = table(spark, sf, "conversations")
    pair = lambda c, p: F.concat(F.lit("["), F.to_json(F.array(c)), F.lit(f",{p}]"))
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    t = F.coalesce("text", F.lit(""))
    cands = F.concat(F.lit("[["), quoted(t), F.lit(",-0.5],["), quoted(F.translate(t, "aeo", "eoa")), F.lit(",-1.25]]"))
    line = F.concat(F.lit('{"file":"'), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"), F.lit('","label":"l","greedy":"g","words":[['), quoted(t), F.lit(","), cands, F.lit("]]}"))
    said.select(line.alias("value")).write.text(path)
    word = files.read_nbest(spark, path).select(F.split("file", "/").alias("f"), F.explode("words").alias("w"))
    return word.select(F.get("f", 0).cast("bigint").alias("conv_id"), F.get("f", 1).cast("int").alias("turn"), "w.greedy", F.transform("w.cands", lambda c: c["text"]).alias("cands"), F.transform("w.cands", lambda c: c["logp"]).alias("logps"))


@query("SELECT 'doc' || doc_id AS name, lang AS value FROM documents WHERE doc_id % 3 <> 0 AND lang IS NOT NULL")
def log_lines(spark, sf):
    path = scratch(spark, "log")
    told = F.when(F.col("doc_id") % 3 == 0, F.format_string("doc%d is skipped", "doc_id")).otherwise(F.format_string("  %s doc%d: %s", F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-"), "doc_id", "lang"))
    table(spark, sf, "documents").where("lang is not null").select(told.alias("value")).write.text(path)
    return files.read_log(spark, path)


@query("SELECT 'Work' AS index, 3 AS min_quality, page_id AS page_number, CASE WHEN page_id % 5 = 0 THEN 9 WHEN page_id % 2 = 0 THEN 1 ELSE 2 END AS cleaning, 'text/' || page_id || '.txt' AS text FROM pages")
def manifest_files(spark, sf):
    """A manifest written twice, the second time with some pages anew, and read again."""
    first, second = scratch(spark, "first"), scratch(spark, "second")
    pages = table(spark, sf, "pages")
    of = pages.select(
        F.concat(F.lit("T/"), F.col("page_id").cast("string")).alias("title"), F.col("page_id").alias("pageid"), F.lit(3).alias("quality"), F.col("page_id").cast("int").alias("page_number"),
        F.format_string("text/%d.txt", "page_id").alias("text"), F.lit(None).cast("bigint").alias("revid"), F.when(F.col("page_id") % 2 == 1, 2).alias("cleaning"), F.lit(None).cast("string").alias("image"),
    )
    manifest.write_manifest(of, "Work", 3, first)
    read = lambda path: spark.read.schema(manifest.MANIFEST).json(path).select("index", "min_quality", F.inline("pages")).withColumn("cleaning", F.coalesce("cleaning", F.lit(1)))
    manifest.write_manifest(of.where("page_number % 5 = 0").withColumn("cleaning", F.lit(9)), "Work", 3, second, read(first))
    return read(second).select("index", "min_quality", "page_number", "cleaning", "text")


@query("SELECT source AS set, doc_id AS page, text FROM documents")
def readings_files(spark, sf):
    path = scratch(spark, "readings")
    files.write_readings(table(spark, sf, "documents").select(F.col("source").alias("set"), F.col("doc_id").alias("page"), "text"), path)
    return spark.read.schema("page bigint, text string, set string").json(path).select("set", "page", "text")


@query("SELECT o_orderpriority AS word, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 10")
def wordlist_files(spark, sf):
    path = scratch(spark, "words")
    files.write_wordlist(table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("word")).agg(F.count("*").alias("n")), path, least=10)
    return files.read_wordlist(spark, path)


@query("""SELECT '{' || string_agg('"' || lang || '":"' || n || '"', ',' ORDER BY lang) || '}' AS recipe FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)""")
def recipe_json(spark, sf):
    return files.recipe(table(spark, sf, "documents").where("lang is not null").groupBy(F.col("lang").alias("key")).agg(F.count("*").alias("value")))


@query("SELECT source, count(*) AS labels FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source")
def label_counts(spark, sf):
    """Lines of label files, each with its header, which does not count."""
    lines = table(spark, sf, "documents").select("source", F.explode(F.split("text", "\n")).alias("value"))
    headed = lines.unionByName(lines.select("source").distinct().withColumn("value", F.lit(labels.HEADER)))
    return labels.label_counts(headed, "source")


@query(r"""SELECT filename, regexp_replace(words, '[^A-Za-z ]', '', 'g') AS label FROM (SELECT doc_id AS filename, unnest(string_split(text, chr(10))) AS words FROM documents) WHERE length(words) <= 200""")
def labels_stripped(spark, sf):
    """The length is that of the label as it is listed, not of what is left of it."""
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("filename"), F.explode(F.split("text", "\n")).alias("words")).where(F.length("words") <= 200)
    return lines.select("filename", labels.stripped(F.col("words"), "A-Za-z ").alias("label"))


@query("SELECT 'upper' AS kind, source || ' 1.djvu' AS title, CAST(1 AS INT) AS volume FROM documents GROUP BY source")
def title_volumes(spark, sf):
    titles = table(spark, sf, "documents").select(F.concat(F.lit("Index:"), "source", F.lit(" 1.djvu")).alias("index")).distinct()
    swapped = titles.select(text.file_title(F.col("index"), "Index:", "").alias("title"))
    return swapped.select(F.lit("upper").alias("kind"), "title", text.volume_of(F.col("title")).alias("volume"))


@query("SELECT count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, sha256('v1') AS version FROM documents")
def sidecar_files(spark, sf):
    path = scratch(spark, "sidecar")
    told = table(spark, sf, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))
    files.write_sidecar(told.withColumn("version", F.sha2(F.lit("v1"), 256)), path)
    return spark.read.schema("documents bigint, chars bigint, version string").json(path)
