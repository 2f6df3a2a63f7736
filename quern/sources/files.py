"""Scans and sinks of the file formats around a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, text) of the ``<page>.txt`` files under path, whole."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    return found.select(name.alias("path"), F.regexp_extract(name, r"(\d+)\.txt$", 1).try_cast("int").alias("page"), F.col("value").alias("text"))


def read_table(spark: SparkSession, path: str, schema: str, tab: bool = False) -> DataFrame:
    """CSV or TSV with a header; empty fields are null."""
    return spark.read.schema(schema).option("header", True).option("sep", "\t" if tab else ",").option("nullValue", "").csv(path)


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """(word, n) of a tab-separated list, plain or gzipped."""
    return spark.read.schema("word string, n bigint").option("sep", "\t").option("quote", "").csv(path)


def write_wordlist(counts: DataFrame, path: str, least: int = 1, gzip: bool = True) -> None:
    """Words of at least ``least``, the most frequent first.  Spark sorts by ranges, so that no task holds the list."""
    counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").write.option("sep", "\t").option("quote", "").option("compression", "gzip" if gzip else "none").csv(path)


def write_sidecar(values: DataFrame, path: str) -> None:
    """Provenance: one JSON document of a one-row frame."""
    values.coalesce(1).write.json(path)


def write_table(rows: DataFrame, path: str, tab: bool = False) -> None:
    """CSV or TSV with a header, as audits of crops and lists of faces are kept; null is an empty field."""
    rows.write.option("header", True).option("sep", "\t" if tab else ",").option("nullValue", "").csv(path)


def recipe(values: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """(recipe): one JSON object of the settings (key, value), keys in order; a recipe is short."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value).cast("string"))))
    return values.agg(F.to_json(F.map_from_entries(pairs)).alias("recipe"))


def write_recipe(values: DataFrame, path: str, key: str = "key", value: str = "value") -> None:
    recipe(values, key, value).withColumnRenamed("recipe", "value").coalesce(1).write.text(path)


def discover(spark: SparkSession, root: str, name: str = "manifest.json") -> DataFrame:
    """(folder, modified) of the folders under root that hold a file of this name; no file is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root)
    return found.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("modificationTime").alias("modified"))


def evaluation_sets(spark: SparkSession, root: str, images: str = "images") -> DataFrame:
    """(folder) of the folders under root that hold a manifest and a folder of images with something in it."""
    pictures = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    parents = pictures.select(F.regexp_extract("path", rf"^(.*)/{images}/[^/]*$", 1).alias("folder")).where("folder <> ''").distinct()
    return discover(spark, root).select("folder").join(parents, "folder", "left_semi")


CANDIDATES = "file STRING, label STRING, greedy STRING, words STRING"


def read_nbest(spark: SparkSession, path: str) -> DataFrame:
    """(file, label, greedy, words array<struct<greedy,cands array<struct<text,logp>>>>) of JSON lines with nested pairs."""
    raw = spark.read.schema(CANDIDATES).json(path)
    words = F.from_json("words", T.ArrayType(T.StringType()))

    def word(w: Column) -> Column:
        pair = F.from_json(w, T.ArrayType(T.StringType()))
        cands = F.transform(F.from_json(F.get(pair, 1), T.ArrayType(T.StringType())), lambda c: F.struct(F.get(F.from_json(c, T.ArrayType(T.StringType())), 0).alias("text"), F.get(F.from_json(c, T.ArrayType(T.StringType())), 1).try_cast("double").alias("logp")))
        return F.struct(F.get(pair, 0).alias("greedy"), cands.alias("cands"))

    return raw.select("file", "label", "greedy", F.transform(words, word).alias("words"))


DETECTIONS = "box ARRAY<ARRAY<DOUBLE>>, text STRING, conf DOUBLE"


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """(page, text, l, t, r, b, conf) of ``<page>.json`` files, each an array of quadrangles."""
    found = spark.read.schema(DETECTIONS).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    page = F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)\.json$", 1).try_cast("bigint")

    def edge(at: int, pick) -> Column:
        return pick(F.transform("box", lambda p: F.get(p, at)))

    return found.select(page.alias("page"), "text", edge(0, F.array_min).alias("l"), edge(1, F.array_min).alias("t"), edge(0, F.array_max).alias("r"), edge(1, F.array_max).alias("b"), "conf")


def read_log(spark: SparkSession, path: str, pattern: str = r"\s+[+-] (\S+): (\w+)") -> DataFrame:
    """(name, value) of the lines that the pattern matches."""
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(F.regexp_extract("value", pattern, 1).alias("name"), F.regexp_extract("value", pattern, 2).alias("value"))


def write_readings(readings: DataFrame, path: str) -> None:
    """(set, page, text) as a folder for each set."""
    readings.repartition("set").write.partitionBy("set").json(path)


def document_pages(documents: DataFrame, year: str = "year", pages: str = "pages") -> DataFrame:
    """A row for each page of each document, numbered ``year * 100 + page``."""
    return documents.withColumn("page", F.explode(F.sequence(F.lit(1), F.col(pages)))).withColumn("page_number", F.col(year) * 100 + F.col("page"))


def uncached(requests: DataFrame, cache: DataFrame, url: str = "url") -> DataFrame:
    """Requests whose content key, the SHA-256 of the URL, is not in cache (key)."""
    return requests.withColumn("key", F.sha2(F.col(url), 256)).join(cache.select("key"), "key", "left_anti")


def select_datasets(leaves: DataFrame, names: list[str], exact: bool = True, path: str = "path") -> DataFrame:
    """(name, path) of the folders of each dataset: named exactly by the last part, or, as some loaders do, anywhere in the path."""
    listed = leaves.sparkSession.createDataFrame([(n,) for n in names], "name string")
    fits = F.substring_index(F.col(path), "/", -1) == F.col("name") if exact else F.col(path).contains(F.col("name"))
    return leaves.join(F.broadcast(listed), fits).select("name", path)
