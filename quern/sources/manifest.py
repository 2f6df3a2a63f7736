"""Manifests of harvested pages: scan, upsert, resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.checks import refuse_change, refuse_empty

PAGE = "title STRING, pageid BIGINT, quality INT, page_number INT, text STRING, revid BIGINT, cleaning INT, image STRING"
MANIFEST = f"index STRING, min_quality INT, pages ARRAY<STRUCT<{PAGE.replace(' STRING', ': STRING').replace(' BIGINT', ': BIGINT').replace(' INT', ': INT')}>>"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of the manifests under path; a page without a cleaning version has version 1."""
    found = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(path)
    return found.select("index", "min_quality", F.inline("pages")).withColumn("cleaning", F.coalesce("cleaning", F.lit(1)))


def upsert(existing: DataFrame, fresh: DataFrame, key: str = "page_number") -> DataFrame:
    """Rows of both; fresh ones win.  Keys must be unique on either side."""
    return existing.join(fresh.select(key), key, "left_anti").select(*existing.columns).unionByName(fresh.select(*existing.columns))


def to_fetch(listed: DataFrame, existing: DataFrame, current: int | None = None, key: str = "page_number") -> DataFrame:
    """Listed pages that are not there; with current, also those cleaned by an older version."""
    there = existing if current is None else existing.where(F.coalesce(F.col("cleaning"), F.lit(1)) >= current)
    return listed.join(there.select(key), key, "left_anti")


def write_manifest(pages: DataFrame, index: str, min_quality: int, path: str, existing: DataFrame | None = None) -> None:
    """One JSON document for each work, pages sorted; no pages, or another work's, are refused."""
    refuse_empty(pages, "a harvest without pages")
    if existing is not None:
        refuse_change(existing, "index", index)
        pages = upsert(existing.select(*pages.columns), pages)
    body = F.array_sort(F.collect_list(F.struct("page_number", *[c for c in pages.columns if c not in ("page_number", "index", "min_quality")])))
    pages.agg(body.alias("pages")).select(F.lit(index).alias("index"), F.lit(min_quality).alias("min_quality"), "pages").coalesce(1).write.json(path)
