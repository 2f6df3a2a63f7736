"""Incremental runs: what is new in a folder is cleaned and upserted, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_pages(spark: SparkSession, path: str, schema: str, files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def cleaned(pages: DataFrame, clean: Callable[[Column], Column], version: int, text: str = "text") -> DataFrame:
    """pages cleaned and stamped; blank ones dropped.  A pure projection, so a batch may be played again."""
    return pages.withColumns({text: clean(F.col(text)), "cleaning": F.lit(version)}).where(F.length(text) > 0)


def upsert_available(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Take in all that is available, then stop.

    Each batch is written as a generation of its own, named by the batch: playing it again
    overwrites the same generation.  ``current`` reads the newest row of each key.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("generation", F.lit(number)).write.mode("overwrite").parquet(f"{target}/generation_id={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, key: list[str], newest: str = "generation") -> DataFrame:
    """Of each key the row of the newest generation."""
    rows = spark.read.parquet(target).drop("generation_id")
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), newest).alias("r")).select("r.*")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours", ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """Tumbling counts and sums by kind with a watermark; the same on a stream and on a table."""
    held = events.withWatermark(ts, late) if events.isStreaming else events
    return held.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", ts: str = "ts", user: str = "user_id") -> DataFrame:
    """Sessions of each user, ended by a gap."""
    held = events.withWatermark(ts, late) if events.isStreaming else events
    return held.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), user, "n")
