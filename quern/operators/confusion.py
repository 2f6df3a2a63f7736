"""Confusion tables of characters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.charset import characters
from quern.functions.sequences import confusions


def confusion_counts(pairs: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(truth, predicted, n).  Equal pairs are left out before Python sees them, and equal misreadings are compared once."""
    wrong = pairs.where(F.col(truth) != F.col(predicted)).groupBy(truth, predicted).agg(F.count("*").alias("_n"))
    each = wrong.select("_n", confusions(F.col(truth), F.col(predicted)).alias("all")).select("_n", F.explode("all").alias("c"))
    return each.groupBy(F.col("c.truth").alias("truth"), F.col("c.predicted").alias("predicted")).agg(F.sum("_n").alias("n"))


def counts_by_place(pairs: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(truth, predicted, n) of readings that keep each character's place: the n-th is compared with the n-th, and none is read as another's.

    Matching blocks would take a digit that stands in the truth for the same digit as a misreading
    (``a1`` read ``11``).  Characters beyond the shorter one's end are not told.
    """
    wrong = pairs.where(F.col(truth) != F.col(predicted)).groupBy(truth, predicted).agg(F.count("*").alias("_n"))
    both = F.arrays_zip(characters(F.col(truth)).alias("truth"), characters(F.col(predicted)).alias("predicted"))
    each = wrong.select("_n", F.explode(F.filter(both, lambda x: x["truth"] != x["predicted"])).alias("c"))
    return each.groupBy(F.col("c.truth").alias("truth"), F.col("c.predicted").alias("predicted")).agg(F.sum("_n").alias("n"))


def split_counts(counts: DataFrame, alike: list[tuple[str, str]]) -> DataFrame:
    """(homoglyph, shape): confusions between look-alikes, and others."""
    same = F.lit(False)
    for a, b in alike:
        same = same | ((F.col("truth") == a) & (F.col("predicted") == b)) | ((F.col("truth") == b) & (F.col("predicted") == a))
    return counts.agg(F.coalesce(F.sum(F.when(same, F.col("n"))), F.lit(0)).alias("homoglyph"), F.coalesce(F.sum(F.when(~same, F.col("n"))), F.lit(0)).alias("shape"))


def watched(counts: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(truth, predicted, n) of the listed pairs, zero if absent."""
    listed = counts.sparkSession.createDataFrame(pairs, "truth string, predicted string")
    return listed.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def top(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "truth", "predicted").limit(n)
