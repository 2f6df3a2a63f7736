"""Metrics of readings against the expected text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.arrays import let
from quern.functions.sequences import ratio
from quern.functions.text import fold_metric, is_word, tokens
from quern.sources.archive import rewritten


def word_recall(actual: Column, expected: Column) -> Column:
    """Share of the expected words, repeats counted, that the actual text has; 1 if none is expected."""
    have = F.array_distinct(tokens(fold_metric(actual)))
    want = F.filter(tokens(fold_metric(expected)), is_word)

    def share(x: Column) -> Column:
        return F.when(F.size(x["want"]) == 0, 1.0).otherwise(F.size(F.filter(x["want"], lambda w: F.array_contains(x["have"], w))) / F.size(x["want"]))

    return let(F.struct(have.alias("have"), want.alias("want")), share)


def recalled(rows: DataFrame, key: str) -> DataFrame:
    """(key, word_recall) of rows (key, want, have), folded texts whose words are told apart by spaces: ``word_recall`` of long texts.

    Python looks each word up in a set of its row; the search of an array for each word would be
    quadratic, and a join of words would deal all of them out.
    """

    def share(_, both: bytes) -> float:
        want, _, have = both.partition(b"\n")
        words, known = [w for w in want.split(b" ") if w], set(have.split(b" "))
        return sum(w in known for w in words) / len(words) if words else 1.0

    held = rows.select(key, F.concat("want", F.lit("\n"), "have").cast("binary").alias("word_recall"))
    return rewritten(held, share, key, "word_recall", T.DoubleType())


def char_similarity(actual: Column, expected: Column) -> Column:
    return ratio(fold_metric(actual), fold_metric(expected))


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt out evenly over the shuffle partitions: texts that fit few files, but cost much to compare, keep all cores at work."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def norm_edit(truth: Column, predicted: Column) -> Column:
    """1 less the edit distance over the longer length; 0 if either is empty."""
    longer = F.greatest(F.length(truth), F.length(predicted))
    return F.when((F.length(truth) == 0) | (F.length(predicted) == 0), 0.0).otherwise(1 - F.levenshtein(truth, predicted) / longer)


def macro_mean(scores: DataFrame, group: str, value: str) -> DataFrame:
    """The unweighted mean over groups of their means; missing scores count nowhere."""
    return scores.groupBy(group).agg(F.avg(value).alias("_m")).agg(F.round(F.avg("_m"), 6).alias("macro_mean"), F.count("_m").alias("groups"))


def rescored(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """old with its values replaced where new has them."""
    fresh = new.select(*keys, *(F.col(v).alias(f"_{v}") for v in values))
    return old.join(fresh, keys, "left").withColumns({v: F.coalesce(f"_{v}", v) for v in values}).drop(*(f"_{v}" for v in values))


def backend_summary(rows: DataFrame) -> DataFrame:
    """Of each backend mean scores, total seconds and readings; failures, which are null, count nowhere."""
    return rows.groupBy("backend").agg(F.round(F.avg("char_sim"), 6).alias("char_sim"), F.round(F.avg("word_recall"), 6).alias("word_recall"), F.round(F.sum("seconds"), 6).alias("seconds"), F.count("word_recall").alias("n"))


def best_so_far(rows: DataFrame, value: str, order: str, group: list[str] = ()) -> DataFrame:
    """The rows that exceed every earlier one."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_best", F.max(value).over(w)).where(F.col("_best").isNull() | (F.col(value) > F.col("_best"))).drop("_best")


def contrast(values: Column) -> Column:
    """struct<p10,p90> of a row's array, percentiles interpolated; the contrast is their difference over their sum."""

    def at(s: Column, q: float) -> Column:
        x = (F.size(s) - 1) * F.lit(q)
        i = F.floor(x).cast("int")
        lo, hi = F.get(s, i), F.get(s, F.least(i + 1, F.size(s) - 1))
        return lo + (hi - lo) * (x - i)

    return let(F.array_sort(values.cast("array<double>")), lambda s: F.struct(at(s, 0.1).alias("p10"), at(s, 0.9).alias("p90")))


def stretched(values: Column, low: Column, high: Column) -> Column:
    """``(x - low + 25) * 200 / (high - low)`` within 0 to 255; the spread is 10 at least."""
    by = F.lit(200.0) / F.greatest(F.lit(10.0), high - low)
    return F.transform(values, lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), (x.cast("double") - low + 25) * by)))


def stage_means(rows: DataFrame, stages: dict[str, Column], expected: Column) -> DataFrame:
    """(stage, similarity, n): the mean character similarity of each stage's text to the expected one; a missing text counts nowhere."""
    long = spread(rows).select(expected.alias("expected"), F.explode(F.array(*(F.struct(F.lit(k).alias("stage"), c.alias("text")) for k, c in stages.items()))).alias("s")).select("expected", "s.*")
    scored = long.withColumn("similarity", char_similarity(F.col("text"), F.col("expected")))
    return scored.groupBy("stage").agg(F.round(F.avg("similarity"), 6).alias("similarity"), F.count("similarity").alias("n"))


def exact_by(rows: DataFrame, by: list[str], read: str = "read", label: str = "label") -> DataFrame:
    """(by..., lines, exact, similarity): share of lines read exactly, and their mean edit similarity."""
    each = rows.select(*by, (F.col(read) == F.col(label)).cast("double").alias("exact"), norm_edit(F.col(label), F.col(read)).alias("similarity"))
    return each.groupBy(*by).agg(F.count("*").alias("lines"), F.round(F.avg("exact"), 6).alias("exact"), F.round(F.avg("similarity"), 6).alias("similarity"))


def running_mean(rows: DataFrame, value: str, order: str, group: list[str] = ()) -> DataFrame:
    """rows and the mean of all values so far, as a loss is averaged while a run goes on."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("running_mean", F.avg(value).over(w))


def cells(backends: DataFrame, pages: DataFrame, readings: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each of the backends, a short list, and each page: with the reading, or nulls where the backend failed."""
    return pages.crossJoin(F.broadcast(backends)).join(readings, keys, "left")


def by_register(rows: DataFrame, bundle: str, register: str, values: list[str]) -> DataFrame:
    """(bundle, registers, values...): the mean over registers of their means; a register without readings is no zero, it counts nowhere."""
    each = rows.groupBy(bundle, register).agg(*(F.avg(v).alias(v) for v in values), F.count(values[0]).alias("_n")).where("_n > 0")
    return each.groupBy(bundle).agg(F.count("*").alias("registers"), *(F.round(F.avg(v), 6).alias(v) for v in values))
