"""Corpus profiles: character strays, marker rates with verdicts, census roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.charset import characters, ranges


def _stray(text: Column | str, allowed: str) -> Column:
    """text without the characters of allowed and without white space, which go in whole runs."""
    return F.regexp_replace(text, rf"(?U)[\s{ranges(allowed)}]++", "")


def stray_counts(docs: DataFrame, allowed: str, text: str = "text") -> DataFrame:
    """(ch, n) of the characters outside allowed, white space aside."""
    chars = docs.select(F.explode(characters(_stray(text, allowed))).alias("ch"))
    return chars.groupBy("ch").agg(F.count("*").alias("n"))


def raw_and_residual(docs: DataFrame, allowed: str, normalise, text: str = "text") -> DataFrame:
    """(side, total, distinct_chars): strays before and after normalising."""
    sides = docs.select(F.explode(F.array(F.struct(F.lit("raw").alias("side"), F.col(text).alias("t")), F.struct(F.lit("residual").alias("side"), normalise(F.col(text)).alias("t")))).alias("s")).select("s.*")
    chars = sides.select("side", F.explode(characters(_stray("t", allowed))).alias("ch"))
    return chars.groupBy("side", "ch").agg(F.count("*").alias("n")).groupBy("side").agg(F.sum("n").alias("total"), F.count("*").alias("distinct_chars"))


# Orthography markers, patterns counted for each text.
ORTHOGRAPHY = {"letters": "[Ա-Ֆա-և]", "free_yiwn": "(?<![ոՈ])ւ", "final_y": "[աոեէիօ]յ(?![Ա-Ֆա-և])", "inner_e": "(?<=[ա-և])է", "two_letter_ew": "[եԵ]ւ", "ligature_ew": "և"}


def marker_counts(docs: DataFrame, group: str, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """(group, a count of each pattern).  No pattern spans texts, so counts of texts add up."""
    return docs.groupBy(group).agg(*(F.sum(F.regexp_count(text, F.lit(p))).alias(n) for n, p in patterns.items()))


def rate(count: Column, letters: Column, per: float = 1000.0) -> Column:
    """count per thousand letters; zero of no letters."""
    return F.coalesce(count * per / F.nullif(letters, F.lit(0)), F.lit(0.0))


def verdict(letters: Column, marker_rate: Column, high: float = 8.0, low: float = 2.0, least: int = 500) -> Column:
    """unknown of few letters, classical of a high rate, reformed of a low one, else mixed."""
    return F.when(letters < least, "unknown").when(marker_rate >= high, "classical").when(marker_rate <= low, "reformed").otherwise("mixed")


def verdict_rollup(verdicts: DataFrame, pages: str = "pages") -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count("*").alias("sources"), F.sum(pages).alias("pages"))


def quality_pivot(pages: DataFrame, group: str, quality: str = "quality", levels: tuple[int, ...] = (3, 4)) -> DataFrame:
    """(group, total, q<level>..., proofread): proofread are rows of any of the levels."""
    counts = [F.count_if(F.col(quality) == q).alias(f"q{q}") for q in levels]
    return pages.groupBy(group).agg(F.count("*").alias("total"), *counts, F.count_if(F.col(quality).isin(*levels)).alias("proofread"))


def census_totals(census: DataFrame) -> DataFrame:
    return census.agg(F.count("*").alias("indexes"), F.count_if(F.col("proofread") > 0).alias("covered"), F.sum("proofread").alias("proofread"))


def markdown(rows: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """(place, line): rows of a Markdown table, sorted; a report, so of few rows."""
    line = F.concat(F.lit("| "), F.array_join(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), " | "), F.lit(" |"))
    return rows.orderBy(*order).select(line.alias("line"))


def at_quality(pages: DataFrame, floor: int, floors: tuple[int, ...] = (3, 4), quality: str = "quality") -> DataFrame:
    """pages of at least floor, which must be one of floors; pages without a quality go."""
    if floor not in floors:
        raise ValueError(f"{floor} is none of {floors}")
    return pages.where(F.col(quality) >= floor)


def looked_up(rows: DataFrame, costly: DataFrame, key: str, worth: Column) -> DataFrame:
    """rows with the columns of costly, which only rows that are worth it are joined with; others have nulls."""
    asked = rows.where(F.coalesce(worth, F.lit(False))).select(key).distinct().join(costly, key)
    return rows.join(asked, key, "left")


def shares(rows: DataFrame, by: list[str], flags: dict[str, Column]) -> DataFrame:
    """(by..., n, a count of each flag, the share of each flag)."""
    counted = rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in flags.items()))
    return counted.withColumns({f"{name}_share": F.round(F.col(name) / F.col("n"), 6) for name in flags})
