"""Word lists: counts by key, thresholds, unions, raises, and correction by a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import edges, lexicon_key, tokens


def word_counts(docs: DataFrame, letter: str, text: str = "text", by: list[str] = ()) -> DataFrame:
    """(by..., word, n) of the keys with one of the letters (a class such as ``A-Za-z``)."""
    words = docs.select(*by, F.explode(tokens(F.col(text))).alias("tok")).select(*by, lexicon_key(F.col("tok")).alias("word"))
    return words.where(F.col("word").rlike(f"[{letter}]")).groupBy(*by, "word").agg(F.count("*").alias("n"))


def at_least(counts: DataFrame, least: int) -> DataFrame:
    return counts.where(F.col("n") >= least)


def united(*lists: DataFrame) -> DataFrame:
    """Word lists as one; counts add up."""
    both = lists[0].select("word", "n")
    for other in lists[1:]:
        both = both.unionByName(other.select("word", "n"))
    return both.groupBy("word").agg(F.sum("n").alias("n"))


def raised(counts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """counts with each of words at least ``least``, new ones included."""
    more = words.select("word", F.lit(least).cast("bigint").alias("n"))
    return counts.select("word", "n").unionByName(more).groupBy("word").agg(F.max("n").alias("n"))


def external_forms(lexicon: DataFrame) -> DataFrame:
    """(word) of a nested lexicon: lexemes of lemmas of word forms."""
    lemmas = lexicon.select(F.explode("lexemes").alias("x")).select(F.explode("x.lemmas").alias("y"))
    return lemmas.select(F.explode("y.wordForms").alias("z")).select(F.col("z.s").alias("word")).where("word is not null").distinct()


def corrected(words: DataFrame, lexicon: DataFrame, taus: DataFrame, letter: str, key: list[str]) -> DataFrame:
    """words at each tau, with ``chosen``.

    words: key columns, greedy, cands array<struct<text,logp>> in order of probability.
    A word is kept if its key is short, has no letter, or is listed.  Else its first
    candidate that is listed and has the same edges decides: it is chosen if the greedy
    reading is no more than tau more probable, and if not, the word is kept.
    The greedy reading and the candidates meet the lexicon in one join by word, whatever its
    size; a side is broadcast only by Spark's own measure.
    """
    g = F.col("greedy")
    own = F.coalesce(F.get(F.filter("cands", lambda c: c["text"] == g), 0)["logp"], F.get("cands", 0)["logp"])
    read = F.array(F.struct(g.alias("text"), F.lit(None).cast("double").alias("logp")))
    every = words.select(*key, "greedy", own.alias("own"), F.posexplode(F.concat(read, "cands")).alias("at", "c")).select(*key, "greedy", "own", "at", "c.text", "c.logp")
    met = every.withColumn("word", lexicon_key(F.col("text"))).join(lexicon.select("word", F.lit(True).alias("listed")), "word", "left")
    (gb, ga), (tb, ta) = edges(g), edges(F.col("text"))
    fits = F.coalesce("listed", F.lit(False)) & (F.col("at") > 0) & (gb == tb) & (ga == ta)
    first = F.min_by(F.when(fits, F.struct("text", "logp")), F.when(fits, F.col("at")))
    told = met.groupBy(*key).agg(F.max("greedy").alias("greedy"), F.max("own").alias("own"), F.bool_or(F.col("listed") & (F.col("at") == 0)).alias("listed"), first.alias("first"))
    word = lexicon_key(g)
    kept = (F.length(word) < 2) | ~word.rlike(f"[{letter}]") | F.coalesce("listed", F.lit(False)) | F.col("first").isNull()
    swept = told.crossJoin(F.broadcast(taus))  # taus: a short list of thresholds
    return swept.select(*key, "tau", "greedy", F.when(kept | (F.col("own") - F.col("first.logp") > F.col("tau")), g).otherwise(F.col("first.text")).alias("chosen"))


def outcome(rows: DataFrame, truth: Column, by: list[str], n: Column | None = None) -> DataFrame:
    """(by..., ok, fixed, broke, corrections) of rows with greedy and chosen; n tells for how many words a row stands."""
    was, now = F.col("greedy") == truth, F.col("chosen") == truth
    each = F.lit(1) if n is None else n

    def count(what: Column) -> Column:
        return F.coalesce(F.sum(F.when(what, each)), F.lit(0)).cast("bigint")

    return rows.groupBy(*by).agg(count(now).alias("ok"), count(now & ~was).alias("fixed"), count(was & ~now).alias("broke"), count(F.col("greedy") != F.col("chosen")).alias("corrections"))
