"""Contamination: shingles that two sets of texts share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.arrays import let
from quern.functions.text import tokens

from .checks import refuse_empty

#: A side of at most so many shingles is broadcast (about 60 MB of hashes); a larger one is shuffled.
BROADCAST_ROWS = 2_000_000


def shingles(text: Column, k: int = 8) -> Column:
    """The distinct runs of k tokens of text in lower case; none of shorter texts."""
    none = F.array().cast("array<string>")

    def windows(t: Column) -> Column:
        return F.when(F.size(t) >= k, F.transform(F.sequence(F.lit(1), F.size(t) - k + 1), lambda i: F.array_join(F.slice(t, i, k), " "))).otherwise(none)

    return F.array_distinct(let(tokens(F.lower(text)), windows))


def shared_runs(docs: DataFrame, held: DataFrame, doc_id: str, held_id: str, text: str = "text", k: int = 8, least: int = 5) -> DataFrame:
    """(doc_id, held_id, shared_runs) of pairs with at least ``least`` distinct runs of k tokens in common.

    The held side must not be empty: an empty one would pass everything.  It is broadcast
    if it is small enough, by a count; else both sides are shuffled on the runs.
    """
    ours = held.select(held_id, F.explode(shingles(F.col(text), k)).alias("run"))
    count = refuse_empty(ours, "the held side has no runs")
    theirs = docs.select(doc_id, F.explode(shingles(F.col(text), k)).alias("run"))
    met = theirs.join(F.broadcast(ours) if count <= BROADCAST_ROWS else ours, "run")
    return met.groupBy(doc_id, held_id).agg(F.count("*").alias("shared_runs")).where(F.col("shared_runs") >= least)
