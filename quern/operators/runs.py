"""Runs of usable tokens, and the lines cut from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.arrays import let
from quern.functions.text import tokens


def token_runs(docs: DataFrame, usable, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, run array<string>): maximal runs of usable tokens, broken by others and by the text's end.

    start is the place of the run's first token.  The fold keeps to the row, so long texts cost no shuffle.
    """


    def between(b: Column, t: Column) -> Column:
        """The runs between neighbouring bad places b."""
        runs = F.transform(F.slice(b, 2, F.size(b) - 1), lambda end, i: F.struct((F.get(b, i) + 1).alias("start"), F.slice(t, F.get(b, i) + 2, end - F.get(b, i) - 1).alias("run")))
        return F.filter(runs, lambda r: F.size(r["run"]) > 0)

    def split(t: Column) -> Column:
        bad = F.filter(F.transform(t, lambda x, i: F.when(~usable(x), i)), lambda i: i.isNotNull())
        return let(F.concat(F.array(F.lit(-1)), bad, F.array(F.size(t))), lambda b: between(b, t))

    return docs.select(doc_id, F.explode(let(tokens(F.col(text)), split)).alias("r")).select(doc_id, "r.start", "r.run")


def draw(key: Column, most: int) -> Column:
    """1 to most, from the MD5 of key: the same draw in every engine."""
    return (F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("int") % most) + 1


def line_candidates(runs: DataFrame, doc_id: str = "doc_id", most_tokens: int = 4, most_chars: int = 30) -> DataFrame:
    """(id, pos, line): from each place of a run 1 to most_tokens tokens, drawn by hash, if the line is short enough."""
    places = runs.select(doc_id, "start", "run", F.posexplode("run").alias("at", "_"))
    pos = (F.col("start") + F.col("at")).alias("pos")
    take = draw(F.concat_ws("|", F.col(doc_id).cast("string"), (F.col("start") + F.col("at")).cast("string")), most_tokens)
    line = F.array_join(F.slice("run", F.col("at") + 1, take), " ")
    return places.select(doc_id, pos, line.alias("line")).where(F.length("line") <= most_chars)
