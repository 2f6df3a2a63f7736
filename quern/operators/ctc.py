"""Connectionist temporal classification: encoding, greedy and beam decoding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.arrays import consecutive
from quern.functions.charset import characters


def encode(text: Column, charset: str) -> Column:
    """Classes of the characters, from 1; characters outside the set are null."""
    return F.transform(characters(text), lambda c: F.nullif(F.instr(F.lit(charset), c), F.lit(0)))


def greedy(classes: Column) -> Column:
    """classes without blanks (0) and repeats of the class just before."""
    return F.filter(classes, lambda x, i: (x != 0) & ((i == 0) | (x != F.get(classes, i - 1))))


def best_path(matrix: Column) -> Column:
    """The most probable class of each time; the first among equals."""
    return F.transform(matrix, lambda row: (F.array_position(row, F.array_max(row)) - 1).cast("int"))


def confidence(matrix: Column) -> Column:
    """The product of the times' highest probabilities."""
    return F.aggregate(matrix, F.lit(1.0).cast("double"), lambda a, row: a * F.array_max(row).cast("double"))


def ranked_labellings(matrix: np.ndarray, width: int = 25, literal: bool = False) -> list[tuple[int, ...]]:
    """The labellings that a prefix beam search of matrix (times, classes) ends with, the most probable first; class 0 is the blank.

    A prefix's chance is kept apart by whether its path ends in a blank.  literal follows a
    known decoder to the letter: it extends by the blank too, never by the last class.
    """
    beams: dict[tuple[int, ...], tuple[float, float]] = {(): (1.0, 0.0)}
    classes = range(0, matrix.shape[1] - 1) if literal else range(1, matrix.shape[1])
    for row in matrix:
        new: dict[tuple[int, ...], list[float]] = {}
        for prefix, (blank, sound) in sorted(beams.items(), key=lambda x: (-sum(x[1]), x[0]))[:width]:
            here = new.setdefault(prefix, [0.0, 0.0])
            here[0] += (blank + sound) * row[0]
            if prefix:
                here[1] += sound * row[prefix[-1]]
            for c in classes:
                new.setdefault((*prefix, c), [0.0, 0.0])[1] += row[c] * (blank if prefix and prefix[-1] == c else blank + sound)
        beams = {k: (v[0], v[1]) for k, v in new.items()}
    return sorted(beams, key=lambda k: (-sum(beams[k]), k))


def beam_search(matrix: np.ndarray, width: int = 25, literal: bool = False) -> list[int]:
    """The most probable labelling; literal takes blanks and repeats out of it at the end."""
    best = list(ranked_labellings(matrix, width, literal)[0])
    return [c for i, c in enumerate(best) if c and (i == 0 or best[i - 1] != c)] if literal else best


def segments(classes: Column, separators: dict[str, tuple[int, int]]) -> Column:
    """array<struct<name,first,last>> of a best path: its parts between separators.

    Each name has a class that opens it and one that closes it, and the part between is the
    name's; all else has the empty name.  Of a run of one opening class the last place
    counts, of a closing class the first.  A part that is closed by another name is given up.
    """

    def places(c: int, last: bool) -> Column:
        at = F.filter(F.transform(classes, lambda x, i: F.when(x == c, i)), lambda i: i.isNotNull())
        return F.transform(consecutive(at, last), lambda i: F.struct(i.alias("at"), F.lit(c).alias("mark")))

    marks = F.array_sort(F.concat(*(places(c, last) for pair in separators.values() for c, last in zip(pair, (True, False), strict=True))))
    part = lambda name, first, last: F.array(F.struct(name.alias("name"), first.alias("first"), last.alias("last")))
    none = F.array().cast("array<struct<name:string,first:int,last:int>>")

    def step(held: Column, m: Column) -> Column:
        opened, closed = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, (a, b) in separators.items():
            opened, closed = F.when(m["mark"] == a, name).otherwise(opened), F.when(m["mark"] == b, name).otherwise(closed)
        before = F.when(held["at"] > held["start"], part(F.lit(""), held["start"], held["at"] - 1)).otherwise(none)
        done = F.concat(held["out"], before, part(closed, held["at"] + 1, m["at"] - 1))
        fits = held["name"].eqNullSafe(closed)
        state = lambda name, at, start, out: F.struct(name.alias("name"), at.alias("at"), start.alias("start"), out.alias("out"))
        return F.when(opened.isNotNull(), state(opened, m["at"], held["start"], held["out"])).when(fits, state(held["name"], held["at"], m["at"] + 1, done)).otherwise(state(F.lit(None).cast("string"), held["at"], held["start"], held["out"]))

    def end(held: Column) -> Column:
        return F.when(held["start"] < F.size(classes), F.concat(held["out"], part(F.lit(""), held["start"], F.size(classes) - 1))).otherwise(held["out"])

    start = F.struct(F.lit(None).cast("string").alias("name"), F.lit(0).alias("at"), F.lit(0).alias("start"), none.alias("out"))
    return F.aggregate(marks, start, step, end)


def word_search(matrix: np.ndarray, words: dict[str, set[tuple[int, ...]]], parts: list[tuple[str, int, int]], width: int = 5) -> list[int]:
    """The labelling of a matrix part by part: of a named part the most probable labelling among the name's words, or else the most probable."""
    out: list[int] = []
    for name, first, last in parts:
        ranked = ranked_labellings(matrix[first : last + 1], width)[:width] if last >= first else [()]
        out += next((x for x in ranked if x in words.get(name, ())), ranked[0])
    return out


def word_beam(words: dict[str, list[list[int]]], separators: dict[str, tuple[int, int]], width: int = 5):
    """A function of a column ARRAY<ARRAY<DOUBLE>> that decodes by ``word_search``; words: labellings by name, lists that the caller bounds."""
    known = {name: {tuple(x) for x in xs} for name, xs in words.items()}

    @F.pandas_udf("array<int>")
    def decode(matrices: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([[] if m is None or not len(m) else word_search(np.stack([np.asarray(r, dtype=float) for r in m]), known, [(p["name"], p["first"], p["last"]) for p in ps], width) for m, ps in zip(matrices, parts, strict=True)])

    return lambda matrix: decode(matrix, segments(best_path(matrix), separators))


def beam(width: int = 25, literal: bool = False):
    """beam_search over a column of ARRAY<ARRAY<DOUBLE>>."""

    @F.pandas_udf("array<int>")
    def decode(matrices: pd.Series) -> pd.Series:
        return pd.Series([[] if m is None or not len(m) else beam_search(np.stack([np.asarray(r, dtype=float) for r in m]), width, literal) for m in matrices])

    return decode
