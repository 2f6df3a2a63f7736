"""Guards that fail rather than let doubtful data pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refuse_empty(df: DataFrame, why: str) -> int:
    """The number of rows of df, which must not be none."""
    count = df.count()
    if not count:
        raise ValueError(why)
    return count


def refuse_any(df: DataFrame, bad: Column, why: str) -> DataFrame:
    """df; evaluating it fails if a row is bad."""
    return df.where(F.when(bad, F.raise_error(F.lit(why)).cast("boolean")).otherwise(F.lit(True)))


def refuse_change(existing: DataFrame, column: str, value: str) -> None:
    """An immutable key: every existing row must have this value."""
    if existing.where(~F.col(column).eqNullSafe(F.lit(value))).limit(1).count():
        raise ValueError(f"{column} cannot change to {value}")


def refuse_stale(manifest: DataFrame, current: int, version: str = "cleaning") -> None:
    """No row may be cleaned by an older version; a row without one counts as version 1."""
    stale = manifest.where(F.coalesce(F.col(version), F.lit(1)) < current).count()
    if stale:
        raise ValueError(f"{stale} rows are older than version {current}")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) of keys that several rows have."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def refuse_duplicates(df: DataFrame, *keys: str) -> None:
    found = duplicates(df, *keys).limit(5).collect()
    if found:
        raise ValueError(f"several rows share {[tuple(r) for r in found]}")


def same_width(charset: str, classes: int) -> None:
    """A model's classes are the characters and the blank."""
    if len(set(charset)) != len(charset) or len(charset) + 1 != classes:
        raise ValueError(f"{len(charset)} characters do not make {classes} classes")
