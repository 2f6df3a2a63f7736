"""Near-duplicate groups by SimHash, with pigeonring filtering.

A fingerprint's 64 bits lie on a ring of segments.  If two fingerprints differ in at most
``most`` bits, the ring has a start from which every run of consecutive segments holds no
more than its share of the differences (l of m segments: at most l * most / m).  The first
segments of such a chain must be equal, so they are the key under which fingerprints meet;
the rest of the chain's budgets prune the pairs that meet, and the full Hamming distance
decides.  A key that very many fingerprints share is not expanded into pairs: its
fingerprints are linked through the strings one bit away from them, which two fingerprints
share exactly if they differ in at most two bits.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_rows, materialise, typed
from .components import connected_components

_LOWER = bytes(range(256)).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the words-word shingles of a whole text, repeats included, as a signed 64-bit integer.

    A-Z in lower case; words end at ASCII white space; fewer words make one shingle; none, or null, is zero.
    """
    tokens = (text or "").encode().translate(_LOWER).split()
    n = len(tokens)
    if not n:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    if n < words:
        shingles = [join(tokens)]
    elif words == 3:
        shingles = [b"%b %b %b" % x for x in zip(tokens, tokens[1:], tokens[2:], strict=False)]
    else:
        shingles = [join(tokens[i : i + words]) for i in range(n - words + 1)]
    return majority(np.array([hashed(s, SEED) for s in shingles], dtype="<u8"))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed 64-bit integer."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 3) -> DataFrame:
    """(id, fp bigint, text_hash bigint) of every row; text_hash is Spark's xxhash64 of the text, null as empty."""

    def row(key, value):
        digest = xxhash.xxh64_intdigest((value or "").encode(), SEED)
        return key, fingerprint(value, words), digest - (1 << 64) if digest >> 63 else digest

    return map_rows(docs, [id_column, text], lambda: row, f"{typed(docs, id_column)},fp bigint,text_hash bigint")


def segments(count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``count`` segments of nearly equal length."""
    ends = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(count: int, start: int, length: int) -> int:
    ring = segments(count)
    return sum(((1 << n) - 1) << first for first, n in (ring[(start + k) % count] for k in range(length)))


def chain(count: int, start: int, most: int, differ: Column) -> Column:
    """Whether every run of segments from start keeps to its share of the differences."""
    ok = F.lit(True)
    for length in range(1, count + 1):
        ok = ok & (F.bit_count(differ.bitwiseAND(F.lit(_signed(_mask(count, start, length))))) <= length * most // count)
    return ok


def heads(fp: Column, most: int, count: int) -> Column:
    """(start, bits) of each segment of the ring: the part that is equal if a chain begins there."""
    free = -(-count // most) - 1
    if free < 1:
        raise ValueError("too few segments for so many differing bits")
    return F.array(*(F.struct(F.lit(i).alias("start"), fp.bitwiseAND(F.lit(_signed(_mask(count, i, free)))).alias("bits")) for i in range(count)))


def close(start: Column, differ: Column, most: int, count: int) -> Column:
    """Whether no more than ``most`` bits differ, and a chain begins at start."""
    kept = F.lit(False)
    for i in range(count):
        kept = kept | ((start == i) & chain(count, i, most, differ))
    return (F.bit_count(differ) <= most) & kept


def links(held: DataFrame, most: int = 2, count: int = 7, crowd: int = 128) -> tuple[DataFrame, list[str]]:
    """Edges (a, b) between different fingerprints at most ``most`` bits apart, or what links the same groups.

    held has one row for each fingerprint (fp).  Keys of at most ``crowd`` fingerprints give
    their true pairs; the fingerprints of larger keys give edges to the least fingerprint at
    each string one bit away, which links the same groups.  That way is exact for ``most`` = 2
    only; for other values all keys are compared pair by pair.  Also returns the tables written.
    """
    keyed = held.select("fp", F.explode(heads(F.col("fp"), most, count)).alias("key")).select("fp", "key.start", "key.bits")
    shared = keyed.groupBy("start", "bits").agg(F.count("*").alias("members")).where("members > 1")
    sizes, sizes_path = materialise(shared, "sizes")
    met, met_path = materialise(keyed.join(sizes, ["start", "bits"]), "met")
    a, b = met.alias("a"), met.alias("b")
    if most == 2:
        a, b = a.where(F.col("members") <= crowd), b.where(F.col("members") <= crowd)
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    same_key = (F.col("a.start") == F.col("b.start")) & (F.col("a.bits") == F.col("b.bits"))
    pairs = a.join(b, same_key & (F.col("a.fp") < F.col("b.fp")) & close(F.col("a.start"), differ, most, count)).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    paths = [sizes_path, met_path]
    if most == 2:
        crowded, crowded_path = materialise(met.where(F.col("members") > crowd).select("fp").distinct(), "crowded")
        around = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)))
        balls = crowded.select("fp", F.explode(around).alias("near"))
        centres = balls.groupBy("near").agg(F.collect_set("fp").alias("held")).where(F.size("held") > 1)
        # at most 65 fingerprints lie within one bit of a string
        star = centres.select(F.array_min("held").alias("a"), F.explode("held").alias("b")).where("a < b")
        pairs = pairs.unionByName(star.distinct())
        paths.append(crowded_path)
    return pairs, paths


def groups(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 3, most: int = 2, count: int = 7, crowd: int = 128) -> DataFrame:
    """(id, fp, text_hash, component_id) of every row: component_id is the least id that links lead to, its own included.

    Fingerprints are the nodes; so exact copies, however many, cost one row each and no
    pair.  Null and empty texts have fingerprint zero.  A null id takes part, also as a bridge
    between others, but names no group: a group of null ids only has a null component_id.
    Repeated rows stay; other columns are left out; no documents, no rows.
    """
    spark = docs.sparkSession
    signed, _ = materialise(fingerprints(docs, text, id_column, words), "fingerprints")
    reps, reps_path = materialise(signed.groupBy("fp").agg(F.min(id_column).alias("rep")), "representatives")
    edges, paths = links(reps.select("fp"), most, count, crowd)
    labels = connected_components(edges).withColumnRenamed("node", "fp")
    least = labels.join(reps, "fp").groupBy("component").agg(F.min("rep").alias("least"))
    of, _ = materialise(reps.join(labels.join(least, "component"), "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id")), "groups", reps.count())
    discard(spark, reps_path, *paths)
    return signed.join(of, "fp").select(id_column, "fp", "text_hash", "component_id")


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 3, most: int = 2, count: int = 7) -> DataFrame:
    """docs without all but one row of each group, see ``one_of_each``."""
    found, _ = materialise(groups(docs, text, id_column, words, most, count), "found")
    return one_of_each(docs, found, text, id_column)


def one_of_each(docs: DataFrame, found: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """docs, with all their columns, without all but one row of each group: that of the group's least id.

    Rows with that id are told apart by a hash of their text, then of all their columns; the
    first stays.  Of groups whose ids are all null one row for each text stays.  What goes is
    joined, not what stays, as it is the smaller part; texts are dealt out only if it is too
    large to broadcast.  An id that very many rows have is summed up before it is dealt out.
    """
    stays = F.col(id_column).eqNullSafe(F.col("component_id"))
    gone = found.where(~stays).select(F.col(id_column).alias("gone"), F.col("text_hash").alias("gone_hash")).distinct()
    digest = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    kept = docs.join(gone, docs[id_column].eqNullSafe(gone["gone"]) & (digest == gone["gone_hash"]), "left_anti")
    many = found.where(stays).groupBy(F.col(id_column).alias("_many")).agg(F.count("*").alias("_n")).where("_n > 1").select("_many")
    if not many.limit(1).count():
        return kept
    again = F.col(f"_row.{id_column}").eqNullSafe(F.col("_many"))
    held = kept.select(F.struct(*(kept[c] for c in docs.columns)).alias("_row")).withColumns({"_h": F.xxhash64(F.coalesce(F.col(f"_row.{text}"), F.lit(""))), "_r": F.xxhash64(F.to_json("_row"))})
    held = held.withColumn("_id", F.col(f"_row.{id_column}")).withColumn("_of", F.when(F.col("_id").isNull(), F.col("_h")))
    some = held.join(many, again, "left_semi").dropDuplicates(["_id", "_h", "_r"])
    first = some.groupBy(F.col("_id").alias("_id1"), F.col("_of").alias("_of1")).agg(F.min(F.struct("_h", "_r")).alias("_first"))
    one = some.join(first, F.col("_id").eqNullSafe(F.col("_id1")) & F.col("_of").eqNullSafe(F.col("_of1")) & (F.col("_h") == F.col("_first._h")) & (F.col("_r") == F.col("_first._r")), "left_semi")
    return held.join(many, again, "left_anti").select("_row.*").unionByName(one.select("_row.*"))
