"""Near-duplicate groups by SimHash with pigeonring filtering, decided by the Jaccard similarity of word shingles.

Texts with the same set of shingles are one node, with the SimHash of that set as its
fingerprint.  Fingerprints meet on the equal heads of pigeonring chains, see ``simhash``;
pairs within the chain's budgets and ``MOST`` bits are verified by the exact similarity of
their sets, and link.  Two sets at 0.8 differ in some ten bits, and the heads of so wide a
budget have about six, on which very many others meet; so what fingerprints leave apart has a
further way: MinHash bands name candidates.  Two sets of similarity s share a band of r values
with probability s ** r, so of pairs at 0.8 three in a million share none of 24 bands of 4.
Those whose nodes are not yet linked are verified in the same way.  A head or band value that
very many nodes share is not expanded into pairs: its nodes are compared with one of them, the
most usual.  Nodes of such bands that are still apart then meet on the rarest of their
shingles, of which two alike sets share one; shingles that a node has alone bound what it can
have in common with any other, so that most meet none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, discard, map_rows, materialise, slices, typed
from .components import connected_components
from .simhash import _LOWER, SEED, close, heads, majority, one_of_each

#: Bits in which fingerprints that meet may differ, and the segments of the ring.
MOST, SEGMENTS = 4, 9
BANDS, ROWS = 24, 4
#: Places of the table that tells rare shingles, a byte each.
COUNTERS = 1 << 22
_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 2**63, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _RNG.integers(0, 2**63, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = _RNG.integers(0, 2**63, size=ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes, ascending, of the words-word shingles of a whole text.

    A-Z in lower case; words end at ASCII white space; fewer words, or none, make one shingle.
    """
    tokens = (text or "").encode().translate(_LOWER).split()
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    count = max(1, len(tokens) - words + 1)
    return np.unique(np.fromiter((hashed(join(tokens[i : i + words]), SEED) for i in range(count)), dtype=np.uint64, count=count))


def bands(shingles: np.ndarray) -> np.ndarray:
    """A hash of each band's least values."""
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        x = (shingles[None, at : at + 1024] ^ _XOR) * _FACTOR
        least = np.minimum(least, x.min(axis=1))
    h = ((least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(31))) * _JOIN).sum(axis=1, dtype=np.uint64)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def signatures(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 5) -> DataFrame:
    """(id, text_hash, node, fp, size, bands) of every row; node is a digest of the set of shingles, fp its SimHash, text_hash as in ``simhash``."""

    def row(key, value):
        digest = xxhash.xxh64_intdigest((value or "").encode(), SEED)
        held = shingle_set(value, words)
        node = xxhash.xxh64_intdigest(held.tobytes(), SEED)
        return key, digest - (1 << 64) if digest >> 63 else digest, node - (1 << 64) if node >> 63 else node, majority(held), len(held), bands(held)

    return map_rows(docs, [id_column, text], lambda: row, f"{typed(docs, id_column)},text_hash bigint,node bigint,fp bigint,size int,bands array<bigint>")


def _stars(many: DataFrame, key: list[str], *more: str) -> DataFrame:
    """Rows of many (key, node, members, more) with the centre of their crowd: its most usual node, which stands in the largest crowds."""
    weights = many.groupBy("node").agg(F.sum("members").alias("weight"))
    centres = many.join(weights, "node").groupBy(*key).agg(F.max(F.struct("weight", "node", *more)).alias("centre"))
    return many.join(centres, key).where("centre.node <> node")


def _meeting(nodes: DataFrame, least: float, crowd: int) -> tuple[DataFrame, str]:
    """Pairs (a, b) of nodes (node, fp, size) within ``MOST`` bits, of sizes that can be ``least`` alike; and the table that they read.

    Heads of at most ``crowd`` nodes give all such pairs, larger ones those with their centre.
    Sets that are ``least`` alike have sizes in the same class or in two that adjoin: a node
    stands in its own (``own``) and in the next.
    """
    of = F.floor(F.log("size") / (1e-6 - math.log(least))).cast("int")
    keyed = nodes.select("node", "fp", of.alias("class"), F.explode(heads(F.col("fp"), MOST, SEGMENTS)).alias("head"))
    keyed = keyed.select("node", "fp", "head.start", "head.bits", F.posexplode(F.array(F.col("class"), F.col("class") + 1)).alias("next", "class"))
    keyed = keyed.select("node", "fp", "start", "bits", "class", (F.col("next") == 0).alias("own"))
    key = ["start", "bits", "class"]
    sizes = keyed.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
    met, path = materialise(keyed.join(sizes, key), "heads")
    few, many = met.where(F.col("members") <= crowd), met.where(F.col("members") > crowd)
    a, b = few.alias("a"), few.alias("b")
    same = (F.col("a.start") == F.col("b.start")) & (F.col("a.bits") == F.col("b.bits")) & (F.col("a.class") == F.col("b.class"))
    one = (F.col("a.node") < F.col("b.node")) & (F.col("a.own") | F.col("b.own"))
    pairs = a.join(b, same & one & close(F.col("a.start"), F.col("a.fp").bitwiseXOR(F.col("b.fp")), MOST, SEGMENTS)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    star = _stars(many, key, "fp").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre.fp"))) <= MOST)
    return pairs.unionByName(star.select(F.least("centre.node", "node").alias("a"), F.greatest("centre.node", "node").alias("b"))).distinct(), path


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, str]:
    """The pairs (a, b) of nodes whose sets are at least ``least`` alike, and the table written."""
    left, left_path = materialise(pairs.join(sets.select(F.col("node").alias("a"), F.col("size").alias("a_size")), "a").join(sets.select(F.col("node").alias("b"), F.col("size").alias("b_size")), "b").where(F.least("a_size", "b_size") >= least * F.greatest("a_size", "b_size")), "sized")
    met = left.join(sets.select(F.col("node").alias("a"), F.col("held").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("held").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    found, path = materialise(met.where(same >= least * (F.col("a_size") + F.col("b_size") - same)).select("a", "b"), "verified")
    discard(left.sparkSession, left_path)
    return found, path


def _tally(sets: DataFrame) -> np.ndarray:
    """How many of sets (held) have a shingle, by a hash of ``COUNTERS`` places: never too few, and no more than 255.

    Each task counts its own sets; the table's size does not depend on their number.
    """
    bits = COUNTERS.bit_length() - 1

    def run(batches):
        counts = np.zeros(COUNTERS, dtype=np.int32)
        for part in slices(batches):
            held = part.column(0).flatten()
            np.add.at(counts, (held.to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int32())], names=["place", "n"])

    found = sets.select("held").mapInArrow(run, "place bigint,n int").groupBy("place").agg(F.least(F.sum("n"), F.lit(255)).alias("n")).toArrow()
    table = np.zeros(COUNTERS, dtype=np.uint8)
    table[found["place"].to_numpy()] = found["n"].to_numpy().astype(np.uint8)
    return table


def rarest(held: np.ndarray, table: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(place, shingle, shingles in common at most) of the rarest shingles of a set, as many as two alike sets need to share one of.

    Rare ones are first, by the table's counts.  Those that count once are the set's alone:
    they take their places, but no one can be met on them.  None if too few are left.
    """
    bits = len(table).bit_length() - 1
    n, counts = len(held), table[(held.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)]
    alone = int((counts <= 1).sum())
    if n - alone < least * n - 1e-9:
        return []
    last = n - math.ceil(least * n - 1e-9) + 1
    order = np.lexsort((held, counts))
    return [(k, int(held[order[k]]), n - alone) for k in range(alone, last)]


def _apart(nodes: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, list[str]]:
    """Pairs (a, b) of nodes (node, component) of different components, without which no two are at least ``least`` alike; and the tables written.

    Two sets of n and m shingles that alike have at least ``least / (1 + least) * (n + m)`` in
    common, so they share one of the rarest of each, up to the place from which on too few are
    left.  Shingles that no other node has are the rarest of all and shared with none: they
    take their part of those places, and what is left of the set bounds the overlap.  Any one
    order of the shingles will do; counts only make it a good one.
    """
    held = nodes.join(sets, "node").select("node", "component", "size", "held")
    held, held_path = materialise(held, "held")
    table = held.sparkSession.sparkContext.broadcast(_tally(held))
    told = "node bigint,component bigint,size int,place int,shingle bigint,common int"
    out = arrow_schema(told)

    def run(batches):
        for part in slices(batches):
            rows = [(node, of, size, place, shingle, common) for node, of, size, x in zip(*(c.to_pylist() for c in part.columns), strict=True) for place, shingle, common in rarest(np.array(x, dtype=np.int64), table.value, least)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * len(out), out, strict=True)], schema=out)

    keyed, path = materialise(held.mapInArrow(run, told), "rare")
    a, b = keyed.alias("a"), keyed.alias("b")
    alike = F.ceil(least / (1 + least) * (F.col("a.size") + F.col("b.size")) - 1e-9)
    enough = (F.least("a.common", "b.common") >= alike) & (F.col("a.place") + alike <= F.col("a.size")) & (F.col("b.place") + alike <= F.col("b.size"))
    met = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component")) & enough)
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), [held_path, path]


def groups(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 5, least: float = 0.8, crowd: int = 64) -> DataFrame:
    """(id, text_hash, component_id) of every row: component_id is the least id of the rows that links of at least ``least`` lead to.

    Null and empty texts are alike.  A group of null ids only has a null component_id.
    Repeated rows stay; other columns are left out.
    """
    spark = docs.sparkSession
    signed, _ = materialise(signatures(docs, text, id_column, words), "signatures")
    nodes, nodes_path = materialise(signed.groupBy("node").agg(F.min(F.struct(id_column, "text_hash")).alias("of"), F.min(id_column).alias("rep"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    near, heads_path = _meeting(nodes, least, crowd)
    near, near_path = materialise(near, "near")
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    sizes, sizes_path = materialise(keyed.groupBy("band", "value").agg(F.count("*").alias("members")).where("members > 1"), "sizes")
    met, met_path = materialise(keyed.join(sizes, ["band", "value"]), "met")
    seen = met.select("node").unionByName(near.select(F.col("a").alias("node"))).unionByName(near.select(F.col("b").alias("node")))
    wanted = seen.distinct().join(nodes, "node").select("node", F.col(f"of.{id_column}").alias("of_id"), F.col("of.text_hash").alias("of_hash"))
    of = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    texts = of.join(wanted, of["id"].eqNullSafe(F.col("of_id")) & (F.xxhash64(F.coalesce(of["text"], F.lit(""))) == F.col("of_hash"))).select("node", "text")

    def held(node, value):
        x = shingle_set(value, words)
        return node, len(x), x.view(np.int64)

    sets, sets_path = materialise(map_rows(texts, ["node", "text"], lambda: held, "node bigint,size int,held array<bigint>").dropDuplicates(["node"]), "sets")

    linked, linked_path = _verified(near, sets, least)
    labels = connected_components(linked)

    few, many = met.where(F.col("members") <= crowd), met.where(F.col("members") > crowd)
    a, b = few.alias("a"), few.alias("b")
    small = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.node") < F.col("b.node"))).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    star = _stars(many, ["band", "value"]).select(F.least("centre.node", "node").alias("a"), F.greatest("centre.node", "node").alias("b"))
    left = small.unionByName(star).distinct()
    for side in ("a", "b"):
        left = left.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")), side, "left")
    rest, rest_path = _verified(left.where("not coalesce(of_a = of_b, false)").select("a", "b"), sets, least)
    edges = linked.unionByName(rest)
    paths = [nodes_path, heads_path, near_path, sizes_path, met_path, sets_path, linked_path, rest_path]

    labels = connected_components(edges)
    labelled, labelled_path = materialise(many.select("band", "value", "node").join(labels, "node", "left").select("band", "value", "node", F.coalesce("component", "node").alias("component")), "labelled")
    paths.append(labelled_path)
    split = labelled.groupBy("band", "value").agg((F.min("component") < F.max("component")).alias("split")).where("split").select("band", "value")
    if split.limit(1).count():
        still, still_path = materialise(labelled.join(split, ["band", "value"]).select("node", "component").distinct(), "rest")
        met_again, more_paths = _apart(still, sets, least)
        more, more_path = _verified(met_again, sets, least)
        labels = connected_components(edges.unionByName(more))
        paths += [still_path, more_path, *more_paths]
    placed = nodes.select("node", "rep").join(labels, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    least_id = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    found, _ = materialise(signed.drop("fp", "size", "bands").join(placed.join(least_id, "component").select("node", "component_id"), "node").select(id_column, "text_hash", "component_id"), "found")
    discard(spark, *paths)
    return found


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 5, least: float = 0.8) -> DataFrame:
    """docs, with all their columns, without all but one row of each group: that of the group's least id."""
    return one_of_each(docs, groups(docs, text, id_column, words, least), text, id_column)
