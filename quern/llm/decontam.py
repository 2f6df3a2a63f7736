"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive tokens; tokens under its zeros are ignored, so a
passage with replaced words still shares seeds with its source.  Seeds of the benchmark are
hashed into an index; a document's seeds are looked up in it; around every hit the document
and the item are laid over each other and their equal tokens counted.

An index of a bounded number of benchmark tokens travels to the tasks.  A larger benchmark's
seeds are joined with the documents' on their hashes instead, after a filter of fixed size
has dropped seeds that no item has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, discard, map_rows, materialise, slices, typed

TOKEN = re.compile(r"[^\W_]+")

#: The masks.  Of any 15 tokens with up to three replaced, one of them always finds a place.
MASKS = ("1110110101", "110100110111", "11011000111", "101111001001", "111111", "11100010100011", "11110101001")
_COVERED = (15, 3)


@lru_cache(maxsize=256)
def placed_masks(width: int, misses: int) -> tuple[tuple[int, ...], ...]:
    """Places out of a window of width tokens, so that whichever ``misses`` tokens are replaced, all places of one mask are kept.

    Parts of the window, one more than misses, are such masks; where they would have fewer
    than four places and the ways to replace are few, masks of four or more are chosen one by one.
    """
    parts = tuple(tuple(range(width * k // (misses + 1), width * (k + 1) // (misses + 1))) for k in range(misses + 1))
    size = min(5, width - misses)
    if min(map(len, parts)) >= 4 or width > 15 or size < 4:
        return parts
    left = set(combinations(range(width), misses))
    masks, chosen = list(combinations(range(width), size)), []
    while left:
        best = max(masks, key=lambda m: sum(not set(m).intersection(p) for p in left))
        chosen.append(best)
        left = {p for p in left if set(best).intersection(p)}
    return tuple(chosen)


@dataclass(frozen=True)
class Settings:
    """window: tokens laid over each other (the whole item if it is shorter); share: of them equal.

    shortest: items of fewer tokens are no passages; only a document that consists of such
    an item repeats it.  most: benchmark tokens that are indexed in one broadcast; beyond it
    seeds are joined.  filter_bits: size of the filter before that join, as a power of two.
    """

    window: int = 15
    share: float = 0.8
    shortest: int = 5
    most: int = 1_000_000
    filter_bits: int = 27


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def code_of(word: str) -> int:
    """An odd 64-bit code, the same for a word wherever it is met."""
    return xxhash.xxh64_intdigest(word.encode(), 42) | 1


@lru_cache(maxsize=8)
def masks_for(widths: tuple[int, ...], settings: Settings) -> tuple[list[np.ndarray], list[int | None], np.ndarray]:
    """The masks for items or windows of the given widths; for each the only width it is made for, or None; the factors of their places."""
    masks = [np.flatnonzero(np.frombuffer(m.encode(), dtype=np.uint8) == 49) for m in MASKS]
    only: list[int | None] = [None] * len(masks)
    for width in widths:
        misses = sum(width - n >= settings.share * width for n in range(1, width + 1))
        if width < _COVERED[0] or misses > _COVERED[1]:
            more = placed_masks(width, misses)
            masks += [np.array(m) for m in more]
            only += [width] * len(more)
    rng = np.random.default_rng(42)
    factors = rng.integers(1, 2**62, size=(max(len(masks), 512), 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return masks, only, factors


def seed_hashes(codes: np.ndarray, mask: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The seed at each place of codes where the mask fits."""
    n = len(codes) - int(mask[-1])
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k, off in enumerate(mask):
        h += codes[off : off + n] * factors[k]
    return h ^ h >> np.uint64(29)


def _differences(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The distinct differences of each of places and each of others, both ascending.

    Few are subtracted one by one.  Of many, as tokens that a text repeats over and over give,
    the differences are those at which the two sets, as 0-1 sequences, correlate.
    """
    span = int(places[-1] - places[0] + others[-1] - others[0]) + 1
    if len(places) * len(others) <= max(4096, 32 * span):
        out = np.zeros(span, dtype=bool)
        first = places[0] - others[-1]
        step = max(1, (1 << 20) // len(others))
        for at in range(0, len(places), step):
            out[(places[at : at + step, None] - others[None, :] - first).ravel()] = True
        return np.flatnonzero(out) + first
    size = 1 << span.bit_length()
    x, y = np.zeros(size), np.zeros(size)
    x[places - places[0]] = 1
    y[others[-1] - others] = 1
    met = np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size)[:span]
    return np.flatnonzero(met > 0.5) + places[0] - others[-1]


class Index:
    """Seeds of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings, self.keys, self.vocabulary, self.tokens = settings, [], {}, []
        #: Items that are no passages, by their tokens.
        self.short: dict[tuple[str, ...], list] = {}
        for key, text in items:
            words = tokens_of(text)
            if len(words) >= settings.shortest:
                self.keys.append(key)
                self.tokens.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.int64))
            elif words:
                self.short.setdefault(tuple(words), []).append(key)
        self.codes = np.array([0, *map(code_of, self.vocabulary)], dtype=np.uint64)
        self.masks, self.widths, self.factors = masks_for(tuple(sorted({min(len(t), settings.window) for t in self.tokens})), settings)
        self.tables = []
        for m in range(len(self.masks)):
            hashes, owners, places = [], [], []
            for i, t in enumerate(self.tokens):
                if self.widths[m] not in (None, min(len(t), settings.window)):
                    continue
                h = self._hash(self.codes[t], m)
                hashes.append(h)
                owners.append(np.full(len(h), i, dtype=np.int32))
                places.append(np.arange(len(h), dtype=np.int32))
            h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << 20, dtype=bool)
            bits[(h >> np.uint64(44)).astype(np.int64)] = True
            own, at = (np.concatenate(x)[order] if x else np.zeros(0, dtype=np.int32) for x in (owners, places))
            self.tables.append((h[order], own, at, bits))

    def _hash(self, codes: np.ndarray, m: int) -> np.ndarray:
        return seed_hashes(codes, self.masks[m], self.factors[m])

    def _shifts(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """By item, the distinct shifts of the document against it at which they share a seed."""
        found: dict[int, list[np.ndarray]] = {}
        few = []
        for m, (hashes, owners, places, bits) in enumerate(self.tables):
            h = self._hash(codes, m)
            at = bits[(h >> np.uint64(44)).view(np.int64)].nonzero()[0]
            if not len(at):
                continue
            left, right = hashes.searchsorted(h[at], "left"), hashes.searchsorted(h[at], "right")
            n = right - left
            total = int(n.sum())
            if total <= 4 * len(codes) + 1024:
                if total:
                    k = np.repeat(left - n.cumsum() + n, n) + np.arange(total)
                    few.append(owners[k].astype(np.int64) << 40 | np.repeat(at, n) - places[k] + (1 << 39))
                continue
            # seeds that come again and again: place by place only once for each seed and item
            hit = n > 0
            at, left, right = at[hit], left[hit], right[hit]
            order = np.argsort(left, kind="stable")
            at, left, right = at[order], left[order], right[order]
            for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(left)) + 1):
                lo, hi = int(left[group[0]]), int(right[group[0]])
                # one seed's places lie item by item, ascending
                for part in np.split(np.arange(lo, hi), np.flatnonzero(np.diff(owners[lo:hi])) + 1):
                    found.setdefault(int(owners[part[0]]), []).append(_differences(at[group], places[part].astype(np.int64)))
        if few:
            met = np.unique(np.concatenate(few))
            item, shift = met >> 40, (met & (1 << 40) - 1) - (1 << 39)
            for part in np.split(np.arange(len(met)), np.flatnonzero(np.diff(item)) + 1):
                found.setdefault(int(item[part[0]]), []).append(shift[part])
        return {i: np.unique(np.concatenate(x)) if len(x) > 1 else x[0] for i, x in found.items()}

    def _best(self, item: np.ndarray, doc: np.ndarray, shift: int) -> tuple[int, int, int] | None:
        """Equal tokens in the best window of item laid over doc at shift, the window's width, and its place in doc."""
        width = min(self.settings.window, len(item))
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        if hi - lo < width * self.settings.share:
            return None
        same = np.zeros(len(item) + 1, dtype=np.int64)
        same[lo + 1 : hi + 1] = item[lo:hi] == doc[lo + shift : hi + shift]
        total = np.cumsum(same)
        equal = total[width:] - total[:-width]
        at = int(equal.argmax())
        return int(equal[at]), width, at + shift

    def find(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item, equal tokens, width, start, end) of the best window of every item found; code points."""
        lowered = (text or "").lower()
        words = TOKEN.findall(lowered)
        if 0 < len(words) < self.settings.shortest:
            best = {key: (len(words), len(words), 0) for key in self.short.get(tuple(words), ())}
            return self._told(text, lowered, list(best.items()))
        get = self.vocabulary.get
        doc = np.array([get(w, 0) for w in words], dtype=np.int64)
        best: dict[int, tuple[int, int, int]] = {}
        for i, shifts in sorted(self._shifts(self.codes[doc]).items()):
            for shift in shifts.tolist():
                now = best.get(i)
                if now and now[0] == now[1]:
                    break
                got = self._best(self.tokens[i], doc, shift)
                if got and got[0] >= self.settings.share * got[1] and (not now or got[0] > now[0]):
                    best[i] = got
        return self._told(text, lowered, [(self.keys[i], x) for i, x in sorted(best.items())])

    def _told(self, text: str, lowered: str, best: list[tuple[int, tuple[int, int, int]]]) -> list[tuple[int, int, int, int, int]]:
        if not best:
            return []
        spans = [m.span() for m in TOKEN.finditer(lowered)]
        if len(lowered) != len(text):  # lower() can lengthen a text; places are those of the text itself
            spans = [m.span() for m in TOKEN.finditer(text)]
        last = len(spans) - 1
        return [(key, equal, width, spans[max(0, min(at, last))][0], spans[max(0, min(at + width - 1, last))][1]) for key, (equal, width, at) in best]


@lru_cache(maxsize=64)
def _single(passage: str, settings: Settings) -> Index:
    return Index([(0, passage)], settings)


def _items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    return benchmark.select(F.col(item).alias("item"), F.col(text).alias("passage")).where(F.col("passage").isNotNull())


def _index(benchmark: DataFrame, settings: Settings) -> Index | None:
    """An index of all of benchmark, or None if it has more than ``settings.most`` tokens or so."""
    held = _items(benchmark)
    # a token is a character and a sign at least, so this bounds the tokens too
    size = held.agg(F.sum(F.size(F.regexp_extract_all(F.lower("passage"), F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0))))).first()[0] or 0
    if size > settings.most:
        return None
    return Index([(r["item"], r["passage"]) for r in held.collect()], settings)


def _seeds_of(df: DataFrame, text: str, widths: tuple[int, ...], settings: Settings, schema: str, known: Broadcast | None = None) -> DataFrame:
    """(hash, ...) of every distinct seed of each row's text, with the row's other columns; schema is theirs.

    Of the items' texts the masks of their own width, of documents' texts all; known, if
    given, holds a bit for each hash that any item may have.
    """
    others, place = {c: df.columns.index(c) for c in df.columns if c != text}, df.columns.index(text)
    told = f"hash bigint,{schema}"
    out = arrow_schema(told)

    def run(batches):
        masks, only, factors = masks_for(widths, settings)
        codes: dict[str, int] = {}
        for part in slices(batches):
            at, hashes = [], []
            for row, value in enumerate(part.column(place).to_pylist()):
                words = tokens_of(value)
                if len(codes) > 500_000:
                    codes.clear()
                x = np.array([codes.get(w) or codes.setdefault(w, code_of(w)) for w in words], dtype=np.uint64)
                for m, mask in enumerate(masks):
                    if known is None and (len(words) < settings.shortest or only[m] not in (None, min(len(words), settings.window))):
                        continue
                    h = np.unique(seed_hashes(x, mask, factors[m])).view(np.int64)
                    if known is not None:
                        h = h[known.value[(h.view(np.uint64) >> np.uint64(64 - settings.filter_bits)).astype(np.int64)]]
                    hashes.append(h)
                    at.append(np.full(len(h), row))
            at = pa.array(np.concatenate(at) if at else np.zeros(0, dtype=np.int64))
            h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), *(part.column(i).take(at).cast(out.field(c).type) for c, i in others.items())], schema=out)

    return df.mapInArrow(run, told)


def _known(seeds: DataFrame, settings: Settings) -> np.ndarray:
    """A bit for each value that the first bits of the seeds' hashes have; its size does not depend on their number."""
    place = f"shiftrightunsigned(hash, {64 - settings.filter_bits})"
    words = seeds.groupBy(F.expr(f"shiftright({place}, 6)").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, int({place} % 64)))").alias("bits")).toArrow()
    held = np.zeros(1 << (settings.filter_bits - 6), dtype=np.int64)
    held[words["word"].to_numpy()] = words["bits"].to_numpy()
    return np.unpackbits(held.view(np.uint8), bitorder="little").view(bool)


def _joined(docs: DataFrame, benchmark: DataFrame, text: str, settings: Settings) -> tuple[DataFrame, list[str]]:
    """(digest, item, equal, width, start, end): what texts of docs, told by a digest, repeat; and the tables written.

    Seeds are joined on their hashes; each text and item that share one are then laid over
    each other.  Equal texts are compared once, and Spark can split the rows of a frequent hash.
    """
    spark, digest = docs.sparkSession, F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    kind = typed(_items(benchmark), "item").split(" ", 1)[1]
    items, items_path = materialise(_items(benchmark).withColumn("key", F.sha2("passage", 256)), "items")
    passages = items.select("key", "passage").dropDuplicates(["key"])
    lengths = map_rows(passages, ["passage"], lambda: lambda p: (min(len(tokens_of(p)), settings.window),), "width int").distinct()
    widths = tuple(sorted(r["width"] for r in lengths.collect() if r["width"] >= settings.shortest))
    seeds, seeds_path = materialise(_seeds_of(passages, "passage", widths, settings, "key string"), "seeds")
    known = spark.sparkContext.broadcast(_known(seeds, settings))
    told = docs.select(digest.alias("digest"), F.col(text).alias("text"))
    met = _seeds_of(told, "text", widths, settings, "digest string", known).join(seeds, "hash").select("digest", "key").distinct()
    short = _short(told, "text", settings).join(_short(passages.withColumnRenamed("passage", "text"), "text", settings), "words").select("digest", "key").distinct()
    pairs, pairs_path = materialise(met.unionByName(short).distinct(), "pairs")
    texts, texts_path = materialise(told.join(pairs.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"]), "texts")

    schema = "digest string,key string,equal int,width int,start bigint,end bigint"
    out = arrow_schema(schema)

    def verify(batches):
        for part in slices(batches):
            rows = [(d, k, *hit[1:]) for d, k, t, p in zip(*(c.to_pylist() for c in part.columns), strict=True) for hit in _single(p, settings).find(t)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(out), out, strict=True)], schema=out)

    found = pairs.join(texts, "digest").join(passages, "key").select("digest", "key", "text", "passage").mapInArrow(verify, schema)
    found, found_path = materialise(found.join(items.select("key", F.col("item").cast(kind)), "key").drop("key"), "found")
    discard(spark, items_path, seeds_path, pairs_path, texts_path)
    return found, [found_path]


def _short(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """df with ``words`` in place of text: its tokens, of the rows that have some, but fewer than a passage."""
    others = [c for c in df.columns if c != text]

    def row(value, *rest):
        words = tokens_of(value)
        return " ".join(words) if 0 < len(words) < settings.shortest else None, *rest

    return map_rows(df, [text, *others], lambda: row, ",".join(["words string", *(typed(df, c) for c in others)])).where("words is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """A row for each document and benchmark item that it repeats: (id, item_id, equal, width, start, end).

    The best window of the item is laid over the document; ``equal`` of its ``width``
    tokens are the same, of windows as good the first found; start and end are code points of
    the document.  Tokens are runs of letters and digits in lower case.  Null and empty texts
    on either side match nothing; repeated rows give repeated finds; other columns are left
    out; no documents or no items, no rows.
    """
    told = f"{typed(docs, id_column)},{typed(benchmark, 'item_id')},equal int,width int,start bigint,end bigint"
    index = _index(benchmark, settings)
    if index is None:
        found, _ = _joined(docs, benchmark, text, settings)
        held = docs.select(id_column, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"))
        return held.join(found, "digest").select(id_column, F.col("item").alias("item_id"), "equal", "width", "start", "end")
    out, shared = arrow_schema(told), docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for part in slices(batches):
            rows = [(key, *hit) for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for hit in shared.value.find(value)]
            columns = zip(*rows, strict=True) if rows else [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, out, strict=True)], schema=out)

    return docs.select(id_column, text).mapInArrow(run, told)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, with all their columns, that repeat no item of benchmark; what matches is as in ``overlaps``."""
    index = _index(benchmark, settings)
    if index is None:
        found, _ = _joined(docs, benchmark, text, settings)
        same = F.sha2(F.coalesce(docs[text], F.lit("")), 256) == F.col("_digest")
        return docs.join(found.select(F.col("digest").alias("_digest")).distinct(), same, "left_anti")
    shared, at = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index(text)

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array([not shared.value.find(v) for v in batch.column(at).to_pylist()], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
