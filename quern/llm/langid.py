"""Language identification, word first.

A word that the model knows is scored by its per-language log frequency.  An unknown
word is scored by its character n-grams (of the word in edge marks), each by the longest
known one that ends at its place, down to a single character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, discard, least_hashes, let_go, map_rows, materialise, slices, typed

#: A word: letters (and marks that stand among them) without digits and signs.
WORD = re.compile(r"[^\W\d_]+")
_NATIVE_WORD = r"[\p{L}]+"


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case; none if they hold no letter (superscripts and fractions alone, say)."""
    words = WORD.findall((text or "").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


@dataclass(frozen=True)
class Settings:
    """What the model is fitted on.  Nothing here bounds what is predicted.

    rows: distinct labelled texts to learn from, the same number of each language: those of
    the least hashes, all if there are fewer.  languages: the most frequent ones that are
    learned.  least: how often a word or n-gram must occur in those texts to be known.
    """

    rows: int = 20_000
    languages: int = 200
    least: int = 2
    longest: int = 4
    smoothing: float = 0.5
    seed: int = 11


@dataclass
class Model:
    """words and grams: the row in word_scores or gram_scores (one column for each language)."""

    langs: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray
    longest: int

    def places(self, word: str) -> list[int]:
        """For each place of the marked word, the row of the longest known n-gram that ends there; else the last row."""
        marked, out, get, longest = f"<{word}>", [], self.grams.get, self.longest
        for end in range(2, len(marked) + 1):
            row = None
            for start in range(max(0, end - longest), end):
                row = get(marked[start:end])
                if row is not None:
                    break
            out.append(len(self.gram_scores) - 1 if row is None else row)
        return out


#: Unknown words whose scores a task remembers; beyond it starts anew.
REMEMBERED = 120_000


class Predictor:
    """A model with the scores of unknown words met before."""

    def __init__(self, model: Model):
        self.model, known = model, len(model.words)
        self.at = dict(model.words)
        self.scores = np.zeros((known + REMEMBERED, len(model.langs)), dtype=np.float32)
        self.scores[:known] = model.word_scores
        #: How much of each word the model has seen: 1 for known words, else the share that the known n-grams reach of the longest ones possible.
        self.fits = np.ones(len(self.scores), dtype=np.float32)
        self.sizes = np.zeros(len(model.gram_scores))
        for gram, row in model.grams.items():
            self.sizes[row] = len(gram)

    def _learn(self, words: list[str]) -> None:
        model, n = self.model, len(self.at)
        if n + len(words) > len(self.scores):
            self.at, n = dict(model.words), len(model.words)
        for k in range(0, len(words), REMEMBERED):
            places = [model.places(w) for w in words[k : k + REMEMBERED]]
            sizes = np.array([len(p) for p in places])
            rows = model.gram_scores[np.concatenate(places)]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            means = np.add.reduceat(rows, starts, axis=0) / sizes[:, None]
            reached = np.add.reduceat(self.sizes[np.concatenate(places)], starts)
            # the ends of the marked word's n-grams are 2, 3 and so on; an n-gram is no longer than its end
            most = np.array([sum(min(end, model.longest) for end in range(2, min(m, model.longest) + 2)) + model.longest * max(0, m - model.longest) for m in sizes.tolist()])
            if n + len(places) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros((len(places), len(model.langs)), dtype=np.float32)])
                self.fits = np.concatenate([self.fits, np.ones(len(places), dtype=np.float32)])
            self.scores[n : n + len(places)] = means
            self.fits[n : n + len(places)] = reached / most
            for w in words[k : k + REMEMBERED]:
                self.at[w] = n
                n += 1

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share in the mean evidence of all words; ties go to the first in order."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """As ``predict``, and the mean of the words' fits, which tells texts of languages that were not learned."""
        words = words_of(text)
        if not words or not self.model.langs:
            return "und", 0.0, 0.0
        try:
            rows = [self.at[w] for w in words]
        except KeyError:
            self._learn([w for w in dict.fromkeys(words) if w not in self.at])
            if any(w not in self.at for w in words):  # the memory began anew
                self._learn([w for w in dict.fromkeys(words) if w not in self.at])
            rows = [self.at[w] for w in words]
        mean = self.scores[rows].mean(axis=0, dtype=np.float64)
        share = np.exp(mean - mean.max())
        share /= share.sum()
        best = int(share.argmax())
        return self.model.langs[best], float(share[best]), float(self.fits[rows].mean(dtype=np.float64))


def _frequencies(rows: list, langs: list[str], smoothing: float) -> tuple[dict[str, int], np.ndarray]:
    """Of rows (item, lang, count): the items' places, and each one's log share of a language's count, unknown items last."""
    at, place = {x: i for i, x in enumerate(langs)}, {}
    for item, _, _ in rows:
        place.setdefault(item, len(place))
    counts = np.zeros((len(place) + 1, len(langs)))
    for item, lang, n in rows:
        counts[place[item], at[lang]] = n
    return place, np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts)))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> Model:
    """Learn from labelled rows; null texts and null languages are left out.

    The texts are a bounded sample (``Settings.rows``) if there are more, with an equal share
    for each language, so that small languages are learned beside large ones; repeated
    texts count once.  Words and n-grams are counted by Spark, and all that occur often
    enough reach the driver: their number follows the sample, not the corpus.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text, F.lit(settings.seed)).alias("h"))
    spoken = labelled.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.languages)
    counts = {r["lang"]: r["n"] for r in spoken.collect()}
    bounds = least_hashes(rows, "lang", "h", max(1, settings.rows // len(counts)), counts) if counts else {}
    counted = chosen(rows, "lang", "h", bounds).select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_NATIVE_WORD), F.lit(0))).alias("item")).groupBy("lang", "item").agg(F.count("*").alias("n"))
    words, path = materialise(counted, "words")

    def often(counted: DataFrame) -> list:
        keep = counted.groupBy("item").agg(F.sum("n").alias("all")).where(F.col("all") >= settings.least).select("item")
        got = counted.join(keep, "item", "left_semi").select("item", "lang", "n").toArrow().to_pydict()
        return sorted(zip(got["item"], got["lang"], got["n"], strict=True))

    marked = F.concat(F.lit("<"), F.col("item"), F.lit(">"))
    sizes = F.array(*map(F.lit, range(1, settings.longest + 1)))
    spread = F.flatten(F.transform(sizes, lambda k: F.when(F.length(marked) >= k, F.transform(F.sequence(F.lit(1), F.length(marked) - k + 1), lambda i: F.substring(marked, i, k))).otherwise(F.array().cast("array<string>"))))
    grams = words.select("lang", "n", F.explode(spread).alias("item")).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    word_rows, gram_rows = often(words), often(grams)
    discard(labelled.sparkSession, path)
    langs = sorted({r[1] for r in gram_rows} | {r[1] for r in word_rows})
    known, word_scores = _frequencies(word_rows, langs, settings.smoothing)
    grams, gram_scores = _frequencies(gram_rows, langs, settings.smoothing)
    return Model(langs, known, word_scores[:-1], grams, gram_scores, settings.longest)


def predict(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) of every row by its whole text alone.

    Null, empty or letterless text gives ``und`` and 0.  Other columns are left out,
    repeated rows stay.  The model, whose size ``Settings`` bounds, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        let_go()
        predictor = Predictor(shared.value)
        return lambda key, value: (key, *predictor.predict(value))

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},lang_pred string,score double")


def keep(docs: DataFrame, model: Model, least: float, text: str = "text", fit: float = 0.0) -> DataFrame:
    """The rows of docs, with all their columns, whose language has at least ``least`` of the evidence and whose words fit the model by at least ``fit``.

    A model without languages cannot reject more than texts without letters.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        let_go()
        predictor = Predictor(shared.value)
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            if not predictor.model.langs:
                kept = [bool(words_of(t)) for t in texts]
            else:
                kept = [lang != "und" and share >= least and seen >= fit for lang, share, seen in map(predictor.judge, texts)]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
