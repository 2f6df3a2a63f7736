"""A quality classifier from weak labels.

Overlapping heuristic labellers vote for or against a text, or abstain.  How often each is
right is estimated by expectation-maximisation over the counts of all vote patterns, which
gives each pattern a posterior.  Posteriors label a sample, on which a linear scorer over
hashed features is trained; the scorer judges every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, least_hashes, map_rows, typed


@dataclass(frozen=True)
class Settings:
    """rows: distinct texts that the scorer is trained on: those of the least hashes, all if there are fewer.

    bits: of the hashed feature space.  rounds: of expectation-maximisation.  steps: of
    training.  prior: share of good texts that the estimate starts from.
    """

    rows: int = 4_000
    bits: int = 13
    rounds: int = 100
    steps: int = 600
    prior: float = 0.7
    seed: int = 5


_SIGNS = re.compile(r"""[^\w\s.,;:'"()?!-]+""")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def _chars_of(pattern: re.Pattern, text: str) -> int:
    """Characters of text in matches of a run of them."""
    return len("".join(pattern.findall(text)))


def votes(text: str | None) -> tuple[int, ...]:
    """Of each labeller 1 (good), -1 (bad) or 0 (abstains).  Texts without a letter, and null, are bad to the first alone."""
    words = (text or "").split()
    n, letters = len(words), _chars_of(_LETTERS, text or "")
    if not letters:
        return (-1, 0, 0, 0, 0, 0, 0, 0, 0, 0)
    chars = len(text)
    counts = Counter(words)
    signs, upper, distinct, top = _chars_of(_SIGNS, text) / chars, _chars_of(_UPPER, text) / letters, len(counts) / n, counts.most_common(1)[0][1] / n
    ends = sum(w[-1] in ".!?" for w in words) / n
    attached = sum(len(w) > 2 and not (w[-1].isalnum() or w[-2].isalnum()) for w in words) / n
    echoes = sum(map(str.__eq__, words, words[1:])) / n
    bars = sum(c for w, c in counts.items() if not any(x.isalnum() for x in w)) / n
    lines = [x for x in text.split("\n") if x]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0
    long_enough = n >= 20
    return (
        0,
        -1 if attached > 0.2 else 1 if attached < 0.03 else 0,
        -1 if signs > 0.05 else 1 if signs < 0.01 else 0,
        -1 if upper > 0.4 else 1 if upper < 0.15 else 0,
        0 if not long_enough else -1 if distinct < 0.25 * min(1, 400 / n) else 1 if distinct > 0.35 * min(1, 400 / n) else 0,
        0 if not long_enough else -1 if top > 0.3 else 1 if top < 0.15 else 0,
        -1 if echoes > 0.2 else 1 if echoes < 0.05 else 0,
        -1 if bars > 0.2 else 1 if bars < 0.02 else 0,
        0 if not long_enough else 1 if 0.02 <= ends <= 0.3 else -1,
        -1 if repeated > 0.3 else 0,
    )


def estimate(patterns: list[tuple[tuple[int, ...], int]], settings: Settings) -> dict[tuple[int, ...], float]:
    """Each vote pattern's probability of a good text, by expectation-maximisation over counted patterns.

    A labeller's model is the chance of each of its votes given a good and given a bad text,
    if it votes at all; labellers are taken as independent given that.
    """
    if not patterns:
        return {}
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], dtype=float)
    good = np.clip(0.5 + v.sum(axis=1) * 0.12, 0.05, 0.95)
    prior = settings.prior
    for _ in range(settings.rounds):
        log = np.tile(np.log([1 - prior, prior]), (len(v), 1))
        for k in range(v.shape[1]):
            for side, weight in ((0, n * (1 - good)), (1, n * good)):
                share = np.array([weight[v[:, k] == x].sum() for x in (-1, 1)]) + 1.0
                share = np.log(share / share.sum())
                log[:, side] += np.select([v[:, k] < 0, v[:, k] > 0], share, 0.0)
        odds = np.clip(log[:, 1] - log[:, 0], -30, 30)
        new = 1 / (1 + np.exp(-odds))
        prior = float(np.clip((n * new).sum() / n.sum(), 0.02, 0.98))
        if np.abs(new - good).max() < 1e-6:
            good = new
            break
        good = new
    return {p: float(g) for (p, _), g in zip(patterns, good, strict=True)}


_LOWER, _CAPITAL, _DIGITS = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")


def token_features(word: str, bits: int) -> tuple[int, int]:
    """Hashed places of a word and of its shape."""
    shape = _LOWER.sub("a", _CAPITAL.sub(lambda m: "A" if len(m[0]) == 1 else "AA", _DIGITS.sub("9", word)))
    size = 1 << bits
    return zlib.crc32(word.lower().encode()) % size, zlib.crc32(b"\x00" + shape.encode()) % size


def document_features(counts: Counter, words: list[str], text: str, bits: int) -> list[int]:
    """Hashed places of a text's coarse measures: length, share of distinct words, of the top word, of words said twice, of repeated lines."""
    n = len(words)
    echoes = sum(map(str.__eq__, words, words[1:])) / max(n, 1)
    size, lines = 1 << bits, [x for x in text.split("\n") if x]
    top = max(counts.values(), default=0) / max(n, 1)
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    measures = (("n", int(np.log2(n + 1))), ("d", int(10 * len(counts) / max(n, 1))), ("t", int(10 * top)), ("e", int(5 * echoes)), ("r", int(5 * repeated)))
    return [zlib.crc32(f"\x01{k}{x}".encode()) % size for k, x in measures]


def features(text: str | None, bits: int) -> dict[int, float]:
    words = (text or "").split()
    counts, out = Counter(words), {}
    for w, c in counts.items():
        for f in token_features(w, bits):
            out[f] = out.get(f, 0.0) + c / len(words)
    for f in document_features(counts, words, text or "", bits):
        out[f] = out.get(f, 0.0) + 1.0
    return out


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, text: str | None, memory: dict[str, float]) -> float:
        words = (text or "").split()
        counts, total = Counter(words), 0.0
        for w, c in counts.items():
            known = memory.get(w)
            if known is None:
                if len(memory) > 500_000:
                    memory.clear()
                known = memory[w] = float(sum(self.weights[f] for f in token_features(w, self.bits)))
            total += c * known
        total = total / max(len(words), 1) + sum(float(self.weights[f]) for f in document_features(counts, words, text or "", self.bits)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def train(samples: list[tuple[list[int], list[float], float]], settings: Settings) -> Scorer:
    """Logistic regression of (places, values, probability of good) by full gradients with adaptive steps."""
    size = 1 << settings.bits
    if not samples:
        return Scorer(np.zeros(size), 0.0, settings.bits)
    row = np.repeat(np.arange(len(samples)), [len(s[0]) for s in samples])
    col = np.concatenate([np.array(s[0], dtype=np.int64) for s in samples])
    val = np.concatenate([np.array(s[1]) for s in samples])
    y = np.array([s[2] for s in samples])
    w, b, squares = np.zeros(size), 0.0, np.full(size + 1, 1e-8)
    for _ in range(settings.steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, val * w[col], minlength=len(y)) + b, -30, 30)))
        r = (p - y) / len(y)
        g = np.append(np.bincount(col, val * r[row], minlength=size) + 1e-5 * w, r.sum())
        squares = squares + g * g
        step = 0.5 * g / np.sqrt(squares)
        w, b = w - step[:-1], b - step[-1]
    return Scorer(w, float(b), settings.bits)


def fit(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Scorer:
    """A scorer trained on a sample, whose labels come from the votes on all rows.

    Votes are counted by pattern: at most 3 to the power of the number of labellers reach the driver.
    """

    def row(value):
        return (",".join(map(str, votes(value))),)

    voted = map_rows(docs, [text], lambda: row, "votes string")
    counted = [(tuple(map(int, r["votes"].split(","))), r["n"]) for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    good = estimate(sorted(counted), settings)
    rows = docs.select(F.lit(0).alias("all"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(settings.seed)).alias("h"))
    there = sum(n for _, n in counted)
    rows = chosen(rows, "all", "h", least_hashes(rows, "all", "h", settings.rows, {0: there}) if there else {})

    def sample(value):
        found = features(value, settings.bits)
        return list(found), list(found.values()), good.get(votes(value), 0.5)

    got = map_rows(rows, ["text"], lambda: sample, "places array<int>,x array<float>,y double").collect()
    return train([(r["places"], r["x"], r["y"]) for r in got], settings)


def classify(docs: DataFrame, text: str = "text", id_column: str = "doc_id", settings: Settings = Settings(), least: float = 0.5) -> DataFrame:
    """(id, score, quality) of every row by its whole text: quality is 1 if the score is at least ``least``.

    The sample that trains the scorer is bounded by ``Settings.rows`` and holds each text
    once; votes are taken and counted over all rows.  Null counts as empty, which is of low quality unless the corpus
    says otherwise.  Equal texts score alike; repeated rows stay; other columns are left out.
    """
    scorer = fit(docs, text, settings)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def make():
        known, memory = shared.value, {}

        def row(key, value):
            score = known.score(value, memory)
            return key, score, int(score >= least)

        return row

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},score double,quality int")
