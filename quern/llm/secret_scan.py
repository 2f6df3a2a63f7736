"""Secrets: fixed forms, and strings that a tokenizer finds hard.

Text that people write falls into few tokens; random strings fall into many.  Runs of key
characters with a low number of characters per token are reported, after digests of known
lengths, UUIDs and names made of words have been taken out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame

from .common import kept, map_rows, slices, typed

#: The fixed forms by kind, in their order: pattern, and least length of the group that counts.
KINDS = {
    "assign": (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE), 1, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # a run is taken whole, so a run of the least length is where a match begins
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
RANDOM = "random"
ORDER = [*KINDS, RANDOM]

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX = re.compile(r"[0-9A-Fa-f]+")
#: Lengths in hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGESTS = {32, 40, 56, 64, 96, 128}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: A part of a run that a path or name joins; one of at least a run's length is tested by itself.
_JOINED = re.compile(r"[A-Za-z0-9+]{16,}")
_NUMBER = re.compile(r"[0-9_+/=-]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed forms, by start, then kind as listed."""
    found = []
    for kind, (pattern, group, least) in KINDS.items():
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found, key=lambda x: (x[0], ORDER.index(x[2])))


def is_hard(run: str, tokenizer, most: float) -> bool:
    """Whether run has at most ``most`` characters for each token; a run of capitals counts as in lower case, if that is easier."""
    fewest = len(tokenizer.encode_ordinary(run))
    if run.isupper():
        fewest = min(fewest, len(tokenizer.encode_ordinary(run.lower())))
    return len(run) <= most * fewest


def is_known(run: str, tokenizer, most: float) -> bool:
    """Whether a run is a digest of a known length, a UUID, a number, or a name made of words, which are letters in few tokens."""
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run) or _HEX.fullmatch(run) and len(run) in DIGESTS:
        return True
    words = [p for p in _PART.findall(run) if len(p) >= 4 and p[0].isalpha()]
    if sum(map(len, words)) < 0.7 * len(run):
        return False
    return sum(len(p) for p in words if not is_hard(p, tokenizer, most)) >= 0.7 * len(run)


def _tokenizer(raw: bytes, pattern: str):
    import tiktoken

    def make():
        ranks = {base64.b64decode(p[0]): int(p[1]) for p in map(bytes.split, raw.splitlines()) if p}
        return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return kept((tiktoken.Encoding, raw, pattern), make)


def random_spans(text: str, tokenizer, most: float) -> list[tuple[int, int, str]]:
    """Runs of key characters with at most ``most`` characters for each token, or else such parts of them; known ones left out."""

    def counts(run: str) -> bool:
        return is_hard(run, tokenizer, most) and not is_known(run, tokenizer, most)

    found = []
    for m in _CANDIDATE.finditer(text):
        if counts(m[0]):
            found.append((m.start(), m.end(), RANDOM))
        elif not _UUID.fullmatch(m[0]):
            found += [(m.start() + p.start(), m.start() + p.end(), RANDOM) for p in _JOINED.finditer(m[0]) if len(p[0]) < len(m[0]) and counts(p[0])]
    return found


def spans(text: str, tokenizer, most: float) -> tuple[list, list]:
    """The fixed forms; and all spans, which are those and random runs that overlap none of them."""
    base = base_spans(text)
    starts, ends = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
    more = []
    for run in random_spans(text, tokenizer, most):
        # of the fixed forms that start before the run's end, the furthest end tells whether one reaches into it
        before = bisect_left(starts, run[1])
        if not before or ends[before - 1] <= run[0]:
            more.append(run)
    return base, sorted(base + more, key=lambda x: (x[0], ORDER.index(x[2])))


def written(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _vocabulary(path: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def scan(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, most: float = 2.0) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every whole text; null is empty.

    Positions are code points.  Rows without a find have zero counts, the digest of the
    empty string and empty spans.  Spans that begin together lie in the order of their kinds.
    Other columns are left out, repeated rows stay; no documents, no rows.
    """
    raw, pattern = _vocabulary(path)

    def make():
        tokenizer = _tokenizer(raw, pattern)

        def row(key, value):
            base, found = spans(value or "", tokenizer, most)
            kinds = [x[2] for x in base]
            return key, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(written(base).encode()).hexdigest(), written(found)

        return row

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},n_assign bigint,n_access bigint,n_hex bigint,base_sha256 string,spans string")


def redacted(text: str, found: list[tuple[int, int, str]], by: str = "[SECRET]") -> str:
    """text with every span (overlapping ones as one) replaced."""
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, most: float = 2.0) -> DataFrame:
    """docs with all secrets in text replaced; every row stays, null text stays null.

    Of the other columns only ``n_chars``, if there is one of integers, follows the new text.
    Repeated rows stay; no documents, no rows.
    """
    import pyarrow as pa

    raw, pattern = _vocabulary(path)
    at = docs.columns.index(text)
    count = docs.columns.index("n_chars") if dict(docs.dtypes).get("n_chars") == "bigint" else None

    def run(batches):
        tokenizer = _tokenizer(raw, pattern)
        for batch in slices(batches):
            new = []
            for value in batch.column(at).to_pylist():
                found = spans(value, tokenizer, most)[1] if value else None
                new.append(redacted(value, found) if found else value)
            out = batch.set_column(at, batch.schema.field(at), pa.array(new, type=batch.schema.field(at).type))
            if count is not None:
                out = out.set_column(count, out.schema.field(count), pa.array([None if v is None else len(v) for v in new], type=pa.int64()))
            yield out

    return docs.mapInArrow(run, docs.schema)
