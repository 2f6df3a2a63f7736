"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece the table holds the one token with which the
prefix's encoding ends.  A sequence of tokens is an encoding exactly if each two
neighbours are, so the last token of a prefix is the token t for which the prefix
before t ends in a token that may stand before t.  Appends extend the table; an
edit keeps all before it and recomputes only until the table agrees with the old one.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import kept, map_rows, typed

#: Pieces, and pairs of tokens, that a worker remembers; beyond it forgets.  They bound memory only.
REMEMBERED, PAIRS = 300_000, 400_000


class Codec:
    """Ranks of a vocabulary, which of its tokens their own bytes encode to, and which may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: Tokens that merges can make.  A token that they cannot make only ever stands for a whole piece.
        self.own: dict[bytes, int] = {}
        self._right_edge: dict[int, tuple[int, ...]] = {}
        self._left_edge: dict[int, tuple[int, ...]] = {}
        self._neighbours: dict[int, bool] = {}
        self._width = max(ranks.values(), default=0) + 1
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self._admit(token, rank, None)
                continue
            for cut in range(1, len(token)):
                a, b = self.own.get(token[:cut]), self.own.get(token[cut:])
                if a is not None and b is not None and self._may_meet(a, b, rank):
                    self._admit(token, rank, (a, b))
                    break
        #: Every end of a token, with the token that it is itself, or -1.
        self._ends = {t[i:]: -1 for t in self.own for i in range(1, len(t))} | self.own

    def _admit(self, token: bytes, rank: int, halves: tuple[int, int] | None) -> None:
        """An edge lists the parts at one end of a token, from the largest down; a part's life ends with the merge into the one before."""
        self.own[token] = rank
        self._right_edge[rank] = (rank, *(self._right_edge[halves[1]] if halves else ()))
        self._left_edge[rank] = (rank, *(self._left_edge[halves[0]] if halves else ()))

    def _may_meet(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merges of ranks under below leave left and right as they are, side by side."""
        ranks, text = self.ranks, self.bytes_of
        a_ends = self._width
        for a in self._right_edge[left]:
            b_ends = self._width
            for b in self._left_edge[right]:
                if max(a, b) < min(a_ends, b_ends) or (len(text[a]) == 1 and len(text[b]) == 1):
                    joint = ranks.get(text[a] + text[b])
                    # of equal ranks the merge further left comes first
                    if joint is not None and joint < a_ends and joint <= b_ends and (below is None or joint < below):
                        return False
                b_ends = b
            a_ends = a
        return True

    def neighbours(self, left: int, right: int) -> bool:
        key = left * self._width + right
        found = self._neighbours.get(key)
        if found is None:
            if len(self._neighbours) > PAIRS:
                self._neighbours.clear()
            found = self._neighbours[key] = self._may_meet(left, right)
        return found

    def last_token(self, text: bytes, end: int, last: list[int]) -> int:
        """The token with which text[:end] ends, given those of all shorter prefixes."""
        ends, known, width = self._ends, self._neighbours, self._width
        for start in range(end - 1, -1, -1):
            token = ends.get(text[start:end])
            if token is None:
                break
            if token < 0:
                continue
            if start == 0:
                return token
            ok = known.get(last[start] * width + token)
            if ok or ok is None and self.neighbours(last[start], token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def pieces(self, texts: list[bytes]) -> dict[bytes, list[int]]:
        """Token ids of each piece; a piece that is an entry of the vocabulary is that token.

        In sorted order a piece shares a prefix with the one before, whose table it takes over.
        """
        found, table = {}, PrefixTable(self)
        for text in sorted(texts):
            whole = self.ranks.get(text)
            if whole is None:
                table.become(text)
            found[text] = [whole] if whole is not None else table.tokens()
        return found

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The last tokens of all prefixes of one growing, editable byte string."""

    def __init__(self, codec: Codec, text: bytes = b""):
        self.codec, self.text, self.last, self.computed = codec, b"", [-1], 0
        self.append(text)

    def append(self, more: bytes) -> None:
        self.text += more
        for end in range(len(self.last), len(self.text) + 1):
            self.last.append(self.codec.last_token(self.text, end, self.last))
        self.computed += len(more)

    def become(self, text: bytes) -> None:
        """Drop all after the prefix shared with text, and append the rest of it."""
        shared, most = 0, min(len(text), len(self.text))
        while shared < most and text[shared] == self.text[shared]:
            shared += 1
        self.text = self.text[:shared]
        del self.last[shared + 1 :]
        self.append(text[shared:])

    def replace(self, start: int, end: int, by: bytes) -> None:
        """Put by in the place of text[start:end].

        A last token depends on the ``longest`` bytes and table entries before it.  Once
        so many new entries equal the old ones at the same text, the rest does too.
        """
        old, tail = self.last, len(self.text) - end
        self.text = self.text[:start] + by + self.text[end:]
        self.last = old[: start + 1]
        same, shift = 0, len(by) - (end - start)
        while len(self.last) <= len(self.text):
            at = len(self.last)
            token = self.codec.last_token(self.text, at, self.last)
            self.last.append(token)
            self.computed += 1
            inside = at > len(self.text) - tail
            same = same + 1 if inside and old[at - shift] == token else 0
            if same >= self.codec.longest:
                self.last += old[at - shift + 1 :]

    def tokens(self) -> list[int]:
        out, end, length = [], len(self.text), self.codec.bytes_of
        while end:
            out.append(self.last[end])
            end -= len(length[out[-1]])
        return out[::-1]


#: Fast splitting needs no character outside these, where letters, numbers and spaces are told as Unicode does.
_UNUSUAL = re.compile("[\x1c-\x1f²³¹¼-¾ɐ-\U0010ffff]")
_SPACE = r"\t-\r \x85\xa0"
_USUAL = re.compile(rf" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\w{_SPACE}]|_)+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def splitter(pattern: str):
    """A function that lists a text's pieces under pattern.

    For the usual pattern of these vocabularies, texts of common characters are split by an
    equal expression of the standard library, which is several times as fast.
    """
    import public_tokenizers

    general = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return general
    return lambda text: general(text) if _UNUSUAL.search(text) else _USUAL.findall(text)


class Encoder:
    """Encodes texts; remembers the ids of pieces as packed integers."""

    def __init__(self, codec: Codec, pattern: str):
        self.codec, self.split, self._packed = codec, splitter(pattern), {}

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces, memory = self.split(text), self._packed
        try:
            return b"".join([memory[p] for p in pieces])
        except KeyError:
            if len(memory) > REMEMBERED:
                memory.clear()
            new = {p.encode(): p for p in set(pieces) if p not in memory}
            for raw, ids in self.codec.pieces(list(new)).items():
                memory[new[raw]] = np.array(ids, dtype="<u4").tobytes()
        return b"".join([memory[p] for p in pieces])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()


def _encoder(raw: bytes, pattern: str) -> Encoder:
    def make():
        pairs = map(bytes.split, raw.splitlines())
        return Encoder(Codec({base64.b64decode(p[0]): int(p[1]) for p in pairs if p}), pattern)

    return kept((Encoder, raw, pattern), make)


def load(path: str, pattern: str) -> Encoder:
    with open(path, "rb") as f:
        return _encoder(f.read(), pattern)


def _vocabulary(path: str | None, pattern: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, ids array<int>, decoded string) of every row's whole text.

    Null text counts as empty: no ids.  Other columns of docs are left out, whatever their
    names.  Repeated rows give repeated rows.  The vocabulary file is read on the driver
    (its size is fixed) and travels with the tasks.
    """
    raw, pattern = _vocabulary(path, pattern)

    def make():
        encoder = _encoder(raw, pattern)

        def row(key, value):
            ids = encoder.ids(value or "")
            return key, ids, encoder.codec.decode(ids).decode()

        return row

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},ids array<int>,decoded string")


def digests(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): what ``encode`` gives, as digests, without moving the ids to the JVM.

    Null is empty: no tokens.  Repeated rows stay, other columns are left out; no documents, no rows.
    """
    raw, pattern = _vocabulary(path, pattern)

    def make():
        encoder = _encoder(raw, pattern)

        def row(key, value):
            packed = encoder.packed(value or "")
            decoded = encoder.codec.decode(np.frombuffer(packed, dtype="<u4").tolist())
            return key, len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return row

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},n_tokens bigint,ids_sha256 string,decoded_sha256 string")


def tokens(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids array<int>, decoded_sha256) of every whole text: the ids, and a digest of what they decode to."""
    raw, pattern = _vocabulary(path, pattern)

    def make():
        encoder = _encoder(raw, pattern)

        def row(key, value):
            ids = np.frombuffer(encoder.packed(value or ""), dtype="<u4").astype(np.int32)  # a list of a slice's ids would take ten times as much
            return key, len(ids), ids, hashlib.sha256(encoder.codec.decode(ids.tolist())).hexdigest()

        return row

    return map_rows(docs, [id_column, text], make, f"{typed(docs, id_column)},n_tokens bigint,ids array<int>,decoded_sha256 string")
