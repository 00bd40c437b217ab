"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are the encoding of theirs. So each
prefix of a piece of text has one last token: the one whose rest, a shorter prefix, ends with a token it may follow.
``Prefixes`` stores that token for every prefix. Appending bytes only adds entries, and after an edit the entries before
it stay while those behind it are kept as soon as a token's length of them comes out unchanged.

Encoding splits a text by the tokenizer's pattern first, each match on its own; a match that is one token as a whole
takes it, as the usual library does.

Defined cases: NULL counts as the empty text, which has no tokens; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

CACHE = 300_000
LONGEST_CACHED = 48  # characters; longer ones hardly come again
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank and which of them may follow each other."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.matcher = ahocorasick.Automaton()  # of the tokens, a byte for a character
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def merge(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """The definition: merge the neighbours of the lowest rank, leftmost first, while there are any."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            joined = parts[best] + parts[best + 1]
            if joined not in self.ranks:
                break
            parts[best : best + 2] = [joined]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge, the last one, gives this token; None for a single byte."""
        if token not in self._halves:
            parts = self.merge(self.tokens[token], 2)
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def alone(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token; others never come out of merges."""
        if token not in self._alone:
            self._alone[token] = len(self.merge(self.tokens[token])) == 1
        return self._alone[token]

    def follows(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between the two tokens.

        Their merges are taken back one by one, the latest first. A border merge would have happened if it comes before
        the merge just taken back: that has a higher rank, or the same rank and stands to the right of the border.
        """
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) >= 4 * CACHE:
                self.pairs.clear()
            self.pairs[key] = self.alone(left) and self.alone(right) and self._apart(left, right)
        return self.pairs[key]

    def _apart(self, left: int, right: int) -> bool:
        limit, ranks, tokens = 1 << 40, self.ranks, self.tokens
        while True:
            if ranks.get(tokens[left] + tokens[right], 1 << 40) < limit:
                return False
            own, other = self.halves(left), self.halves(right)
            if own and (not other or left > right):
                limit, left = left, own[1]
            elif other:
                limit, right = right + 1, other[0]
            else:
                return True


class Prefixes:
    """The last token of every prefix of one piece of bytes; ``last[i]`` belongs to the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _settle(self, begin: int, old: list[int] = (), behind: int = 0, shift: int = 0) -> int:
        """Finds the last tokens of the prefixes longer than ``begin`` and returns how many.

        From a length over ``behind`` on, ``old`` holds the tokens of a former text of ``shift`` more bytes; equal ones
        over a token's length end the work, as all that follows depends on these only.
        """
        v, last = self.vocabulary, self.last
        known, lengths = v.pairs.get, v.lengths
        end, same = begin, 0
        # all tokens that end anywhere behind ``begin``; those of one end come together
        for place, token in v.matcher.iter(self.data.decode("latin-1"), max(0, begin - v.longest + 1)):
            if place < end:
                continue
            start = place + 1 - lengths[token]
            if start:
                fits = known((last[start - 1], token))
                if fits is None:
                    fits = v.follows(last[start - 1], token)
            else:
                fits = v.alone(token)
            if fits:
                last.append(token)
                end = place + 1
                if old:
                    same = same + 1 if end > behind and token == old[place + shift] else 0
                    if same >= v.longest:
                        last += old[end + shift :]
                        return end - begin
        if end < len(self.data):
            raise ValueError("the vocabulary lacks a single byte")
        return end - begin

    def append(self, data: bytes) -> None:
        begin = len(self.data)
        self.data += data
        self._settle(begin)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Puts ``data`` in place of bytes start to stop; returns how many prefixes were worked out anew."""
        old, shift = self.last, stop - start - len(data)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[:start]
        return self._settle(start, old, start + len(data), shift)

    def ids(self) -> list[int]:
        found, end, lengths = [], len(self.data), self.vocabulary.lengths
        while end:
            found.append(self.last[end - 1])
            end -= lengths[found[-1]]
        return found[::-1]


class Codec:
    """Encoder and decoder of whole texts; what was seen before is not encoded again.

    The pattern must never match across a place where white space follows something else, so that the text can be cut
    there: the chunks of a text, white space and what follows, are looked up first.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary, self.pattern = Vocabulary(ranks), regex.compile(pattern)
        blank = re.escape("".join(c for c in map(chr, range(0x10000)) if regex.match(r"\s", c)))
        self.chunk = re.compile(f"[{blank}]*[^{blank}]+|[{blank}]+")
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._chunks: dict[str, tuple[int, ...]] = {}
        self._names = {rank: str(rank) for rank in self.vocabulary.tokens}

    @staticmethod
    def _keep(cache: dict[str, tuple[int, ...]], text: str, ids: tuple[int, ...], most: int) -> tuple[int, ...]:
        if len(text) <= LONGEST_CACHED:
            if len(cache) >= most:
                cache.clear()
            cache[text] = ids
        return ids

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        found = self._pieces.get(text)
        if found is None:
            data = text.encode()
            whole = self.vocabulary.ranks.get(data)
            found = (whole,) if whole is not None else tuple(Prefixes(self.vocabulary, data).ids())
            self._keep(self._pieces, text, found, 2 * CACHE)
        return found

    def _chunk(self, text: str) -> tuple[int, ...]:
        parts = self.pattern.findall(text)
        if len(parts) == 1:
            return self.piece(text)
        return self._keep(self._chunks, text, tuple(i for part in parts for i in self.piece(part)), CACHE)

    def encode(self, text: str | None) -> list[int]:
        parts = self.chunk.findall(text or "")
        found = list(map(self._chunks.get, parts))
        if None in found:
            get = self._pieces.get  # most chunks are a single piece
            found = [ids or get(p) or self._chunk(p) for p, ids in zip(parts, found, strict=True)]
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def decimals(self, ids: list[int]) -> bytes:
        return ",".join(map(self._names.__getitem__, ids)).encode()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary file; the file is installed on every machine."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def tokens(text: str, path: str, pattern: str) -> Column:
    """The ids of a text column as array<int>."""

    @F.pandas_udf("array<int>")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for part in parts:
            yield pd.Series([own.encode(t) for t in part])

    return apply(F.col(text))


def decoded(ids: str, path: str, pattern: str) -> Column:
    """The bytes of a column of ids; NULL for NULL."""

    @F.pandas_udf("binary")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for part in parts:
            yield pd.Series([None if x is None else own.decode(list(x)) for x in part])

    return apply(F.col(ids))


def digests(text: str, path: str, pattern: str) -> Column:
    """A struct of token count, hash of the ids and hash of the bytes decoded from them."""

    @F.pandas_udf(RESULT)
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for part in parts:
            rows = []
            for t in part:
                ids = own.encode(t)
                hashes = [hashlib.sha256(x).hexdigest() for x in (own.decimals(ids), own.decode(ids))]
                rows.append((len(ids), *hashes))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return apply(F.col(text))
