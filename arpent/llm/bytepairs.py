"""Byte-level BPE encoding and decoding of rank files, by backtracking from longest matches.

A text is cut by the vocabulary's pattern; each match is encoded by itself. Its bytes, read as Latin-1, go through an
Aho-Corasick automaton of all tokens, which gives the longest token at each place. From the left the longest token is
tried, then its shorter prefixes, until one fits the token before it; where none fits, the place is dead and the token
before it is shortened. Two neighbours fit if merging their bytes by rank would leave exactly the two: their merges are
undone along the seam, latest first, and no earlier merge may cross it. The answers are remembered. Every place dies once
at most, so the work is linear, and the tokens are those of the merges: a sequence in which all neighbours fit is the one
that the merges make. Decoding gathers the bytes of all tokens from one table.

The vocabulary is a file that the driver hands out; each Python worker builds its tables once. Tokenizers are never
trained here. Encoded words are remembered from batch to batch, up to a fixed number.
Defined cases: a null text is empty and has no ids; texts are encoded whole, very long ones in runs of matches; repeated
rows give equal results; an empty table gives no rows; null ids and extra columns pass through ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import os
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from arpent.llm.pieces import slices
from arpent.plans.shipping import ship

#: The number of encoded words, and of answers about two neighbours, that a task remembers; and the longest such word.
REMEMBERED, ANSWERS, LONGEST = 600_000, 1_000_000, 200
#: The number of characters of a text, or of matches of a longer one, that are looked up at once.
RUN = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a rank file: a line holds a token in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class _Known(dict):
    """Matches of the pattern and their ids; what is not known yet is encoded, and remembered unless very long."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.ranks.tokens(word))
        if sys.byteorder == "big":
            ids.byteswap()
        out = ids.tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = out
        return out


class Ranks:
    """Tables of a vocabulary: the automaton, shorter prefixes, how each token was merged, and what fits together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a single byte")
        self.ids, self.cut = ranks, regex.compile(pattern)
        top = max(ranks.values()) + 1
        self.size, self.left, self.right, self.shorter = ([-1] * top for _ in range(4))
        self.pairs: dict[tuple[int, int], int] = {}
        self._answers: dict[tuple[int, int], bool] = {}
        self.known = _Known(self)
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        made: dict[bytes, int] = {}  # tokens that merges can make; others stand for whole matches only
        for token, t in sorted(ranks.items(), key=lambda x: (len(x[0]) > 1, x[1])):
            if len(token) == 1:
                self.left[t] = self.right[t] = t
            else:
                halves = ((made.get(token[:k], -1), made.get(token[k:], -1)) for k in range(1, len(token)))
                half = next(((a, b) for a, b in halves if 0 <= a < t > b >= 0 and self._stay(a, b)), None)
                if half is None:
                    continue
                self.left[t], self.right[t] = half
                self.pairs[half] = t
                self.matches.add_word(token.decode("latin-1"), t)
            made[token], self.size[t] = t, len(token)
        self.matches.make_automaton()
        for token, t in made.items():
            self.shorter[t] = next((made[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in made), -1)
        self.single, self.behind = [ranks[bytes([b])] for b in range(256)], [1 - n for n in self.size]
        tokens = sorted((t, token) for token, t in ranks.items())
        self._bytes = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)
        self._lengths, self._starts = np.zeros(top, np.int64), np.zeros(top, np.int64)
        at, lengths = [t for t, _ in tokens], np.array([len(token) for _, token in tokens])
        self._lengths[at], self._starts[at] = lengths, np.cumsum(lengths) - lengths

    def _stay(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` apart. The later of the two merges is undone at the seam, again and
        again; a pair across the seam whose merge comes before the last one undone would have taken it."""
        left, right, pairs = self.left, self.right, self.pairs
        before = len(left) + 1  # merges of lower rank than this had their turn while a and b stood as they are
        while True:
            crossing = pairs.get((a, b))
            if crossing is not None and crossing < before:
                return False
            a_whole, b_whole = right[a] == a, left[b] == b
            if a_whole and b_whole:
                return True
            if b_whole or (a > b and not a_whole):
                before, a = a, right[a]
            else:
                before, b = b + 1, left[b]  # of equal rank the left one goes first

    def tokens(self, word: str) -> list[int]:
        """The tokens of one match of the pattern."""
        raw = word.encode()
        whole = self.ids.get(raw)
        if whole is not None:
            return [whole]
        size, shorter, answers, stay = self.size, self.shorter, self._answers, self._stay
        if len(answers) > ANSWERS:
            answers.clear()
        n = len(raw)
        longest, dead, behind = list(map(self.single.__getitem__, raw)), bytearray(n + 1), self.behind
        for end, t in self.matches.iter(raw.decode("latin-1")):
            longest[end + behind[t]] = t  # of those that start at a place the longest ends last
        found: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                if not dead[at + size[token]]:
                    if last < 0:
                        break
                    fits = answers.get((last, token))
                    if fits is None:
                        fits = answers[last, token] = stay(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                at += size[token]
                last, token = token, longest[at] if at < n else -1
            else:
                dead[at] = 1
                token = found.pop()
                last = found[-1] if found else -1
                at -= size[token]
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(text) <= RUN:
            return b"".join(map(self.known.__getitem__, self.cut.findall(text)))
        matches = (self.known[m.group()] for m in self.cut.finditer(text))
        return b"".join(iter(lambda: b"".join(islice(matches, RUN)), b""))

    def decoded(self, texts: list[bytes]) -> list[bytes]:
        """The bytes of each text's ids."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        length = self._lengths[ids]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._starts[ids] - ends + length, length)
        flat = self._bytes[at].tobytes()
        cuts = np.r_[0, ends][np.r_[0, np.cumsum([len(t) // 4 for t in texts], dtype=np.int64)]].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


_read: dict[tuple[str, str], Ranks] = {}


def vocabulary(path: str, pattern: str) -> Ranks:
    """The tables of a file, built once a process."""
    if (path, pattern) not in _read:
        _read[path, pattern] = Ranks(read_ranks(path), pattern)
    return _read[path, pattern]


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes; with ``with_ids`` also ``ids`` and ``decoded``."""
    name = os.path.basename(path)
    docs.sparkSession.sparkContext.addFile(path)  # the driver hands the vocabulary out
    fields = docs.select(*keep).schema.fields
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), SCHEMA, *(["ids array<int>", "decoded binary"] * with_ids)])
    names = [*(f.name for f in fields), "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] * with_ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = vocabulary(SparkFiles.get(name), pattern)
        for batch in batches:
            texts = batch.column("_t").to_pylist()
            for a, b in slices(texts):
                ids = [ranks.encode(t) for t in texts[a:b]]
                decoded = ranks.decoded(ids)
                columns = [batch.column(f.name).slice(a, b - a) for f in fields]
                columns.append(pa.array([len(x) // 4 for x in ids], pa.int64()))
                columns += [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (ids, decoded)]
                if with_ids:
                    columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ship(docs.sparkSession)
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t")).mapInArrow(run, schema)
