"""SentencePiece encoding and decoding of BPE models with byte fallback, by vectorised merge rounds.

A text is cut into words (a run of blanks and what follows it): no piece of such a model holds a blank after another
character, so no merge crosses a cut. The words of a batch become one flat array of symbols. In each round every word
finds the least rank among its neighbouring pairs (a segmented minimum) and merges the pairs of that rank from the left,
all words at once, and the array is compacted; words without a mergeable pair leave. Several pairs of a word merge in one
round only where none of these merges makes a pair that the library's queue would take before the next, so the order is
the queue's, ties from the left; long words go the same way. Decoding gathers the bytes of all pieces from one table.
Encoded words are kept from batch to batch, up to a fixed number.

The vocabulary is a fixed file of 32,000 pieces; a task reads it where it runs. Tokenizers are never trained here.
Defined cases: a null text is empty and gets begin and end only; texts are encoded whole, and in slices only of the
batch, never of a text; repeated rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from arpent.plans.shipping import ship

BLANK = "▁"
#: The number of encoded words that a task remembers.
REMEMBERED = 300_000
_NONE = np.int64(1) << 40
_BITS = 20


def _slot(keys: np.ndarray) -> np.ndarray:
    """The home slot of a pair: the top bits of a multiplicative hash."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)


class Model:
    """Pieces, merge ranks and byte ids of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only BPE models with the identity normalizer are supported")
        self.prefix = spec.add_dummy_prefix
        kinds = type(proto.pieces[0])
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        if any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError("a piece holds a blank after another character")
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        self.pieces = [p.piece if p.type == kinds.NORMAL else None for p in proto.pieces]
        byte_of = {i: b for b, i in self.bytes.items()}
        shown = [bytes([byte_of[i]]) if i in byte_of else (p or "").replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        self._bytes = np.frombuffer(b"".join(shown), np.uint8)
        self._lengths = np.array([len(x) for x in shown], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._blank_first = np.array([bool(p) and p.startswith(BLANK) for p in self.pieces])
        # Equal scores are equal ranks: then the leftmost pair goes first.
        scores = sorted({proto.pieces[i].score for i in normal.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        self.size = len(proto.pieces)
        # Symbols are piece ids; characters without a piece of their own get ids from ``size`` on.
        self.symbol = {p: i for p, i in normal.items() if len(p) == 1}
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = self._id(p[:k], normal), self._id(p[k:], normal)
                if a is not None and b is not None:
                    pairs[a * (1 << 20) + b] = (rank[proto.pieces[i].score], i)
        self.pairs = pairs
        self._table()
        self.known: dict[str, bytes] = {}

    def _id(self, part: str, normal: dict[str, int]) -> int | None:
        if part in normal:
            return normal[part]
        return self.symbol.setdefault(part, self.size + len(self.symbol)) if len(part) == 1 else None

    def _table(self) -> None:
        """Pairs in an open hash table: a key lies in one of the ``_probes`` slots from its own on."""
        self._slots = np.full((1 << _BITS) + 64, -1, np.int64)
        self._slot_rank, self._slot_id = np.full(len(self._slots), _NONE), np.zeros(len(self._slots), np.int64)
        self._probes = 1
        for key, (rank, made) in self.pairs.items():
            at = start = int(_slot(np.array([key], np.int64))[0])
            while self._slots[at] >= 0:
                at += 1
            self._slots[at], self._slot_rank[at], self._slot_id[at] = key, rank, made
            self._probes = max(self._probes, at - start + 1)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair; ``_NONE`` where there is none."""
        keys = np.where((left >= 0) & (right >= 0), left * (1 << 20) + right, -2)
        at = _slot(keys)
        open_ = np.flatnonzero(self._slots[at] != keys)
        for _ in range(self._probes - 1):
            open_ = open_[(self._slots[at[open_]] != keys[open_]) & (self._slots[at[open_]] >= 0)]
            if not len(open_):
                break
            at[open_] += 1
        hit = self._slots[at] == keys
        return np.where(hit, self._slot_rank[at], _NONE), self._slot_id[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The final symbols of all words in one array, the borders of the words in it, and where each symbol starts in
        the joined words. Unknown characters are -1 or beyond the vocabulary."""
        self._points = points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        kinds, inverse = np.unique(points, return_inverse=True)
        table = np.array([self.symbol.get(chr(c), -1) for c in kinds.tolist()], np.int64)
        symbols, char = table[inverse], np.arange(len(points))
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, made = np.full(len(points), _NONE), np.zeros(len(points), np.int64)
        rank[:-1], made[:-1] = self._look(symbols[:-1], symbols[1:])
        rank[:-1][word[:-1] != word[1:]] = _NONE
        ended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(symbols)])
            stay = np.repeat(least != _NONE, length)
            if not stay.all():  # words without a mergeable pair leave
                gone = ~stay
                ended.append((word[gone], symbols[gone], char[gone]))
                symbols, word, char, rank, made = symbols[stay], word[stay], char[stay], rank[stay], made[stay]
                length, least = length[least != _NONE], least[least != _NONE]
                if not len(symbols):
                    break
            lead = self._leads(symbols, word, made, np.flatnonzero(rank == np.repeat(least, length)), rank)
            symbols[lead] = made[lead]
            stay = np.ones(len(symbols), bool)
            stay[lead + 1] = False
            lead = lead - np.arange(len(lead))  # each earlier merge of the round has taken one place
            symbols, word, char, rank, made = symbols[stay], word[stay], char[stay], rank[stay], made[stay]
            # Only the pairs beside a merge have changed.
            near = np.concatenate([lead, lead[lead > 0] - 1])
            pair = near[near < len(symbols) - 1]
            rank[near] = _NONE
            rank[pair], made[pair] = self._look(symbols[pair], symbols[pair + 1])
            cut = pair[word[pair] != word[pair + 1]]
            rank[cut] = _NONE
        word, symbols, char = (np.concatenate(x) for x in zip(*ended))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1)), char[order]

    def _leads(self, symbols: np.ndarray, word: np.ndarray, made: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The places of the least rank of each word that merge in this round, given all such places.

        One at a time they would merge from the left, skipping those that the one before has used up. They may go together
        as long as no merge makes a pair that would go before the next of them: a word stops after the first that does."""
        runs = np.r_[True, np.diff(place) != 1]
        first = np.flatnonzero(runs)
        lead = place[(np.arange(len(place)) - np.repeat(first, np.diff(np.r_[first, len(place)]))) % 2 == 0]
        heads = np.flatnonzero(np.r_[True, word[lead][1:] != word[lead][:-1]])
        count = np.diff(np.r_[heads, len(lead)])
        if (count == 1).all():
            return lead
        many = np.flatnonzero(np.repeat(count > 1, count))
        after, gone = symbols.copy(), np.zeros(len(symbols) + 2, bool)
        at = lead[many]
        after[at], gone[at + 1] = made[at], True
        left = np.where(gone[np.maximum(at - 1, 0)], at - 2, at - 1)
        right = np.minimum(at + 2, len(symbols) - 1)
        inner = (at > 0) & (word[np.maximum(left, 0)] == word[at])
        outer = (at + 2 < len(symbols)) & (word[right] == word[at])
        soonest = np.where(inner, self._look(after[np.maximum(left, 0)], after[at])[0], _NONE)
        for other in (symbols, after):
            soonest = np.minimum(soonest, np.where(outer, self._look(after[at], other[right])[0], _NONE))
        bad = np.zeros(len(lead), np.int64)
        bad[many] = soonest <= rank[at]
        before = np.cumsum(bad) - bad
        return lead[before == np.repeat(before[heads], count)]

    def _ids(self, symbol: int, char: str) -> Iterable[int]:
        if 0 <= symbol < self.size:
            return (symbol,)
        return tuple(self.bytes[b] for b in char.encode("utf-8"))

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not remembered yet."""
        known = self.known
        new = [w for w in words if w not in known]
        if new:
            symbols, borders, places = self.merged(new)
            odd = (symbols < 0) | (symbols >= self.size)
            flat = symbols.astype("<u4").tobytes()
            cuts = (4 * borders).tolist()
            known.update((w, flat[a:b]) for w, a, b in zip(new, cuts, cuts[1:]))
            for k in np.unique(np.searchsorted(borders, np.flatnonzero(odd), "right") - 1).tolist():
                a, b = borders[k], borders[k + 1]
                ids = [x for s, c in zip(symbols[a:b].tolist(), places[a:b].tolist()) for x in self._ids(s, chr(self._points[c]))]
                known[new[k]] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, begin and end included."""
        words = [_cut((" " if self.prefix and t else "") + t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn({w for ws in words for w in ws})
        first, last = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        known = self.known
        return [b"".join([first, *[known[w] for w in ws], last]) for ws in words]

    def decoded(self, texts: list[bytes]) -> list[bytes]:
        """The texts of ids, in UTF-8: the bytes of all pieces are gathered from one table, blanks turned back; the first
        blank of a text is dropped, and bytes of no valid character become replacement characters."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        borders = np.r_[0, np.cumsum([len(t) // 4 for t in texts])]
        length, start = self._lengths[ids], self._starts[ids]
        seen = np.flatnonzero(length)
        first = np.searchsorted(seen, borders)  # the first piece of each text that shows
        if self.prefix and len(seen):
            shows = first[:-1] < first[1:]
            lead = seen[first[:-1][shows]]
            lead = lead[self._blank_first[ids[lead]]]
            length[lead] -= 1
            start[lead] += 1
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - length, length) + np.repeat(start, length)
        flat = self._bytes[at].tobytes()
        cuts = np.r_[0, ends][borders].tolist()
        out = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        try:
            flat.decode("utf-8")
        except UnicodeDecodeError:
            return [_mended(x) for x in out]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of one text's ids."""
        return self.decoded([ids])[0].decode("utf-8")


_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def _cut(text: str) -> list[str]:
    return _WORD.findall(text.replace(" ", BLANK))


def _mended(run: bytes) -> bytes:
    """UTF-8 in which each byte that is part of no valid character is a replacement character."""
    out: list[bytes] = []
    while run:
        try:
            run.decode("utf-8")
            break
        except UnicodeDecodeError as e:
            out += [run[: e.start], b"\xef\xbf\xbd"]
            run = run[e.start + 1 :]
    return b"".join([*out, run])


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file, read once a process."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Characters that one slice of a batch holds at most, unless a single text is longer.
SLICE = 1_000_000


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Cuts of a batch at text borders, each of about ``SLICE`` characters."""
    start = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > SLICE:
            yield start, k
            start, held = k, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Number of tokens and digests of ids and decoded text; with ``with_ids`` also ``ids`` and ``decoded``."""
    name = os.path.basename(path)
    docs.sparkSession.sparkContext.addFile(path)  # the driver hands the vocabulary out
    fields = [f.name for f in docs.select(*keep).schema]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), SCHEMA, *(["ids array<int>", "decoded string"] * with_ids)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(SparkFiles.get(name))
        for batch in batches:
            texts = batch.column("_t").to_pylist()
            for a, b in slices(texts):
                ids = m.encode(texts[a:b])
                decoded = m.decoded(ids)
                columns = [batch.column(f).slice(a, b - a) for f in fields]
                columns += [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(t).hexdigest() for t in decoded]),
                ]
                if with_ids:
                    columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array([t.decode() for t in decoded])]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *(f.split()[0] for f in SCHEMA.split(", ")), *(["ids", "decoded"] * with_ids)])

    ship(docs.sparkSession)
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t")).mapInArrow(run, schema)
