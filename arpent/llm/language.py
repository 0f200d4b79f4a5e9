"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram is the product of its letters' vectors, the first rolled
by two places and the second by one (binding); a text is the sum of its trigrams (bundling), and so is a language. A
text is given to the language whose prototype is closest in cosine.

Prototypes are bundles of the training rows, so they are sums of partial bundles: each task bundles its rows and sends
one vector a language, and partial bundles meet in a grouping by language and slice of the vector. Training reads at
most about ``TRAINING_ROWS`` rows, chosen by a hash of their id (the documented bound of the fit); every document is
then classified over its whole text. What the driver holds is one vector a language.

Defined cases: a null text, or one without letters, is ``und`` with score 0; ties go to the smaller language code;
without training rows everything is ``und``; repeated rows give equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arpent.plans.shipping import ship

DIMENSIONS = 1024
SEED = 20_161
#: Rows of the fit, about: beyond this count a hash picks the share of rows that gives it.
TRAINING_ROWS = 40_000
#: Texts of one slice of a batch, and trigram vectors that a task remembers.
SLICE_CHARS, REMEMBERED = 400_000, 60_000
UNKNOWN = "und"


class Space:
    """Letter and trigram vectors; both come from the seed alone, so all tasks agree."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.vectors = np.empty((0, dimensions), np.float32)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = np.random.default_rng([self.seed, point]).choice(np.array([-1, 1], np.int8), self.dimensions)
        return self.letters[point]

    def trigrams(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers in ``vectors`` of trigrams, each three code points of 21 bits."""
        if len(self.row) > REMEMBERED:
            self.row.clear()
            self.vectors = np.empty((0, self.dimensions), np.float32)
        new = [c for c in codes.tolist() if c not in self.row]
        if new:
            points = np.array(new, np.int64)
            parts = [(points >> 42) & 0x1FFFFF, (points >> 21) & 0x1FFFFF, points & 0x1FFFFF]
            used, at = np.unique(np.concatenate(parts), return_inverse=True)
            letters = np.stack([self.letter(p) for p in used.tolist()])
            at = at.reshape(3, -1)
            made = np.roll(letters, 2, 1)[at[0]] * np.roll(letters, 1, 1)[at[1]] * letters[at[2]]
            self.row.update(zip(new, range(len(self.vectors), len(self.vectors) + len(new))))
            self.vectors = np.concatenate([self.vectors, made.astype(np.float32)])
        return np.array([self.row[c] for c in codes.tolist()], np.int64)

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One row a text: the sum of its trigrams' vectors; zero where it has no letters."""
        doc, codes, counts = grams(texts)
        out = np.zeros((len(texts), self.dimensions), np.float32)
        if not len(doc):
            return out
        kinds, at = np.unique(codes, return_inverse=True)
        vectors = self.vectors[rows] if len(rows := self.trigrams(kinds)) else self.vectors
        # A block of texts times all trigrams of the slice, as a matrix product.
        step = max(1, 8_000_000 // len(kinds))
        for a in range(0, len(texts), step):
            lo, hi = np.searchsorted(doc, [a, a + step])
            block = np.zeros((min(step, len(texts) - a), len(kinds)), np.float32)
            block[doc[lo:hi] - a, at[lo:hi]] = counts[lo:hi]
            out[a : a + step] = block @ vectors
        return out


_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Code point to itself where it is a letter, else to a blank."""
    global _letter_table
    if _letter_table is None:
        table = np.full(0x110000, 32, np.int64)
        for p in range(0x110000):
            if chr(p).isalpha():
                table[p] = p
        _letter_table = table
    return _letter_table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of each text as (text, code, count), sorted by text. Words are taken in lower case, with one
    blank before, between and after them; trigrams over two blanks' worth of nothing do not occur."""
    joined = "\x00".join([f" {t.lower()} " for t in texts]) + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    end = points == 0
    # A zero inside a text would look like a border: such a character counts as a blank.
    if end.sum() != len(texts):
        return grams([t.replace("\x00", " ") for t in texts])
    text = np.cumsum(end) - end
    letters = _letters()[points]
    blank = letters == 32
    keep = ~(blank & np.r_[False, blank[:-1] & (text[1:] == text[:-1])]) & ~end
    letters, text = letters[keep], text[keep]
    if len(letters) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    whole = text[2:] == text[:-2]
    codes = ((letters[:-2] << 42) | (letters[1:-1] << 21) | letters[2:])[whole]
    text = text[2:][whole]
    kinds, at = np.unique(codes, return_inverse=True)
    pair, counts = np.unique(text * len(kinds) + at, return_counts=True)
    return pair // max(len(kinds), 1), kinds[pair % max(len(kinds), 1)], counts.astype(np.float32)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > SLICE_CHARS:
            yield start, k
            start, held = k, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


_space: Space | None = None


def space() -> Space:
    global _space
    if _space is None:
        _space = Space()
    return _space


def held_out(doc_id: str = "doc_id"):
    """Rows kept from the fit: the checksum of the id as text is divisible by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", rows: int = TRAINING_ROWS) -> dict[str, np.ndarray]:
    """One unit vector a language, bundled from training rows."""
    ship(docs.sparkSession)
    train = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = train.count()
    if n > rows:
        train = train.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < int((1 << 30) * rows / n))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for a, b in slices(texts):
                found = space().bundles(texts[a:b]).astype(np.float64)
                # Each text counts by direction, so that long texts do not drown the others.
                norm = np.linalg.norm(found, axis=1, keepdims=True)
                found = np.divide(found, norm, out=np.zeros_like(found), where=norm > 0)
                for k, one in enumerate(langs[a:b]):
                    sums[one] = sums.get(one, 0.0) + found[k]
        width = 64
        for one, v in sums.items():
            if np.any(v):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one] * (DIMENSIONS // width)), pa.array(range(DIMENSIONS // width), pa.int32()), pa.array(v.reshape(-1, width).tolist(), pa.list_(pa.float64()))],
                    names=["lang", "slice", "v"],
                )

    partial = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(bundle, "lang string, slice int, v array<double>")
    summed = partial.groupBy("lang", "slice").agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(64)]).alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # one vector a language
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[64 * r["slice"] : 64 * (r["slice"] + 1)] = r["v"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items())}


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """Prediction and score of every document, with whether its row was kept from the fit."""
    known = prototypes(docs, text, lang, doc_id)
    langs, matrix = list(known), np.array(list(known.values()), np.float32).reshape(len(known), DIMENSIONS)
    id_type = docs.select(doc_id).schema[0].dataType.simpleString()

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(texts):
                found = space().bundles(texts[a:b])
                norm = np.linalg.norm(found, axis=1)
                some = norm > 0
                cosine = (found @ matrix.T) / np.where(some, norm, 1)[:, None] if langs else np.zeros((b - a, 1))
                best = cosine.argmax(1)  # the first of equals: languages are in order
                pred = [langs[k] if ok and langs else UNKNOWN for k, ok in zip(best.tolist(), some.tolist())]
                score = np.where(some, np.clip(cosine.max(1), 0, 1), 0.0).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(pred, pa.string()), pa.array(score)],
                    names=[doc_id, "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col(doc_id).alias("id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(classify, f"`{doc_id}` {id_type}, held_out boolean, lang_pred string, score double")
