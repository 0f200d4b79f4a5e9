"""Spelling variants: pairs of words one edit apart, by blocked Gram matrices of letter counts.

Words are counted over all texts. Two words one edit apart have letter counts whose squared distance is at most two: one
for a letter more, two for another letter, and their lengths differ by at most one. Letters fall into ``CLASSES``; the
counts of the classes of a word (their sum is its length) are its block, and a word one edit away lies in the same block,
in one with one letter more in one class, or in one with a letter moved between two classes. So only neighbouring blocks
meet. A block is dealt into tiles of bounded size; a unit of work is one tile as rows, and tiles of the same and of later
neighbouring blocks as columns that pass by in batches. The products of the count matrices give the squared distances;
pairs at two or less are held against each other letter by letter. No pair is lost, whatever the blocks hold; the sizes of
blocks and tiles only decide where the work happens.

Each word then takes the most frequent of its near words as its form if that is at least twice as frequent, and forms are
followed to the last by doubling: after k rounds, 2 to the k steps. A form at least doubles the count, so chains are short.

Defined cases: a null text has no words; a null id counts as empty in the checksum; repeated rows count again; texts are
read whole; a table without such words gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arpent.plans.shipping import ship
from arpent.plans.staging import staged, unstage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS, MIN_COUNT, TYPO, FORM = 5, 3, 97, 2
#: Letters by class, about as frequent; the last class has all others. Any split gives the same pairs.
CLASSES = ("el", "to", "an", "is", "hrd")
#: Code points of one tile, about; columns of one product.
TILE, COLUMNS = 16_384, 2_048
#: Counts of a word: the 26 letters, and the other letters folded into six.
BINS = 32


def words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Words of at least five letters and their number over all texts, in which each 97th run has lost a letter."""
    low = F.translate(F.col(text), UPPER, LOWER)
    runs = F.regexp_extract_all(low, F.lit(f"[a-z\\u00C0-\\u00FF]{{{MIN_LETTERS},}}"), F.lit(0))
    rows = docs.select(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":")).alias("mark"), F.explode(runs).alias("run"))
    h, at = F.crc32(F.concat("mark", "run").cast("binary")), F.col("h") % F.length("run")
    cut = F.concat(F.expr("left(run, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    rows = rows.withColumn("h", h).select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= MIN_COUNT) & (F.length("word") >= MIN_LETTERS))


def _block(word: str):
    """The counts of the classes, the rest last."""
    left = [F.length(F.translate(word, c, "")) for c in CLASSES]
    known = [F.length(word) - n for n in left]
    rest = F.length(word)
    for n in known:
        rest = rest - n
    return F.array(*known, rest)


def _later(block: str):
    """The neighbouring blocks that come after one: a letter more in a class, or a letter moved from a class to an earlier
    one, whichever two."""
    size, moved = len(CLASSES) + 1, []
    step = lambda by: F.transform(F.col(block), lambda x, i: x + F.element_at(F.array(*[F.lit(v) for v in by]), i + 1))
    for a in range(size):
        moved.append(step([int(i == a) for i in range(size)]))
        moved += [F.when(F.col(block)[b] > 0, step([(i == a) - (i == b) for i in range(size)])) for b in range(a + 1, size)]
    return F.filter(F.array(*moved), lambda x: x.isNotNull())


def _units(vocabulary: DataFrame) -> DataFrame:
    """Rows of the units: tiles of words that own the unit, and tiles that pass by it as guests."""
    rows = vocabulary.select("word", "n", _block("word").alias("block"))
    sizes = rows.groupBy("block").agg(F.sum(F.greatest(F.length("word"), F.lit(16))).alias("points"))
    sizes = staged(sizes.select("block", F.ceil(F.col("points") / TILE).cast("int").alias("tiles")), "blocks")
    rows = rows.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    tiles = staged(rows.groupBy("block", "tile", "tiles").agg(F.collect_list(F.struct("word", "n")).alias("words")), "tiles")  # TILE bounds a list
    # Guests come in as many parts as the largest block among them has tiles, and a unit for each part.
    pairs = sizes.select("block", "tiles", F.explode(_later("block")).alias("guest")).join(sizes.select(F.col("block").alias("guest"), F.col("tiles").alias("guests")), "guest")
    parts = sizes.join(pairs.groupBy("block").agg(F.max("guests").alias("guests")), "block", "left").select("block", F.greatest("tiles", F.coalesce("guests", F.lit(0))).alias("parts"))
    unit = lambda i, part, guest: [F.col("unit"), i.alias("i"), part.alias("part"), F.lit(guest).alias("guest"), F.col("words.word").alias("words"), F.col("words.n").alias("counts")]
    owners = tiles.join(parts, "block").withColumnRenamed("block", "unit").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    owners = owners.select(*unit(F.col("tile"), F.col("part"), False))
    same = tiles.where("tile > 0").withColumnRenamed("block", "unit").withColumn("owner", F.explode(F.sequence(F.lit(0), F.col("tile") - 1)))
    same = same.select(*unit(F.col("owner"), F.col("tile"), True))
    later = tiles.join(pairs.select(F.col("guest").alias("block"), F.col("block").alias("unit"), F.col("tiles").alias("owners")), "block")
    later = later.withColumn("owner", F.explode(F.sequence(F.lit(0), F.col("owners") - 1))).select(*unit(F.col("owner"), F.col("tile"), True))
    return owners.unionByName(same).unionByName(later)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points in rows, padded with zeros; lengths; counts of the bins."""
    length = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    row = np.repeat(np.arange(len(words)), length)
    column = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    held = np.zeros((len(words), int(length.max(initial=0)) + 1), np.int32)
    held[row, column] = points
    fold = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 6)
    counts = np.bincount(row * BINS + fold, minlength=len(words) * BINS).reshape(len(words), BINS)
    return held, length, counts.astype(np.float64)


def one_edit(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether row k of ``a`` and of ``b`` differ by exactly one inserted, deleted or replaced code point. The rows are
    padded with zeros; ``na`` and ``nb`` are lengths."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    short, shorter = np.where((na <= nb)[:, None], a, b), np.minimum(na, nb)
    long = np.where((na <= nb)[:, None], b, a)
    equal = short == long
    first = np.where(equal.all(1), width, np.argmin(equal, 1))  # the first place where they differ
    place = np.arange(width)
    shifted = np.pad(long[:, 1:], ((0, 0), (0, 1)))
    same_after = ((short == long) | (place[None, :] <= first[:, None])).all(1)
    same_shifted = ((short == shifted) | (place[None, :] < first[:, None]) | (place[None, :] >= shorter[:, None])).all(1)
    gap = np.abs(na - nb)
    return np.where(gap == 0, same_after & (first < width), (gap == 1) & same_shifted)


def near(owners: list[str], guests: list[str], among: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the pairs one edit apart; with ``among`` both lists are the same and each pair comes once."""
    held, length, counts = letters(owners)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(guests), COLUMNS):
        other, other_length, other_counts = letters(guests[start : start + COLUMNS])
        gram = counts @ other_counts.T
        distance = (counts * counts).sum(1)[:, None] + (other_counts * other_counts).sum(1)[None, :] - 2 * gram
        i, j = np.nonzero(distance <= 2)
        if among:
            i, j = i[i < j + start], j[i < j + start]
        step = max(1, 2_000_000 // max(held.shape[1], other.shape[1]))
        for a in range(0, len(i), step):
            x, y = i[a : a + step], j[a : a + step]
            ok = one_edit(held[x], length[x], other[y], other_length[y])
            found.append((x[ok], y[ok] + start))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of units whose rows come in order, the owner first. Guests of a unit are gathered up to one product; a
    tile that no word fell into has guests only, and no pairs."""
    unit, owners, guests = None, ([], []), ([], [])

    def pairs(left, right, among: bool) -> pa.RecordBatch:
        i, j = near(left[0], right[0], among)
        take = lambda values, at: [values[k] for k in at.tolist()]
        a, b, na, nb = take(left[0], i), take(right[0], j), take(left[1], i), take(right[1], j)
        return pa.RecordBatch.from_arrays([pa.array(a + b, pa.string()), pa.array(na + nb, pa.int64()), pa.array(b + a, pa.string()), pa.array(nb + na, pa.int64())], names=["word", "n", "other", "other_n"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("unit", "i", "part", "guest"))))
        words, counts = batch.column("words"), batch.column("counts")
        for k, (block, i, part, guest) in enumerate(keys):
            held = (words[k].as_py(), counts[k].as_py())
            if not guest:
                if guests[0]:
                    yield pairs(owners, guests, False)
                unit, owners, guests = (block, i, part), held, ([], [])
                if part == i:  # pairs within the tile come from one of its units
                    yield pairs(owners, owners, True)
            elif (block, i, part) == unit:
                guests[0].extend(held[0])
                guests[1].extend(held[1])
                if len(guests[0]) >= COLUMNS:
                    yield pairs(owners, guests, False)
                    guests = ([], [])
    if guests[0]:
        yield pairs(owners, guests, False)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Ordered pairs (word, n, other, other_n) of words one edit apart, both ways round."""
    units = _units(vocabulary).withColumn("unit", F.array_join(F.transform("unit", lambda x: x.cast("string")), ","))
    ship(vocabulary.sparkSession)
    dealt = units.repartition("unit", "i", "part").sortWithinPartitions("unit", "i", "part", "guest")
    return dealt.mapInArrow(_matched, "word string, n long, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """The last form of each word that has one. A table a round, each twice as far as the one before."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        unstage(now)
        now = after.select("word", "root")
        now._staged_at = after._staged_at
        if after.where("moved").isEmpty():
            return now


def group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every word with the number of its near words, its form, and the last form that it leads to."""
    vocabulary = staged(words(docs, text, doc_id), "words")
    best = near_pairs(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    best = best.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
    is_form = F.col("form_n") >= FORM * F.col("n")
    rows = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    rows = staged(rows, "forms")
    out = rows.join(_roots(rows.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
