"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are runs of letters and digits of the lower-cased text; a k-mer is three words in a row, labelled with how often it
has occurred before. For each of ``TABLES`` hash functions a text keeps the ``TAKEN`` k-mers of least hash, in the order
in which they stand: such an ordered sample agrees between two texts about as often as their edit similarity is high.
Texts of at most ``SHORT`` words get ``SHORT_TABLES`` more samples, of two-word k-mers, since few edits leave them no
three words in a row. Texts that agree in a table are candidates; the numbers are such that nearly all pairs at the
threshold agree in one (the README has the measured shares). A candidate pair is a link if its alignment, in words and
within the band that the threshold allows, has at most (1 - threshold) of the longer text's words as edits.

Groups of thousands of copies never become pairs. Each bucket first compares its members with one hub, which links a group
of copies at once; exact copies are one text from the start. Then every pair of a bucket whose texts are still in different
components is compared: the members are dealt to blocks of about ``BLOCK``, and each pair of blocks compares bit signatures
of words, an exact bound; what passes is aligned. So a bucket of many texts that are not similar
costs a comparison of bits a pair, within a task, but no pair of a bucket is left out.

A text is known by a 64-bit hash of its whole, so rows that share an id but not a text are told apart; two of n texts have
the same hash with a probability of n^2 / 2^65. Nothing comes to the driver but checksums of edge sets. Defined cases: a
null or empty text is its own class; equal texts without words are a class; a text of fewer words than a k-mer is one
k-mer; a null id joins the class of its text, whose id is the least other one, or null; rows that repeat an id and a text
share a class; whole texts are read; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arpent.operators.graph import connected_components
from arpent.plans.shipping import ship
from arpent.plans.staging import staged, unstage

K, THRESHOLD = 3, 0.8
TABLES, TAKEN, SEED = 64, 2, 11
#: Texts of at most so many words have further tables, of shorter k-mers.
SHORT, SHORT_TABLES, SHORT_K = 63, 16, 2
#: Members of a block in the last comparison; bits of a signature for each word, and the bounds of a signature's bits.
BLOCK, SPARSE, LEAST_BITS, MOST_BITS = 2048, 8, 512, 1 << 17
SLICE_BYTES = 2_000_000

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, TABLES + SHORT_TABLES + K + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each one (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 texts laid end to end, and the borders of the texts among them."""
    inside = _WORD_BYTE[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    start = inside & (fresh[:-1] | ~np.r_[False, inside[:-1]])
    if not start.any():
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(inside)
    begins = np.flatnonzero(start)
    first = np.searchsorted(at, begins)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    power = np.cumprod(np.full(int(place.max()) + 1, _ODD[-1], np.uint64))
    hashed = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * power[place], first)
    return _mix(hashed), np.searchsorted(begins, offsets)


def _labels(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How often each value has occurred before in its text."""
    own = _mix(values + text.astype(np.uint64) * _ODD[-2])
    order = np.argsort(own, kind="stable")
    lead = np.r_[True, own[order][1:] != own[order][:-1]] if len(own) else np.empty(0, bool)
    runs = np.flatnonzero(lead)
    seen = np.empty(len(own), np.uint64)
    seen[order] = (np.arange(len(own)) - np.repeat(runs, np.diff(np.r_[runs, len(own)]))).astype(np.uint64)
    return seen


def kmers(hashes: np.ndarray, borders: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers of each text, and the borders of the texts among them."""
    n = np.diff(borders)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out = np.r_[0, np.cumsum(count)]
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(out[-1]) - out[text] + borders[text]
    padded = np.r_[hashes, np.zeros(k, np.uint64)]
    grams = np.zeros(len(at), np.uint64)
    for j in range(k):
        w = padded[at + j]
        grams += np.where(at + j < borders[text + 1], w, np.uint64(j)) * _ODD[TABLES + SHORT_TABLES + j]
    grams = _mix(grams)
    return _mix(grams + _labels(grams, text) * _ODD[-3]), out


def sketches(grams: np.ndarray, borders: np.ndarray, first_table: int = 0, tables: int = TABLES) -> np.ndarray:
    """For each text with k-mers: a key for each table."""
    some = np.flatnonzero(np.diff(borders))
    first, n = borders[some], np.diff(borders)[some]
    keys = np.empty((len(some), tables), np.int64)
    for t in range(first_table, first_table + tables):
        h = grams * _ODD[t]
        chosen = []
        for _ in range(TAKEN):
            least = np.minimum.reduceat(h, first)
            hit = np.flatnonzero(h == np.repeat(least, n))
            owner = np.searchsorted(first, hit, "right") - 1
            place = hit[np.searchsorted(owner, np.arange(len(some)))]
            chosen.append(place)
            h[place] = _TOP
        kept = np.sort(np.stack(chosen), axis=0)  # text order
        key = np.full(len(some), np.uint64(t + 1)) * _ODD[-1]
        for place in kept:
            key = _mix(key + grams[place])
        keys[:, t - first_table] = key.view(np.int64)
    return keys


def bucket_keys(hashes: np.ndarray, borders: np.ndarray) -> list[np.ndarray | None]:
    """The keys of each text in all its tables; none for a text without words."""
    n = np.diff(borders)
    keys: list[np.ndarray | None] = [None] * len(n)
    some = np.flatnonzero(n)
    if not len(some):
        return keys
    for k, own in zip(some.tolist(), sketches(*kmers(hashes, borders))):
        keys[k] = own
    short = (n > 0) & (n <= SHORT)
    if short.any():
        few = kmers(hashes[np.repeat(short, n)], np.r_[0, np.cumsum(n[short])], SHORT_K)
        for k, own in zip(np.flatnonzero(short).tolist(), sketches(*few, TABLES, SHORT_TABLES)):
            keys[k] = np.concatenate([keys[k], own])
    return keys


def signatures(hashes: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """For each text the set of its words, each labelled with its earlier occurrences, as bits; longer texts have more."""
    text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    w = hashes >> np.uint64(32)
    labelled = _mix(w + _labels(w, text) * _ODD[-3])
    out = []
    for a, b in zip(borders.tolist(), borders[1:].tolist()):
        size = min(max(LEAST_BITS, 1 << (SPARSE * (b - a) - 1).bit_length()), MOST_BITS) if b > a else LEAST_BITS
        bits = np.zeros(size, np.uint8)
        bits[labelled[a:b] & np.uint64(size - 1)] = 1
        out.append(np.packbits(bits, bitorder="little").tobytes())
    return out


def _folded(signature: bytes, size: int) -> np.ndarray:
    """The signature with ``size`` bytes, at most as many as it has."""
    return np.bitwise_or.reduce(np.frombuffer(signature, np.uint64).reshape(-1, size // 8), axis=0)


def possible(left: list[tuple], right: list[tuple], upwards: bool = False, threshold: float = THRESHOLD, table: int = 0) -> Iterator[tuple[int, int]]:
    """Places (i, j) of the members (node, component, words, signature, keys) of two blocks, of other components, that may
    be similar; ``upwards`` takes only pairs whose second node is the larger. Pairs that share a key of a table before
    ``table`` meet there and are passed over. An edit leaves at most one word of either text without a partner, so more
    bits that only one text has than the edits allowed rule a match out; no match is ruled out."""
    by_size: dict[int, list[int]] = {}
    for j, m in enumerate(right):
        by_size.setdefault(len(m[3]), []).append(j)
    for size_b, places in by_size.items():
        places.sort(key=lambda j: right[j][2])
        nodes, components, lengths = (np.array([right[j][k] for j in places]) for k in (0, 1, 2))
        keys = np.stack([right[j][4][:table] for j in places]) if table else None
        folds: dict[int, np.ndarray] = {}
        for i, (node, component, n, signature, *own_keys) in enumerate(left):
            # One more on either side than the threshold allows: the exact test of the lengths is below.
            lo, hi = np.searchsorted(lengths, [int(n * threshold) - 1, int(n / threshold) + 2]).tolist()
            if lo >= hi:
                continue
            limits = ((1 - threshold) * np.maximum(lengths[lo:hi], n) + 1e-9).astype(np.int64)
            fit = (np.abs(lengths[lo:hi] - n) <= limits) & (components[lo:hi] != component)
            if upwards:
                fit &= nodes[lo:hi] > node
            fit = np.flatnonzero(fit)
            if table and len(fit):
                fit = fit[~(keys[lo:hi][fit] == own_keys[0][:table]).any(axis=1)]
            if not len(fit):
                continue
            size = min(size_b, len(signature))
            if size not in folds:
                folds[size] = np.stack([_folded(right[j][3], size) for j in places])
            own, others, most = _folded(signature, size), folds[size][lo:hi][fit], limits[fit]
            good = np.bitwise_count(own & ~others).sum(axis=1, dtype=np.int64) <= most
            fit, others, most = fit[good], others[good], most[good]
            for k in fit[np.bitwise_count(others & ~own).sum(axis=1, dtype=np.int64) <= most].tolist():
                yield i, places[lo + k]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    ends = _buffers(column)[1] if len(column) else np.zeros(1)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE_BYTES, "right")) - 1)
        yield a, b
        a = b


def text_key(text: str):
    """A 64-bit hash that stands for a text; null for a null or empty one."""
    return F.when(F.col(text) != "", F.xxhash64(F.col(text)))


def _cut(rows: DataFrame, text: str, schema: str, columns) -> DataFrame:
    """``columns`` of the words of each text: a function of word hashes and borders that gives Arrow arrays. The rows are
    (node, text)."""
    ship(rows.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_t")
            for a, b in _slices(column):
                hashes, borders = words(*_buffers(column.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), *columns(hashes, borders)], names=["node", *names])

    rows = rows.select("node", F.coalesce(F.lower(text), F.lit("")).cast("binary").alias("_t"))
    return rows.mapInArrow(run, f"node long, {schema}")


def sketched(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, keys, n, bits) of each text; keys are null for texts without words."""

    def columns(hashes: np.ndarray, borders: np.ndarray) -> list[pa.Array]:
        keys = pa.array(bucket_keys(hashes, borders), pa.list_(pa.int64()))
        return [keys, pa.array(np.diff(borders), pa.int64()), pa.array(signatures(hashes, borders), pa.binary())]

    return _cut(docs.select(text_key(text).alias("node"), F.col(text).alias("_text")), "_text", "keys array<long>, n long, bits binary", columns)


def _once_a_batch(texts: DataFrame) -> DataFrame:
    """Rows (node, _text) with each node once a batch, so that a text with very many copies is few rows before they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first = np.unique(batch.column("node").to_numpy(), return_index=True)
            yield batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))

    return texts.where("node is not null").mapInArrow(run, "node long, _text string")


def word_rows(texts: DataFrame) -> DataFrame:
    """(node, words) of rows (node, _text): the words of each text as 32-bit numbers, in bytes."""

    def columns(hashes: np.ndarray, borders: np.ndarray) -> list[pa.Array]:
        flat, cuts = (hashes >> np.uint64(32)).astype("<u4").tobytes(), (4 * borders).tolist()
        return [pa.array([flat[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())]

    return _cut(texts, "_text", "words binary", columns)


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether at most ``limit`` words must be put in, taken out or replaced, by an alignment within the band of that width.

    With so few edits the alignment never leaves the diagonals within ``limit`` of the main one. A column of the table of
    distances is held in that band only, as the bits of two numbers, rises and falls, which slide down a row with each
    word of ``b`` (Myers, 1999; Hyyro, 2003). The cost is followed along the lower edge of the band, then along the last
    row; outside the band it could only be too high, so the answer is exact."""
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > limit:
        return False
    if limit >= n or not m:
        return limit >= n
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    width = 2 * limit + 1  # bit k of column j is row j - limit + k
    full, edge = (1 << width) - 1, 1 << 2 * limit
    rise, fall, cost = full ^ ((1 << limit) - 1), 0, limit  # column 0, seen from the band of column 1
    most = limit + m - (n - limit)
    for j, y in enumerate(b.tolist(), 1):
        found, at = places.get(y, 0), j - limit - 1
        same = (found >> at if at > 0 else found << -at) & full
        level = (((same & rise) + rise) ^ rise | same | fall) & full
        up, down = fall | full ^ (level | rise), level & rise
        if j <= n - limit:  # the lower edge still runs along a diagonal
            cost += not level & edge
            if cost > most:
                return False
        else:  # the last row: one bit higher with each column
            edge >>= 1
            cost += 1 if up & edge else -1 if down & edge else 0
            if cost - (m - j) > limit:  # each word left takes off one at most
                return False
        level >>= 1
        rise, fall = down | full ^ (level | up), level & up
    return cost <= limit


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two multisets."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[x], cb[y]).sum())


def edits_at_most(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the edits between two texts: the cost of one alignment, through pairs of neighbouring words that
    both have exactly once and in the same order. Between anchors, words are compared in place where the gaps are equally
    long, and all count as edits where they are not."""
    pairs_a, pairs_b = _pairs(a), _pairs(b)
    ua, ia, ca = np.unique(pairs_a, return_index=True, return_counts=True)
    ub, ib, cb = np.unique(pairs_b, return_index=True, return_counts=True)
    _, x, y = np.intersect1d(ua[ca == 1], ub[cb == 1], assume_unique=True, return_indices=True)
    at_a, at_b = ia[ca == 1][x], ib[cb == 1][y]
    order = np.argsort(at_a)
    at_a, at_b = at_a[order].tolist(), at_b[order].tolist()
    # Longest run of anchors whose places rise in both texts.
    tops: list[int] = []
    tails: list[int] = []
    before = [-1] * len(at_b)
    for k, v in enumerate(at_b):
        p = bisect_left(tops, v)
        if p:
            before[k] = tails[p - 1]
        if p == len(tops):
            tops.append(v)
            tails.append(k)
        else:
            tops[p], tails[p] = v, k
    cost, k, end_a, end_b = 0, tails[-1] if tails else -1, len(a), len(b)
    while True:
        i, j = (at_a[k], at_b[k]) if k >= 0 else (-1, -1)
        gap_a, gap_b = end_a - i - 1, end_b - j - 1
        if gap_a or gap_b:
            cost += int((a[i + 1 : end_a] != b[j + 1 : end_b]).sum()) if gap_a == gap_b else max(gap_a, gap_b)
        if k < 0:
            return cost
        end_a, end_b, k = i, j, before[k]


def _pairs(w: np.ndarray) -> np.ndarray:
    """Each word with the next, as one number."""
    return w[:-1].astype(np.uint64) * _ODD[0] + w[1:]


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether the edit similarity of two word arrays reaches the threshold; exact.

    An edit leaves at most one word, and at most two pairs of neighbours, of the longer text without a partner: texts
    that share too few of either are no match. One alignment that is cheap enough proves a match. Only what these two
    bounds leave open needs the best alignment."""
    longer = max(len(a), len(b))
    limit = int((1 - threshold) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit or not longer:
        return False
    if longer - _shared(a, b) > limit:
        return False
    if longer - 1 - _shared(_pairs(a), _pairs(b)) > 2 * limit:
        return False
    return edits_at_most(a, b) <= limit or edits_within(a, b, limit)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (src, dst) that are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("wa"), batch.column("wb"))):
                if similar(np.frombuffer(x.as_py(), "<u4"), np.frombuffer(y.as_py(), "<u4"), threshold):
                    keep.append(k)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("src").take(at), batch.column("dst").take(at)], names=["src", "dst"])

    one = texts.select(F.col("node").alias("src"), F.col("words").alias("wa"))
    two = texts.select(F.col("node").alias("dst"), F.col("words").alias("wb"))
    return pairs.join(one, "src").join(two, "dst").select("src", "dst", "wa", "wb").mapInArrow(run, "src long, dst long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, class_id (the smallest id of its class), ``kept``, true for the rows of that id and its
    text, and ``text_key`` and ``class_key``, the hash of its text and the least one of its class."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("text_key"))
    placed = rows.join(_labels_of(docs, text, threshold), "text_key", "left").withColumn("class_key", F.coalesce("class_key", "text_key"))
    ids = placed.where("class_key is not null").groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
    placed = placed.join(ids, "class_key", "left")
    alone = F.col("class_key").isNull()
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))
    return placed.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.when(alone, True).otherwise(first).alias("kept"), "text_key", "class_key")


def _labels_of(docs: DataFrame, text: str, threshold: float) -> DataFrame:
    """(text_key, class_key) of the texts that are similar to another."""
    sketch = sketched(docs, text).where("keys is not null")
    nodes = staged(sketch.groupBy("node").agg(*[F.first(c).alias(c) for c in ("keys", "n", "bits")]), "nodes")
    keyed = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").drop("last")
    members = staged(keyed.join(shared, "bucket"), "members")
    wanted = members.select("node").distinct()
    texts = _once_a_batch(docs.select(text_key(text).alias("node"), F.col(text).alias("_text"))).join(wanted, "node", "left_semi")
    texts = staged(word_rows(texts.dropDuplicates(["node"])), "words")  # the join has brought equal texts together
    pairs = members.where("node <> hub").select(F.col("hub").alias("src"), F.col("node").alias("dst")).distinct()
    links = staged(_verified(pairs, texts, threshold), "links")
    labels = staged(connected_components(links), "labels")
    more = staged(_verified(_remaining(members, labels, nodes, threshold), texts, threshold), "links")
    if not more.isEmpty():
        before = labels
        labels = staged(connected_components(links.unionByName(more)), "labels")
        unstage(before)
    for table in (nodes, members, texts, links, more):
        unstage(table)
    return labels.select(F.col("node").alias("text_key"), F.col("component").alias("class_key"))


def _remaining(members: DataFrame, labels: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """All pairs (src, dst) of a bucket that are in different components and may be similar, each in the bucket of the
    first table in which it agrees.

    A bucket of more than ``BLOCK`` members is dealt to blocks: the members outside its largest component to some, those of
    that component to others. Each block of the first kind meets all of both kinds; within the largest component nothing is
    left to compare. A pair of blocks is the unit of work, so no task holds a bucket. A smaller bucket is one unit."""
    now = members.select("bucket", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("components")).where("components > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    mixed = mixed.select("bucket", F.col("main.component").alias("main"), (F.col("all") <= BLOCK).alias("small"), blocks(F.col("all") - F.col("main.n")).alias("outer"), blocks(F.col("main.n")).alias("inner"))
    dealt = now.join(mixed, "bucket").withColumn("in_main", F.col("component") == F.col("main"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.when(F.col("in_main"), F.col("inner")).otherwise(F.col("outer"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    unit = lambda kind, i, j, left: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), left.alias("left"))
    block, yes, no, zero = F.col("block"), F.lit(True), F.lit(False), F.lit(0)
    outer = F.transform(upto("outer"), lambda k: unit(_OUTER, F.least(block, k), F.greatest(block, k), block <= k))
    large = F.when(F.col("in_main"), F.transform(upto("outer"), lambda k: unit(_MAIN, k, block, no))).otherwise(F.concat(outer, F.transform(upto("inner"), lambda k: unit(_MAIN, block, k, yes))))
    units = F.when(F.col("small"), F.array(unit(_WHOLE, zero, zero, ~F.col("in_main")))).otherwise(large)
    key = ["bucket", "kind", "i", "j"]
    rows = dealt.select("bucket", "node", "component", F.explode(units).alias("u")).select("bucket", "u.*", "node", "component")
    rows = rows.join(nodes, "node").repartition(*key).sortWithinPartitions(*key)
    ship(members.sparkSession)

    def met(unit: tuple, left: list[tuple], right: list[tuple]) -> Iterator[tuple[int, int]]:
        bucket, kind, i, j = unit
        table = int(np.flatnonzero((left or right)[0][4] == bucket)[0])
        if kind == _WHOLE or (kind == _OUTER and i == j):
            for a, b in possible(left, left, True, threshold, table):
                yield left[a][0], left[b][0]
        if kind != _OUTER or i != j:
            for a, b in possible(left, right, False, threshold, table):
                yield min(left[a][0], right[b][0]), max(left[a][0], right[b][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, sides, out = None, ([], []), []

        def put() -> pa.RecordBatch:
            taken = pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["src", "dst"])
            out.clear()
            return taken

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "left", "node", "component", "n", "bits")]
            lists = batch.column("keys")
            ends = lists.offsets.to_numpy()
            keys = np.split(lists.values.to_numpy()[ends[0] : ends[-1]], ends[1:-1] - ends[0])
            for *at, is_left, node, component, n, bits, own in zip(*columns, keys):
                if at != unit:
                    for pair in met(unit, *sides) if unit else ():
                        out.append(pair)
                        if len(out) >= 50_000:
                            yield put()
                    unit, sides = at, ([], [])
                sides[0 if is_left else 1].append((node, component, n, bits, own))
        for pair in met(unit, *sides) if unit else ():
            out.append(pair)
            if len(out) >= 50_000:
                yield put()
        yield put()

    return rows.mapInArrow(run, "src long, dst long")


#: Kinds of units: two blocks outside the largest component, one outside and one of it, a whole bucket.
_OUTER, _MAIN, _WHOLE = 0, 1, 2
