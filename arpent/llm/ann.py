"""Approximate nearest neighbours by inner product: inverted file with product-quantised residuals.

Fit: coarse centroids and residual codebooks come from a bounded sample of vectors (``SAMPLE``), on the driver. Index:
every distinct vector goes to its nearest centroid and keeps one byte for each of ``PARTS`` parts of its residual.
Search: a query probes the lists whose centroids have the largest inner product with it, as many as a bounded sample of
the queries themselves needed (``FOUND_SHARE``); in each list, tables of the
query's inner products with all codewords (asymmetric distances) score the codes; the best by score, as many as those
queries needed, are measured again on the original vectors, in double precision. Two passes find the best: the first reports from each block the scores at
ranks 1, 2, 4 and so on, from which a score follows that surely as many codes reach as are wanted; the second returns
what reaches it. So a query gets one or two times that many codes, however many blocks it has probed.

Small lists are packed into groups and large ones cut, so that a block holds about ``BLOCK`` vectors, and the queries that
probe a group are cut likewise: a list with a third of all vectors is many tasks. Equal vectors are indexed once and come back as their smallest ids, as many as an answer can hold.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
take no part, nor do null ids; an id stands for one row, and rows that repeat id and vector count once; equal scores go
to the smaller id; with fewer candidates than asked all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from arpent.plans.shipping import ship
from arpent.plans.staging import staged

K, QUERY_STEP = 20, 20
SAMPLE = 20_000
MAX_LISTS, PARTS, CODES, ROUNDS, SEED = 1024, 16, 256, 8, 7
#: A query probes so many lists that this share of the true neighbours within the sample lies in them, measured with so
#: many of the queries; and at least so many lists and vectors.
FOUND_SHARE, TRIED, LEAST_LISTS, LEAST_VECTORS = 0.95, 400, 8, 400
#: Best codes over all blocks that are measured again: so many at least, and as many as keep this share of the true neighbours.
RERANKED, KEPT_SHARE = 300, 0.99
BLOCK = 4096


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (vec_id, v) that take part. An id stands for one row: of several vectors the least, compared component by component."""
    v = F.col(embedding)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    length = [r["n"] for r in usual.collect()] or [0]
    return rows.where(F.size("v") == length[0]).groupBy("vec_id").agg(F.min("v").alias("v"))


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from a random start; an empty cluster takes the point farthest from its centre."""
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at, far = _nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=k)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        if (empty := np.flatnonzero(n == 0)).size:
            c[empty] = x[np.argsort(-far)[: empty.size]]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (c * c).sum(1)[None, :] - 2 * (x @ c.T)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at] + (x * x).sum(1)


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int):
        rng = np.random.default_rng(SEED)
        self.dims = sample.shape[1]
        self.parts = max(p for p in range(1, min(PARTS, self.dims) + 1) if self.dims % p == 0)
        self.centroids = _means(sample, min(lists, len(sample)), rng)
        residual = sample - self.centroids[_nearest(sample, self.centroids)[0]]
        cut = residual.reshape(len(sample), self.parts, -1)
        self.books = np.stack([_means(cut[:, p], min(CODES, len(sample)), rng) for p in range(self.parts)])

    def _near(self, tried: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
        """Places of the ``k`` vectors of the sample nearest to each tried query, itself left out."""
        scores = tried @ sample.T
        place = {v.tobytes(): i for i, v in enumerate(sample)}
        for i, q in enumerate(tried):
            if (own := place.get(q.tobytes())) is not None:
                scores[i, own] = -np.inf
        return np.argpartition(-scores, k, axis=1)[:, :k]

    def probe_share(self, sample: np.ndarray, k: int = K, found: float = FOUND_SHARE, tried: np.ndarray | None = None) -> float:
        """The share of the lists, in the order in which a query takes them, that holds ``found`` of the ``k`` nearest
        within the sample. Vectors that fall into clusters need few lists, evenly spread ones many, and queries that lie
        apart from the vectors other ones than those, so ``tried`` should be queries (default: some of the sample)."""
        if len(sample) <= k + 1:
            return 1.0
        tried = sample[:TRIED] if tried is None else tried
        near = self._near(tried, sample, k)
        lists, _ = _nearest(sample, self.centroids)
        place = np.argsort(np.argsort(-(tried @ self.centroids.T), axis=1, kind="stable"), axis=1)
        needed = np.take_along_axis(place, lists[near], axis=1) + 1
        return float(np.quantile(needed, found)) / len(self.centroids)

    def rerank(self, sample: np.ndarray, tried: np.ndarray, n: int, k: int = K, kept: float = KEPT_SHARE) -> int:
        """How many of ``n`` codes, best scores first, hold ``kept`` of the ``k`` nearest. Ranks within the sample stand for
        as many more as the table is larger; codes that tell a crowd of close vectors apart no more ask for many."""
        if len(sample) <= k + 1:
            return RERANKED
        near = self._near(tried, sample, k)
        at, codes = self.encode(sample)
        need = np.empty(near.shape)
        for i, q in enumerate(tried):
            score = self.centroids[at] @ q
            for p, part in enumerate(q.reshape(self.parts, -1)):
                score += (self.books[p] @ part)[codes[:, p]]
            # Equal codes count as before, so that a tie is never settled by chance.
            need[i] = len(score) - np.searchsorted(np.sort(score), score[near[i]] - 1e-9 * np.abs(score).max(), "left")
        return int(max(RERANKED, np.ceil(np.quantile(need, kept) * max(1.0, n / len(sample)))))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, _ = _nearest(x, self.centroids)
        cut = (x - self.centroids[at]).reshape(len(x), self.parts, -1)
        return at, np.stack([_nearest(cut[:, p], self.books[p])[0] for p in range(self.parts)], 1).astype(np.uint8)

    def scores(self, queries: np.ndarray, centroid: int, codes: np.ndarray) -> np.ndarray:
        """Inner products of queries with the coded vectors of one list, from tables by part."""
        q = queries.reshape(len(queries), self.parts, -1)
        out = np.repeat((queries @ self.centroids[centroid])[:, None], len(codes), 1)
        for p in range(self.parts):
            out += (q[:, p] @ self.books[p].T)[:, codes[:, p]]
        return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def search(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, query_step: int = QUERY_STEP, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest found of each row whose id is divisible by ``query_step``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, vec_id, embedding)
    distinct = staged(rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vectors")
    n = distinct.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    chosen = distinct if n <= sample else distinct.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    learned = np.array([r["v"] for r in chosen.select("v").orderBy(F.xxhash64("rep")).collect()], np.float64)  # about ``sample`` rows
    if not len(learned):
        learned = np.array([r["v"] for r in distinct.select("v").limit(1).collect()], np.float64)
    index = Index(learned, int(min(MAX_LISTS, max(LEAST_LISTS, 2 * np.sqrt(n)))))
    queries = staged(rows.where(F.col("vec_id") % query_step == 0).select(F.col("vec_id").alias("query_id"), "v"), "queries")
    asking = queries.select("v").orderBy(F.xxhash64("query_id"), "query_id").limit(TRIED).collect()
    if not asking:
        return spark.createDataFrame([], schema)
    tried = np.array([r["v"] for r in asking], np.float64)
    dims, share, reranked = index.dims, index.probe_share(learned, k, tried=tried), index.rerank(learned, tried, n, k)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, codes = index.encode(_matrix(batch.column("v"), dims))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(at, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())], names=["rep", "list", "code"])

    coded = staged(distinct.select("rep", "v").mapInArrow(encode, "rep long, list int, code binary"), "codes")
    counts = {r["list"]: r["count"] for r in coded.groupBy("list").count().collect()}  # a row a list
    held = np.array([counts.get(i, 0) for i in range(len(index.centroids))])
    # Lists in turn fill groups of a block's size; a group has one more block for each further BLOCK vectors.
    group = np.cumsum(held) // BLOCK
    cut = spark.createDataFrame([(i, int(g)) for i, g in enumerate(group)], "list int, grp int")
    blocks = {int(g): max(1, -(-int(held[group == g].sum()) // (2 * BLOCK))) for g in np.unique(group)}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-(_matrix(batch.column("v"), dims) @ index.centroids.T), axis=1, kind="stable")
            enough = (np.cumsum(held[order], 1) < LEAST_VECTORS).sum(1) + 1
            width = np.clip(np.maximum(enough, max(LEAST_LISTS, int(np.ceil(share * len(held))))), 1, len(held))
            at, groups, lists = [], [], []
            for k, (o, w) in enumerate(zip(order, width)):
                mine = np.sort(o[:w])
                for g in np.unique(group[mine]):
                    at.append(k)
                    groups.append(int(g))
                    lists.append(mine[group[mine] == g].astype("<i4").tobytes())
            rows_at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(rows_at), batch.column("v").take(rows_at), pa.array(groups, pa.int32()), pa.array(lists, pa.binary())],
                names=["query_id", "v", "grp", "lists"],
            )

    kind = distinct.schema["v"].dataType.simpleString()
    probes = staged(queries.mapInArrow(probe, f"query_id long, v {kind}, grp int, lists binary"), "probes")
    asked = {r["grp"]: r["count"] for r in probes.groupBy("grp").count().collect()}  # a row a group
    sizes = spark.createDataFrame([(g, blocks[g], -(-n // BLOCK)) for g, n in sorted(asked.items())], "grp int, vb int, qb int")
    left = probes.join(sizes, "grp").withColumn("vblock", F.explode(F.sequence(F.lit(0), F.col("vb") - 1))).withColumn("qblock", F.pmod(F.xxhash64("query_id"), "qb").cast("int"))
    right = coded.join(cut, "list").join(sizes, "grp").withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))).withColumn("vblock", F.pmod(F.xxhash64("rep"), "vb").cast("int"))

    ranks = [1 << i for i in range(reranked.bit_length()) if 1 << i < reranked] + [reranked]

    def scored(q: pa.Table, c: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For blocks of the queries: the first one's number, their scores of all codes, and the codes' vectors."""
        codes = np.frombuffer(b"".join(c.column("code").to_pylist()), np.uint8).reshape(c.num_rows, -1)
        reps, at = c.column("rep").to_numpy(), c.column("list").to_numpy()
        order = np.lexsort((reps, at))
        codes, reps, at = codes[order], reps[order], at[order]
        x = _matrix(q.column("v").combine_chunks(), dims)
        wanted = np.zeros((len(x), len(held)), bool)
        for k, lists in enumerate(q.column("lists").to_pylist()):
            wanted[k, np.frombuffer(lists, "<i4")] = True
        for a in range(0, len(x), 256):
            s = np.full((min(256, len(x) - a), len(reps)), -np.inf)
            for one in np.unique(at):
                lo, hi = np.searchsorted(at, [one, one + 1])
                asking = np.flatnonzero(wanted[a : a + 256, one])
                if asking.size:
                    s[asking, lo:hi] = index.scores(x[a : a + 256][asking], one, codes[lo:hi])
            yield a, s, reps

    def report(q: pa.Table, c: pa.Table) -> pa.Table:
        ids, points = [], []
        if q.num_rows and c.num_rows:
            all_ids = q.column("query_id").to_pylist()
            for a, s, _ in scored(q, c):
                keep = min(reranked, s.shape[1])
                top = -np.sort(np.partition(-s, keep - 1, 1)[:, :keep], 1)
                for k, row in enumerate(top):
                    ids.append(all_ids[a + k])
                    points.append([{"near": float(row[r - 1]), "step": r - (ranks[i - 1] if i else 0)} for i, r in enumerate(ranks) if r <= keep and row[r - 1] > -np.inf])
        kind = pa.list_(pa.struct([("near", pa.float64()), ("step", pa.int64())]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(points, kind)], names=["query_id", "points"])

    def best_codes(q: pa.Table, c: pa.Table) -> pa.Table:
        out = []
        if q.num_rows and c.num_rows:
            ids, least = q.column("query_id").to_numpy(), q.column("least").to_numpy()
            for a, s, reps in scored(q, c):
                # Sums of the two passes may round apart; equal scores must not fall below their own bound.
                bound = least[a : a + 256] - 1e-9 * np.maximum(np.abs(least[a : a + 256]), np.abs(np.where(s > -np.inf, s, 0)).max(1))
                at, place = np.nonzero(s >= np.maximum(bound, -1e300)[:, None])
                out.append((ids[a : a + 256][at], reps[place], s[at, place]))
        columns = [np.concatenate(z) for z in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(z) for z in columns], names=["query_id", "rep", "near"])

    keys = ["grp", "vblock", "qblock"]
    codes_by = lambda: right.select("rep", "list", "code", *keys).groupBy(*keys)
    points = left.select("query_id", "v", "lists", *keys).groupBy(*keys).cogroup(codes_by()).applyInArrow(report, "query_id long, points array<struct<near:double,step:long>>")
    falling = Window.partitionBy("query_id").orderBy(F.desc("near")).rowsBetween(Window.unboundedPreceding, 0)
    reached = points.select("query_id", F.explode("points").alias("p")).select("query_id", "p.near", "p.step").withColumn("_n", F.sum("step").over(falling))
    least = reached.groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("_n") >= reranked, F.col("near"))), F.lit(-1e300)).alias("least"))
    held_to = left.join(staged(least, "least"), "query_id").select("query_id", "v", "lists", "least", *keys)
    found = held_to.groupBy(*keys).cogroup(codes_by()).applyInArrow(best_codes, "query_id long, rep long, near double")
    best = Window.partitionBy("query_id").orderBy(F.desc("near"), "rep")
    short = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= reranked).select("query_id", "rep")
    # Exact measure on the original vectors, in the order of their components.
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    measured = short.join(queries.select("query_id", F.col("v").alias("q")), "query_id").join(distinct.select("rep", "v"), "rep").select("query_id", "rep", dot.alias("score"))
    # Copies: the smallest other ids of each vector, as many as an answer can hold.
    again = rows.join(distinct.where("n > 1"), "v").where(F.col("vec_id") != F.col("rep")).select("rep", "vec_id").distinct()
    ranked = again.withColumn("_r", F.row_number().over(Window.partitionBy("rep").orderBy("vec_id"))).where(F.col("_r") <= k)
    copies = ranked.groupBy("rep").agg(F.collect_list("vec_id").alias("ids"))
    ids = F.explode(F.concat(F.array("rep"), F.coalesce("ids", F.array().cast("array<long>"))))
    every = measured.join(copies, "rep", "left").select("query_id", ids.alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
