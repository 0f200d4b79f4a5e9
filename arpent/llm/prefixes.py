"""The prefix trie of conversations, in minimal-perfect-hash node tables.

Turns are ordered within their conversation, and a conversation may take its first turns from another one. A prefix is
known by a digest of 128 bits: the exclusive or of a hash of each of its turns and their places, so that running digests
of a very long conversation are made in pieces. Each distinct digest is a node; where two rows of one digest differ in
depth, last turn or parent, the job stops with an error instead of mixing nodes up.

A node belongs to its smallest member. Whatever a node hands to all its ancestors (being a leaf, tokens saved) lies on the
path of that member. Paths are cut into pieces of ``PIECE`` turns and dealt to shards of about ``SHARD`` rows, similar ones
together; a piece starts with what the later pieces of its path have gathered. A shard enumerates the distinct digests of
its rows, gives each a slot by a minimal perfect hash whose answers are held against the stored digests, scatters counts
into flat arrays and adds them up through the array of parent slots, the deepest first. A node that several shards hold
gets one partial row from each, and these are summed. No conversation, node or shard is held by one task as a whole
unless its size is bounded: ids of a node's ends are joined in runs and digested as a stream.

Defined cases: a null role or text is empty; a null turn comes first; equal turn numbers go by role, then text (its first
64 characters, then its digest); repeated rows are a turn each; rows without a conversation id belong to no conversation
and make no node; a conversation that is left without turns is a member of the root; the remainder of a negative id is
negative, as in SQL; an empty table has no root. Columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arpent.plans.shipping import ship
from arpent.plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
#: A conversation takes its first turns from the one whose id is the next multiple of this below, fewer than ``LENT``.
FAMILY, LENT = 20, 4
#: Turns of one piece of a path, rows of a shard, ids of one run of ends.
PIECE, SHARD, RUN = 4096, 400_000, 512
_AT = (1 << 33) - 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _placed(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns in order: the block that a turn fell into, its place there, a digest and its words. No text from here on.
    Blocks are ranges of (conversation, turn), so a conversation of any size is spread over as many as it needs."""
    who, body = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, body), 256)
    part = lambda k: F.conv(F.substring(digest, k, 15), 16, 10).cast("long")
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), F.left(body, F.lit(64)).alias("head"),
        part(1).alias("t1"), part(16).alias("t2"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"),
    )
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "head", "t1", "t2", "row"))]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "t1", "t2", "words", F.monotonically_increasing_id().alias("at"))
    return staged(dealt.select("conv", "t1", "t2", "words", F.shiftright("at", 33).alias("block"), F.col("at").bitwiseAND(F.lit(_AT)).alias("at")), "turns")


def _spans(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (conversation, block): first place and turns ahead; per conversation: how many turns it takes from another."""
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = turns.groupBy("conv", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    per = per.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).withColumn("own", F.sum("n").over(Window.partitionBy("conv")))
    per = staged(per.drop("n"), "spans")
    convs = per.where("ahead = 0").select("conv", "own", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % LENT).alias("h"))
    bases = convs.where("conv = base").select("base", F.col("own").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    return per, convs.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).drop("there")


def _rebuilt(turns: DataFrame, per: DataFrame, convs: DataFrame) -> DataFrame:
    """The turns of the rebuilt conversations with their depth, and how long the conversation is."""
    where = per.drop("own").join(convs, "conv")
    place = F.col("at") - F.col("first") + F.col("ahead")
    own = turns.join(where, ["conv", "block"]).withColumn("pos", place)
    kept = own.where("pos >= h").withColumn("depth", F.col("pos") + 1 + F.col("taken") - F.col("h"))
    lent = own.where((F.col("conv") == F.col("base")) & (F.col("pos") < LENT - 1)).select("base", "pos", "t1", "t2", "words")
    lent = convs.where("taken > 0").join(lent, "base").where("pos < taken").withColumn("depth", F.col("pos") + 1)
    columns = ["conv", "depth", "len", "t1", "t2", "words"]
    return kept.select(*columns).unionByName(lent.select(*columns))


def _turn_hash(k: int) -> Column:
    """The k-th hash of a turn and its place."""
    return F.xxhash64(F.lit(k), "depth", "t1", "t2") if k == 1 else F.xxhash64("t2", F.lit(k), "t1", "depth")


def _paths(rows: DataFrame, length: int) -> DataFrame:
    """Each turn of each path with the digests of the prefix that it ends (k1, k2) and of the one before (p1, p2)."""
    piece = F.expr(f"(depth - 1) div {length}")
    local = Window.partitionBy("conv", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("piece", piece)
    rows = rows.select("*", *[F.bit_xor(_turn_hash(k)).over(local).alias(f"l{k}") for k in (1, 2)], F.first(_turn_hash(1)).over(local).alias("head"))
    rows = staged(rows, "paths")
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    full = rows.where((F.col("depth") % length == 0) & (F.col("len") > F.col("depth")))
    carry = full.select("conv", (F.col("piece") + 1).alias("piece"), *[F.bit_xor(f"l{k}").over(before).alias(f"c{k}") for k in (1, 2)])
    rows = rows.join(carry, ["conv", "piece"], "left")
    for k in (1, 2):
        rows = rows.withColumn(f"k{k}", F.col(f"l{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0)))).withColumn(f"p{k}", F.col(f"k{k}").bitwiseXOR(_turn_hash(k)))
    return rows.drop("l1", "l2", "c1", "c2")


def _nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: its smallest member, members, ends, parent and what it adds to all above it."""
    same = ["depth", "t1", "t2", "p1", "p2"]
    found = paths.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.sum((F.col("depth") == F.col("len")).cast("long")).alias("ends"), F.max("words").alias("words"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same],
    )
    agree = F.lit(True)
    for c in same:
        agree = agree & (F.col(c) == F.col(f"{c}_"))
    found = found.where(F.when(agree, True).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("boolean")))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.sum((F.col("len") == 0).cast("long")).alias("ends")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "n_convs", "conv_id", "ends", F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("depth"),
                       F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = found.select(*root.columns).unionByName(root)
    return nodes.select(*root.columns, (F.col("n_convs") == F.col("ends")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saves"))


class NodeTable:
    """Slots 0 to n - 1 for n distinct digests, by a minimal perfect hash in levels: on each level the digests that are
    alone in their place of a bit array take it, the others go on. A slot is a bit's rank; it stores its digest."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        order = np.lexsort((k2, k1))
        a, b = k1[order], k2[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.k1, self.k2 = np.empty_like(a), np.empty_like(b)
        given = 0
        while len(a):
            size = 2 * len(a) + 1
            at = self._place(a, b, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            slots = given + np.cumsum(alone) - 1
            self.levels.append((alone, slots))
            mine = alone[at]
            self.k1[slots[at[mine]]], self.k2[slots[at[mine]]] = a[mine], b[mine]
            given += int(alone.sum())
            a, b = a[~mine], b[~mine]

    def __len__(self) -> int:
        return len(self.k1)

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64((level + 1) * int(_MIX[1]) % (1 << 64))
        x = a.view(np.uint64) * _MIX[0] ^ (b.view(np.uint64) + step)
        x = (x ^ (x >> np.uint64(31))) * _MIX[2]
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for one that is not in the table."""
        out = np.full(len(k1), -1)
        left = np.arange(len(k1))
        for level, (alone, slots) in enumerate(self.levels):
            at = self._place(k1[left], k2[left], level, len(alone))
            hit = alone[at]
            out[left[hit]] = slots[at[hit]]
            left = left[~hit]
        found = out >= 0
        found[found] = (self.k1[out[found]] == k1[found]) & (self.k2[out[found]] == k2[found])
        return np.where(found, out, -1)


def accumulated(length: int, k1, k2, p1, p2, depth, leaf, saves, owned) -> tuple[NodeTable, np.ndarray, np.ndarray, np.ndarray]:
    """Leaves, saved tokens and children of the nodes of one shard, as far as its rows hold them; pieces have ``length`` turns."""
    nodes = NodeTable(np.concatenate([k1, p1]), np.concatenate([k2, p2]))
    slot, above = nodes.slots(k1, k2), nodes.slots(p1, p2)
    if len(slot) and min(slot.min(), above.min()) < 0:
        raise ValueError("a digest has no slot")
    leaves, saved, children = (np.zeros(len(nodes), np.int64) for _ in range(3))
    np.add.at(leaves, slot, leaf)
    np.add.at(saved, slot, saves)
    np.add.at(children, above[owned], 1)
    deep, parent = np.zeros(len(nodes), np.int64), np.full(len(nodes), -1)
    inner = (depth == 1) | ((depth - 1) % length != 0)  # a piece hands nothing up: the piece above it has its sum already
    deep[slot] = depth
    parent[slot[inner]] = above[inner]
    order = np.argsort(-deep, kind="stable")
    cuts = np.flatnonzero(np.diff(deep[order])) + 1
    for group in np.split(order, cuts):
        group = group[parent[group] >= 0]
        np.add.at(leaves, parent[group], leaves[group])
        np.add.at(saved, parent[group], saved[group])
    return nodes, leaves, saved, children


def _sums(paths: DataFrame, nodes: DataFrame, length: int) -> DataFrame:
    """Leaves, saved tokens and children of each node: partial sums of the shards, added up."""
    mine = nodes.where("depth > 0").select("k1", "k2", F.col("conv_id").alias("conv"), "leaf", "saves")
    rows = paths.join(mine, ["k1", "k2", "conv"], "left")
    rows = staged(rows.select("conv", "depth", "len", "piece", "head", "k1", "k2", "p1", "p2", "leaf", "saves"), "owned")
    later = Window.partitionBy("conv").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.where(F.col("len") > length).groupBy("conv", "piece").agg(F.sum("leaf").alias("leaf"), F.sum("saves").alias("saves"))
    carry = sums.select("conv", "piece", *[F.sum(c).over(later).alias(f"later_{c}") for c in ("leaf", "saves")])
    last = (F.col("depth") % length == 0) | (F.col("depth") == F.col("len"))
    rows = rows.join(carry, ["conv", "piece"], "left")
    brought = lambda c: F.coalesce(c, F.lit(0)) + F.when(last, F.coalesce(f"later_{c}", F.lit(0))).otherwise(0)
    rows = rows.select("head", "conv", "piece", "k1", "k2", "p1", "p2", "depth", brought("leaf").alias("leaf"), brought("saves").alias("saves"), F.col("leaf").isNotNull().alias("owned"))
    shards = max(1, -(-paths.count() // SHARD))
    ship(paths.sparkSession)
    names = ["k1", "k2", "p1", "p2", "depth", "leaf", "saves", "owned"]

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        columns = [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in names]
        nodes, leaves, saved, children = accumulated(length, *columns)
        some = np.flatnonzero(leaves | saved | children)
        for a in range(0, len(some), 50_000):
            s = some[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(x[s]) for x in (nodes.k1, nodes.k2, leaves, saved, children)], names=["k1", "k2", "leaves", "saved", "children"])

    partial = rows.repartitionByRange(shards, "head", "conv", "piece").select(*names).mapInArrow(shard, "k1 long, k2 long, leaves long, saved long, children long")
    return partial.groupBy("k1", "k2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("children").alias("n_children"))


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """The digest of the ids that end at a node. Ids are sorted over all nodes, joined in runs, and each node's runs are
    digested one after the other."""
    root = convs.where("len = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv")
    ends = paths.where("depth = len").select("k1", "k2", "conv").unionByName(root)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, conv = (b.column(c).to_numpy() for c in ("k1", "k2", "conv"))
            if not len(k1):
                continue
            new = np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
            start = np.flatnonzero(new)
            inside = np.arange(len(k1)) - np.repeat(start, np.diff(np.r_[start, len(k1)]))
            cut = np.flatnonzero(inside % RUN == 0)
            ids = conv.tolist()
            text = [",".join(map(str, ids[a:z])) for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)])]
            yield pa.RecordBatch.from_arrays([pa.array(k1[cut]), pa.array(k2[cut]), pa.array(conv[cut]), pa.array(text, pa.string())], names=["k1", "k2", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            out = []
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == now:
                    h.update(b",")
                else:
                    if h:
                        out.append((*now, h.hexdigest()))
                    now, h = (k1, k2), hashlib.sha256()
                h.update(ids.encode())
            if out:
                yield _table(out)
        if h:
            yield _table([(*now, h.hexdigest())])

    joined = ends.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv").mapInArrow(runs, "k1 long, k2 long, first long, ids string")
    joined = joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
    return joined.mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def _table(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    k1, k2, digest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digest, pa.string())], names=["k1", "k2", "ends_sha256"])


def trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """One row a node of the prefix trie of the rebuilt conversations. ``piece`` is the number of turns of a piece of a path."""
    turns = _placed(conversations, conv_id, turn, role, text)
    per, convs = _spans(turns)
    convs = staged(convs, "convs")
    paths = staged(_paths(_rebuilt(turns, per, convs), piece), "prefixes")
    nodes = staged(_nodes(paths, convs), "nodes")
    sums, ends = _sums(paths, nodes, piece), _ends(paths, convs)
    rows = nodes.join(sums, ["k1", "k2"], "left").join(ends, ["k1", "k2"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    lone = (F.col("depth") == 0) & (F.col("leaf") == 1)  # a root without children is on no path
    rows = rows.select(
        "conv_id", "depth", "p1", "p2", "n_convs", zero("n_children").alias("n_children"), F.when(lone, F.lit(1).cast("long")).otherwise(zero("n_leaves")).alias("n_leaves"),
        zero("saved_tokens").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = rows.join(parents, ["p1", "p2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
