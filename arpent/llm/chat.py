"""Chat formatting by perspective rotation: every participant in turn is the assistant.

For each participant of a conversation the dialogue is rendered with that speaker's turns as ``assistant`` and everyone
else's as ``user`` with a name; the mask lists the spans of text that the assistant's turns take, the parts to learn.

A dialogue is rendered whole up to ``piece`` turn numbers, by default 4,096; a longer one is several rows, so that a
conversation with a third of all turns is never one task's string. The pieces join: put together in order of ``block``
they are the whole rendering, ``first_char`` says where a piece starts in it, and masks count from its beginning.

Defined cases: turns come in order of number, then role, then text; turns without number are the last piece; rows that
repeat conversation, number, role and text are said once and counted in ``n_copies``; a null role speaks as ``unknown``
and is no participant; a null text is empty; a null conversation id is a conversation; text that looks like a marker is
broken up; other columns are ignored. Turns that share a number stay in one piece, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from arpent.plans.staging import staged

#: Turn numbers of one piece, and the block of turns without a number, after all others.
PIECE, LAST = 4096, 2**62
#: Fixed markers of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(c: Column) -> Column:
    """Text in which no marker can start."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def _block(turn: Column, piece: int) -> Column:
    return F.coalesce(F.floor(turn.cast("long") / piece), F.lit(LAST)).cast("long")


def said(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """Distinct turns with their block and number of copies."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("block", _block(F.col("turn"), piece))


def _parts(rows: DataFrame) -> DataFrame:
    """Each piece for each participant, its turns as (head, body, own)."""
    # Numbers first, those without at the end of their own block; then role and text settle ties.
    one = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), _plain(F.col("text")).alias("text"),
        F.col("role").isNull().alias("nameless"), F.col("n").alias("n"),
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    people = rows.where(F.col("role").isNotNull()).select(F.col("conv_id").alias("_conv"), F.col("role").alias("participant")).distinct()
    both = blocks.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
    own = lambda t: (t["role"] == F.col("participant")) & ~t["nameless"]
    name = lambda t: F.when(t["nameless"], F.lit("unknown")).otherwise(_plain(F.regexp_replace(t["role"], r"[\r\n]", " ")))
    head = lambda t: F.when(own(t), F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), name(t), F.lit("\n")))
    return both.withColumn("parts", F.transform("turns", lambda t: F.struct(head(t).alias("head"), t["text"].alias("body"), own(t).alias("own"))))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """A row for each (conversation, block, participant): the rendered piece and where it starts in the dialogue, the mask
    as ``start:end`` of code points of the dialogue (end exclusive), and counts."""
    both, tail = _parts(said(turns, conv, turn, role, text, piece)), f"{CLOSE}\n"
    # Where the pieces of a longer dialogue start; the others are not touched.
    extent = turns.groupBy(F.col(conv).alias("_longer")).agg(F.min(_block(F.col(turn), piece)).alias("a"), F.max(_block(F.col(turn), piece)).alias("b"))
    longer = turns.join(extent.where("a < b").select("_longer"), F.col(conv).eqNullSafe(F.col("_longer")), "left_semi")
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.length(p["head"]) + F.length(p["body"]) + len(tail))
    ahead = Window.partitionBy("conv_id", "participant").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = _parts(said(longer, conv, turn, role, text, piece)).select("conv_id", "block", "participant", size.alias("size"))
    starts = staged(starts.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("participant").alias("_p"), F.sum("size").over(ahead).alias("_start")), "starts")
    both = both.join(starts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")) & (F.col("participant") == F.col("_p")), "left")
    both = both.withColumn("first_char", F.coalesce("_start", F.lit(0)).cast("long"))
    start = F.struct(F.col("first_char").alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        a = acc["at"] + F.length(p["head"])
        b = a + F.length(p["body"])
        span = F.array(F.concat_ws(":", a.cast("string"), b.cast("string")))
        return F.struct((b + len(tail)).alias("at"), F.when(p["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    rendered = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    mine = F.filter("parts", lambda p: p["own"])
    return both.select(
        "conv_id", "block", "participant", "first_char", rendered.alias("rendered"), F.aggregate("parts", start, add, lambda acc: F.array_join(acc["spans"], ",")).alias("mask"),
        F.size("parts").cast("long").alias("n_turns"), F.size(mine).cast("long").alias("n_own_turns"),
        F.aggregate(mine, F.lit(0).cast("long"), lambda acc, p: acc + F.length(p["body"])).alias("n_learned_chars"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + t["n"]).alias("n_copies"),
    )
