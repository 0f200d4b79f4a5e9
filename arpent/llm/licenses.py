"""License scans: phrase places, and an exact set-similarity join of text blocks with license notices.

A block is a run of ``SPAN`` times as many consecutive words of the text as the notice has (the whole text, if shorter); every
word begins one, and line ends mean nothing. A block meets a notice when it holds at least the notice's ``threshold`` of the
notice's distinct words. The words of the notices are ordered by their frequency over all documents, rarest first; other
words cannot count and are left out. A notice needs ``need`` of its ``n`` words, so a block that meets it has one of the
``n - need + 1`` rarest (the prefix). Each place of a prefix word, with the words around it, is joined with the notices that
have the word in their prefix, by equality. The place stands for the blocks whose rarest word of the notice it is: only words
from it on in the order can count (position), and fewer than ``need`` places of such words around it end the pair (length).
What passes is counted exactly, block by block. The filters lose no block that meets a notice.

A row around a prefix word is bounded by the longest notice, so a long text is many small rows. Notices are a relation of at
most ``MAX_NOTICES`` rows (more are refused), so their index is broadcast. The text is read once, and labels meet their
documents by a digest of the text.

Defined cases: a null text is empty; an empty text has no words, labels or places; repeated rows and equal texts give equal
results; blocks of any text are found, however long it is; a notice without words or label is left out, one without a
threshold takes ``CONTAINMENT``; of the other columns only those named in ``keep`` are carried along.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arpent.plans.staging import staged

#: Words of the lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Share of a notice's distinct words that a block must hold, where the notice does not say.
CONTAINMENT = 0.8
#: A block has this many times the words of the notice, so a notice is found with as many foreign words in between.
SPAN = 2
#: More notices than this are refused: their index goes to every task.
MAX_NOTICES = 10_000
# Sentences of public license notices, each with its threshold. Sentences of a few words, most of which other
# licenses share, ask for all of them.
NOTICES = [
    ("apache-2.0", 1.0, "licensed under the apache license version 2 0"),
    ("bsd", 0.8, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", 0.8, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("cc-by-4.0", 0.8, "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", 1.0, "licensed under cc by nc 4 0"),
    ("gpl-3.0", 0.8, "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", 0.8, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", 0.8, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", 1.0, "released under the mit license"),
    ("mit", 0.8, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 0.8, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mpl-2.0", 0.8, "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

_INDEX = "array<struct<first:string,label:string,rest:array<string>,n:int,need:int,span:int>>"
_HITS = "array<struct<at:int,w:string>>"


def notices_table(spark: SparkSession) -> DataFrame:
    """The public notices as a relation: label, threshold, notice."""
    return spark.createDataFrame(NOTICES, "label string, threshold double, notice string")


def notice_words(notice: str) -> list[str]:
    return re.findall(WORD, notice.translate(str.maketrans(UPPER, LOWER)))


def needed(threshold: float | None, n: int) -> int:
    """How many of ``n`` distinct words a block must hold."""
    return max(1, math.ceil((CONTAINMENT if threshold is None else threshold) * n - 1e-9))


def prefix_index(notices: list[tuple], counts: dict[str, int]) -> list[dict]:
    """A row for each prefix word of each notice: the notice's words from that one on, rarest first, and its numbers."""
    out = []
    for label, threshold, notice in notices:
        words = notice_words(notice)
        order = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        need = needed(threshold, len(order))
        for i in range(len(order) - need + 1):
            out.append({"first": order[i], "label": label, "rest": order[i:], "n": len(order), "need": need, "span": SPAN * len(words)})
    return out


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), notices: DataFrame | None = None) -> DataFrame:
    """Phrase places, labels and the best containment of each document. ``notices`` has label, threshold and notice."""
    spark = docs.sparkSession
    listed = NOTICES if notices is None else [tuple(r) for r in notices.select("label", "threshold", "notice").limit(MAX_NOTICES + 1).collect()]
    if len(listed) > MAX_NOTICES:
        raise ValueError(f"more than {MAX_NOTICES} notices")
    listed = [x for x in listed if x[0] is not None and x[2] is not None and notice_words(x[2])]
    read = staged(_read(docs, text, keep, sorted({w for x in listed for w in notice_words(x[2])})), "licenses")
    found = read.drop("_hits", "_key")
    labels, best = F.array().cast("array<string>"), F.lit(0.0)
    if listed:
        counts = {r["w"]: r["count"] for r in read.select(F.explode("_hits.w").alias("w")).groupBy("w").count().collect()}  # a row a word of the notices
        met = staged(_met(spark, read, prefix_index(listed, counts)), "notices")
        found = read.drop("_hits").join(met, "_key", "left")
        labels, best = F.coalesce("_labels", labels), F.coalesce("_best", best)
    base = F.array_sort(F.array_distinct(F.transform("_places", lambda p: p["label"])))
    at = F.transform("_places", lambda p: p["at"].cast("long"))
    return found.select(
        *[F.col("_kept")[c].alias(c) for c in keep], F.col("_n").alias("n_words"), F.size("_places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, labels))), ",").alias("labels"),
        F.when(F.size("_places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def _read(docs: DataFrame, text: str, keep: tuple[str, ...], vocabulary: list[str]) -> DataFrame:
    """Of each document: its number of words, the places of phrases, the places of the notices' words, a digest of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*keep).alias("_kept"), t.alias("_t"))
    rows = rows.withColumn("_w", F.regexp_extract_all(F.translate("_t", UPPER, LOWER), F.lit(WORD), F.lit(0)))
    places = F.concat(*[_places("_w", p.split(), label) for p, label in PHRASES.items()])
    hits = F.filter(F.transform("_w", lambda w, i: F.struct(i.alias("at"), w.alias("w"))), lambda x: x["w"].isin(vocabulary))
    return rows.select("_kept", F.size("_w").cast("long").alias("_n"), places.alias("_places"), hits.cast(_HITS).alias("_hits"), F.sha2("_t", 256).alias("_key"))


def _places(words: str, phrase: list[str], label: str) -> Column:
    """Where the words of a phrase stand one after another: (start, label)."""

    def starts(w: Column, i: Column) -> Column:
        found = w == phrase[0]
        for k, x in enumerate(phrase[1:], 1):
            found = found & (F.coalesce(F.get(words, i + k), F.lit("")) == x)
        return F.when(found, i)

    at = F.filter(F.transform(words, starts), lambda i: i.isNotNull())
    return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def _met(spark: SparkSession, read: DataFrame, index: list[dict]) -> DataFrame:
    """Labels and best containment of each text that has a block which meets a notice."""
    firsts, widest = sorted({x["first"] for x in index}), max(x["span"] for x in index)

    def around(m: Column) -> Column:
        near = F.slice("_hits", F.greatest(m["k"] + 2 - widest, F.lit(1)), F.lit(2 * widest - 1))
        return F.struct(m["w"].alias("first"), m["at"].alias("at"), F.filter(near, lambda x: F.abs(x["at"] - m["at"]) < widest).alias("near"))

    marks = F.filter(F.transform("_hits", lambda x, k: F.struct(x["w"].alias("w"), x["at"].alias("at"), k.alias("k"))), lambda m: m["w"].isin(firsts))
    rows = read.select("_key", F.explode(F.transform(marks, around)).alias("m")).select("_key", "m.first", "m.at", "m.near")
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(index)), _INDEX)))
    pairs = rows.join(F.broadcast(table), "first")
    held = F.filter("near", lambda x: (F.abs(x["at"] - F.col("at")) < F.col("span")) & F.array_contains("rest", x["w"]))
    pairs = pairs.select("_key", "label", "n", "need", "span", "at", held.alias("held"))
    pairs = pairs.where((F.size("held") >= F.col("need")) & (F.size(F.array_distinct("held.w")) >= F.col("need")))

    def words_from(start: Column) -> Column:
        block = F.filter("held", lambda x: (x["at"] >= start["at"]) & (x["at"] < start["at"] + F.col("span")))
        return F.size(F.array_distinct(F.transform(block, lambda x: x["w"])))

    common = F.array_max(F.transform(F.filter("held", lambda x: x["at"] <= F.col("at")), words_from))
    met = pairs.select("_key", "label", "n", "need", common.alias("common")).where("common >= need")
    return met.groupBy("_key").agg(F.collect_set("label").alias("_labels"), F.max(F.round(F.col("common") / F.col("n"), 6)).alias("_best"))
