"""Language identification against a classifier of plain loops, row by row, and ties."""

import zlib
from collections import Counter

import numpy as np
import pytest

from arpent.llm import language

SF = "/root/testdata/sf0.001"


def bundle(text, letters):
    """The sum of the vectors of a text's trigrams, letter by letter."""
    plain = ""
    for c in f" {(text or '').lower()} ":
        c = c if c.isalpha() else " "
        if c != " " or not plain.endswith(" "):
            plain += c
    out = np.zeros(language.DIMENSIONS)
    for (a, b, c), n in Counter(zip(plain, plain[1:], plain[2:])).items():
        for x in (a, b, c):
            if x not in letters:
                letters[x] = np.random.default_rng([language.SEED, ord(x)]).choice([-1, 1], language.DIMENSIONS).astype(float)
        out += n * np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return out


def plain_predictions(rows):
    letters, sums = {}, {}
    made = [bundle(t, letters) for _, t, _ in rows]
    outside = [doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0 for doc_id, _, _ in rows]
    for v, (_, text, lang), out in zip(made, rows, outside):
        if not out and lang is not None and text is not None and np.any(v):
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    known = {k: v / np.linalg.norm(v) for k, v in sorted(sums.items())}
    return [({k: float(v @ p) / np.linalg.norm(v) for k, p in known.items()} if np.any(v) else None, out) for v, out in zip(made, outside)]


def test_predictions_equal_plain_loops(spark):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(9001, None, "en"), (9002, "", "en"), (9003, "123 !?", "en"), (None, "no id but some words", "en"), (9004, "Ünïcode straße ÉCOLE", None), (9005, "the cat", None), (9005, "the cat", None)]
    df = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], "doc_id long, text string, lang string, id int, held_out string")
    got = language.identify(df.coalesce(1)).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text, _), (cosines, out) in zip(got, rows, plain_predictions(rows)):
        assert (r["doc_id"], r["held_out"]) == (doc_id, out)
        if cosines is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            best = max(cosines.values())
            assert cosines[r["lang_pred"]] >= best - 1e-5 and r["score"] == pytest.approx(min(max(best, 0), 1), abs=1e-4), text


def test_ties_go_to_the_smaller_code(spark):
    ids = [k for k in range(50) if zlib.crc32(str(k).encode()) % 5]
    rows = [(k, "the same words in both", "bb" if at % 2 else "aa") for at, k in enumerate(ids[:20])]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in got} == {"aa"}
