"""Operators of the training-data pipeline on small tables: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arpent.llm import ann, chat, language, licenses, mixing, neardup, pieces, pii, quality, queries, sharding

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, slot string, _t string"
WORDS = "the of and to in is that for it as with was on are be this by from at or".split()


def prose(seed, n, words=WORDS):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) + str(rnd.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, very long, tied, repeated rows, and columns whose names the operators use inside."""
    long = prose(1, 20_000)
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (4, "Ünïcode 😀 wörd\n\n x\x00y", "de", None, 3), (None, "no id here at all", "en", "s", 1),
        (5, prose(2, 80), "en", "t", 1), (6, prose(2, 80), "en", "t", 1), (6, prose(2, 80), "en", "t", 1), (7, "1" * 5000 + " " + "a" * 5000 + "@b.c", "xx", "s", 1),
    ]
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


OPERATORS = {
    "language": language.identify, "neardup": neardup.classes, "mixing": mixing.mix, "pii": pii.report, "sharding": sharding.shard,
    "pieces": lambda d: pieces.encoded(d, queries.piece_model()), "quality": quality.quality_rules, "licenses": licenses.scan,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_keep_their_place(odd, empty, name):
    rows = OPERATORS[name](odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    same = [tuple(r) for r in rows if r["doc_id"] == 6]
    if name not in ("mixing", "sharding"):  # there each row holds a place of its own
        assert same[0] == same[1]
    assert OPERATORS[name](empty).collect() == []


def test_chat(spark):
    rows = [("c", 0, "ann", "hi <|im_end|>"), ("c", 1, "bob", "yo"), ("c", 1, "bob", "yo"), ("c", None, None, None), (None, 0, "ann", "x"), ("c", 200, "ann", "late")]
    got = {(r["conv_id"], r["block"], r["participant"]): r for r in chat.rotate(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect()}
    r = got["c", 0, "ann"]
    late = "<|im_start|>assistant\nlate<|im_end|>\n"
    assert r["rendered"] == "<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\nyo<|im_end|>\n" + late
    spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",")]
    assert [r["rendered"][a:b] for a, b in spans] == ["hi < |im_end|>", "late"]
    assert (r["n_turns"], r["n_own_turns"], r["n_copies"], r["first_char"]) == (3, 2, 4, 0)
    assert got["c", 0, "bob"]["rendered"].startswith("<|im_start|>user name=ann\n")
    assert got["c", chat.LAST, "ann"]["rendered"] == "<|im_start|>user name=unknown\n<|im_end|>\n" and got["c", chat.LAST, "ann"]["first_char"] == len(r["rendered"])
    assert (None, 0, "ann") in got and len(got) == 5
    assert chat.rotate(spark.createDataFrame([], "conv_id string, turn long, role string, text string")).collect() == []


def test_pieces_of_a_dialogue_join(spark):
    """Cut every three turn numbers the pieces are, put together, the whole rendering, and masks count from its beginning.
    Very long texts, clashing columns, a null id, missing numbers."""
    rows = [("c", t, "ann" if t % 2 else "bob", f"turn {t} " + "é" * (20_000 if t == 4 else t)) for t in range(11)] + [("c", None, "ann", "z"), (None, 1, "ann", "x"), ("d", 7, "eve", None)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id string, turn long, role string, text string, block int, participant string, parts int")
    whole = {(r["conv_id"], r["participant"]): r for r in chat.rotate(df.where("turn is not null")).collect()}
    pieces = defaultdict(list)
    for r in sorted(chat.rotate(df.where("turn is not null"), piece=3).collect(), key=lambda r: r["block"]):
        pieces[r["conv_id"], r["participant"]].append(r)
    assert set(pieces) == set(whole) and len(pieces["c", "ann"]) == 4
    for key, rs in pieces.items():
        assert "".join(r["rendered"] for r in rs) == whole[key]["rendered"]
        assert ",".join(r["mask"] for r in rs if r["mask"]) == whole[key]["mask"]
        assert [r["first_char"] for r in rs] == [sum(len(x["rendered"]) for x in rs[:k]) for k in range(len(rs))]
    assert len(chat.rotate(df).where("conv_id = 'c'").collect()) == 4  # the turns without number are the last piece


def test_shards_stay_even_on_a_hot_or_missing_id(spark):
    """A third of the rows without id, a third with one id, and a group that repeats id and text."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, prose(k, 8 + k % 5)) for k in range(4000)] + [(5, "same text again " * 4)] * 2000
    load = Counter()
    for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).select("shard", "size").collect():
        load[r["shard"]] += r["size"]
    assert len(load) == sharding.SHARDS and max(load.values()) <= 1.05 * sum(load.values()) / sharding.SHARDS


def test_mix_spreads_rows_without_id(spark):
    rows = [(None, prose(k, 5 + k % 7), "s") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixing.sized(df).select("_block").distinct().count() > 400
    once = lambda d: sorted((r["size"], r["taken"], r["position"] or 0) for r in mixing.mix(d).collect())
    assert once(df.repartition(7)) == once(df.coalesce(1))


def test_an_id_stands_for_one_vector(spark):
    """Ids that carry several vectors: the least one counts, for queries and candidates, however the rows are dealt out;
    equal scores at the cut go to the smaller id; columns with clashing names are ignored."""
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=16).round(3).tolist()) for k in range(300)] + [(k, rng.normal(size=16).round(3).tolist()) for k in (20, 41, 40, 40)]
    rows += [(1000 + k, rows[60][1]) for k in range(40)]
    df = spark.createDataFrame([(k, v, 1, "x", 2.0) for k, v in rows], "vec_id long, embedding array<double>, list int, code string, near double")
    found = [sorted(map(tuple, ann.search(df.repartition(n)).collect())) for n in (1, 3)]
    assert found[0] == found[1] and len({(r[0], r[2]) for r in found[0]}) == len(found[0])
    least = {}
    for k, v in rows:
        least[k] = min(least.get(k, v), v)
    for q, _, c, score in found[0]:
        assert score == pytest.approx(float(np.dot(least[q], least[c])), rel=1e-12)
    assert [c for q, _, c, _ in found[0] if q == 60] == sorted(1000 + k for k in range(40))[:20] or least[60] != rows[60][1]


def test_language_held_out(docs):
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_bundles_are_sums_of_bound_letters():
    space = language.Space(64)
    one = space.bundles(["ab"])[0]
    blank, a, b = (space.letter(ord(c)).astype(int) for c in " ab")
    bound = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    assert (one == bound(blank, a, b) + bound(a, b, blank)).all()


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_a_long_pair_at_the_threshold_stays_in_its_band():
    """20,000 words with exactly as many edits as the threshold allows, and with one more."""
    a = np.random.default_rng(1).integers(0, 2000, 20_000).astype(np.uint32)
    at = np.random.default_rng(2).choice(20_000, 4_001, replace=False)
    b, c = a.copy(), a.copy()
    b[at[:4_000]] = c[at] = 9_999
    assert neardup.similar(a, b) and not neardup.similar(a, c)
    assert neardup.edits_within(a, np.delete(a, at[:4_000]), 4_000) and not neardup.edits_within(a, np.delete(a, at), 4_000)


def test_banded_alignment_is_exact():
    rnd = random.Random(5)
    for _ in range(400):
        a = [rnd.randrange(4) for _ in range(rnd.randint(0, 14))]
        b = [x for x in a if rnd.random() > 0.15] + [rnd.randrange(4) for _ in range(rnd.randint(0, 3))]
        d = levenshtein(a, b)
        for limit in range(8):
            assert neardup.edits_within(np.array(a, np.uint32), np.array(b, np.uint32), limit) == (d <= limit)


def classes_of_all_pairs(rows):
    """The smallest id of each row's class, by comparing all pairs."""
    cut = lambda t: neardup.words(np.frombuffer(t.lower().encode(), np.uint8), np.array([0, len(t.lower().encode())]))[0]
    words = [(cut(r["text"] or "") >> np.uint64(32)).astype(np.uint32) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if neardup.similar(words[i], words[j]) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), r["doc_id"]), r["doc_id"])
    return {r["doc_id"]: least[find(k)] for k, r in enumerate(rows)}


def test_near_duplicates_against_all_pairs(docs):
    expected = classes_of_all_pairs(docs.select("doc_id", "text").collect())
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert got == expected
    assert len(set(got.values())) < len(got)


def test_near_duplicates_in_a_large_group(spark):
    """Hundreds of copies of one text, each with its own edits, are one class; a shared passage alone links nothing."""
    base, passage = prose(7, 120).split(), prose(8, 60)
    rnd = random.Random(9)
    rows = []
    for k in range(300):
        w = list(base)
        for _ in range(5):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, f"{prose(100 + k, 60)} {passage} {prose(500 + k, 60)}") for k in range(60)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[k] for k in range(300)} == {0}
    assert all(got[1000 + k] == 1000 + k for k in range(60))


def test_near_duplicates_within_a_bucket_of_other_texts(spark):
    """Pairs whose common k-mers all lie in a passage that many other texts share."""
    passage, rows = prose(8, 60), []
    for k in range(60):
        own = prose(2000 + k, 40).split()
        rows.append((k, f"{passage} {' '.join(own)}"))
        if k < 30:
            rows.append((100 + k, f"{passage} {' '.join(f'edit{k}x{i}' if i % 3 == 1 else w for i, w in enumerate(own))}"))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 100 for i, _ in rows}


def test_near_duplicates_of_rows_that_share_an_id(spark):
    """Texts are told apart by their hash, so the result does not depend on the partitions."""
    a, b = prose(21, 80), prose(22, 80)
    rows = [(5, a), (5, b), (7, a + " x"), (9, b + " y"), (None, a), (None, "one two"), (None, "one two"), (3, None), (4, ""), (8, "!!"), (6, "!!"), (5, a)]
    expected = sorted([(5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (-1, 5, False), (-1, -1, True), (-1, -1, True), (3, 3, True), (4, 4, True), (8, 6, False), (6, 6, True)])
    for n in (1, 2, 4):
        got = neardup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        ids = sorted((-1 if r["doc_id"] is None else r["doc_id"], -1 if r["class_id"] is None else r["class_id"], r["kept"]) for r in got)
        assert ids == expected
        assert len({r["class_key"] for r in got if r["doc_id"] == 5}) == 2


def test_lone_pairs_at_the_threshold_meet():
    rnd = random.Random(12)
    for n, sim, least in ((100, 0.8, 0.98), (400, 0.8, 0.98), (100, 0.85, 0.99), (20, 0.85, 0.98), (20, 0.8, 0.98), (10, 0.8, 0.95)):
        flat, borders = [], [0]
        for _ in range(200):
            a = [rnd.getrandbits(63) for _ in range(n)]
            b = list(a)
            for i in rnd.sample(range(n), int((1 - sim) * n + 1e-9)):
                b[i] = rnd.getrandbits(63)
            for t in (a, b):
                flat += t
                borders.append(len(flat))
        keys = neardup.bucket_keys(np.array(flat, np.uint64), np.array(borders))
        assert np.mean([(a == b).any() for a, b in zip(keys[0::2], keys[1::2])]) >= least


def test_signatures_rule_out_no_match():
    rnd = random.Random(6)
    for _ in range(300):
        n = rnd.choice([1, 2, 5, 10, 63, 64, 65, 200])
        a = [rnd.randrange(50) for _ in range(n)]
        b = [x if rnd.random() > 0.15 else rnd.randrange(50) for x in a if rnd.random() > 0.05] or [1]
        hashes = np.array(a + b, np.uint64) << np.uint64(32)
        one, two = neardup.signatures(hashes, np.array([0, len(a), len(a) + len(b)]))
        met = list(neardup.possible([(0, 0, len(a), one)], [(1, 1, len(b), two)]))
        assert met == list(neardup.possible([(0, 0, len(a), one)], [(1, 1, len(b), two)], True))
        if neardup.similar(np.array(a, np.uint32), np.array(b, np.uint32)):
            assert met == [(0, 0)]


def test_mixing_reaches_targets(docs):
    rows = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r, s in zip(rows, rows):
        by[s["source_size"], s["target"]].append(r)
    for (size, target), own in by.items():
        assert target <= 3 * size + 1e-6
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
        assert all(r["position"] is None or 0 <= r["position"] <= 1 for r in own)
    assert sum({(r["source_size"], r["target"]): r["target"] for r in rows}.values()) <= sum(r["size"] for r in rows) + 1
    assert abs(sum(r["taken"] for r in rows) - sum(r["size"] for r in rows)) <= 20 + 0.02 * sum(r["size"] for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_due_times_invert_the_integral(spark):
    schedule = ((0.0, 4.0), (0.5, 3.0), (1.0, 2.0))
    shares = [0.0, 0.1, 0.5, 0.583, 0.9, 1.0]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.when_due(F.col("s"), schedule)).collect()]

    def area(t):
        total = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            total += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return total / mixing.integral(schedule)

    assert [area(t) for t in got] == pytest.approx(shares)


def test_nearest_neighbours(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(600, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[40].tolist()) for i in range(50)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] + [0.0] * 15), (2004, [1.0] * 3), (2005, []), (None, [1.0] * 16), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ids = np.array([*range(600), *range(1000, 1050)])
    all_x = np.concatenate([x, np.repeat(x[40:41], 50, 0)]).astype(np.float64)
    hits = 0
    queries_ = [i for i in ids.tolist() if i % 20 == 0]
    for q in queries_:
        s = all_x @ all_x[ids.tolist().index(q)]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert all(abs(sc - s[ids.tolist().index(v)]) < 1e-9 for _, v, sc in got[q])
        hits += len({v for _, v, _ in got[q]} & set(ids[order].tolist()))
    assert set(got) == set(queries_)
    assert hits >= 0.9 * 20 * len(queries_)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["score"]) for r in ann.search(few).orderBy("rank").collect()] == [(2, 1.0), (1, 0.5)]
    assert ann.search(few.limit(0)).collect() == []


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def test_personal_data_base_spans(spark):
    rnd = random.Random(1)
    texts = ["a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004", "4111 1111 1111 1111-4111111111111111 5--4", "+1 (743) 555-3824. +12 +1234567890123456", "😀é a.b+c@d-e.f.g 😀 12.34.56.78é"]
    texts += ["".join(rnd.choice("ab1 23.@+-()_%\n9") for _ in range(rnd.randint(1, 80))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(df).collect():
        spans = [(k, m) for k, rx in BASE.items() for m in re.finditer(rx, texts[r["doc_id"]]) if base_ok(k, m[0])]
        listed = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)
        assert [r[f"n_{k}"] for k in BASE] == [sum(x == k for x, _ in spans) for k in BASE]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["spans"].startswith(listed)


def test_personal_data_added_spans_and_redaction(spark):
    key = 'token = "{}"'
    rnd = random.Random(2)
    rows = [(i, f"some text {key.format(''.join(rnd.choice('0123456789abcdef') for _ in range(40)))} end") for i in range(30)]
    rows += [(100 + i, f"plain words and {'longwordwithoutanydigits' * 1} more") for i in range(30)] + [(200, "mail me: a@b.co now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii.classified(pii.found_spans(df, keep=("doc_id", "text")))
    got = {r["doc_id"]: r["t"] for r in spans.withColumn("all", F.concat("base", "added")).select("doc_id", pii.redacted("text", "all").alias("t")).collect()}
    assert all(got[i] == 'some text token = "[SECRET]" end' for i in range(30))
    assert all(got[100 + i] == rows[30 + i][1] for i in range(30))
    assert got[200] == "mail me: [EMAIL] now"


def test_personal_data_precision_and_recall_on_planted_spans(spark):
    """Planted spans of every further kind are found, look-alikes are not, and no labeler learns the wrong sign."""
    rnd = random.Random(8)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    rows, want = [], {}
    for k in range(400):
        kind = ("secret", "email_like", "phone_like", "card", "email", "none_word", "none_id", "none_at")[k % 8]
        span = {
            "secret": f"sk-{hexes(32)}", "email_like": f"ann{k} [at] host{k} [dot] com", "phone_like": f"(4{digits(2)}) 555-{digits(4)}", "card": f"4{digits(14)}", "email": f"bob{k}@host{k}.org",
            "none_word": "averyveryverylongplainwordindeed", "none_id": f"{digits(9)}", "none_at": f"meet at {k}",
        }[kind]
        if kind == "card":  # the digit that makes the Luhn sum right
            total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(span))
            span += str(-total % 10)
        before = {"secret": "api key = ", "email_like": "write to ", "phone_like": "call ", "card": "my visa card ", "email": "mail "}.get(kind, "see ")
        text = f"{prose(k, 12)} {before}{span} {prose(k + 1, 8)}"
        rows.append((k, text))
        at = text.index(span)
        want[k] = set() if kind.startswith("none") else {f"{kind}:{at}:{at + len(span)}"}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: set(r["spans"].split(",")) - {""} for r in pii.report(df).collect()}
    hits = sum(len(got[k] & want[k]) for k in want)
    assert hits / sum(map(len, want.values())) >= 0.95 and hits / max(1, sum(map(len, got.values()))) >= 0.95
    counts = [r.asDict() for r in pii.vote_counts(pii.found_spans(df)).collect()]
    _, table = pii.reliabilities(counts)
    assert all(table[k, v, 1][1] >= table[k, v, 0][1] for k in {r["kind"] for r in counts} for v in pii.LABELERS)


def test_personal_data_in_a_text_of_many_matches(spark):
    """Positions hold beyond one piece of matches, and base spans keep overlapping candidates out."""
    rnd, text, want = random.Random(3), "", []
    for k in range(1500):
        text += prose(k, 2) + " "
        if k % 3 == 0:
            want.append(("email", len(text), len(text) + len(f"u{k}@h.org")))
            text += f"u{k}@h.org "
        elif k % 3 == 1:
            span = "(415) 555-" + "".join(rnd.choice("0123456789") for _ in range(4))
            want.append(("phone_like", len(text), len(text) + len(span)))
            text += f"{span} "
        else:
            token = "k" + "a1B2c3D4" * 4
            text += f"{token}@x.org "
            want.append(("email", len(text) - len(token) - 7, len(text) - 1))
    r = pii.found_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert sorted((s["kind"], s["start"], s["end"]) for s in r["base"] + r["more"]) == sorted(want)


def test_redaction_covers_overlapping_spans_and_long_secrets(spark):
    token = "eyJ" + "a1B2c3D4" * 40
    rows = [(1, "pay 4111 1111 1111 1111@x.com now"), (2, f'auth token = "{token}" end')]
    df = pii.found_spans(spark.createDataFrame(rows, "doc_id long, text string"), keep=("doc_id", "text"))
    got = {r["doc_id"]: r for r in df.select("doc_id", pii.redacted("text", "base").alias("t"), F.expr("transform(more, m -> struct(m.kind, m.start, m.end))").alias("more")).collect()}
    assert got[1]["t"] == "pay [CARD] now"
    at = rows[1][1].index(token)
    assert ("secret", at, at + len(token)) in [tuple(m) for m in got[2]["more"]]


def test_shards_hold_the_law(docs):
    rows = sharding.shard(docs).collect()
    load, places = Counter(), defaultdict(list)
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) <= 1.1 * sum(load.values()) / sharding.SHARDS


def test_rebalancing_only_moves_what_it_must():
    rnd = random.Random(4)
    sizes = {k: rnd.randint(1, 1000) for k in range(sharding.SLOTS)}
    before = sharding.first_map()
    after = sharding.rebalanced(before, sizes)
    load = Counter()
    for slot, shard in enumerate(after):
        load[shard] += sizes[slot]
    assert max(load.values()) - min(load.values()) <= 0.001 * sum(load.values()) / sharding.SHARDS + 1
    assert sum(a != b for a, b in zip(before, after)) < sharding.SLOTS / 10
    assert sharding.rebalanced(after, sizes) == after


def test_shard_map_is_read_back_and_edited(spark, docs, tmp_path):
    """A second run starts from the stored map: slots that need not move stay, and only changes are a new version."""
    at = str(tmp_path / "map")
    first = {r["doc_id"]: (r["vslot"], r["shard"], r["map_version"]) for r in sharding.shard(docs, map_path=at).collect()}
    version, slots = sharding.load_map(spark, at)
    assert version == 1 and len(slots) == sharding.SLOTS
    assert all(slots[v] == s and n == 1 for v, s, n in first.values())
    again = {r["doc_id"]: (r["vslot"], r["shard"], r["map_version"]) for r in sharding.shard(docs, map_path=at).collect()}
    assert again == first and sharding.load_map(spark, at) == (1, slots)
    more = docs.unionByName(docs.limit(10).withColumn("doc_id", F.col("doc_id") + 100_000))
    loads = defaultdict(int)
    for r in sharding.shard(more, map_path=at).collect():
        loads[r["shard"]] += r["size"]
        assert r["map_version"] == 2
    version, edited = sharding.load_map(spark, at)
    assert version == 2 and 0 < sum(a != b for a, b in zip(slots, edited)) < sharding.SLOTS / 10
    assert set(sharding.rebalanced([30] * sharding.SLOTS, {k: 1 for k in range(sharding.SLOTS)})) == set(range(sharding.SHARDS))


def test_pieces_match_the_library():
    import sentencepiece

    m = pieces.Model(queries.piece_model())
    lib = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    rnd = random.Random(3)
    texts = ["", " ", "  a b  ", "▁x ▁▁y", "a\x00b\n\n\t", "😀é́ሴ", "<s> </s> <unk> <0x41>", " " * 1000, "a" * 3000, "ab" * 700 + " " + "é😀" * 500]
    texts += ["".join(rnd.choice(x) for _ in range(n)) for x in ("a", "aA", "=-", "0123456789", "etaoinshrdlu", "一二三四五六七") for n in (2, 9, 60, 401, 2500)]
    texts += ["".join(rnd.choice("ab eE.\nth é😀\t▁12<0x>") for _ in range(rnd.randint(0, 60))) for _ in range(500)] + [prose(k, 50) for k in range(50)]
    want = lib.encode(texts, add_bos=True, add_eos=True)
    got = m.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert [m.decode(x) for x in got] == lib.decode(want)
    for _ in range(500):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000), 1, 2]) for _ in range(rnd.randint(0, 8))]
        assert m.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids)


def test_quality_counts(docs):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in quality.quality_rules(docs).collect():
        t = text[r["doc_id"]]
        w = words.findall(t)
        n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert not (r["kept"] and r["base_failed"])


def plain_distance(p, q):
    share = lambda c: [x / sum(c) for x in c]
    part = lambda x, y: x * np.log2(2 * x / (x + y)) if x else 0.0
    return max(sum(part(x, y) + part(y, x) for x, y in zip(share(p), share(q))) / 2, 0) ** 0.5


def test_quality_references_leave_the_document_out(spark):
    """Distances to the other documents of the language by plain sums; none where a language has too few others."""
    rows = [(k, prose(k, 90), "en") for k in range(quality.MIN_OTHERS + 1)] + [(100, "#" * 90 + " 12345 " * 60, "en")]
    rows += [(200 + k, prose(k, 90) if k else "%&" * 200, "de") for k in range(quality.MIN_OTHERS)] + [(300, prose(1, 90), "fr"), (301, prose(2, 90), None), (400, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs).collect()}
    hist = {r["doc_id"]: r for r in quality.measures(docs).collect()}
    english = [k for k, _, lang in rows if lang == "en"]
    for k in english[:-1]:
        for column, name in (("char_hist", "char_distance"), ("word_hist", "word_distance")):
            others = np.sum([hist[j][column] for j in english if j != k], axis=0).tolist()
            assert abs(got[k][name] - plain_distance(hist[k][column], others)) < 2e-6
    assert not got[100]["kept"] and got[100]["char_distance"] > quality.MAX_CHAR_DISTANCE and not got[400]["kept"]
    for k in list(range(200, 200 + quality.MIN_OTHERS)) + [300, 301]:
        assert got[k]["char_distance"] is None and got[k]["word_distance"] is None and got[k]["kept"] != got[k]["base_failed"]


def test_license_blocks(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    rows = [(1, f"x MIT LICENSE y\n{notice}\nmit\nlicense"), (2, "the software is free to any person"), (3, "released under MIT License"), (4, None)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"], got[1]["labels"]) == (2, 1, 23, "mit", "mit")
    assert (got[2]["labels"], got[2]["score"]) == ("", 0.0)
    assert (got[3]["labels"], got[3]["score"], got[4]["n_words"]) == ("mit", 1.0, 0)


def test_short_notices_must_be_held_whole(spark):
    rows = [(1, "Released under the Apache License"), (2, "Licensed under CC BY 4.0"), (3, "Licensed under CC BY-NC 4.0"), (4, "Now released under the MIT license, all of it")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "apache", 2: "", 3: "cc-by-nc-4.0", 4: "mit"}


def plain_labels(text, notices=None):
    """Labels and best containment of all blocks of a text, block by block."""
    ws = re.findall(licenses.WORD, (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    out, best = set(), 0.0
    for label, share, notice in notices or licenses.NOTICES:
        listed = notice.split()
        want, span = set(listed), licenses.SPAN * len(listed)
        common = max((len(want & set(ws[i : i + span])) for i in range(max(1, len(ws) - span + 1))), default=0)
        if common >= share * len(want) - 1e-9:
            out.add(label)
            best = max(best, round(common / len(want), 6))
    return out, best


def against_all_blocks(rows, got):
    for k, text in rows:
        r, (labels, best) = got[k], plain_labels(text)
        assert set(filter(None, r["labels"].split(","))) == labels | set(filter(None, r["base_labels"].split(","))), text
        assert r["score"] == (1.0 if r["n_base"] else best)


def test_license_blocks_against_plain_containment(docs):
    """The filters drop no block that meets a notice and add none: all blocks of all documents against all notices."""
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    against_all_blocks(rows, got)
    assert sum(r["labels"] != "" for r in got.values()) > 0


def scattered():
    """Notices whole, with words left out or put in between near the threshold, wrapped, on one line, torn apart."""
    rnd, rows = random.Random(5), [(0, None), (1, ""), (2, "mit"), (3, "the " * 3000)]
    for _, _, notice in licenses.NOTICES:
        for gap, drop, join in ((0, 0, " "), (0, 0.15, "\n"), (1, 0.1, " "), (1, 0.25, "\n * "), (2, 0, " "), (200, 0, " "), (200, 0, "\n"), (0, 0.22, "; ")):
            words = [w for w in notice.split() if rnd.random() >= drop]
            if rnd.random() < 0.3:
                rnd.shuffle(words)
            inside = join.join(w + " " + prose(rnd.randrange(99), rnd.randrange(2 * gap + 1), ["zq", "the", "of"]) for w in words)
            rows.append((len(rows), f"{prose(len(rows), rnd.randrange(60))} {inside} {prose(len(rows) + 1, rnd.randrange(60))}"))
    return rows


def test_license_blocks_of_scattered_notices(spark):
    rows = scattered()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df.repartition(3)).collect()}
    against_all_blocks(rows, got)
    hit = sum(got[k]["labels"] != "" for k in got)
    assert 20 < hit < len(rows) - 20


def test_license_sql_of_scattered_notices(spark):
    """The registered SQL finds the same blocks, wrapped or not."""
    import duckdb
    import pandas as pd

    rows = scattered()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = {r[0]: r[1:] for r in con.sql(queries.ORACLES["op10_license_scan"]).fetchall()}
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


def test_line_ends_do_not_change_licenses(spark):
    """One line or many: the same labels. Words scattered far from each other are no notice."""
    far = " ".join(w + " " + prose(i, 200) for i, w in enumerate(licenses.NOTICES[9][2].split()))
    near = licenses.NOTICES[9][2]
    rows = [(1, far), (2, far.replace(" ", "\n")), (3, near), (4, near.replace(" ", "\n"))]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "", 3: "mit", 4: "mit"}


def test_licenses_of_a_given_table(spark):
    """Notices from a table, nulls and notices without words left out, a missing threshold taken as the usual one; none at all."""
    schema = "label string, threshold double, notice string, extra int"
    notices = spark.createDataFrame([("x", None, "Alpha beta gamma delta epsilon", 1), ("y", 1.0, "alpha zeta", 1), (None, 1.0, "beta", 1), ("z", 1.0, None, 1), ("v", 0.5, " -- ", 1)], schema)
    docs = spark.createDataFrame([(1, "ALPHA beta, gamma delta", "k"), (2, "zeta Alpha", "k"), (None, "beta", "k"), (3, "alpha beta gamma", "k")], "doc_id long, text string, _key string")
    got = {r["doc_id"]: (r["_key"], r["labels"], r["score"]) for r in licenses.scan(docs, keep=("doc_id", "_key"), notices=notices).collect()}
    assert got == {1: ("k", "x", 0.8), 2: ("k", "y", 1.0), None: ("k", "", 0.0), 3: ("k", "", 0.0)}
    assert [r["labels"] for r in licenses.scan(docs, notices=notices.limit(0)).collect()] == [""] * 4


def test_license_notices_wrapped_over_lines(spark):
    import textwrap

    rows, want, k = [(0, "mit\nreleased today\nunder the bridge")], {0: ""}, 0
    for label, _, notice in licenses.NOTICES:
        for width in (20, 72):
            k += 1
            lines = textwrap.wrap(f"{prose(k, 37)} {notice} {prose(k + 50, 41)}", width)
            rows.append((k, "\n * ".join(lines)))
            want[k] = label
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(want[k] in got[k] for k in want)
    assert got[0] == [""]


def test_pipeline_stages(spark, odd, tmp_path):
    import corpus_pipeline as P

    docs = odd.unionByName(odd.where("doc_id = 5").withColumns({"doc_id": F.lit(9).cast("long"), "text": F.concat("text", F.lit(" mail a@b.co now"))}))
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns, name
        if name == "near duplicates":
            ids = [r["doc_id"] for r in out.collect()]
            assert len(ids) == len(set(ids)) and 6 not in ids
        docs = out
    assert all(r["n_tokens"] == len(r["ids"]) for r in docs.collect())
    assert P.ORACLE_SQL is None and 4 <= len(P.STAGES) <= 5


def test_pipeline_stages_against_plain_versions(spark, docs, tmp_path):
    """Each stage on what the one before it has kept: verdicts, classes of all pairs, redaction of the reported spans, copies
    in the order of their positions, and the ids of the library."""
    import sentencepiece

    import corpus_pipeline as P

    def put(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    stage = {name: f for name, f in P.STAGES}
    kept = put(stage["quality rules"](spark, docs, SF), "quality")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}

    single = put(stage["near duplicates"](spark, kept, SF), "single")
    assert {r["doc_id"] for r in single.collect()} == set(classes_of_all_pairs(kept.select("doc_id", "text").collect()).values())

    clean = put(stage["personal data"](spark, single, SF), "clean")
    spans = {r["doc_id"]: r["spans"] for r in pii.report(single).collect()}
    text = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        want, at = "", 0
        for start, end, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans[r["doc_id"]].split(",") if x)):
            if start >= at:
                want += text[r["doc_id"]][at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        assert r["text"] == want + text[r["doc_id"]][at:] and r["n_chars"] == len(r["text"])

    plan = mixing.mix(clean, whole=True, every_copy=True).where("copies > 0").collect()
    order = [d for _, d in sorted((p, r["doc_id"]) for r in plan for p in r["positions"])]
    mixed = stage["mixing"](spark, clean, SF)
    assert [r["doc_id"] for r in mixed.select("doc_id").collect()] == order
    mixed = put(mixed, "mixed")

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    done = stage["tokens"](spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in done) == Counter(order)
    assert all(r["ids"] == lib.encode(text[r["doc_id"]], add_bos=True, add_eos=True) for r in done)
