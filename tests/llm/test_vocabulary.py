"""Spelling variants, byte-level BPE and the prefix trie against brute force, and every SQL of the subpackage."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from arpent.llm import bytepairs, prefixes, queries, variants
from arpent.plans import catalog

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, word string, n int, block string, tile int, h int"
TURNS = "conv_id long, turn long, role string, text string, conv string, k1 int, depth int"
EMPTY = hashlib.sha256(b"").hexdigest()


# --- 11. Spelling variants ----------------------------------------------------------------------------------------


def edits_apart(a: str, b: str) -> bool:
    """One inserted, deleted or replaced letter, found by making every edit."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows):
    low = str.maketrans(variants.UPPER, variants.LOWER)
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in seen.items() if n >= 3 and len(w) >= 5}
    near = {w: [x for x in words if edits_apart(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def odd_words(seed):
    """Nulls, empty and very long texts, ties, repeated rows, letters beyond ASCII, chains of forms."""
    rnd = random.Random(seed)
    stems = ["colour", "color", "colors", "célèbre", "celebre", "ÀÉîõü", "ÀÉîõ", "strasse", "straße", "aaaaaa", "aaaaaaa", "aaaaa", "listen", "silent", "enlist", "x×y÷zz"]
    text = lambda k: " ".join(rnd.choice(stems) if rnd.random() < 0.7 else "".join(rnd.choice("abcé") for _ in range(rnd.randrange(4, 7))) for _ in range(k))
    rows = [(k, text(40)) for k in range(40)] + [(None, None), (1, ""), (None, text(30)), (7, "q" * 30_000 + " " + "q" * 30_001)]
    rows += [(8, "q" * 30_000 + " " + "q" * 30_001)] * 3 + [rows[0]] * 3 + [(9, text(20_000))]
    return [(*r, "x", 1, "y", 2, 3) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_all_pairs(spark, seed):
    rows = odd_words(seed)
    got = variants.group(spark.createDataFrame(rows, DOCS).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == plain_variants([r[:2] for r in rows]) and len(found) == len(set(found))


def test_variants_of_nothing(spark):
    assert variants.group(spark.createDataFrame([], DOCS)).collect() == []
    assert variants.group(spark.createDataFrame([(1, "one two", "", 1, "", 1, 1)], DOCS)).collect() == []


def test_small_tiles_lose_no_pair(spark, monkeypatch):
    """With tiles of a few words a block is many units; the pairs stay the same."""
    monkeypatch.setattr(variants, "TILE", 64)
    rows = [r for r in odd_words(3) if r[1] is None or len(r[1]) < 60_000]
    found = {tuple(r) for r in variants.group(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == plain_variants([r[:2] for r in rows])


def test_one_edit_holds_against_every_edit():
    rnd = random.Random(4)
    words = list({"".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 7))) for _ in range(400)})
    i, j = variants.near(words, words, True)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if edits_apart(words[a], words[b])}


# --- 12. Byte-level BPE -------------------------------------------------------------------------------------------


def library(name="byte_bpe_50k.tiktoken"):
    import public_tokenizers
    import tiktoken

    ranks = bytepairs.read_ranks(public_tokenizers.path(name))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_byte_tokens_equal_the_library(name):
    ranks, lib = library(name)
    ours, rnd, tokens = bytepairs.Ranks(ranks, queries.MATCHES), random.Random(6), list(ranks)
    kinds = ["ab", "aé ", "the and ing ", "😀中文字", "aaaaab", "  \n\t\r\x0b\x1c\x85 ", "0123456789²½", "'s're'll'", "".join(map(chr, range(32, 1500)))]
    texts = ["", " ", "a" * 50_000, " " * 30_001 + "x", "<|endoftext|>", "\x00\x01", "é" * 9_999, "ab" * 30_000]
    texts += ["".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += [b"".join(rnd.choice(tokens) for _ in range(rnd.randrange(1, 9))).decode("utf-8", "ignore") for _ in range(3000)]
    texts += [b"".join(t for t in rnd.choices(tokens, k=14) if t.isalpha()).decode("utf-8", "ignore") for _ in range(2000)]
    ids = [ours.encode(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [lib.encode_ordinary(t) for t in texts]
    assert ours.decoded(ids) == [t.encode() for t in texts]


def test_byte_tokens_of_every_character():
    """The reordered pattern cuts like the public one at each code point, beside letters, digits, blanks and marks."""
    import public_tokenizers
    import regex

    one, other = regex.compile(public_tokenizers.PATTERN), regex.compile(queries.MATCHES)
    for start in range(0, 0x110000, 0x800):
        if not 0xD800 <= start < 0xE000:
            text = "".join(f"{c}{c} {c}a{c}1{c}!{c}  {c}'s{c}\n" for c in map(chr, range(start, start + 0x800)))
            assert one.findall(text) == other.findall(text)


def test_long_texts_go_in_runs(monkeypatch):
    ranks, lib = library()
    monkeypatch.setattr(bytepairs, "RUN", 50)
    monkeypatch.setattr(bytepairs, "REMEMBERED", 20)
    monkeypatch.setattr(bytepairs, "ANSWERS", 10)
    ours = bytepairs.Ranks(ranks, queries.MATCHES)
    text = "".join(random.Random(7).choice(["the ", "Thandst ", "\n\n", "x" * 300 + " ", "9 "]) for _ in range(900))
    assert np.frombuffer(ours.encode(text), "<u4").tolist() == lib.encode_ordinary(text)


def test_byte_tokens_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "Ünïcode 😀\x00 x"), (3, "Ünïcode 😀\x00 x"), (4, "word " * 20_000 + "y" * 3_000)]
    df = spark.createDataFrame([(*r, "w", 1, "b", 2, 3) for r in rows], DOCS)
    got = bytepairs.encoded(df, queries.byte_ranks(), queries.MATCHES, keep=("doc_id", "n"), with_ids=True).collect()
    _, lib = library()
    for r, text in zip(sorted(got, key=lambda r: (r["doc_id"] or 0, r["n_tokens"])), ["no id", *[t or "" for _, t in rows[:2]], *[t for _, t in rows[3:]]]):
        ids = lib.encode_ordinary(text)
        assert (r["ids"], r["n_tokens"], bytes(r["decoded"])) == (ids, len(ids), text.encode())
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bytepairs.encoded(df.limit(0), queries.byte_ranks(), queries.MATCHES).collect() == []


def test_tokens_that_merges_cannot_make_stand_for_whole_matches_only():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 258, b"bcd": 259}
    ours = bytepairs.Ranks(ranks, r"\w+")
    assert ours.tokens("bcd") == [259] and ours.tokens("abcd") == [258, 100] and ours.tokens("xbcd") == [120, 98, 99, 100]
    with pytest.raises(ValueError):
        bytepairs.Ranks({b"a": 0}, r"\w+")


# --- 13. Prefix trie ----------------------------------------------------------------------------------------------


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(set), Counter(), Counter()
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                children[tuple(v[: d - 1])].add(tuple(v[:d]))
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in members[k] if len(built[c]) == len(k)))).encode()).hexdigest()
    return {(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], digest(k)) for k, m in members.items()}


@pytest.mark.parametrize("seed,piece", [(1, prefixes.PIECE), (2, 2)])
def test_trie_equals_plain_prefixes(spark, seed, piece):
    """Also with paths cut every two turns; nulls in every column, negative ids, ties and repeated rows."""
    rnd, rows = random.Random(seed), []
    for c in range(-45, 90):
        for t in range(rnd.choice([0, 1, 2, 3, 4, 9])):
            rows.append((c, rnd.choice([None, t, t, t]), rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "c", "", None, " x y\t z", "word " * 5_000])))
    rows += [(None, 1, "user", "x")] * 3 + rows[:5] + [(200, t, "user", "same") for t in range(300)]
    df = spark.createDataFrame([(*r, "z", 1, 2) for r in rows], TURNS).repartition(5)
    got = [tuple(r) for r in prefixes.trie(df, piece=piece).collect()]
    assert set(got) == plain_trie(rows) and len(got) == len(set(got))


def test_trie_without_turns(spark):
    assert prefixes.trie(spark.createDataFrame([], TURNS)).collect() == []
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    df = spark.createDataFrame([(alone, 1, "user", "x", "", 1, 1)], TURNS)
    assert [tuple(r) for r in prefixes.trie(df).collect()] == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_many_ends_are_one_stream(spark):
    """More ids at one node than one run of ends holds."""
    ids = [c for c in range(4000) if c % 20]
    df = spark.createDataFrame([(c, 1, "user", "hello there", "", 1, 1) for c in ids], TURNS)
    assert {tuple(r) for r in prefixes.trie(df).collect()} == plain_trie([(c, 1, "user", "hello there") for c in ids])


def test_node_table_gives_each_digest_a_slot():
    rnd = np.random.default_rng(5)
    k1, k2 = rnd.integers(-(2**63), 2**63 - 1, 5000), rnd.integers(-3, 3, 5000)
    k1[:2500] = k1[2500:]
    nodes = prefixes.NodeTable(k1, k2)
    slot = nodes.slots(k1, k2)
    assert len(nodes) == len(set(zip(k1.tolist(), k2.tolist()))) and sorted(set(slot.tolist())) == list(range(len(nodes)))
    assert (nodes.k1[slot] == k1).all() and (nodes.k2[slot] == k2).all()
    assert (nodes.slots(k1, k2 + 100) == -1).all()
    assert len(prefixes.NodeTable(k1[:0], k2[:0])) == 0


# --- The SQL ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in catalog.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    plain = lambda v: float(f"{v:.7g}") if isinstance(v, float) else v
    df, found = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(found.columns)
    at = [found.columns.index(c) for c in df.columns]
    assert Counter(tuple(map(plain, r)) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
