"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arpent.llm import ann, bytepairs, chat, language, licenses, mixing, neardup, pieces, pii, prefixes, quality, sharding, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registered(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- 1. Chat formatting -------------------------------------------------------------------------------------------

_CHAT_SQL = f"""
WITH s AS (
  SELECT conv_id, turn::BIGINT AS turn, role, text, count(*) AS n, coalesce(floor(turn / {chat.PIECE}), {chat.LAST})::BIGINT AS block,
    replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations GROUP BY conv_id, turn, role, text),
p AS (SELECT DISTINCT conv_id, role AS participant FROM s WHERE role IS NOT NULL),
r AS (
  SELECT s.conv_id, block, participant, turn, role, body, n, coalesce(role = participant, false) AS own,
    CASE WHEN coalesce(role = participant, false) THEN '{chat.OPEN}assistant' || chr(10)
      ELSE '{chat.OPEN}user name=' || coalesce(replace(regexp_replace(role, '[\r\n]', ' ', 'g'), '<|', '< |'), 'unknown') || chr(10) END AS head
  FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
l AS (SELECT *, length(head) + length(body) + {len(chat.CLOSE) + 1} AS whole FROM r),
c AS (
  SELECT *, coalesce(sum(whole) OVER (PARTITION BY conv_id, participant ORDER BY block, turn NULLS LAST, coalesce(role, ''), body, role IS NULL, n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS first_char,
    row_number() OVER (PARTITION BY conv_id, block, participant ORDER BY turn NULLS LAST, coalesce(role, ''), body, role IS NULL, n) AS k
  FROM l)
SELECT conv_id, block, participant, min(first_char - length(head))::BIGINT AS first_char, string_agg(head || body || '{chat.CLOSE}' || chr(10), '' ORDER BY k) AS rendered,
  coalesce(string_agg(first_char || ':' || (first_char + length(body)), ',' ORDER BY k) FILTER (WHERE own), '') AS mask,
  count(*)::BIGINT AS n_turns, (count(*) FILTER (WHERE own))::BIGINT AS n_own_turns,
  coalesce(sum(length(body)) FILTER (WHERE own), 0)::BIGINT AS n_learned_chars, sum(n)::BIGINT AS n_copies
FROM c GROUP BY conv_id, block, participant"""


@registered("op1_perspective_rotation", _CHAT_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


# --- 2. Language identification: random vectors, tested by held-out accuracy --------------------------------------


@registered("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


# --- 3. Near duplicates: hashed samples and alignment, tested against all pairs of a small table ------------------


@registered("op3_order_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


# --- 4. Mixing sources to target weights --------------------------------------------------------------------------


def _due_sql(schedule) -> str:
    whole, area, out = mixing.integral(schedule), 0.0, ""
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        need, slope = f"(share * {whole!r}::DOUBLE - {area!r}::DOUBLE)", (w1 - w0) / (t1 - t0)
        area += (t1 - t0) * (w0 + w1) / 2
        x = f"2 * {need} / ({w0!r}::DOUBLE + sqrt(greatest({w0 * w0!r}::DOUBLE + 2 * {slope!r}::DOUBLE * {need}, 0)))"
        out += f" WHEN share * {whole!r}::DOUBLE <= {area!r}::DOUBLE THEN {t0!r}::DOUBLE + {x}"
    return f"CASE{out} ELSE {schedule[-1][0]!r}::DOUBLE END"


_MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.SCHEDULES)} + 1)::DOUBLE AS weight FROM d GROUP BY source),
c AS (SELECT *, {mixing.MAX_REPEATS}::DOUBLE * source_size AS cap FROM s),
f AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM c),
l AS (SELECT full_before AS lf, rest AS lr FROM f WHERE (total - full_before) / rest <= cap / weight ORDER BY full_before, rest LIMIT 1),
g AS (SELECT source, source_size, weight, least(cap, (total - lf) * weight / lr) AS target, floor(least(cap, (total - lf) * weight / lr) + 0.5)::BIGINT AS goal FROM f, l),
p AS (
  SELECT d.*, source_size, weight, target, goal, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS rounds,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t AS (SELECT *, least(greatest(goal - rounds * source_size - pos, 0), size) AS extra, least(pos::DOUBLE / nullif(goal, 0)::DOUBLE, 1) AS share FROM p)
SELECT doc_id, size, source_size, target, (rounds * size + extra)::BIGINT AS taken,
  CASE WHEN size > 0 THEN rounds + (extra > 0)::INT ELSE 0 END::INT AS copies,
  CASE WHEN rounds * size + extra > 0 THEN round(CASE weight {' '.join(f'WHEN {k} THEN {_due_sql(x)}' for k, x in enumerate(mixing.SCHEDULES, 1))} END, 9) END AS position
FROM t"""


@registered("op4_mix_curriculum", _MIX_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.mix(table(spark, sf_dir, "documents")))


# --- 5. Approximate nearest neighbours: fitted, tested by recall against brute force ------------------------------


@registered("op5_ivf_pq")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


# --- 6. Personal data: fitted by iteration, so SQL has no form of it ----------------------------------------------


@registered("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


# --- 7. Sharding: a map edited by a greedy loop, tested by its law ------------------------------------------------


@registered("op7_virtual_slots")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


# --- 8. SentencePiece: merge rounds, tested against the library ---------------------------------------------------


def piece_model() -> str:
    """The public vocabulary file; other files of the kind can be given to ``pieces.encoded``."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@registered("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), piece_model())


# --- 9. Quality rules ---------------------------------------------------------------------------------------------


def _quality_sql() -> str:
    n = lambda pattern: f"len(regexp_extract_all(t, '{pattern}'))"
    other = r"[\x00-\x08\x0E-\x1F\x22\x27-\x29\x2B\x2D\x2F\x3D\x40\x5B-\x60\x7B\x7D-\x7F]"
    lists = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in quality.COMMON_WORDS.items())
    forms = " ".join(
        f"WHEN '{k}' THEN [{', '.join(repr(x) for w in v for x in (w, w.capitalize(), w.upper()))}]" for k, v in quality.COMMON_WORDS.items()
    )
    jsd = """sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: (
        CASE WHEN {p}[i] > 0 THEN ({p}[i] / list_sum({p})) * log2(({p}[i] / list_sum({p})) / (({p}[i] / list_sum({p}) + {q}[i] / list_sum({q})) / 2)) ELSE 0 END
      + CASE WHEN {q}[i] > 0 THEN ({q}[i] / list_sum({q})) * log2(({q}[i] / list_sum({q})) / (({p}[i] / list_sum({p}) + {q}[i] / list_sum({q})) / 2)) ELSE 0 END) / 2)), 0))"""
    langs = ", ".join(f"'{k}'" for k in quality.COMMON_WORDS)
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{quality.WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM again, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {n('[#*$%&|<>]')} AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(covered.n, 0) AS n_repeat_words, length(t) AS chars,
    {n('[A-Z]')} AS up, {n('[0-9]')} AS dig, {n('[.,;:!?]')} AS stop, {n(r'[^\x00-\x7F]')} AS beyond, {n(other)} AS oth,
    list_filter(w, lambda x: list_contains(CASE lang {forms} ELSE [] END, x)) AS common, CASE lang {lists} ELSE [] END AS listed
  FROM d LEFT JOIN covered USING (doc_id)),
h AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    [chars - (chars - word_chars) - up - dig - stop - n_symbols - beyond - oth, up, dig, chars - word_chars, stop, n_symbols, beyond, oth]::DOUBLE[] AS ch,
    list_append(list_transform(range(1, 13), lambda i: len(list_filter(common, lambda x: lower(x) = listed[i]))), n_words - len(common))::DOUBLE[] AS wh
  FROM m),
r AS (
  SELECT lang, count(*) AS docs, {', '.join(f'sum(ch[{i}]) AS c{i}' for i in range(1, 9))}, {', '.join(f'sum(wh[{i}]) AS w{i}' for i in range(1, 14))} FROM h GROUP BY lang),
j AS (
  SELECT h.*, docs, [{', '.join(f'c{i} - ch[{i}]' for i in range(1, 9))}] AS cr, [{', '.join(f'w{i} - wh[{i}]' for i in range(1, 14))}] AS wr
  FROM h JOIN r ON h.lang IS NOT DISTINCT FROM r.lang),
v AS (
  SELECT *, CASE WHEN docs > {quality.MIN_OTHERS} AND list_sum(cr) > 0 AND chars >= {quality.MIN_CHARS} THEN round({jsd.format(p='ch', q='cr')}, 6) END AS char_distance,
    CASE WHEN docs > {quality.MIN_OTHERS} AND list_sum(wr) > 0 AND lang IN ({langs}) AND n_words >= {quality.MIN_COMPARED_WORDS} THEN round({jsd.format(p='wh', q='wr')}, 6) END AS word_distance
  FROM j)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, char_distance, word_distance,
  NOT base_failed AND NOT (coalesce(char_distance, 0) > {quality.MAX_CHAR_DISTANCE} OR coalesce(word_distance, 0) > {quality.MAX_WORD_DISTANCE}) AS kept
FROM v"""


@registered("op9_quality_rules", _quality_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


# --- 10. License scans --------------------------------------------------------------------------------------------


def _license_sql() -> str:
    low = lambda x: f"translate({x}, '{licenses.UPPER}', '{licenses.LOWER}')"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS pos, '{label}' AS label FROM d, unnest(range(1, len(w) + 1)) AS u(i) WHERE "
        + " AND ".join(f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(p.split()))
        for p, label in licenses.PHRASES.items()
    )
    rows = ", ".join(
        f"({k}, '{label}', {licenses.SPAN * len(licenses.notice_words(t))}, {licenses.needed(share, len(set(licenses.notice_words(t))))}, [{', '.join(repr(w) for w in sorted(set(licenses.notice_words(t))))}])"
        for k, (label, share, t) in enumerate(licenses.NOTICES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all({low("coalesce(text, '')")}, '{licenses.WORD}') AS w FROM documents),
b AS ({phrases}),
bl AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS labels FROM b GROUP BY doc_id),
tm(k, label, span, need, words) AS (VALUES {rows}),
tw AS (SELECT k, span, unnest(words) AS x FROM tm),
ht AS (SELECT doc_id, k, span, i AS pos, x FROM (SELECT doc_id, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(i)) JOIN tw USING (x)),
wn AS (SELECT doc_id, k, count(DISTINCT x) OVER (PARTITION BY doc_id, k ORDER BY pos RANGE BETWEEN CURRENT ROW AND (span - 1) FOLLOWING) AS n FROM ht),
mt AS (SELECT doc_id, label, round(n / len(words), 6) AS score FROM wn JOIN tm USING (k) WHERE n >= need),
ml AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(score) AS score FROM mt GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(bl.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bl.labels, []), coalesce(ml.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(ml.score, 0) END::DOUBLE AS score
FROM d LEFT JOIN bl USING (doc_id) LEFT JOIN ml USING (doc_id)"""


@registered("op10_license_scan", _license_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


# --- 11. Spelling variants ----------------------------------------------------------------------------------------

#: The checksum of bytes, given as a list; the polynomial is a fixed value.
_CRC32 = """(4294967295 - list_reduce(list_concat([4294967295::BIGINT], {x}),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""
_ASCII = "list_transform(string_split({x}, ''), lambda ch: ascii(ch)::BIGINT)"
_LATIN = "flatten(list_transform(string_split({x}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)]::BIGINT[] END))"

_VARIANTS_SQL = f"""
WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS mark, unnest(regexp_extract_all(translate(text, '{variants.UPPER}', '{variants.LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
h AS (SELECT run, {_CRC32.format(x=_LATIN.format(x='mark || run'))} AS h FROM r WHERE length(run) >= {variants.MIN_LETTERS}),
w AS (SELECT CASE WHEN h % {variants.TYPO} = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word FROM h),
v AS (SELECT word, count(*) AS n FROM w WHERE length(word) >= {variants.MIN_LETTERS} GROUP BY word HAVING count(*) >= {variants.MIN_COUNT}),
d AS (SELECT word, n, i, left(word, (i - 1)::INT) || substring(word, (i + 1)::INT) AS less FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
p AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
k AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k FROM p),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN k.n >= {variants.FORM} * v.n THEN other END AS form, CASE WHEN k.n >= {variants.FORM} * v.n THEN k.n END AS form_n
  FROM v LEFT JOIN k ON v.word = k.word AND k.k = 1),
c(word, root, ahead) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.ahead = f.word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN c ON f.word = c.word AND c.ahead IS NULL"""


@registered("op11_spelling_variants", _VARIANTS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


# --- 12. Byte-level BPE: backtracking over longest matches, tested against the library -----------------------------

#: The public pattern with its alternatives for letters and numbers first. Where one of these matches, none that stood
#: before it could, so the matches are the same; letters are met sooner.
MATCHES = r""" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_ranks() -> str:
    """The public rank file; other files of the kind can be given to ``bytepairs.encoded``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@registered("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.encoded(table(spark, sf_dir, "documents"), byte_ranks(), MATCHES)


# --- 13. Conversation prefix trie ---------------------------------------------------------------------------------

_TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, ({_CRC32.format(x=_ASCII.format(x='conv_id::VARCHAR'))} % {prefixes.LENT})::BIGINT AS h FROM t),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS turns FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % {prefixes.FAMILY}),
m AS (SELECT conv_id, d, turns[1:d] AS k, len(turns) = d AS ends FROM r, unnest(range(0, len(turns) + 1)) AS u(d)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d][2], '[^\x20\x09-\x0D]+')) END AS saves
  FROM m GROUP BY k, d),
c AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
l AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k)),
s AS (SELECT k[1:i] AS k, sum((n_children = 0)::INT) AS n_leaves, sum(saves) AS saved_tokens FROM l, unnest(range(0, d + 1)) AS u(i) GROUP BY 1)
SELECT l.conv_id::BIGINT AS conv_id, l.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM l JOIN s USING (k) LEFT JOIN l p ON l.d > 0 AND p.k = l.k[1:l.d - 1]"""


@registered("op13_prefix_trie", _TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))
