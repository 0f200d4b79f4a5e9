"""Personal data: base spans by fixed patterns, and further spans by weak supervision.

Spans are found by the JVM's regular expressions. A pattern cuts the text into pieces between matches, and the lengths
of pieces and matches give every start in code points. The patterns are written so that a search is linear in the text
and matching needs no deep stack: runs are possessive, and a match may only start where a run starts.

Further candidates (loose phone numbers, spelled-out addresses, secrets, long digit runs) get votes of three labelers: a
pattern labeler, a gazetteer labeler and a context labeler that reads the words on both sides. The matches of the base
patterns get the same votes, so the labelers are seen on many real and failing cases; they stay or go by their own tests,
whatever the votes. Expectation-maximisation over the counts of vote patterns estimates, for each kind, how reliable each
labeler is, without any label; a labeler may prove worthless for a kind, never inverted. The posteriors train a logistic
span classifier over votes, kind, length and character mix. The count table has a bounded number of rows (kinds x votes x
bins), so both fits run on the driver, over counts from all documents. A candidate that overlaps a base span is left out.

Running positions and reaches are taken over pieces of ``PIECE`` matches and then over the pieces, and contexts come from
the text between matches, so a text of very many matches costs little more than its length.

Defined cases: a null text is empty and has no spans; repeated rows give equal results; texts are read whole.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from arpent.plans.staging import staged

_LOCAL = "A-Za-z0-9._%+-"
#: Base kinds in the order of the digest.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be worth a search.
_MARK = {"email": "@", "ip": ".", "phone": "+"}
#: Further kinds: candidates that the classifier decides on.
MORE = {
    "card_like": r"(?<![A-Za-z0-9.+-])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![A-Za-z0-9-])",
    "email_like": r"(?i)(?<![a-z0-9._-])[a-z0-9][a-z0-9._-]{0,63}+(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[a-z0-9-]{1,63}+(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[a-z]{2,12}",
    "phone_like": r"(?<![A-Za-z0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+(?![A-Za-z0-9_-])",
}
KINDS = [*BASE, *MORE]
# Words whose closeness speaks for a kind.
CONTEXT = {
    "card_like": "card|visa|mastercard|credit|debit|payment",
    "email_like": "mail|e-mail|email|contact|write",
    "phone_like": "phone|tel|call|fax|mobile|cell|dial",
    "secret": "token|key|secret|password|passwd|pwd|bearer|credential|auth",
}
# Beginnings that issuers give out.
GAZETTEER = {
    "card_like": "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "email_like": "(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$",
    "phone_like": r"^\(?[2-9][0-9]{2}",
    "secret": r"^(?:sk-|pk-|ghp_|gho_|AKIA|ASIA|xox[abp]-|glpat-|eyJ)",
}
CONTEXT |= {"email": CONTEXT["email_like"], "ip": "ip|host|server|address|from|login|client", "card": CONTEXT["card_like"], "phone": CONTEXT["phone_like"]}
GAZETTEER |= {"email": GAZETTEER["email_like"], "ip": "^(?:10|127|172|192)[.]", "card": GAZETTEER["card_like"], "phone": r"^\+(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"}
CONTEXT_CHARS = 24
LABELERS = ("pattern", "gazetteer", "context")
BINS = ("length_bin", "digit_bin", "distinct_bin")
EM_ROUNDS, FIT_ROUNDS, FIT_RATE = 40, 300, 0.5
#: Matches of one piece of a text's list.
PIECE = 256
_SPAN = "array<struct<start:int,end:int,match:string,left:string,right:string>>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(items: Column, zero: Column, result: str, step, total) -> Column:
    """A running fold over an array whose results are kept: ``step`` gives (state, new item) for a state and an item, and
    ``total`` the state after a piece from the state before it. ``result`` is the type of the results. Arrays grow by one
    only within pieces of ``PIECE`` items, so the work is linear in the array for all but the number of its pieces."""
    none = F.array().cast(f"array<{result}>")

    def state_after(acc: Column, piece: Column) -> Column:
        return F.struct(total(acc["at"], piece).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all"))

    def inside(piece: Column, at: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            after, made = step(acc["at"], x)
            return F.struct(after.alias("at"), F.concat(acc["out"], F.array(made)).alias("out"))

        return F.aggregate(piece, F.struct(at.alias("at"), none.alias("out")), add, lambda acc: acc["out"])

    def scanned(pieces: Column) -> Column:
        starts = F.aggregate(pieces, F.struct(zero.alias("at"), F.array().cast("array<int>").alias("all")), state_after, lambda acc: acc["all"])
        return F.flatten(F.zip_with(pieces, starts, inside))

    def cut(every: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(1), F.size(every), F.lit(PIECE)), lambda i: F.slice(every, i, F.lit(PIECE)))
        return F.when(F.size(every) > 0, _let(pieces, scanned)).otherwise(none)

    return _let(items, cut)


def _found(text: str, kind: str, pattern: str) -> Column:
    """Matches of a pattern as (start, end, match, and up to ``CONTEXT_CHARS`` characters on either side that lie outside
    other matches)."""

    def paired(gaps: Column) -> Column:
        after = F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(1)))
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        every = F.zip_with(F.arrays_zip(gaps.alias("gap"), after.alias("next")), matches, lambda g, m: F.struct(g["gap"].alias("gap"), m.alias("match"), g["next"].alias("next")))
        return F.filter(every, lambda x: x["match"].isNotNull())

    pairs = _let(F.split(text, pattern, -1), paired)

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        start = pos + F.length(x["gap"])
        end = start + F.length(x["match"])
        left, right = F.right(x["gap"], F.lit(CONTEXT_CHARS)), F.left(x["next"], F.lit(CONTEXT_CHARS))
        return end, F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), left.alias("left"), right.alias("right"))

    total = lambda pos, piece: F.aggregate(piece, pos, lambda acc, x: acc + F.length(x["gap"]) + F.length(x["match"]))
    spans = _scan(pairs, F.lit(0), _SPAN[6:-1], step, total)
    gate = F.col(text).rlike(pattern)
    if kind in _MARK:
        gate = F.contains(F.col(text), F.lit(_MARK[kind])) & gate
    return F.when(gate, spans).otherwise(F.array().cast(_SPAN))


def _valid(kind: str, m: Column) -> Column:
    """The second test of a base match."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3
        value = lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255
        return F.forall(F.split(m, r"\."), lambda p: part(p) & value(p))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def found_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each document with ``base`` (kind, start, end), ``more``: candidates with votes and features, and ``seen``: votes
    and features of all matches of the base patterns."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.withColumns({f"_{kind}": _found("_t", kind, rx) for kind, rx in (BASE | MORE).items()})
    rows = rows.withColumn("base", F.concat(*[_kept(kind) for kind in BASE]))
    rows = rows.withColumn("_all", F.concat(*[F.transform(f"_{kind}", partial(_labelled, kind)) for kind in MORE]))
    more = F.when(F.size("_all") == 0, F.col("_all")).when(F.size("base") == 0, F.col("_all")).otherwise(_clear("_all", "base"))
    # A run of digits shorter than any card is no case of one.
    case = lambda kind: F.filter("_card", lambda s: F.length(s["match"]) >= 13) if kind == "card" else F.col(f"_{kind}")
    seen = F.concat(*[F.transform(F.transform(case(kind), partial(_labelled, kind)), lambda x: x.dropFields("start", "end")) for kind in BASE])
    return rows.withColumns({"more": more, "seen": seen}).select(*keep, "base", "more", "seen")


def _kept(kind: str) -> Column:
    good = F.filter(f"_{kind}", lambda s: _valid(kind, s["match"]))
    return F.transform(good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _clear(candidates: str, base: str) -> Column:
    """The candidates that meet no base span. In the order of starts, a candidate meets an earlier span if the farthest
    end so far lies beyond its start; in the opposite order, a later one if the nearest start lies before its end."""
    both = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.lit(-1).alias("i"))),
        F.transform(candidates, lambda c, i: F.struct(c["start"].alias("start"), c["end"].alias("end"), i.alias("i"))),
    )
    is_base = lambda x: x["i"] < 0
    reach = lambda at, x: F.when(is_base(x), F.greatest(at, x["end"])).otherwise(at)
    nearest = lambda at, x: F.when(is_base(x), F.least(at, x["start"])).otherwise(at)
    over = lambda fold: lambda at, piece: F.aggregate(piece, at, fold)
    # A candidate that fails either test gets -1 for its place; base spans have it from the start.
    place = lambda x, met: F.when(met, F.lit(-1)).otherwise(x["i"])
    ahead = lambda up: _scan(up, F.lit(0), "int", lambda at, x: (reach(at, x), place(x, at > x["start"])), over(reach))
    behind = lambda up: _scan(F.reverse(up), F.lit(2**31 - 1), "int", lambda at, x: (nearest(at, x), place(x, at < x["end"])), over(nearest))
    good = _let(F.array_sort(both), lambda up: F.array_sort(F.filter(F.array_intersect(ahead(up), behind(up)), lambda i: i >= 0)))
    return F.transform(good, lambda i: F.get(candidates, i))


def _labelled(kind: str, s: Column) -> Column:
    """A match with its votes (1 for, -1 against, 0 abstain) and feature bins."""
    m = s["match"]
    digits, letters = F.length(F.regexp_replace(m, "[^0-9]", "")), F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    if kind in BASE:
        pattern = F.when(_valid(kind, m), 1).otherwise(-1)
    elif kind == "card_like":
        pattern = F.when(F.call_function("luhn_check", F.regexp_replace(m, "[^0-9]", "")), 1).otherwise(-1)
    elif kind == "secret":
        pattern = F.when((digits >= 4) & (letters >= 4), 1).otherwise(-1)
    else:
        pattern = F.lit(1)
    gazetteer = F.when(m.rlike(GAZETTEER[kind]), 1).otherwise(0 if kind == "secret" else -1)
    near = rf"(?i)\b(?:{CONTEXT[kind]})\b"
    context = F.when(s["left"].rlike(near), 1).when(s["right"].rlike(near), 1).otherwise(-1)
    distinct = F.size(F.array_distinct(F.split(F.left(m, F.lit(64)), "")))
    return F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), pattern.alias("pattern"), gazetteer.alias("gazetteer"),
        context.alias("context"), F.least(F.length(m) / 16, F.lit(3)).cast("int").alias("length_bin"), (3 * digits / F.length(m)).cast("int").alias("digit_bin"),
        F.least(distinct / 6, F.lit(3)).cast("int").alias("distinct_bin"),
    )


def vote_counts(spans: DataFrame) -> DataFrame:
    """How many matches of all documents share each combination of kind, votes and bins."""
    fields = ["kind", *LABELERS, *BINS]
    flat = lambda c: spans.select(F.explode(c).alias("c")).select(*[f"c.{x}" for x in fields])
    return flat("more").unionByName(flat("seen")).groupBy(*fields).count()


def reliabilities(rows: list[dict], rounds: int = EM_ROUNDS) -> tuple[list[float], dict[tuple[str, str, int], dict[int, float]]]:
    """Expectation-maximisation of two classes, a kind at a time: the posterior of each row, and P(vote | class) by kind,
    labeler and class.

    It starts from the majority of votes. Every count is smoothed by one, and by one more for the vote that suits the
    class; a labeler whose votes would speak for the other class gets the same distribution for both, so it says nothing."""
    def majority(r: dict) -> float:
        s = sum(r[v] for v in LABELERS)
        return 0.9 if s > 0 else 0.1 if s < 0 else 0.5

    post = [majority(r) for r in rows]
    table: dict[tuple[str, str, int], dict[int, float]] = {}
    for kind in sorted({r["kind"] for r in rows}):
        own = [i for i, r in enumerate(rows) if r["kind"] == kind]
        for _ in range(rounds):
            total = [sum(rows[i]["count"] * (post[i] if k else 1 - post[i]) for i in own) for k in (0, 1)]
            for name in LABELERS:
                sums = []
                for k in (0, 1):
                    n = {v: 2.0 if v == (1 if k else -1) else 1.0 for v in (-1, 0, 1)}
                    for i in own:
                        n[rows[i][name]] += rows[i]["count"] * (post[i] if k else 1 - post[i])
                    sums.append(n)
                share = [{v: x / sum(n.values()) for v, x in n.items()} for n in sums]
                if share[1][1] < share[0][1] or share[1][-1] > share[0][-1]:
                    both = {v: sums[0][v] + sums[1][v] for v in (-1, 0, 1)}
                    share = [{v: x / sum(both.values()) for v, x in both.items()}] * 2
                for k in (0, 1):
                    table[kind, name, k] = share[k]
            prior = [(x + 1) / (sum(total) + 2) for x in total]
            for i in own:
                log = [math.log(prior[k]) + sum(math.log(table[kind, name, k][rows[i][name]]) for name in LABELERS) for k in (0, 1)]
                post[i] = 1 / (1 + math.exp(min(max(log[0] - log[1], -500), 500)))
    return post, table


def _features(r: dict) -> list[float]:
    return [*(float(r[v]) for v in LABELERS), 1.0, *(float(r[b]) / 3 for b in BINS), *(float(r["kind"] == k) for k in KINDS)]


def fit(rows: list[dict]) -> list[float]:
    """Weights of the span classifier, by gradient steps on the posteriors; each kind weighs the same in all, and no vote
    has a negative weight. None without candidates."""
    if not rows:
        return []
    post, _ = reliabilities(rows)
    totals: dict[str, int] = {}
    for r in rows:
        totals[r["kind"]] = totals.get(r["kind"], 0) + r["count"]
    share = [r["count"] / totals[r["kind"]] / len(totals) for r in rows]
    xs = [_features(r) for r in rows]
    w = [0.0] * len(xs[0])
    for _ in range(FIT_ROUNDS):
        grad = [1e-3 * v for v in w]
        for x, p, part in zip(xs, post, share):
            e = (1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))) - p) * part
            grad = [g + e * b for g, b in zip(grad, x)]
        w = [a - FIT_RATE * len(totals) * g for a, g in zip(w, grad)]
        w[: len(LABELERS)] = [max(v, 0.0) for v in w[: len(LABELERS)]]
    return w


def _accepted(weights: list[float]) -> Column:
    """The candidates with a probability of one half or more."""
    if not weights:
        return F.array().cast("array<struct<kind:string,start:int,end:int>>")

    def likely(c: Column) -> Column:
        terms = [*(c[v].cast("double") for v in LABELERS), F.lit(1.0), *(c[b] / F.lit(3.0) for b in BINS)]
        terms += [F.when(c["kind"] == k, 1.0).otherwise(0.0) for k in KINDS]
        total = F.lit(0.0)
        for w, x in zip(weights, terms):
            total = total + F.lit(w) * x
        return total >= 0

    return F.transform(F.filter("more", likely), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))


def classified(spans: DataFrame) -> DataFrame:
    """Fit on the candidates of ``spans`` (staged: it is read twice) and add ``added``, the accepted ones."""
    rows = [r.asDict() for r in vote_counts(spans).collect()]  # bounded: kinds x votes x bins
    return spans.withColumn("added", _accepted(fit(sorted(rows, key=lambda r: [str(v) for v in r.values()])))).drop("more", "seen")


def _listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of ``spans``."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, digest and list of spans of each document."""
    out = classified(staged(found_spans(docs, text, keep), "pii"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(*keep, *[n(k) for k in BASE], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"))


def redacted(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one, by the kind of
    the earliest."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), acc["pos"] + 1, s["start"] - acc["pos"])
        put = F.array(gap, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        reaching = F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["pos"], F.struct(s["end"].alias("pos"), F.concat(acc["out"], put).alias("out"))).otherwise(reaching)

    done = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col(text), acc["pos"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, add, done)).otherwise(F.col(text))
