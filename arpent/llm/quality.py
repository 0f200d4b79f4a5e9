"""Quality rules: word and line counts with hard limits, and divergence from language references.

Every count is a built-in function of the text; the references are one small aggregate over all documents of a language,
junk included, and no text is shuffled. A document is compared with the other documents of its language, itself left out, and
only where there are at least ``MIN_OTHERS``: one alone would be its own measure, and among few a poor one would set it.
Languages without a list of common words have no word test. Defined cases: a null
text counts as empty; a document without words fails the base rule; a null or unknown language is compared with its own
pooled reference; equal rows give equal verdicts; of the other columns only those named in ``keep`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arpent.plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
CHAR_BINS = ("lower", "upper", "digit", "space", "stop", "symbol", "beyond", "other")
# Frequent function words of each language, most frequent first.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "auf"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "with", "was"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "las", "por", "con", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "qui", "pour"],
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A histogram over fewer characters or words than this says too little, and is not compared.
MIN_CHARS, MIN_COMPARED_WORDS = 200, 50
#: Other documents of a language that a comparison asks for.
MIN_OTHERS = 10
#: Jensen-Shannon distances (0 to 1) beyond which a document is unlike its language.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.45


def measures(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The counts and the two histograms of each document, from one pass over its text.

    ``n_repeat_words`` counts the words that lie in a 3-word window found at least twice. Windows are compared by their
    64-bit hash; sorting them inside the row, with the start of each, brings equal ones together.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*keep, F.col(lang).alias("_lang"), t.alias("_t")).withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    windows = F.transform(
        "_w", lambda w, i: F.when(i < F.size("_w") - 2, F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    )
    base = base.withColumn("_h", F.when(F.size("_w") >= 4, F.slice(windows, 1, F.greatest(F.size("_w") - 2, F.lit(1)))))
    # The sort runs only where some window repeats.
    placed = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    base = base.withColumn("_p", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(placed)))
    again = F.filter(
        F.col("_p"),
        lambda p, j: (p["h"] == F.get("_p", j + 1)["h"]) | ((j > 0) & (p["h"] == F.get("_p", F.greatest(j - 1, F.lit(0)))["h"])),
    )
    base = base.withColumn("_s", F.sort_array(F.transform(again, lambda p: p["i"])))
    covered = F.aggregate(
        F.transform("_s", lambda s, j: F.least(F.coalesce(F.get("_s", j + 1) - s, F.lit(3)), F.lit(3))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern)).cast("long")
    base = base.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": count(r"[#*$%&|<>]"),
        "_lines": lines,
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_chars": F.length("_t").cast("long"),
        "_upper": count("[A-Z]"), "_digit": count("[0-9]"), "_stop": count("[.,;:!?]"),
        "_beyond": count(r"[^\x00-\x7F]"), "_other": count(r"[\x00-\x08\x0E-\x1F\x22\x27-\x29\x2B\x2D\x2F\x3D\x40\x5B-\x60\x7B\x7D-\x7F]"),
        "_common": _common_words("_w"),
    })
    space = F.col("_chars") - F.col("word_chars")
    lower = F.col("_chars") - space - F.col("_upper") - F.col("_digit") - F.col("_stop") - F.col("n_symbols") - F.col("_beyond") - F.col("_other")
    n = F.size("_common").cast("long")
    bins = [n - F.size(F.array_remove("_common", F.lit(k))).cast("long") for k in range(1, 13)]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return base.select(
        *keep, F.col("_lang").alias("lang_ref"), "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        failed.alias("base_failed"), F.col("_chars").alias("n_text_chars"),
        F.array(lower, F.col("_upper"), F.col("_digit"), space, F.col("_stop"), F.col("n_symbols"), F.col("_beyond"), F.col("_other")).alias("char_hist"),
        F.array(*bins, F.col("n_words") - n).alias("word_hist"),
    )


def _common_words(words: str) -> Column:
    """The places in its language's list of those words of a document that the list has, in any case."""
    out = F.array().cast("array<int>")
    for lang, listed in COMMON_WORDS.items():
        out = F.when(F.col("_lang") == lang, _places(words, listed)).otherwise(out)
    return out


def _places(words: str, listed: list[str]) -> Column:
    forms = [x for w in listed for x in (w, w.capitalize(), w.upper())]
    ranks = F.array(*[F.lit(w) for w in listed])
    return F.transform(F.filter(words, lambda w: w.isin(forms)), lambda w: F.array_position(ranks, F.lower(w)).cast("int"))


def references(measured: DataFrame) -> DataFrame:
    """One row a language: its number of documents and summed histograms over all of them. Sums combine before the shuffle."""
    sums = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    return measured.groupBy("lang_ref").agg(F.count(F.lit(1)).alias("n_ref"), sums("char_hist", len(CHAR_BINS)).alias("char_ref"), sums("word_hist", 13).alias("word_ref"))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two count arrays, base 2; null where either is all zeros."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x).cast("double")
    share = lambda c: F.transform(c, lambda x: F.try_divide(x.cast("double"), total(c)))

    def part(x: Column, y: Column) -> Column:
        m = (x + y) / 2
        side = lambda v: F.when(v > 0, v * F.log2(v / m)).otherwise(F.lit(0.0))
        return (side(x) + side(y)) / 2

    return F.sqrt(F.greatest(F.aggregate(F.zip_with(share(p), share(q), part), F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def verdicts(measured: DataFrame) -> DataFrame:
    """Add the distances, rounded to 6 places, and ``kept``. ``measured`` should be staged: it is read twice."""
    # Staged, the references have a size that Spark knows: a few rows are broadcast, so no text is shuffled.
    pooled = staged(references(measured), "references")
    joined = measured.alias("m").join(pooled.alias("r"), F.col("m.lang_ref").eqNullSafe(F.col("r.lang_ref")), "left")
    others = lambda ref, own: F.zip_with(ref, own, lambda a, b: a - b)
    joined = joined.select("m.*", "n_ref", others("char_ref", "char_hist").alias("char_ref"), others("word_ref", "word_hist").alias("word_ref"))
    known, enough = F.col("lang_ref").isin(list(COMMON_WORDS)), F.col("n_ref") > MIN_OTHERS
    char_distance = F.when(enough & (F.col("n_text_chars") >= MIN_CHARS), F.round(distance("char_hist", "char_ref"), 6))
    word_distance = F.when(enough & known & (F.col("n_words") >= MIN_COMPARED_WORDS), F.round(distance("word_hist", "word_ref"), 6))
    out = joined.withColumns({"char_distance": char_distance, "word_distance": word_distance}).drop("n_ref", "char_ref", "word_ref")
    unlike = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE) | (F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE)
    return out.withColumn("kept", ~F.col("base_failed") & ~unlike).drop("char_hist", "word_hist", "lang_ref", "n_text_chars")


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, distances and verdict of each document."""
    return verdicts(staged(measures(docs, text, lang, keep), "quality"))
