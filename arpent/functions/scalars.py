"""Scalar rules of the domain, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accented letters and what they fold to.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
FOLDED = "aaaaaaceeeeiiiinooooouuuuyy"


def folded(c: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(c), ACCENTED, FOLDED)


def address_label(c: Column) -> Column:
    """Normal form of a label: lower case, no accents, runs of anything else than letters and digits as one blank."""
    return F.trim(F.regexp_replace(folded(c), "[^a-z0-9]+", " "))


def parcel_id(c: Column) -> Column:
    """A parcel id of 14 characters; one of 15 with a zero after the commune loses it."""
    padded = (F.length(c) == 15) & (F.substring(c, 6, 1) == "0")
    return F.when(padded, F.concat(F.substring(c, 1, 5), F.substring(c, 7, 9))).otherwise(c)


def display_label(*parts: Column) -> Column:
    """Non-empty parts joined by blanks."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def age_in_months(then: Column, now: Column) -> Column:
    """Complete months from one day to another; may be negative."""
    months = (F.year(now) - F.year(then)) * 12 + F.month(now) - F.month(then)
    return months - F.when(F.dayofmonth(now) < F.dayofmonth(then), 1).otherwise(0)


def months_between(then: Column, now: Column) -> Column:
    """Complete months, zero at least."""
    return F.greatest(age_in_months(then, now), F.lit(0))


def french_or_iso_date(c: Column) -> Column:
    """A day written dd/mm/yyyy or yyyy-mm-dd; null otherwise."""
    return F.coalesce(F.try_to_date(c, "dd/MM/yyyy"), F.try_to_date(c, "yyyy-MM-dd"))


def decimal_comma(c: Column) -> Column:
    """A number written with a comma; null if it is none."""
    return F.translate(F.trim(c), ",", ".").try_cast("double")


def price(c: Column) -> Column:
    """A price: zero is absent."""
    return F.nullif(decimal_comma(c), F.lit(0.0))


def truthy(c: Column) -> Column:
    """Whether a text cell says yes; false for anything else."""
    return F.coalesce(F.lower(F.trim(c)).isin("1", "true", "t", "yes", "oui", "vrai"), F.lit(False))


def entity_id(kind: str, source: Column, identifier: Column) -> Column:
    """Stable id ``type:source:identifier``."""
    return F.concat_ws(":", F.lit(kind), source, identifier)


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words of a label, each padded by two blanks before and one after."""
    words = F.filter(F.split(address_label(c), " "), lambda w: F.length(w) > 0)
    of_word = lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))
    )
    return F.array_distinct(F.flatten(F.transform(words, of_word)))


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two trigram arrays."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def bands(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Label of the half-open band that holds a value; null for null."""
    out = F.lit(last)
    for edge, label in reversed(edges):
        out = F.when(value < edge, label).otherwise(out)
    return F.when(value.isNotNull(), out)


def first_usable(c: Column, length: int) -> Column:
    """The first characters of the first non-null element of an array of ids."""
    return F.substring(F.get(F.filter(c, lambda x: x.isNotNull() & (F.length(x) >= length)), F.lit(0)), 1, length)


def id_key(c: Column) -> Column:
    """The letters and digits of an id, in upper case, for a search by its beginning."""
    return F.regexp_replace(F.upper(c), "[^0-9A-Z]", "")


def code_prefix(c: Column) -> Column:
    """The code before the first bar of a typed code."""
    return F.split(c, r"\|")[0]


def cell_code(cell: Sequence[Column], codes: dict[tuple[str, ...], str]) -> Column:
    """The indicator of a cube cell by the values of its dimensions; null for cells that the map does not hold."""
    out = F.lit(None).cast("string")
    for values, code in codes.items():
        same = F.lit(True)
        for c, v in zip(cell, values):
            same = same & (c == v)
        out = F.when(same, code).otherwise(out)
    return out


def facility_code(domain: Column, subdomain: Column, total: str = "_T") -> Column:
    """The indicator of a count of facilities: of all, of a domain, or of a part of one."""
    of_domain = F.concat(F.lit("equipements_domaine_"), F.lower(domain))
    return F.when(domain == total, "equipements_total").when(subdomain == total, of_domain).otherwise(F.concat(F.lit("equipements_sous_domaine_"), F.lower(subdomain)))
