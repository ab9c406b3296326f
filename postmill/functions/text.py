"""Normal forms of address texts, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and what they are folded to, position by position.
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: Letters folded to two.
LIGATURES = (("œ", "oe"), ("æ", "ae"), ("ß", "ss"))
#: Short forms by the word they stand for.
SHORT_FORMS = {
    "avenue": ("av", "ave", "aven"),
    "boulevard": ("bd", "bvd", "blvd", "boul", "bld"),
    "route": ("rt", "rte"),
    "rue": ("r",),
    "chemin": ("ch", "che", "chem"),
    "place": ("pl",),
    "impasse": ("imp",),
    "allee": ("all", "allees"),
    "square": ("sq",),
    "cours": ("crs",),
    "faubourg": ("fg", "fbg"),
    "docteur": ("dr",),
    "saint": ("st",),
    "sainte": ("ste",),
    "general": ("gal", "gen"),
    "marechal": ("mal",),
    "president": ("pdt",),
    "professeur": ("pr", "prof"),
    "street": ("str",),
    "road": ("rd",),
    "lane": ("ln",),
    "drive": ("drv",),
}
#: Words that name a kind of street.
STREET_TYPES = ("allee", "avenue", "boulevard", "chaussee", "chemin", "cours", "drive", "faubourg", "impasse", "lane", "passage", "place", "quai", "road", "route", "rue", "sentier", "square", "street", "voie")
#: Words without weight in a street's name.
STOP_WORDS = ("a", "au", "aux", "d", "de", "des", "du", "et", "l", "la", "le", "les", "of", "the")


def fold(x: Column) -> Column:
    """Lower case, without accents, everything but letters and digits as single spaces."""
    out = F.lower(x)
    for letter, two in LIGATURES:
        out = F.replace(out, F.lit(letter), F.lit(two))
    return F.trim(F.regexp_replace(F.translate(out, ACCENTED, PLAIN), r"[^\p{L}\p{N}]+", " "))


def expand(folded: Column) -> Column:
    """Short forms written out, word by word."""
    known = F.create_map(*(F.lit(v) for word, shorts in SHORT_FORMS.items() for short in shorts for v in (short, word)))
    return F.array_join(F.transform(F.split(folded, " "), lambda t: F.coalesce(F.try_element_at(known, t), t)), " ")


def without(expanded: Column, words: tuple[str, ...]) -> Column:
    return F.array_join(F.filter(F.split(expanded, " "), lambda t: ~t.isin(*words)), " ")


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x with x computed once, however often f uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def core(expanded: Column) -> Column:
    """What is left without kinds of street and words without weight; all of it if nothing is."""
    return bound(expanded, lambda e: bound(without(e, STREET_TYPES + STOP_WORDS), lambda rest: F.when(rest == "", e).otherwise(rest)))


def number_key(x: Column) -> Column:
    """House number with its suffix pulled to it: '4 bis' and '4bis' agree."""
    return F.regexp_replace(fold(x), r"(\d) (bis|ter|quater|[a-z])$", "$1$2")


def postcode_key(x: Column) -> Column:
    return F.upper(F.regexp_replace(x, r"\s+", ""))


def trimmed(x: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def null_to_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))
