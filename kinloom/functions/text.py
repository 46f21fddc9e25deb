"""Text normalisation as column expressions: whitespace, names, addresses, countries, tokens.

All but one run inside Spark; compatibility composition (NFKC) has no built-in function, so it is an
Arrow function, which ASCII text skips within. Every function treats null as the empty string.
"""

from __future__ import annotations

import unicodedata
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .words import COUNTRY_CODES, LEGAL_FORMS, NULL_CELLS, NULL_WORDS

#: Word characters and white space, as the golden vectors have them: marks are no word characters.
W = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"


@pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition."""
    return text.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


def filled(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


#: What counts as white space once a text is cleaned: zero-width blanks too.
BLANKS = SPACE[:-1] + r"\u200b\ufeff]+"


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def is_null_word(c: Column, trimmed: bool = True) -> Column:
    return F.lower(strip(c) if trimmed else c).isin(*NULL_WORDS)


def is_blank(c: Column) -> Column:
    """Empty, white space alone, or a word for null."""
    return (strip(filled(c)) == "") | is_null_word(filled(c))


def cell_kind(c: Column) -> Column:
    """null, empty, whitespace or valid."""
    return (
        F.when(c.isNull() | c.isin(*NULL_CELLS), "null").when(F.length(c) == 0, "empty")
        .when(strip(c) == "", "whitespace").otherwise("valid")
    )


def clean(c: Column, compose: bool = True) -> Column:
    """NFKC, lower case, plain single blanks; a word for null becomes empty."""
    c = filled(c)
    base = F.when(F.lower(c).isin(*NULL_WORDS), "").otherwise(nfkc(c) if compose else c)
    return F.trim(F.regexp_replace(F.lower(base), BLANKS, " "))


#: Signs that separate words, in names and in addresses.
_SIGNS = r""",;:/\\|()\[\]{}"~`!@#$%^*_=?<>"""
_LETTER = r"[\p{L}\p{N}]"


def _joined(signs: str) -> str:
    """Runs of signs, blanks, and hyphens and apostrophes that don't stand between two letters or digits; one pass."""
    return rf"(?:[{signs}{SPACE[1:-1]}]|[-'](?:(?!{_LETTER})|(?<!{_LETTER}[-'])))+"


_NAME_GAPS, _ADDRESS_GAPS = _joined(_SIGNS), _joined(_SIGNS + "&")


def _without_dots(c: Column) -> Column:
    """Without the dots that end a word, and without those that stand alone."""
    ended = F.regexp_replace(c, rf"\.(?={SPACE}|$)(?<={W}\.)", "")
    return F.when(ended.contains(" ."), F.regexp_replace(ended, rf"{SPACE}+\.{SPACE}+", " ")).otherwise(ended)


def normal_name(cleaned: Column) -> Column:
    """A cleaned name with & and + as words, without dots of abbreviations, signs as blanks, inner hyphens kept."""
    spelled = F.replace(F.replace(cleaned, F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" and "))
    plain = F.regexp_replace(spelled, rf"\.(?={W}(?!{W}))(?<=(?<!{W}){W}\.)", "")
    return F.trim(F.regexp_replace(_without_dots(plain), _NAME_GAPS, " "))


def normal_address(cleaned: Column) -> Column:
    """A cleaned address without dots of abbreviations, signs (& too) as blanks, inner hyphens kept."""
    return F.trim(F.regexp_replace(_without_dots(cleaned), _ADDRESS_GAPS, " "))


def alnum(normal: Column) -> Column:
    """Letters, digits and marks alone, others as blanks."""
    return F.trim(F.regexp_replace(normal, r"[^\p{L}\p{N}\p{M}]+", " "))


def alnum_name(normal: Column) -> Column:
    """``alnum`` of a normal name that is cleaned and normalised once more; without a dot in it that changes nothing."""
    again = F.when(normal.contains("."), alnum(normal_name(clean(normal, False)))).otherwise(alnum(normal))
    return F.when(normal.isin(*NULL_WORDS), "").otherwise(again)


def alnum_address(normal: Column) -> Column:
    """``alnum`` of a normal address that is cleaned and normalised once more, which only blanks words for null."""
    return F.when(normal.isin(*NULL_WORDS), "").otherwise(alnum(normal))


def without_forms(normal: Column) -> Column:
    """A name without the legal forms it ends with; empty if nothing else is in it."""
    forms = "|".join(LEGAL_FORMS)
    cut = F.regexp_replace(normal, rf"[ \-]+(?:{forms})(?:[ \-]+(?:{forms}))*$", "")
    return F.regexp_replace(cut, r"^[ \-]+|[ \-]+$", "")


def name_core(normal: Column, cut: Column | None = None) -> Column:
    """A name without the legal forms it ends with, unless nothing else is in it.

    ``cut`` is ``without_forms`` of it, if that is a column already.
    """
    cut = without_forms(normal) if cut is None else cut
    return F.when(cut == "", normal).otherwise(cut)


def normal_country(cleaned: Column) -> Column:
    """A country's code where its name is known, else its cleaned name."""
    codes = F.create_map(*[F.lit(x) for pair in COUNTRY_CODES.items() for x in pair])
    bare = squeeze(F.regexp_replace(cleaned, r"""^[ .,;:\-_()\[\]'"]+|[ .,;:\-_()\[\]'"]+$""", ""))
    without_dots = F.replace(bare, F.lit("."), F.lit(""))
    return F.coalesce(F.try_element_at(codes, bare), F.try_element_at(codes, without_dots), bare)


def word_tokens(c: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_extract_all(c, F.lit(f"({W}+)"), F.lit(1))


def blank_tokens(c: Column) -> Column:
    """What blanks separate, each once."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def number_tokens(c: Column) -> Column:
    """Runs of digits between word boundaries, each once."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"(?<!{W})(\p{{Nd}}+)(?!{W})"), F.lit(1)))


def trigrams(c: Column) -> Column:
    """Windows of three characters, each once; none of shorter text."""
    windows = lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.size(x) - 3, F.lit(0))), lambda i: F.concat(x[i], x[i + 1], x[i + 2]))
    made = F.array_distinct(F.transform(F.array(F.split(c, "")), windows)[0])  # split once, whatever the length
    return F.when(F.length(c) >= 3, made).otherwise(F.array().cast("array<string>"))


def target_source(c: Column, mode: str = "strict") -> Column:
    """Which source an id belongs to.

    ``strict``: s2 or s3 before a hyphen or underscore or within underscores, else Unknown; ``lenient``:
    as strict, but Source 3 for the rest; ``prefix``: only the beginning counts, Source 3 for the rest;
    ``underscore``: s2_ or s3_ in either case, else Unknown.
    """
    low = F.lower(c)
    is_ = lambda k: low.rlike(f"^{k}[-_]") | low.contains(f"_{k}_")
    if mode == "strict":
        return F.when(is_("s2"), "Source 2").when(is_("s3"), "Source 3").otherwise("Unknown")
    if mode == "lenient":
        return F.when(is_("s2"), "Source 2").otherwise("Source 3")
    if mode == "prefix":
        return F.when(low.rlike("^s2[_-]."), "Source 2").otherwise("Source 3")
    if mode == "underscore":
        return F.when(low.startswith("s2_"), "Source 2").when(low.startswith("s3_"), "Source 3").otherwise("Unknown")
    raise ValueError(f"unknown mode: {mode}")
