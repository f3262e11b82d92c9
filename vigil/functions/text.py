"""Text normalisers as column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, with the separators U+001C to U+001F that Java leaves out.
SPACES = r"(?U)[\s\x{1C}-\x{1F}]+"


@cache
def _folding() -> tuple[str, str]:
    """Characters whose decomposition without combining marks is one other character, and those characters."""
    pairs = []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(bare) == 1 and bare != chr(code):
            pairs.append((chr(code), bare))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def strip(c: Column) -> Column:
    """c without Unicode white space at its ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def non_empty(c: Column) -> Column:
    """c stripped, null if nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def first_of(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[non_empty(c) for c in columns])


def fold_accents(c: Column) -> Column:
    """c without accents; letters that don't decompose, as in LODZ with a stroke, stay."""
    return F.regexp_replace(F.translate(c, *_folding()), r"\p{Mn}+", "")


def normalize_text(c: Column) -> Column:
    """Without accents, upper case, single spaces; null if empty. Punctuation stays."""
    return F.nullif(strip(F.upper(F.regexp_replace(fold_accents(c.cast("string")), SPACES, " "))), F.lit(""))


def match_name(c: Column) -> Column:
    """normalize_text, then only A-Z and spaces; null if empty."""
    return F.nullif(F.trim(F.regexp_replace(normalize_text(c), "[^A-Z ]", "")), F.lit(""))


def clean_document(c: Column) -> Column:
    """A document number in upper case without spaces, hyphens and dots; null only where the raw one is null or empty."""
    return F.when(F.length(c) > 0, F.regexp_replace(F.upper(c), r"[\s\-.]", ""))


def full_name(first: Column, last: Column, null_token: str | None = None) -> Column:
    """Both names; a null one is left out, or written as null_token where that is given."""
    rest = F.lit(null_token or "")
    return strip(F.concat(F.coalesce(first, rest), F.lit(" "), F.coalesce(last, rest)))


def first_word_and_rest(c: Column) -> tuple[Column, Column]:
    """The first word, and the others (null if none)."""
    words = F.filter(F.split(strip(c), SPACES), lambda w: w != "")
    rest = F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " ")
    return F.get(words, 0), F.nullif(rest, F.lit(""))
