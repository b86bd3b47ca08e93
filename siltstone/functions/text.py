"""Word casing and whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words for INITCAP in the warehouse dialect
# (whitespace and this punctuation); an apostrophe does not separate words.
WORD_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""

WHITESPACE = " \t\n\r\u000b\u000c"


def _upper_first_of_each(pieces: Column) -> Column:
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))),
        "",
    )


def initcap_words(text: Column) -> Column:
    """INITCAP that also starts a word after punctuation (`sci-fi` -> `Sci-Fi`).

    The built-in `initcap` breaks words on spaces only.
    """
    pieces = F.regexp_extract_all(F.lower(text), F.lit(f"([^{WORD_BREAKS}]+|[{WORD_BREAKS}]+)"), F.lit(1))
    return _upper_first_of_each(pieces)


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters (an apostrophe does start a word)."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return _upper_first_of_each(pieces)


def strip(text: Column, characters: str = WHITESPACE) -> Column:
    """Strip `characters` from both ends; linear, unlike an anchored regex."""
    return F.btrim(text, F.lit(characters))


def collapse_whitespace(text: Column) -> Column:
    """Runs of (Unicode) whitespace become one space; ends are stripped."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def path_safe(identifier: Column) -> Column:
    """Identifier usable as a file name: `/` and space become `_`."""
    return F.translate(identifier, "/ ", "__")
