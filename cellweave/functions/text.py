"""Text expressions: trimming, folding accents, identifiers, masking."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts read as "no value" in a cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters Unicode calls white space, plus the four ASCII separators.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

BEYOND_LATIN = "[^\\x00-\\x7fÀ-ÿ]"
IDENTIFIER_LENGTH = 63
NBSP = "\xa0"
FIRST_SYLLABLE, LAST_SYLLABLE = "\uac00", "\ud7a3"


def na_to_null(c: Column) -> Column:
    # Longer texts need no look at the list.
    return F.when((F.octet_length(c) > max(map(len, NA_TOKENS))) | ~c.isin(*NA_TOKENS), c)


def trimmed(c: Column) -> Column:
    """Strip Unicode white space at both ends (plain trim would leave no-break spaces)."""
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return trimmed(c) == ""


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit("0"))


def _fold_char(ch: str) -> str:
    parts = unicodedata.normalize("NFKD", ch)
    return "".join(p for p in parts if not unicodedata.combining(p)).lower()


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Folding rule applied to all of Unicode but the Hangul syllables, which have a rule of their own.

    Returns (characters to replace, their replacements) for ``translate``, with the characters to
    delete at the end of the first string, and the characters which become several.
    """
    one, gone, many = [], [], {}
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):
        if FIRST_SYLLABLE <= ch <= LAST_SYLLABLE or unicodedata.category(ch) in ("Cn", "Co", "Cs"):
            continue
        folded = _fold_char(ch)
        if folded == ch:
            continue
        if len(folded) == 1:
            one.append((ch, folded))
        elif not folded:
            gone.append(ch)
        else:
            many[ch] = folded
    return "".join(a for a, _ in one) + "".join(gone), "".join(b for _, b in one), many


def _jamo(ch: Column) -> Column:
    """A Hangul syllable taken apart by the arithmetic of the standard."""
    def sign(first: int, count: int, nth: Column) -> Column:
        return F.substring(F.lit("".join(chr(first + i) for i in range(count))), nth.cast("int") + 1, F.lit(1))

    number = F.ascii(ch) - ord(FIRST_SYLLABLE)
    tail = number % 28
    return F.concat(
        sign(0x1100, 19, F.floor(number / 588)),
        sign(0x1161, 21, F.floor(number % 588 / 28)),
        F.when(tail > 0, sign(0x11A7, 28, tail)).otherwise(""),
    )


def _is_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def fold(c: Column) -> Column:
    """Lower case without accents, trimmed; for any text, without leaving the JVM."""
    source, target, many = _fold_tables()
    spread = F.from_json(F.lit(json.dumps(many)), "map<string,string>")
    syllable = f"[{FIRST_SYLLABLE}-{LAST_SYLLABLE}]"
    expanded = F.array_join(
        F.transform(
            F.split(c, ""),
            lambda ch: F.coalesce(F.try_element_at(spread, ch), F.when(ch.rlike(syllable), _jamo(ch)), ch),
        ),
        "",
    )
    # The first test settles nearly all texts; the second removes the characters and looks for a loss.
    lost = F.length(F.translate(c, "".join(many), "")) < F.length(c)
    has_many = c.rlike(BEYOND_LATIN) & (lost | c.rlike(syllable))
    with_many = F.when(has_many, expanded).otherwise(c)
    folded = F.when(_is_ascii(c), c).otherwise(F.translate(with_many, source, target))
    return trimmed(F.lower(folded))


def snake(c: Column) -> Column:
    """Identifier in snake case; empty or null becomes ``col``."""
    s = F.regexp_replace(fold(c), f"[{SPACES}.-]+", "_")
    s = F.regexp_replace(s, "[^a-z0-9_]", "_")
    s = F.btrim(F.regexp_replace(s, "_+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("col"))


def clean_text(c: Column) -> Column:
    return trimmed(F.translate(c, NBSP, " "))


def cut_identifier(c: Column) -> Column:
    return F.substring(c, 1, IDENTIFIER_LENGTH)


def mask(c: Column) -> Column:
    """Keep two characters at each end; short secrets become stars only."""
    n = F.length(c)
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "")
        .when(n <= 4, F.repeat(F.lit("*"), n))
        .otherwise(F.concat(F.left(c, F.lit(2)), F.repeat(F.lit("*"), n - 4), F.right(c, F.lit(2))))
    )


def word_pattern(words: tuple[str, ...]) -> str:
    """Regular expression matching any of the words anywhere."""
    return "|".join("".join("\\" + ch if ch in r".+*?()[]{}|^$\\" else ch for ch in w) for w in words)


def has_any(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike(word_pattern(words)) if words else F.lit(False)
