"""Number expressions: strict numbers, French number texts, integral tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as accepted from text; try_cast alone would also take suffixes such as 1d.
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# Numbers that any double holds, as most are; what became of them needs no look.
NEVER_INFINITE = r"^[+-]?(?:[0-9]{1,300}(?:\.[0-9]*)?|\.[0-9]+)$"
# The infinite numbers accepted from text, in any case.
INFINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
THOUSANDS_DOT = r"(?<=[0-9])\.(?=[0-9]{3}(?:[^0-9]|$))"
DOT_BEFORE_THREE = r"\.[^,]*[0-9][^,]*[0-9][^,]*[0-9]"
BOOLEAN_WORD = r"^(?i)(?:true|false|yes|no|vrai|faux)$"


@dataclass(frozen=True)
class NumberStyle:
    """How number texts are cleaned: characters to remove, whether boolean words are blanked."""

    remove: str
    blank_words: bool = False


PLAIN_SPACES = NumberStyle(" \xa0")
WIDE_SPACES = NumberStyle(" \xa0\u202f")
EURO = NumberStyle(" \xa0\u202f€")
NO_WORDS = NumberStyle(" \xa0", blank_words=True)


def finite_number(c: Column) -> Column:
    """Double for a text made of digits as they stand; one too large for a double is no number."""
    number = c.try_cast("double")
    return F.when(c.rlike(NEVER_INFINITE), number).when(c.rlike(NUMBER), F.when(F.abs(number) < float("inf"), number))


def infinite_number(c: Column) -> Column:
    return F.when(F.length(c).between(3, 9) & F.lower(c).isin(*INFINITE), c.try_cast("double"))


def plain_number(c: Column) -> Column:
    """Double for a text that is a number as it stands, else null."""
    return F.coalesce(finite_number(c), infinite_number(c))


def clean_number(c: Column, style: NumberStyle) -> Column:
    """Remove group spaces and thousands dots, turn the decimal comma into a dot."""
    s = c
    for ch in style.remove:
        s = F.replace(s, F.lit(ch), F.lit(""))
    # Most texts have no dot to remove, so look for one before replacing.
    s = F.when(c.contains(".") & c.rlike(DOT_BEFORE_THREE), F.regexp_replace(s, THOUSANDS_DOT, "")).otherwise(s)
    s = F.replace(s, F.lit(","), F.lit("."))
    return F.when(c.rlike(BOOLEAN_WORD), "").otherwise(s) if style.blank_words else s


def number_like(c: Column, style: NumberStyle) -> Column:
    return plain_number(clean_number(c, style))


def to_integer(cleaned: Column) -> Column:
    """Long for a cleaned number text; exact beyond the 53 bits of a double."""
    exact = F.when(cleaned.rlike("^[+-]?[0-9]{1,19}$"), cleaned.try_cast("long"))
    return F.coalesce(exact, F.rint(plain_number(cleaned)).try_cast("long"))


def integer_like(c: Column, style: NumberStyle) -> Column:
    return to_integer(clean_number(c, style))


def is_integral(v: Column) -> Column:
    """No fraction at all (an infinite value is not integral)."""
    return (F.abs(v) < float("inf")) & (v == F.floor(v))


def is_close_to_integral(v: Column) -> Column:
    """Within 1e-8 plus a relative 1e-5 of the rounded value."""
    near = F.rint(v)
    return (F.abs(v) < float("inf")) & (F.abs(v - near) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(near))
