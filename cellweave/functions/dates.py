"""Date expressions: ISO texts, day-first and month-first texts, spreadsheet day numbers.

A text is rewritten to ``y-m-d time`` by an anchored pattern and then cast. The cast is a
hand-written JVM parser, far cheaper on bad values than format-driven parsing, which throws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}:[0-9]{2})?$"

# What makes a text look like it holds a date, anywhere, in any case.
DATE_TOKEN = (
    r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}"
    r"|j(?:an|un|ul|uin|uil)|f(?:eb|évr|evr)|m(?:ar|ay|ai)|a(?:pr|ug|vr)|sep|oct|nov|d(?:ec|éc)"
)

_TIME = r"(?:[ T]+([0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?))?$"
_AB = r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]"
_MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)

# The texts that are both a plain number and a date.
BARE = "^(?:[0-9]{4}|[0-9]{8})$"

# Accepted forms by overall shape, with their rewriting to ``y-m-d time``. A leading space marks the
# forms with the year last, which are read month first here and may be read day first.
FORMS = (
    (
        "^[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]",
        (
            (_AB + "([0-9]{4})" + _TIME, " $3-$1-$2 $4"),
            (_AB + "([0-5][0-9]|6[0-8])" + _TIME, " 20$3-$1-$2 $4"),
            (_AB + "(69|[7-9][0-9])" + _TIME, " 19$3-$1-$2 $4"),
        ),
    ),
    (
        "^[0-9]{4}[-/.][0-9]",
        (
            (r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})" + _TIME, "$1-$2-$3 $4"),
            (r"^([0-9]{4})[-/]([0-9]{1,2})$", "$1-$2-1"),
        ),
    ),
    (
        BARE,
        ((r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3"), (r"^([0-9]{4})$", "$1-1-1")),
    ),
    ("^[0-9]{1,2}[-/][0-9]{4}$", ((r"^([0-9]{1,2})[-/]([0-9]{4})$", "$2-$1-1"),)),
)
WORD_FORMS = (
    ("(?i)^([0-9]{1,2})[ -]" + _MONTH + "[ -]([0-9]{4})" + _TIME, "$3-$2-$1 $4"),
    ("(?i)^" + _MONTH + " ([0-9]{1,2}),? ([0-9]{4})" + _TIME, "$3-$1-$2 $4"),
    ("(?i)^" + _MONTH + "[ -]([0-9]{4})$", "$2-$1-1"),
)
WORD_SHAPE = "(?i)^(?:[0-9]{1,2}[ -])?[a-z]{3,9}[ -][0-9][-0-9,.:T ]{3,}$"
# What all accepted forms with digits only look like; keeps most texts away from the patterns.
DIGIT_SHAPE = "^[0-9][-0-9/.T: ]{3,}$"

# The commonest date, in two digits, two digits and four, needs no rewriting by pattern.
TWO_TWO_FOUR = "^[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}$"

PLAUSIBLE = "^ ?[0-9]{4}-(?:0?[1-9]|1[0-2])-(?:0?[1-9]|[12][0-9]|3[01])(?:[ T]|$)"

# Nanosecond time covers 1677-09-21 to 2262-04-11; dates outside are no dates here either.
_FIRST, _AFTER = "1677-09-22", "2262-04-12"
SERIAL_LIMIT = 132_321.0
SERIAL_MIN = 60.0


def has_date_token(c: Column) -> Column:
    return F.lower(c).rlike(DATE_TOKEN)


def parse_iso(c: Column) -> Column:
    return in_range(F.when(c.rlike(ISO), to_timestamp(c)))


def is_in_range(ts: Column) -> Column:
    first, after = (F.lit(d).cast("timestamp_ntz") for d in (_FIRST, _AFTER))
    return (ts >= first) & (ts < after)


def in_range(ts: Column) -> Column:
    return F.when(is_in_range(ts), ts)


def _rewrite(c: Column, forms: tuple[tuple[str, str], ...]) -> Column:
    for pattern, replacement in forms:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _month_to_number(rewritten: Column) -> Column:
    month = F.lower(F.regexp_extract(rewritten, "-([A-Za-z]{3})", 1))
    number = F.floor((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), month) + 2) / 3)
    return F.regexp_replace(rewritten, F.lit("[A-Za-z]+"), number.cast("string"))


def _plain(c: Column, begin: str, month: int, day: int) -> Column:
    """The commonest date rewritten, given where its month and day begin; null for other texts."""
    parts = (F.lit(begin), F.substring(c, 7, 4), F.lit("-"), F.substring(c, month, 2), F.lit("-"), F.substring(c, day, 2), F.lit(" "))
    return F.when((F.length(c) == 10) & c.rlike(TWO_TWO_FOUR), F.concat(*parts))


def date_text(c: Column) -> Column:
    """Rewrite a date text to ``y-m-d time``, reading year-last texts month first.

    Each pattern is anchored and leaves other texts as they are, so a text takes one form at most;
    what has none stays as it is and does not parse. Year-first texts always mean y-m-d, so ISO
    dates never swap day and month.
    """
    digits = F.coalesce(*[F.when(c.rlike(shape), _rewrite(c, forms)) for shape, forms in FORMS])
    other = F.when(c.rlike(DIGIT_SHAPE), digits).when(c.rlike(WORD_SHAPE), _month_to_number(_rewrite(c, WORD_FORMS)))
    return F.coalesce(_plain(c, " ", 1, 4), other)


def swap_day_month(rewritten: Column) -> Column:
    """The day-first reading of ``date_text``: only year-last texts differ."""
    return F.regexp_replace(rewritten, "^ ([0-9]+)-([0-9]+)-([0-9]+)", "$1-$3-$2")


def day_first_text(c: Column) -> Column:
    """``date_text`` read day first; the commonest date is put together at once."""
    return F.coalesce(_plain(c, "", 4, 1), swap_day_month(date_text(c)))


def to_timestamp(rewritten: Column) -> Column:
    """Cast ``y-m-d time``; null for what is no date.

    Casting a month 13 raises and catches an exception inside the JVM, so test the ranges first.
    """
    return F.when(rewritten.rlike(PLAUSIBLE), rewritten.try_cast("timestamp_ntz"))


def parse_date(c: Column, day_first: bool) -> Column:
    return in_range(to_timestamp(day_first_text(c) if day_first else date_text(c)))


def from_serial(v: Column, upper: float) -> Column:
    """Timestamp for a spreadsheet day number between 60 and ``upper``, else null."""
    micros = F.round(v * F.lit(86_400e6)).cast("long")
    ok = (v >= SERIAL_MIN) & (v <= upper) & (v < SERIAL_LIMIT)
    return F.when(ok, F.timestamp_add("MICROSECOND", micros, F.lit("1899-12-30").cast("timestamp_ntz")))


def has_time(ts: Column) -> Column:
    return ts != ts.cast("date").cast("timestamp_ntz")
