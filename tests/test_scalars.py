import sys
import unicodedata
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.functions import booleans, dates, numbers, text



def test_fold(column):
    got = column(["  Été FAÇADE\xa0", "ﬁn ½", "Straße", "Œuvre", None], lambda c: text.fold(c))
    assert got == ["ete facade", "fin 1⁄2", "straße", "œuvre", None]


def fold_by_hand(value):
    plain = unicodedata.normalize("NFKD", value)
    return "".join(ch for ch in plain if not unicodedata.combining(ch)).lower().strip()


def test_fold_covers_all_of_unicode(column):
    values = ["Ångström", "İstanbul", "Ǆ ½ ﬃ ①", "Ελληνικά Ώ", "Привет Й", "é", "Ｆｕｌｌ　ｗｉｄｔｈ", "x²", "…", "12 ㎡", "한글 값", "𝐁𝐨𝐥𝐝 𝟙", "㍿ 豈"]
    assert column(values, lambda c: text.fold(c)) == [fold_by_hand(v) for v in values]
    kept = [chr(i) for i in range(0x20, sys.maxunicode, 7) if unicodedata.category(chr(i)) not in ("Cn", "Co", "Cs", "Cc")]
    got = column([f"a{ch}b" for ch in kept], lambda c: text.fold(c))
    assert [(k, g) for k, g in zip(kept, got) if g != fold_by_hand(f"a{k}b")] == []


def test_integers_of_19_digits(column):
    values = ["1234567890123456789", "-9223372036854775808", "9223372036854775808", "12"]
    got = column(values, lambda c: numbers.to_integer(c).cast("string"))
    assert got[:2] == values[:2] and got[3] == "12" and got[2] != values[2]


def test_snake(column):
    got = column(["N° Dossier.X-1", "  ", None, "Montant  H.T. (€)", "__a__b", "2025"], lambda c: text.snake(c))
    assert got == ["n_dossier_x_1", "col", "col", "montant_h_t", "a_b", "2025"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=30, max_size=60))
def test_snake_is_idempotent(column, values):
    once = column(values, lambda c: text.snake(c))
    assert column(once, lambda c: text.snake(c)) == once
    assert all(v and set(v) <= set("abcdefghijklmnopqrstuvwxyz0123456789_") for v in once)


def test_trim_mask_cut(column):
    assert column([" \xa0a b　\n", "\x1fx"], lambda c: text.trimmed(c)) == ["a b", "x"]
    assert column(["", None, "abc", "abcd", "secret"], lambda c: text.mask(c)) == ["", "", "***", "****", "se**et"]
    assert column(["a" * 70], lambda c: text.cut_identifier(c)) == ["a" * 63]
    assert column(["a\xa0b \xa0"], lambda c: text.clean_text(c)) == ["a b"]


def test_missing_tokens(column):
    assert column(["", "N/A", "nan", "None", "0", " ", "na"], lambda c: text.na_to_null(c)) == [None] * 4 + ["0", " ", "na"]


NUMBERS = ["1.234.567,8", "1 234,5", "1\xa0234", "1 234", "12 €", "1234.567", "1e5", "+3", ".5", "1.", "1d", "inf", "vrai", "1_0", "0x1", "1e400", "", "-", "12.3456"]


@pytest.mark.parametrize(
    "style, want",
    [
        (numbers.PLAIN_SPACES, [1234567.8, 1234.5, 1234, None, None, 1234567, 1e5, 3, 0.5, 1, None, float("inf")] + [None] * 6 + [12.3456]),
        (numbers.WIDE_SPACES, [1234567.8, 1234.5, 1234, 1234, None, 1234567, 1e5, 3, 0.5, 1, None, float("inf")] + [None] * 6 + [12.3456]),
        (numbers.EURO, [1234567.8, 1234.5, 1234, 1234, 12, 1234567, 1e5, 3, 0.5, 1, None, float("inf")] + [None] * 6 + [12.3456]),
        (numbers.NO_WORDS, [1234567.8, 1234.5, 1234, None, None, 1234567, 1e5, 3, 0.5, 1, None, float("inf")] + [None] * 6 + [12.3456]),
    ],
)
def test_number_like(column, style, want):
    assert column(NUMBERS, lambda c: numbers.number_like(c, style)) == want


def test_integers(column):
    assert column(["123456789012345678", "3,0", "1e3", "1e30"], lambda c: numbers.integer_like(c, numbers.EURO)) == [123456789012345678, 3, 1000, None]
    close = column([60000.4, 1.0, 1.1, float("inf")], lambda c: numbers.is_close_to_integral(c), "double")
    assert close == [True, True, False, False]
    assert column([60000.4, 2.0], lambda c: numbers.is_integral(c), "double") == [False, True]


def test_boolean_words(column):
    got = column(["Oui", "NON", "1", "0", "vrai", "n", "peut-être", None], lambda c: booleans.boolean_word(c))
    assert got == [True, False, True, False, True, False, None, None]


DAY_FIRST = {
    "13/02/2025": datetime(2025, 2, 13), "02/13/2025": None, "01.02.25": datetime(2025, 2, 1), "1/2/70": datetime(1970, 2, 1),
    "2025-01-02": datetime(2025, 1, 2), "2025-1-2 3:04": datetime(2025, 1, 2, 3, 4), "2 Jan 2025": datetime(2025, 1, 2),
    "Jan 2, 2025": datetime(2025, 1, 2), "January 2025": datetime(2025, 1, 1), "20250102": datetime(2025, 1, 2),
    "2025": datetime(2025, 1, 1), "01/2025": datetime(2025, 1, 1), "31/04/2025": None, "janv 2025": None, "5 mai 2025": None,
    "45000": None, "202501": None, "1/2/1600": None, "1/2/3000": None, "10:30": None, "2025-02-30": None,
    "2025-01-02T10:30:00.5": datetime(2025, 1, 2, 10, 30, 0, 500000),
}


def test_parse_date_day_first(column):
    assert column(list(DAY_FIRST), lambda c: dates.parse_date(c, True)) == list(DAY_FIRST.values())


def test_parse_date_month_first(column):
    got = column(["13/02/2025", "02/13/2025", "01.02.25", "2025-01-02"], lambda c: dates.parse_date(c, False))
    assert got == [None, datetime(2025, 2, 13), datetime(2025, 1, 2), datetime(2025, 1, 2)]


def test_iso_and_tokens(column):
    got = column(["2025-01-02", "2025-01-02 10:30:00", "2025-1-2", "2025-13-01", "2025-01-02 10:30"], lambda c: dates.parse_iso(c))
    assert got == [datetime(2025, 1, 2), datetime(2025, 1, 2, 10, 30), None, None, None]
    tokens = column(["13/02/25", "le 3 AVRIL", "Décembre", "FÉVRIER", "hello", "3/4", "mois"], lambda c: dates.has_date_token(c))
    assert tokens == [True, True, True, True, False, False, False]


def test_serials(column):
    values = [45000.0, 45000.5, 59.0, 60001.0, 106751.0, 132320.5, 132321.0, float("nan"), float("inf")]
    low = column(values, lambda c: dates.from_serial(c, 60_000.0), "double")
    assert low[:2] == [datetime(2023, 3, 15), datetime(2023, 3, 15, 12)] and low[2:] == [None] * 7
    wide = column(values, lambda c: dates.from_serial(c, 2_950_000.0), "double")
    assert [w is None for w in wide] == [False, False, True, False, False, False, True, True, True]


def test_plain_dates_are_rewritten_as_by_pattern(column):
    texts = ["13/02/2025", "02-13-2025", "99.99.9999", "1/02/2025", "13/02/2025 ", "13/02/25", "2025-02-13", " 13/02/2025"]
    by_pattern = lambda c: F.regexp_replace(c, dates._AB + "([0-9]{4})" + dates._TIME, " $3-$1-$2 $4")
    plain = [t for t in texts if len(t) == 10 and t[2] in "-/."]
    assert column(plain, dates.date_text) == column(plain, by_pattern) == [f" {t[6:]}-{t[:2]}-{t[3:5]} " for t in plain]


def test_numbers_too_large_for_a_double(column):
    texts = ["1" + "0" * 299, "9" * 400, "-" + "9" * 400, "1e400", "-1e400", "1e300", ".5", "0" * 320 + "1", "1d", "12."]
    found = column(texts, numbers.finite_number)
    assert found == [1e299, None, None, None, None, 1e300, 0.5, 1.0, None, 12.0]
