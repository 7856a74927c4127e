"""Golden rows for every column function."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee import functions as mf

CASES = {
    "trim_ws": (mf.trim_ws, {"\xa0a\t": "a", None: None, "  ": "", "\u2028x\u3000": "x", "\x1cx": "\x1cx", "\u200bx": "\u200bx"}),
    "norm_text": (mf.norm_text, {"\x1cX ": "x", None: None}),
    "is_null_token": (mf.is_null_token, {"": True, "[]": True, "N/A": True, None: True, "0": False}),
    "null_tokens": (mf.null_tokens, {"": None, "  ": None, "[]": None, "N/A": None, "n/a": None, None: None, "0": "0"}),
    "null_if_in": (mf.null_if_in, {"NA": None, "None": None, "": None, "nan": None, "No": "No", None: None}),
    "list_text_or_null": (
        mf.list_text_or_null,
        {" ['a'] ": "['a']", "[]": None, "plain": None, "[a\nb]": None, None: None, "[a\u2028b]": "[a\u2028b]"},
    ),
    "malformed_list": (mf.malformed_list, {"[a]": False, "x": True, "[a]\n": True, None: False, "[]": False}),
    "clean_title": (
        mf.clean_title,
        {"12.  The 3. Thing": "The 3. Thing", "5. N/A": None, " 7. X": "7. X", "10.5 x": "5 x", None: None},
    ),
    "clean_link": (
        mf.clean_link,
        {"https://h/title/tt012/?ref=a?b": "https://h/title/tt012/", "https://h/none": "https://h/none", "?x": None},
    ),
    "extract_id": (mf.extract_id, {"https://h/title/tt012/": "tt012", "https://h/none": None, None: None}),
    "parse_rating": (
        mf.parse_rating,
        {" 7.5 ": 7.5, "11.5": 10.0, "0.2": 1.0, "bad": None, "1.0d": None, None: None, ".5": 1.0, "5.": 5.0, "1e1": 10.0,
         "7f": None, "NaN": None},
    ),
    "parse_score": (mf.parse_score, {"85.0": 85, "85.9": 85, "130": 100, "-3.7": 0, "x": None, None: None, "99999999999": None}),
    "parse_release_date": (
        mf.parse_release_date,
        {"7/18/2008": date(2008, 7, 18), "2008-07-18": date(2008, 7, 18), "18-07-2008": date(2008, 7, 18),
         "July 18, 2008": date(2008, 7, 18), "unknown": None, "N/A": None, "[]": None, "July 2008": date(2008, 7, 1),
         "2008": date(2008, 1, 1), "25/12/2008": date(2008, 12, 25), "Jul 4, 2001": date(2001, 7, 4),
         "4 July 2001": date(2001, 7, 4), "May 1999": date(1999, 5, 1), "99/99/2001": None, None: None,
         "2008-07-18 00:00:00": date(2008, 7, 18), "2008-07-18T01:02:03": date(2008, 7, 18), "July 18 2008": date(2008, 7, 18),
         "Jul. 18, 2008": date(2008, 7, 18), "Sept 5, 2008": date(2008, 9, 5), "Sept. 5, 2008": date(2008, 9, 5),
         "18-Jul-2008": date(2008, 7, 18), "2008-07": date(2008, 7, 1), "20080718": date(2008, 7, 18), "7/18/08": date(2008, 7, 18),
         "7/18/99": date(1999, 7, 18), "7/18/68": date(2068, 7, 18), "7/18/69": date(1969, 7, 18), "2008.07.18": date(2008, 7, 18), "July 18th, 2008": date(2008, 7, 18),
         "1st May 2001": date(2001, 5, 1), "August 5, 2008": date(2008, 8, 5), "20081318": None, "2008.13.01": None},
    ),
    "duration_minutes": (
        mf.duration_minutes,
        {"1h 30m": 90, "1h30m": 90, "90 min": 90, "90": 90, "45 minutes": 45, "2 Hours": 120, "2h": 120, "1:15": 75,
         "1h": 60, "1h 30min": -1, "PG-13": -1, "90.0": -1, None: -1, "h 30m": -1, "1 minute": 1, "\xa030m": 30,
         "99999999999999999999": -1, "9223372036854775807h": -1, "1h 30": -1, "": -1},
    ),
    "is_duration": (mf.is_duration, {"1h 30m": True, "PG-13": False, None: True, "1h 30min": False, "1:15": True}),
    "rating_group": (
        mf.rating_group,
        {"R": "mature", "tv-ma ": "mature", "Approved": "parental_guidance", "NC-17": "adults_only", "weird": "unrated",
         None: "unrated", "13+": "teen", "G": "general"},
    ),
    "rating_min_age": (mf.rating_min_age, {"mature": "17", "general": "0", "unrated": "unrated", None: "unrated"}),
    "rating_min_age_int": (mf.rating_min_age_int, {"mature": 17, "general": 0, "unrated": None}),
    "parse_votes": (
        mf.parse_votes,
        {"1.2K": 1200, "3M": 3000000, "2.01k": 2009, "8.2m": 8199999, "77": 77, "1,234": -1, "abc": -1, "5.5": -1,
         None: -1, "k": -1, "1e30k": -1, "": -1},
    ),
    "clean_money": (mf.clean_money, {"$1\u202f000\xa0": "$1,000", None: None}),
    "money_amount": (mf.money_amount, {"$1,000.50": Decimal("1000.50"), "x": None, None: None}),
    "strip_parens": (mf.strip_parens, {"\xa0(1.2K)": "1.2K", None: None, "": "", "x": ""}),
    "before": (mf.before, {"July 18, 2008 (USA)": "July 18, 2008", "x": "x", None: None}),
    "text_to_list": (
        mf.text_to_list,
        {"['a\\xa0b', \"O'B\"]": ["a\xa0b", "O'B"], "[]": [], "plain": None, "['\\\\x41']": ["\\x41"]},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_golden(column, name):
    function, cases = CASES[name]
    assert column(function, list(cases)) == list(cases.values())


def test_rating_code(column):
    values = [-1.0, 0.0, 7.5, 10.0, 7.25, 11.0, None]
    assert column(mf.rating_code, values, "double") == [0, 1, 76, 101, None, None, None]
    grid = [round(i / 10, 1) for i in range(101)]
    assert column(mf.rating_code, grid, "float") == list(range(1, 102))


def test_year_fallback(spark):
    df = spark.createDataFrame(
        [(None, " 1999"), (None, "1999.0"), (date(2001, 2, 3), "1999"), (None, "99999999"), (None, None)], "d date, y string"
    )
    rows = df.select(
        mf.date_or_year(F.col("d"), F.col("y")), mf.date_or_year(F.col("d"), F.col("y"), lenient=True)
    ).collect()
    first = date(1999, 1, 1)
    assert [tuple(r) for r in rows] == [
        (first, first), (None, first), (date(2001, 2, 3), date(2001, 2, 3)), (None, None), (None, None)
    ]


def test_missing_flag(spark):
    df = spark.createDataFrame([(-1, 5), (7, -1), (7, 5)], "r int, v int")
    assert [r[0] for r in df.select(mf.missing_flag(df.r, df.v)).collect()] == [True, True, False]


def test_strict_number_fails(spark):
    df = spark.createDataFrame([("x",)], "y string")
    assert df.select(mf.to_number(df.y, strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(mf.to_number(df.y)).collect()


def test_numbers_in_number_columns(column):
    assert column(mf.duration_minutes, [90.0, 90.9, -5.0, None, float("nan")], "double") == [90, 90, -5, -1, -1]
    assert column(mf.duration_minutes, [90, None], "int") == [90, -1]
    assert column(mf.parse_votes, [1200.0, 2.5e7, None], "double") == [1200, 25_000_000, -1]


def test_number_text(column):
    values = ["1999", " 1999.0 ", "1999.5", "x", "1e3", "40000", None, "99999999999"]
    assert column(lambda c: mf.to_number(c, strict=False), values) == [1999, 1999, None, None, 1000, 40000, None, None]
    assert column(mf.to_number, ["1999.0", None]) == [1999, None]


def test_list_prints_as_python_does(column):
    values = [["a\xa0b", "O'B"], [], None, ["a\"b'c", "d\\e", "t\tn\n"], ["plain", "\u2028", "é"]]
    assert column(mf.list_to_text, values, "array<string>") == [None if v is None else repr(v) for v in values]


TEXT = st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Cn", "Co", "Cc", "Cf")), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(TEXT, max_size=4), min_size=1, max_size=40))
def test_list_round_trip(column, lists):
    back = column(lambda c: mf.text_to_list(mf.list_to_text(c)), lists, "array<string>")
    assert back == lists


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(" \t\xa0\u2003\x1ca[]N/.1"), max_size=8), min_size=1, max_size=60))
def test_trim_and_tokens_follow_python(column, texts):
    assert column(lambda c: mf.trim_ws(c, separators=True), texts) == [t.strip() for t in texts]
    once = column(mf.null_tokens, texts)
    assert column(mf.null_tokens, once) == once
