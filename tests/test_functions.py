"""Value fixtures of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from arealoom import functions as A
from arealoom.functions import vocab


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn("t")).collect()]


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


PERIODS = {
    "20211231": "2021-12-31", "202112": "2021-12-31", "2021_12": "2021-12-31", "44561": "2021-12-31",
    "11007": None, "2021-Q4": "2021-12-31", "Q4 2021": "2021-12-31", "2021Q1": "2021-03-31",
    "Q4 FY21/22": "2022-06-30", "FY2021-22 Q2": "2021-12-31", "Q1 2021-22": "2021-09-30", "Jun-2021": "2021-06-30",
    "Mar 26": "2026-03-31", "Feb 2024": "2024-02-29", "02/2024": "2024-02-29", "03/2022": "2022-03-31",
    "Data as at 30 June 2021": "2021-06-30", "as at 30-Jun-21": "2021-06-30", "Reporting period: June 2021": "2021-06-30",
    "2021-06-30": "2021-06-30", "30/06/2021": "2021-06-30", "31 Feb 2021": None, "1999-12-31": None, "n.p.": None,
    "2021-12": "2021-12-31", "": None, "June 30, 2021": "2021-06-30", "2036-01-01": None, "20211301": None,
    "101021007": None, "2021 12 31": "2021-12-31", "30 06 2021": None, "d|2021|1|1": None, "35000": None,
    "Quarter ending 31 December 2021": "2021-12-31", "September 2021": "2021-09-30", "Sept 21": "2021-09-30",
}


def test_parse_period(spark):
    got = values(spark, list(PERIODS), A.parse_period)
    assert dict(zip(PERIODS, got)) == {k: day(v) for k, v in PERIODS.items()}


def test_month_labels_can_give_day_one(spark):
    assert values(spark, ["Dec 2021", "30 Dec 2021"], lambda c: A.parse_period(c, "first")) == [
        day("2021-12-01"), day("2021-12-30"),
    ]


TEXTS = {
    "data 2122 Q3 and as at 31 December 2021": ["2021-12-31", "2022-03-31"],
    "participants_202112_01.csv": ["2021-12-31"],
    "q4 fy21/22, then 30/06/2022": ["2022-06-30"],
    "june_2021 release": ["2021-06-30"],
    "code 101021007": [],
}


def test_extract_periods(spark):
    got = values(spark, list(TEXTS), A.extract_periods)
    assert dict(zip(TEXTS, got)) == {k: [day(d) for d in v] for k, v in TEXTS.items()}


def test_parse_measure(spark):
    cases = {
        "1,234": 1234.0, "$12.50": 12.5, "45%": 45.0, "<5": None, ">100": None, "n.p.": None, "np": None, "-": None,
        "": None, "suppressed": None, "abc": None, " $ 7 ": 7.0, "1 234": None, "1d": None, "NaN": None, "-3.5": -3.5,
        "1e3": 1000.0, "inf": None,
    }
    assert dict(zip(cases, values(spark, list(cases), A.parse_measure))) == cases
    assert values(spark, ["999", "99"], lambda c: A.parse_measure(c, ["999"])) == [None, 99.0]


def test_suppressed_tokens_are_null(spark):
    tokens = vocab.SUPPRESSED + [t.upper() for t in vocab.SUPPRESSED]
    assert set(values(spark, tokens, A.parse_measure)) == {None}
    assert set(values(spark, tokens, A.parse_period)) == {None}


def test_remoteness_order(spark):
    names = list(vocab.REMOTENESS_ORDER)
    assert values(spark, names, lambda c: A.map_values(c, vocab.REMOTENESS_ORDER)) == [0, 1, 2, 3, 4]
    assert values(spark, names[:2], A.short_label) == ["Major Cities", "Inner Regional"]


def test_norm_code(spark):
    cases = {" 101021007.0 ": "101021007", "1 01": "101", "00123": "00123", "nan": None, "None": None, "": None,
             "﻿ 12": "12", ".0": None}
    assert dict(zip(cases, values(spark, list(cases), A.norm_code))) == cases
    assert values(spark, ["PHN 101 ", "a-b"], lambda c: A.norm_code(c, "alnum")) == ["PHN101", "AB"]
    assert values(spark, [" x y "], lambda c: A.norm_code(c, "keep")) == ["x y"]


def test_short_code(spark):
    assert values(spark, ["101021007", "11007", "1234", None], A.short_code) == ["11007", "11007", None, None]


def test_publication_status(spark):
    cases = {"n.p.": "not_published", "": "not_available", "n/a": "not_available", "1,234": "published_numeric",
             "about 5": "published_non_numeric", "<5": "published_non_numeric"}
    assert dict(zip(cases, values(spark, list(cases), A.publication_status))) == cases


def test_key_tokens(spark):
    assert values(spark, ["PHN 101, x 27"], lambda c: A.key_tokens(c, "PHN")) == [["PHN101,x27", "PHN101", "27"]]
    assert values(spark, ["a 101021007 b"], lambda c: A.key_tokens(c, "SA2")) == [["a101021007b", "101021007"]]
    assert values(spark, ["City of Perth (C)", "LGA"], lambda c: A.key_tokens(c, "LGA_name")) == [["perth"], []]


def test_slug_and_names(spark):
    assert values(spark, ["Rent & Own (%)", "", "***"], A.slug) == ["rent_and_own", "unnamed", "unnamed"]
    assert values(spark, ["% of (x) $"], lambda c: A.slug(c, 50, "bare")) == ["pct_of_dollar"]
    assert values(spark, ["North & West PHN", "Shire of Foo (S)"], A.name_key) == ["north and west", "foo"]


def test_strip_tags(spark):
    text = ["<b>a&amp;lt;</b>&nbsp;&mdash; x"]
    assert values(spark, text, A.strip_tags) == ["a&lt; &mdash; x"]
    assert values(spark, text, lambda c: A.strip_tags(c, True)) == ["a&lt; — x"]


@pytest.mark.parametrize("n, letters", [(1, "A"), (26, "Z"), (27, "AA"), (702, "ZZ"), (703, "AAA"), (16384, "XFD")])
def test_column_letters(spark, n, letters):
    assert spark.range(1).select(A.column_letters(F.lit(n))).first()[0] == letters


def test_path_parts(spark):
    df = spark.createDataFrame([("raw\\abs\\A.b.CSV",), ("raw/.extracted",)], "p string")
    rows = [tuple(r) for r in df.select(*A.path_parts("p", "raw").values()).collect()]
    assert rows == [("abs/A.b.CSV", "A.b.CSV", ".csv", "abs"), (".extracted", ".extracted", "", "")]


def test_classify_binds_and_defaults(spark):
    rules = [("pension", r"\bpension\b"), ("any", ".")]
    assert values(spark, ["Age-Pension", "x", ""], lambda c: A.classify(A.match_text(c), rules, "none")) == [
        "pension", "any", "none",
    ]
