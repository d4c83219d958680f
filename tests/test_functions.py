from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martflow.functions import text, timeparts


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_epoch_keeps_or_drops_milliseconds(spark):
    ms = F.lit(1541106000796).cast("bigint")
    got = one(spark, full=timeparts.from_epoch_ms(ms), cut=timeparts.from_epoch_ms(ms, whole_seconds=True),
              back=timeparts.to_epoch_ms(timeparts.from_epoch_ms(ms)))
    assert got["full"] == datetime(2018, 11, 1, 21, 0, 0, 796000)
    assert got["cut"] == datetime(2018, 11, 1, 21, 0, 0)
    assert got["back"] == 1541106000796


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = one(spark, t=timeparts.from_epoch_ms(F.lit(0).cast("bigint")).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["t"] == "1970-01-01 00:00:00"


def test_weekday_conventions(spark):
    sunday = F.lit("2018-11-04 10:00:00").cast("timestamp_ntz")
    got = one(spark, **{c: timeparts.weekday(sunday, c) for c in timeparts.WEEKDAY_CONVENTIONS})
    assert got == {"monday0": 6, "sunday0": 0, "sunday1": 1, "name": "Sun"}
    with pytest.raises(ValueError):
        timeparts.weekday(sunday, "iso")


def test_text_parts_are_padded(spark):
    moment = F.lit("2018-03-04 05:06:07.891").cast("timestamp_ntz")
    got = one(spark, whole=timeparts.format_start_time(moment), **timeparts.padded_parts(moment))
    assert got == {"whole": "04-03-2018 05:06:07", "hour": "05", "day": "04", "month": "03", "year": "2018"}


def test_week_is_iso(spark):
    got = one(spark, **timeparts.calendar_parts(F.lit("2016-01-01").cast("date")))
    assert got == {"day": 1, "week": 53, "month": 1, "year": 2016, "weekday": 6, "yearday": 1}


@pytest.mark.parametrize(
    ("number", "expected"),
    [(20454.0, date(2016, 1, 1)), (0.0, date(1960, 1, 1)), (-1.0, date(1959, 12, 31)), (None, None)],
)
def test_sas_date(spark, number, expected):
    assert one(spark, d=timeparts.sas_date(F.lit(number).cast("double")))["d"] == expected


@pytest.mark.parametrize(
    ("value", "pattern", "expected"),
    [
        ("2000-01-02", "yyyy-MM-dd", date(2000, 1, 2)),
        ("02/01/2000", "dd/MM/yyyy", date(2000, 1, 2)),
        ("31/02/2000", "dd/MM/yyyy", None),
        ("soon", "yyyy-MM-dd", None),
        (None, "yyyy-MM-dd", None),
    ],
)
def test_parse_date(spark, value, pattern, expected):
    assert one(spark, d=timeparts.parse_date(F.lit(value).cast("string"), pattern))["d"] == expected


def test_element_is_null_when_missing(spark):
    got = one(
        spark,
        there=text.element(F.lit("US-CA"), "-", 1),
        missing=text.element(F.lit("US"), "-", 1),
        literal=text.element(F.lit("a.b"), ".", 1),
        null=text.element(F.lit(None).cast("string"), "-", 1),
    )
    assert got == {"there": "CA", "missing": None, "literal": "b", "null": None}


def test_commas_become_spaces_and_null_stays_null(spark):
    got = one(spark, a=text.commas_to_spaces(F.lit("a,b,,c")), b=text.commas_to_spaces(F.lit(None).cast("string")))
    assert got == {"a": "a b  c", "b": None}


@pytest.mark.parametrize(
    ("value", "expected"), [("2.7", 2), ("-2.7", -2), ("12", 12), (" 5 ", 5), ("", None), ("0=x", None), (None, None), ("9e99", None)]
)
def test_to_int(spark, value, expected):
    assert one(spark, n=text.to_int(F.lit(value).cast("string")))["n"] == expected


def test_blank_to_null(spark):
    got = one(spark, a=text.blank_to_null(F.lit("  ")), b=text.blank_to_null(F.lit("x")))
    assert got == {"a": None, "b": "x"}


def test_exact_number_rounds_to_its_scale(spark):
    got = one(spark, a=text.exact_number(F.lit(495.5), 0).cast("int"), b=text.exact_number(F.lit("x")))
    assert got == {"a": 496, "b": None}
