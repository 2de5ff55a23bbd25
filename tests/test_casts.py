"""Strict casts: what is accepted, what is null and what fails."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarmac.functions.casts import iso_date, strict_casts


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def session(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.unset("spark.sql.ansi.enabled")


def cast_one(session, text, dtype, **options):
    df = session.createDataFrame([(text,)], "v string")
    return strict_casts(df, {"v": dtype}, **options).first().v


@pytest.mark.parametrize(
    ("text", "dtype", "value"),
    [
        ("0.00", "tinyint", 0),
        ("1.00", "tinyint", 1),
        ("0005", "int", 5),
        ("-0.00", "tinyint", 0),
        ("7.", "smallint", 7),
        (".00", "int", 0),
        (" 12.00 ", "int", 12),
        ("1e2", "int", 100),
        ("-127.000", "tinyint", -127),
        ("3.4028234e38", "float", 3.4028234663852886e38),
        (" 12 ", "int", 12),
        ("-128", "tinyint", -128),
        ("2147483647", "int", 2147483647),
        ("12.5", "float", 12.5),
        ("-3", "float", -3.0),
        ("NA", "string", None),
        ("", "string", None),
        ("#N/A", "int", None),
        ("NaN", "float", None),
        ("-nan", "float", None),
        ("null", "tinyint", None),
        (None, "int", None),
        ("N12", "string", "N12"),
    ],
)
def test_accepted(session, text, dtype, value):
    assert cast_one(session, text, dtype) == value


@pytest.mark.parametrize(
    ("text", "dtype"),
    [
        ("1.5", "tinyint"),
        ("300", "tinyint"),
        ("-32769", "smallint"),
        ("2147483648", "int"),
        ("abc", "int"),
        ("1d", "float"),
        ("1.2.00", "int"),
        ("128.00", "tinyint"),
        (".", "int"),
        ("1e39", "float"),
        ("-1e39", "float"),
        ("Infinity", "float"),
        ("-inf", "float"),
        ("1.00d", "int"),
        ("7F", "int"),
        ("x", "float"),
    ],
)
def test_refused(session, text, dtype):
    with pytest.raises(PySparkException, match=f"v: not a valid {dtype}"):
        cast_one(session, text, dtype)


def test_other_missing_words(session):
    assert cast_one(session, "NA", "string", na_tokens=("",)) == "NA"
    assert cast_one(session, "-9999", "int", na_tokens=("-9999",)) is None
    assert cast_one(session, "it's", "string", na_tokens=("it's", "\\")) is None


def test_iso_date(session):
    def parse(text):
        df = session.createDataFrame([(text,)], "v string")
        return df.select(iso_date(F.col("v"))).first()[0]

    assert parse("2024-01-31") == datetime.date(2024, 1, 31)
    assert parse(None) is None
    for bad in ("20240131", "2024-13-01", "soon"):
        with pytest.raises(PySparkException):
            parse(bad)
