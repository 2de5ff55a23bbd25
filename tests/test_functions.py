import pytest
from pyspark.sql import functions as F

from tarmac.functions.codes import decode, encode, lookup_url, month_url
from tarmac.functions.keys import surrogate_key
from tarmac.functions.rates import half_even, percent


@pytest.fixture
def one(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    return value


def test_known_codes(one):
    assert one(encode(F.lit("L_CANCELLATION"))) == "Y_PNaPRYYNgVba"
    assert one(decode(F.lit("Y_PNaPRYYNgVba"))) == "L_CANCELLATION"
    assert one(decode(F.lit("gnoyr_VQ=FGJ"))) == "Table_ID=236"
    assert one(encode(F.lit("NT2"))) == "agF"
    assert one(encode(encode(F.lit("A")))) != "A"


def test_addresses(one):
    assert one(month_url(F.lit(2024), F.lit(1))).endswith("_1987_present_2024_1.zip")
    assert one(lookup_url(F.lit("L_CANCELLATION"))).endswith("=Y_PNaPRYYNgVba")


def test_key_spells_out_nulls(spark):
    import hashlib

    row = spark.createDataFrame([(2024, None, "AA")], "y int, m int, c string")
    text = "2024-_dbt_utils_surrogate_key_null_-AA"
    expected = hashlib.md5(text.encode()).hexdigest()
    assert row.select(surrogate_key(["y", "m", "c"])).first()[0] == expected


def test_rounding_is_half_even(one):
    assert one(half_even(F.lit(0.125), 2)) == 0.12
    assert one(half_even(F.lit(0.375), 2)) == 0.38
    assert one(percent(F.lit(1), F.lit(8), 1)) == 12.5
    assert one(percent(F.lit(1), F.lit(0), 1)) is None
