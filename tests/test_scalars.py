import datetime as dt

import pytest
from pyspark.sql import functions as F

from estatelens.functions import scalars as S

PRICE_CASES = [
    ("$1,250,000", 1250000.0), ("$1.1m - $1.2m", 1150000.0),
    ("$1,100,000 - $1,200,000", 1150000.0), ("$850k", 850000.0),
    ("$1200k", 1200.0), ("Contact Agent", None), ("", None), (None, None),
    ("$", None), ("1,100,000", None), ("$1 million", 1.0),
    ("From $1m", 1000000.0), ("$500,0000", 500000.0),
    ("$650,000 to $700,000", 675000.0), ("$700,000 - 750,000", 700000.0),
    ("$620,000 - $650,000 FHOG applies", 620000.0), ("$ 450,000", 450000.0),
    ("$1.23456m", 1234000.0), ("$500,000 – $550,000", 525000.0),
    ("$780k-$820k", 800000.0), ("Offers over $1.5M", 1500000.0),
    ("2-bed unit $500,000 + $20,000", 260000.0), ("$850 000", 850.0),
]


def test_price_parser_golden(spark):
    df = spark.createDataFrame([(t,) for t, _ in PRICE_CASES], "t string")
    got = [r[0] for r in df.select(S.parse_price("t")).collect()]
    want = [v for _, v in PRICE_CASES]
    for (t, w), g in zip(PRICE_CASES, got):
        assert (g is None and w is None) or abs(g - w) < 1e-6, (t, g, w)


def test_dates_and_rounding(spark):
    df = spark.createDataFrame([("1 Jan 2020",), ("10 DEC 2012",), ("2020-01-01",),
                                ("31 Feb 2020",), ("1 January 2020",)], "t string")
    got = [r[0] for r in df.select(S.parse_listing_date("t")).collect()]
    assert got == [dt.date(2020, 1, 1), dt.date(2012, 12, 10), None, None, None]
    r = spark.range(1).select(S.round_thousand(F.lit(2500.0)), S.round_thousand(F.lit(3500.0)),
                              S.distance_to_cbd_km(F.lit(None).cast("double"), F.lit(1.0))).first()
    assert r[0] == 2000.0 and r[1] == 4000.0 and r[2] is None


def test_deal_and_bucket(spark):
    df = spark.createDataFrame([(1_000_000.0, 905_000.0), (1_000_000.0, None),
                                (1_000_000.0, 1_200_000.0), (1_000_000.0, 850_000.0)],
                               "p double, a double")
    prod = [r[0] for r in df.select(S.deal_signal("p", "a")).collect()]
    nb = [r[0] for r in df.select(S.deal_signal("p", "a", basis="asking")).collect()]
    assert prod == ["Fair", "No Asking Price", "Overpriced", "Good Deal"]
    assert nb[0] == "Good Deal"
    b = spark.createDataFrame([(500000.0,), (500001.0,), (0.0,), (25e6,)], "x double")
    assert [r[0] for r in b.select(S.price_bucket("x")).collect()] == \
        ["<500k", "500-750k", None, None]


def test_land_unit(spark):
    df = spark.createDataFrame([("2", "ha"), ("3", "hectares"), ("500", "m²"), ("abc", "m")],
                               "s string, u string")
    got = [r[0] for r in df.select(S.land_size_sqm("s", "u")).collect()]
    assert got == [20000.0, 30000.0, 500.0, None]
