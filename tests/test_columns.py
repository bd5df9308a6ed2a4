import math

import pytest
from pyspark.sql import functions as F

from tidewright.functions import columns as fx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [("12", 12), (" -7", -7), ("12.7", 12), ("12abc", 12), ("NA", None), ("", None),
                                       ("99999999999", None)])
def test_lenient_int(spark, text, want):
    assert one(spark, fx.lenient_int(F.lit(text))) == want
    assert one(spark, fx.lenient_int(F.lit(text), blank="zero")) == (want or 0)


@pytest.mark.parametrize("text,want", [("3.5kg", 3.5), (".5", 0.5), ("1e3", 1000.0), ("x", None)])
def test_lenient_double(spark, text, want):
    assert one(spark, fx.lenient_double(F.lit(text))) == want


@pytest.mark.parametrize("lat,lon,angle,region", [
    (0.0, 1.0, 360.0, 3),      # due east: the sector index 12 lands on 3
    (1.0, 0.0, 270.0, 0),      # due north
    (0.0, -1.0, 180.0, 9),     # due west
    (-1.0, 0.0, 90.0, 6),      # due south
])
def test_bearing_and_region(spark, lat, lon, angle, region):
    a = fx.bearing(F.lit(0.0), F.lit(0.0), F.lit(lat), F.lit(lon))
    assert math.isclose(one(spark, a), angle)
    assert one(spark, fx.compass_region(a)) == region


def test_delay_status_counts_missing_as_on_time(spark):
    got = [one(spark, fx.delay_status(F.lit(v).cast("int"))) for v in (None, 10, 11, 45, 46)]
    assert got == ["ontime", "ontime", "delay_minor", "delay_minor", "delay_major"]
    assert one(spark, fx.delay_status(F.lit(50), (10, 60))) == "delay_minor"


def test_dates(spark):
    assert str(one(spark, fx.date_of(F.lit("2013-7-1 x")))) == "2013-07-01"
    assert one(spark, fx.date_of(F.lit("NA"))) is None
    assert one(spark, F.date_format(fx.instant_of(F.lit("2013-07-01"), F.lit("9:05:07")), "HH:mm:ss")) == "09:05:07"
    assert one(spark, F.date_format(fx.instant_of(F.lit("2013-07-01"), F.lit("09:05")), "HH:mm:ss")) == "09:05:00"
    assert one(spark, fx.instant_of(F.lit("2013-07-01"), F.lit("x"))) is None


def test_words_and_titles(spark):
    assert one(spark, fx.words(F.lit(" a  B\nc\t \t"), lower=True)) == ["a", "b", "c\t"]
    assert one(spark, fx.title_year(F.lit("Heat (1995)"))) == 1995
    assert one(spark, fx.title_year(F.lit("Heat"))) is None
    assert one(spark, fx.without_leading_quote(F.lit('"a"'))) == 'a"'


def test_access_log(spark):
    good = '1.2.3.4 - "ann" [01/Feb/2020:10:00:00 +0100] "GET /a HTTP/1.1" 200 315 "http://x/" "agent"'
    cases = [(good, ("1.2.3.4", '"ann"', "GET /a HTTP/1.1", 315)),
             (good.replace(" 315 ", " - "), ("1.2.3.4", '"ann"', "GET /a HTTP/1.1", 0)),
             (good.replace('"ann"', '"-"'), (None, None, None, 315)),
             ("nonsense", (None, None, None, 0))]
    for line, want in cases:
        assert tuple(one(spark, fx.access_log(F.lit(line)))) == want


def test_clamp_and_above(spark):
    assert [one(spark, fx.clamp(F.lit(x), 0, 1)) for x in (-1.0, 0.5, 3.0)] == [0.0, 0.5, 1.0]
    assert [one(spark, fx.above(F.lit(x), 0)) for x in (0.0, 0.1)] == [0.0, 1.0]
