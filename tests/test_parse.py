import datetime as dt
from decimal import Decimal

from conftest import values
from pyspark.sql import functions as F

from tidewater.functions import parse as fp


DAYS = [dt.date(1899, 12, 31), dt.date(1969, 12, 31), dt.date(1970, 1, 2), dt.date(1985, 2, 28), dt.date(2004, 2, 29),
        dt.date(2031, 11, 5)]


def spellings(day):
    """ISO, day/month/year and, for days whose milliseconds have 12 or 13 digits, the epoch."""
    ms = (day - dt.date(1970, 1, 1)).days * 86_400_000
    return [day.isoformat(), day.strftime("%d/%m/%Y"), f" {day.isoformat()} "] + ([str(ms)] if len(str(ms)) in (12, 13) else [])


def test_a_day_is_read_from_each_of_its_spellings(spark):
    pairs = [(text, day) for day in DAYS for text in spellings(day)]
    assert values(spark, fp.parse_date_multi, [t for t, _ in pairs]) == [d for _, d in pairs]


def test_what_is_no_day_is_null(spark):
    texts = ["primero de mayo", "", None, "2001-02-29", "31/04/2010", "12-05-2010", "9" * 25]
    assert values(spark, fp.parse_date_multi, texts) == [None] * len(texts)


def test_reading_a_read_day_again_changes_nothing(spark):
    texts = [t for day in DAYS for t in spellings(day)]
    again = lambda c: fp.parse_date_multi(fp.parse_date_multi(c).cast("string"))
    assert values(spark, again, texts) == values(spark, fp.parse_date_multi, texts)


def test_money_in_every_spelling_of_an_amount(spark):
    amounts = [Decimal("0.00"), Decimal("7.25"), Decimal("98765.40"), Decimal("-310.99")]
    texts = [f(a) for a in amounts for f in (str, lambda a: f"${a}" if a >= 0 else str(a), lambda a: f" {a:,} ")]
    assert values(spark, fp.parse_money, texts) == [a for a in amounts for _ in range(3)]
    assert values(spark, fp.parse_money, ["", "NaN", "abc", None]) == [None] * 4
    assert values(spark, fp.parse_money, ["0.125", "-0.125"]) == [Decimal("0.13"), Decimal("-0.13")]


def test_age_and_validity(spark):
    df = spark.createDataFrame([(dt.date(1980, 9, 2),), (dt.date(1990, 1, 1),), (dt.date(1890, 1, 1),),
                                (dt.date(2000, 1, 1),), (None,)], "b date")
    rows = df.select(fp.age_years("b", "2001-09-01").alias("a"), fp.valid_age("b", "2001-09-01").alias("v")).collect()
    assert [r.a for r in rows] == [20, 11, 111, 1, None]
    assert [r.v for r in rows] == [True, False, False, False, False]


def test_monthly_rate_guard(spark):
    df = spark.createDataFrame([(10, 29), (10, 30), (10, None)], "v int, d int")
    out = [r[0] for r in df.select(fp.monthly_rate("v", "d")).collect()]
    assert out[0] is None and abs(out[1] - 10 / (30 / 30.44)) < 1e-12 and out[2] is None


def test_pct_change(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 0.0)], "a double, b double")
    out = [r[0] for r in df.select(fp.pct_change(F.col("a"), F.col("b"))).collect()]
    assert out == [100.0, None]
