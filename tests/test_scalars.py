from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as fn
from tests.conftest import rows


def one(spark, column, schema="x string", data=(("a",),)):
    return spark.createDataFrame(list(data), schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("order_day, as_of, legacy, expected", [
    (date(2024, 12, 5), date(2025, 1, 10), False, date(2025, 1, 1)),     # year boundary
    (date(2024, 12, 5), date(2025, 1, 10), True, None),                  # month number 12 > 1
    (date(2024, 1, 5), date(2025, 1, 10), False, date(2025, 1, 1)),      # same month of last year
    (date(2024, 1, 5), date(2025, 1, 10), True, date(2024, 1, 5)),
    (date(2025, 1, 5), date(2025, 1, 10), False, date(2025, 1, 5)),
    (date(2025, 2, 1), date(2025, 1, 10), False, None),
    (None, date(2025, 1, 10), False, None),
])
def test_posting_date(spark, order_day, as_of, legacy, expected):
    assert one(spark, fn.posting_date("d", as_of, legacy), "d date", [(order_day,)]) == expected


def test_null_parts_are_skipped(spark):
    assert one(spark, fn.concat_skip_null("x", F.lit("-OBH-"), F.lit(None))) == "a-OBH-"


def test_month_end_clamps(spark):
    assert one(spark, F.add_months("d", -1), "d date", [(date(2025, 3, 31),)]) == date(2025, 2, 28)
    assert one(spark, fn.end_of_last_month("d"), "d date", [(date(2025, 3, 31),)]) == date(2025, 2, 28)
    assert fn.period_day("2025-02", 31) == date(2025, 2, 28)
    assert fn.period_day("2024-12", 31) == date(2024, 12, 31)


def test_shift_period():
    assert fn.shift_period("2025-01", -1) == "2024-12"
    assert fn.shift_period("2024-12", 1) == "2025-01"


def test_unit_price_zero_and_rounding(spark):
    price = fn.unit_price("a", "q")
    schema = "a decimal(18,2), q int"
    assert one(spark, price, schema, [(Decimal("10.00"), 0)]) is None
    assert one(spark, price, schema, [(Decimal("1.01"), 2)]) == Decimal("0.51")     # half away from zero
    assert one(spark, price, schema, [(Decimal("-1.01"), 2)]) == Decimal("-0.51")


def test_positive_gap(spark):
    gap = fn.positive_gap("e", "i")
    schema = "e decimal(10,2), i decimal(10,2)"
    for e, i, want in (("5", "3", 2), ("3", "5", 0), (None, "5", 0), ("5", None, 5)):
        data = [(e and Decimal(e), i and Decimal(i))]
        assert one(spark, gap, schema, data) == want


def test_contains_empty_needle(spark):
    assert one(spark, fn.contains("x", F.lit("")))
    assert one(spark, fn.contains("x", F.lit(None))) is None


def test_date_text(spark):
    day = [(date(2024, 3, 5),)]
    want = {"YYYYMMDD": "20240305", "YYMMDD": "240305", "MonYYYY": "Mar2024", "MONYYYY": "MAR2024", "YY": "24", "MM": "03"}
    for pattern, text in want.items():
        assert one(spark, fn.date_text("d", pattern), "d date", day) == text


def test_in_period_is_half_open(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 31),), (date(2025, 2, 1),), (None,)], "d date")
    assert rows(df.where(fn.in_period("d", "2025-01"))) == [(date(2025, 1, 1),), (date(2025, 1, 31),)]
