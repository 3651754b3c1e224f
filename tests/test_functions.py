import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks import functions as fn


def values(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_ageing_boundaries(spark):
    rows = [(d,) for d in (-1, 29, 30, 31, 59, 60, 90, 91, None)]
    got = values(spark, "d int", rows, fn.ageing_bucket(F.col("d")))
    assert got == [
        "Current",
        "Current",
        "Over 30 Days",
        "31-59 Days",
        "31-59 Days",
        "60-90 Days*",
        "60-90 Days*",
        "Over 91 Days*",
        "",
    ]


def test_ageing_days_counts_from_the_column_to_the_as_of_date(spark):
    assert values(spark, "d date", [(dt.date(2024, 1, 1),)], fn.ageing_days(F.col("d"), "2024-01-31")) == [30]


def test_div0_keeps_null_and_maps_zero_divisor(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (None, 0.0), (1.0, None), (0.0, 0.0)]
    assert values(spark, "a double, b double", rows, fn.div0(F.col("a"), F.col("b"))) == [0.5, 0.0, None, None, 0.0]


@pytest.mark.parametrize(("tol", "inside", "outside"), [("0.05", "0.0500", "0.0501"), ("0.1", "0.1000", "0.1001")])
def test_tolerance_edges(spark, tol, inside, outside):
    rows = [(Decimal(s + v),) for v in (inside, outside) for s in ("", "-")] + [(None,)]
    d = F.col("d")
    assert values(spark, "d decimal(10,4)", rows, fn.within_tolerance(d, tol)) == [True, True, False, False, None]
    assert values(spark, "d decimal(10,4)", rows, fn.outside_tolerance(d, tol)) == [False, False, True, True, None]


def test_month_filter_wraps_in_january(spark):
    days = [dt.date(2023, 12, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2022, 12, 5), None]
    got = values(spark, "d date", [(d,) for d in days], fn.in_month(F.col("d"), dt.date(2024, 1, 15), -1))
    assert got == [True, True, False, False, None]
    assert fn.month_bounds(dt.date(2024, 1, 15), -1) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert fn.month_bounds(dt.date(2024, 2, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_month_key_has_no_leading_zero(spark):
    assert values(spark, "d date", [(dt.date(2024, 3, 9),)], fn.month_key(F.col("d"))) == ["2024/3"]


def test_digit_dates(spark):
    rows = [("20240229",), ("00000000",), ("20240230",), ("x",), (None,)]
    parsed = values(spark, "s string", rows, fn.parse_yyyymmdd(F.col("s")))
    assert parsed == [dt.date(2024, 2, 29), None, None, None, None]
    kept = fn.digits_between(F.col("s"), dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert values(spark, "s string", [("20240229",), ("20240301",), ("20240215x",)], kept)[:2] == [True, False]


def test_digits_to_time(spark):
    rows = [("101530",), ("000000",), ("240000",), ("1015",), (None,)]
    assert values(spark, "s string", rows, fn.digits_to_time(F.col("s"))) == ["10:15:30", "00:00:00", None, None, None]


def test_proper_number_text(spark):
    rows = [("1234.50",), ("0",), ("-1234567.885",), ("12.3",), ("9999999999.99",), (None,)]
    got = values(spark, "s string", rows, fn.format_ptbr(F.col("s").cast("decimal(30,6)"), 2))
    assert got == ["1.234,50", "0,00", "-1.234.567,89", "12,30", "9.999.999.999,99", None]


def test_printed_number_text_of_the_original(spark):
    x = fn.comma_decimal(F.col("d"))
    two = fn.format_ptbr_compat(x)
    rows = [(Decimal(v),) for v in ("1.00", "123.45", "1234.50", "12345.67", "123456.78", "1234567.89", "123456789.01")]
    assert values(spark, "d decimal(18,2)", rows, two) == [
        "1,00",
        "123,45",
        "1.234,50",
        "12.345,67",
        "123.456,78",
        "1.234.567,89",
        "123.456.789,01",
    ]
    # ten digits stay ungrouped, a minus sign counts as a place, four decimals lose the first two
    assert values(spark, "d decimal(18,2)", [(Decimal("1234567890.12"),)], two) == ["1234567890,12"]
    assert values(spark, "d decimal(18,2)", [(Decimal("-123.45"),)], two) == ["-.123,45"]
    assert values(spark, "d decimal(18,4)", [(Decimal("1234.5678"),)], two) == ["1.234,78"]
    by_width = fn.format_ptbr_compat(x, tail_by_width=True)
    rows = [(Decimal("1234.567"),), (Decimal("12345.678"),), (Decimal("12.345"),)]
    assert values(spark, "d decimal(20,3)", rows, by_width) == ["1.234,567", "12.345,,678", "12,345"]


def test_keys_and_masks(spark):
    c = F.col("c")
    assert values(spark, "c string", [("12345678000195",)], fn.mask_tax_id(c)) == ["12.345.678/0001-95"]
    assert values(spark, "c string", [("a",), (None,)], fn.access_key(c, F.lit("b"))) == ["ab", None]
    assert values(spark, "c string", [("a",), (None,)], fn.text_key(c, F.lit("b"))) == ["ab", "b"]
    padded = fn.pad_key(c, F.col("k"), "Warehouse", 10)
    assert values(spark, "c string, k string", [("12", "Warehouse"), ("12", "X"), ("12", None)], padded) == [
        "12",
        "0000000012",
        "0000000012",
    ]
    cut = fn.strip_prefix(c, ("DEBIT NOTE ", "ND "))
    assert values(spark, "c string", [("DEBIT NOTE 7",), ("ND 8",), ("N 9",), ("ND ",)], cut) == ["7", "8", "N 9", ""]
    assert values(spark, "c string", [("BRPD",), ("X",), (None,)], fn.remap(c, {"BRPD": "BRPA"})) == ["BRPA", "X", None]


def test_signed_and_flags(spark):
    a, m = F.col("a"), F.col("m")
    assert values(spark, "a int, m string", [(5, "S"), (5, "H"), (5, None)], fn.signed(a, m)) == [5, -5, -5]
    assert values(spark, "a int", [(1,), (2,), (None,)], fn.flag(F.col("a") == 1)) == [1, 0, 0]
    rate = fn.override_by_prefix(m, F.col("a"), ("3", "4"), F.lit(0))
    assert values(spark, "a int, m string", [(7, "31"), (7, "51"), (7, None)], rate) == [0, 7, 7]


def test_charge_share_is_exact(spark):
    rows = [(Decimal("100.10"), Decimal("33.25"), Decimal("60")), (Decimal("100.10"), None, Decimal("60"))]
    df = spark.createDataFrame(rows, "v decimal(18,2), p decimal(7,2), q decimal(7,2)")
    got = [r[0] for r in df.select(fn.charge_share(df, F.col("v"), F.col("p"), F.col("q"))).collect()]
    assert got == [Decimal("19.96995000000000"), Decimal("0E-14")]


def test_strip_prefix_keeps_long_texts_whole(spark):
    df = spark.range(1).select(F.concat(F.lit("NC "), F.repeat(F.lit("x"), (1 << 20) + 5)).alias("t"))
    assert df.select(F.length(fn.strip_prefix(F.col("t"), ("NC ",))).alias("n")).first().n == (1 << 20) + 5
