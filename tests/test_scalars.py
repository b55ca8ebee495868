import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, ns",
    [
        ("2026-09-16T10:00:00.123456789Z", 1789552800123456789),
        ("2026-09-16 10:00:00", 1789552800000000000),
        ("2026-09-16T11:30:00+01:30", 1789552800000000000),
        ("1789552800123456789", 1789552800123456789),
        ("1789552800123", 1789552800123000000),
        ("1789552800", 1789552800000000000),
        ("20260916T100000", 1789552800000000000),
        ("20260916T1000", 1789552800000000000),
        ("20260916T113000.123456789+0130", 1789552800123456000),
        ("2026-09-16T10", 1789552800000000000),
        ("2026-09-16T10:00:00,5Z", 1789552800500000000),
        ("2026-W38-3T10:00:00Z", 1789552800000000000),
        ("2026W383T100000", 1789552800000000000),
        ("2026-W38", 1789344000000000000),
        ("2026-W54-1", None),
        ("20261316T100000", None),
        ("\t2026-09-16T10:00:00Z\u00a0", 1789552800000000000),
        ("", None),
        ("INVALID_DATE_STRING", None),
        ("-100", None),
        ("2026-02-30T00:00:00Z", None),
        ("5000000000", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, ns):
    assert one(spark, S.parse_timestamp_ns, text) == ns


@pytest.mark.parametrize(
    "text, canonical",
    [("$1,250.75", "1250.75"), ("150.2500", "150.2500"), (".5", "0.5"), ("5.", "5"), ("1.5e3", "1500"), ("12e-4", "0.0012"), ("-007.0", "-7.0"), ("NaN", None), ("1e9999999999", None), ("abc", None), ("", None), (None, None)],
)
def test_decimal_text(spark, text, canonical):
    assert one(spark, lambda v: S.format_decimal(S.lexeme(v)), text) == canonical


def test_identity(spark):
    got = spark.range(1).select(S.trade_id(F.lit("AAPL"), F.lit(1789552800100000000), F.lit("150.25"), F.lit("100"), F.lit("BUY"), F.lit("NASDAQ"), F.lit(None))).first()[0]
    assert got == "66b853f96664bca3431e5538b9c856e1257890cb2496d285a6656a9d7326dbc6"


@pytest.mark.parametrize("text, want", [("12.30", "12.30"), ("-0.5", "-0.5"), ("12\n", "12"), ("007.10", "7.10"), ("5.", "5"), ("1e3", "1000"), ("$1,250.75", "1250.75"), ("x", None), ("9" * 70, None)])
def test_canonical_decimal(spark, text, want):
    assert one(spark, S.canonical_decimal, text) == want == one(spark, lambda v: S.format_decimal(S.lexeme(v)), text)


@pytest.mark.parametrize("text, ns", [("99999999999999999", None), ("4102444800000000", 4102444800000000000), ("4102444801", None), ("0", 0), ("100000000000000000", 100000000000000000)])
def test_epochs_at_their_limits(spark, text, ns):
    assert one(spark, S.parse_timestamp_ns, text) == ns
