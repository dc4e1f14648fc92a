from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from assay.functions import lenient_date, lenient_double, lenient_int
from assay.operators import cast_orders

INTS = [
    "3", "+3", "-3", "003", "0", "-0", "3.7", "-3.7", "+3.7", "3.", "-3.", ".5", "-.5", ".", "+.", "-.",
    " 5 ", "\t5\n", "\r5", " 5.7 ", "\x005", "5 5", "5. 7", "", " ", "+", "-", "abc", "1e2", "1.5e2",
    "3.7.1", "1,000", "0x10", "NaN", "Infinity", "2147483647", "2147483648", "-2147483648",
    "-2147483649", "2147483647.9", "2147483648.1", "00000000000000012", "00000000000000012.5", "٣",
    "3d", "3.0f", None,
]

DATES = [
    "2024-01-05", "2024-1-5", " 2024-01-05 ", "2024-01-05T10:11:12", "2024-01-05 10:11:12", "2024",
    "2024-03", "01/05/2024", "20240105", "2024-02-30", "2024-13-01", "", "not-a-date", None,
]

DOUBLES = ["9.99", " 9.99 ", "1e2", "-1.50", "NaN", "Infinity", "-Infinity", "1,000", "", "x", "5d", None]


def _both(spark, values, ours, legacy_type):
    """Our value beside that of the plain cast in non-ANSI mode, for each text."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    mine = [r[0] for r in df.select(ours(F.col("v"))).collect()]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [r[0] for r in df.select(F.col("v").cast(legacy_type)).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    return mine, plain


@pytest.mark.parametrize(
    "values, ours, legacy",
    [
        (INTS, lenient_int, "int"),
        (DATES, lenient_date, "date"),
        (DOUBLES, lenient_double, "double"),
    ],
)
def test_same_as_cast_without_ansi(spark, values, ours, legacy):
    mine, plain = _both(spark, values, ours, legacy)
    shown = [(v, m, p) for v, m, p in zip(values, mine, plain) if repr(m) != repr(p)]
    assert shown == []


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_input_is_null_in_both_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = (
            spark.createDataFrame([("abc",)], "v string")
            .select(lenient_int(F.col("v")), lenient_date(F.col("v")), lenient_double(F.col("v")))
            .first()
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert tuple(row) == (None, None, None)


def test_typed_sources_are_not_read_as_text(spark):
    """A double of 1.0E7 is ten million, though its text would not parse as a whole number."""
    row = (
        spark.sql(
            "SELECT 7L AS order_id, timestamp_ntz'2024-01-05 10:11:12' AS order_date, 8 AS customer_id,"
            " 'US' AS country, 'Widget A' AS product, 1.0E7D AS quantity, 9.99 AS unit_price"
        )
        .transform(cast_orders)
        .first()
    )
    assert (row["order_id"], row["customer_id"], row["quantity"]) == ("7", "8", 10_000_000)
    assert str(row["order_date"]) == "2024-01-05" and row["unit_price"] == 9.99


def test_int_of_other_types(spark):
    df = spark.sql("SELECT 3.9D AS d, 3e10D AS big")
    row = df.select(
        lenient_int(F.col("d"), df.schema["d"].dataType),
        lenient_int(F.col("big"), df.schema["big"].dataType),
        lenient_int(F.lit("4.9"), StringType()),
    ).first()
    assert tuple(row) == (3, None, 4)
