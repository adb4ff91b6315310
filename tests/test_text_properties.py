"""Casts and masks over thousands of drawn texts, against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowsieve.functions import (
    int_value,
    masked_timestamp,
    non_negative,
    number_value,
    pattern_found,
    type_class,
)
from rowsieve.functions.scalar import BOOLEAN_BIT, FRACTIONAL_BIT, INTEGRAL_BIT, STRING_BIT

SEED_TEXTS = ["", " ", "-", "+", ".", "0", "-0", "007", "true", "TRUE", "2147483647", "2147483648",
              "-2147483648", "-2147483649", "9223372036854775808", "1e5", "NaN", "١٢", "é", "1_0"]


def drawn(rng, alphabet, longest, n):
    return ["".join(rng.choices(alphabet, k=rng.randrange(longest + 1))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    found = [*SEED_TEXTS, *drawn(rng, "0123456789", 11, 2000), *drawn(rng, "+-.eE01 9", 6, 4000)]
    found += drawn(rng, "NXYtrue", 4, 500)
    return sorted(set(found))


@pytest.fixture(scope="module")
def dates():
    rng = random.Random(12)
    found = {"2015-8-3", "2015-08-31 10:00:00", "02015-08-31", " 2015-08-31", "2015-08-31 ", "2016-02-29"}
    for _ in range(4000):
        y, m, d = rng.randrange(1900, 2100), rng.randrange(0, 14), rng.randrange(0, 33)
        found.add(f"{y:04d}-{m:02d}-{d:02d}")
        found.add(f"{y}-{m}-{d}")
        found.add(f"{y:04d}-{m:02d}-{d:02d}"[: rng.randrange(11)])
    return sorted(found)


def evaluated(spark, values, expression):
    df = spark.createDataFrame([(value,) for value in values], "v string")
    return {row["v"]: row["x"] for row in df.select("v", expression.alias("x")).collect()}


def test_int_values(spark, texts):
    got = evaluated(spark, texts, int_value(F.col("v")))
    for text, value in got.items():
        stripped = text.strip(" ")
        expected = int(stripped) if re.fullmatch(r"[+-]?[0-9]+", stripped) else None
        if expected is not None and not -(2**31) <= expected < 2**31:
            expected = None
        assert value == expected, repr(text)


def test_guarded_casts_equal_plain_ones(spark, texts):
    """The shape tests in front of the casts keep out only what a cast would refuse."""
    rng = random.Random(13)
    padded = drawn(rng, "019+-\t\n\x00\x1f\x7f\u00a0 ", 5, 3000)
    padded += [f"{s}{n}" for s in ("", "-", "+0") for n in (2**31 - 1, 2**31, 2**63 - 1, 2**63, 10**20)]
    df = spark.createDataFrame([(v,) for v in {*texts, *padded}], "v string")
    col = F.col("v")
    for guarded, plain in [
        (int_value(col), col.try_cast("int")),
        (int_value(col, big=True), col.try_cast("bigint")),
    ]:
        different = df.where(~guarded.eqNullSafe(plain)).collect()
        assert different == []
    double = col.try_cast("double")
    different = df.where(~number_value(col, StringType()).eqNullSafe(double)).collect()
    assert {row["v"].strip().lower() for row in different} <= {"nan"}


def test_non_negative_text_is_judged_by_its_value(spark, texts):
    """However long: against exact decimals, which no type of the engine can hold."""
    rng = random.Random(14)
    more = drawn(rng, "-0123456789.", 40, 2000) + drawn(rng, "-+0.5eE ", 9, 3000)
    more += [f"-{'0' * 30}.{'0' * 30}{d}" for d in "01"] + [f"-{'9' * 60}", "-0e9", "-1e-99", "-", "--1"]
    got = evaluated(spark, sorted({*texts, *more}), non_negative(F.col("v"), StringType()))
    for text, told in got.items():
        number = re.fullmatch(r" *([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?) *", text)
        if number:
            digits = re.split("[eE]", number[1])[0]
            assert told == (Decimal(digits) >= 0), repr(text)
        else:
            assert told, repr(text)


def test_type_classes(spark, texts):
    got = evaluated(spark, texts, type_class(F.col("v")))
    for text, bit in got.items():
        if re.fullmatch(r"[+-]?[0-9]+", text):
            expected = INTEGRAL_BIT
        elif re.fullmatch(r"[+-]?(([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[0-9]+[eE][+-]?[0-9]+)", text):
            expected = FRACTIONAL_BIT
        elif text in ("true", "false"):
            expected = BOOLEAN_BIT
        else:
            expected = STRING_BIT
        assert bit == expected, repr(text)


def test_numeric_classes_are_exactly_what_a_cast_reads(spark, texts):
    both = F.struct(type_class(F.col("v")).alias("bit"), F.col("v").try_cast("double").alias("number"))
    for text, (bit, number) in evaluated(spark, texts, both).items():
        if bit in (INTEGRAL_BIT, FRACTIONAL_BIT):
            assert number is not None, repr(text)


def test_masked_dates(spark, dates):
    got = evaluated(spark, dates, masked_timestamp(F.col("v"), "yyyy-MM-dd"))
    for text, value in got.items():
        expected = None
        if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
            try:
                expected = dt.datetime.strptime(text, "%Y-%m-%d")
            except ValueError:
                pass
        assert value == expected, repr(text)


MASKS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd", "d.M.yyyy", "yyyy-MM"]


@pytest.mark.parametrize("mask", MASKS)
def test_guarded_masks_equal_plain_ones(spark, dates, mask):
    odd = ["0000-01-01", "2015-08-31\n", "2015-08-31T", "+015-01-02", "2015-08-3 ", "٢٠١٥-08-31", None,
           "+2015-08-31", "-2015-08-31", "+12345-08-31", "12345-08-31", "-0001-01-01", "+002015-08-31",
           "31/08/2015", "31/02/2015", "31/08/+12015", "2015-08-31 24:00:00", "2015-08-31 23:59:60",
           "20150831", "31.8.2015", "2015-08", "99999999999-01-01"]
    texts = [*dates, *odd, *[f"{v} 10:20:30" for v in dates], *[f"{v[8:]}/{v[5:7]}/{v[:4]}" for v in dates]]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Sao_Paulo", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", name)
            fast = masked_timestamp(F.col("v"), mask)
            slow = F.try_to_timestamp(F.col("v"), F.lit(mask))
            df = spark.createDataFrame([(v,) for v in texts], "v string")
            different = df.where(~fast.eqNullSafe(slow)).limit(5)
            assert [row["v"] for row in different.collect()] == []
            plan = df.select(fast.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
            assert "typeof" not in plan
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("pattern", ["N|Y", "^[A-Z0-9]+$", "X*", "[0-9]{3}", "e$"])
def test_patterns(spark, texts, pattern):
    search = evaluated(spark, texts, pattern_found(F.col("v"), pattern))
    whole = evaluated(spark, texts, pattern_found(F.col("v"), pattern, full_match=True))
    for text in texts:
        first = re.search(pattern, text)
        assert search[text] == (first is not None and first.group() != ""), repr(text)
        # the pattern's own anchors stay as they are, so bound the whole by fullmatch
        assert whole[text] == (bool(re.fullmatch(pattern, text)) and text != ""), repr(text)
