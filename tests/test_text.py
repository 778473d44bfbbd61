"""Text and number functions, one row each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketmill.functions import numbers, text


def values(spark, column, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_trim_takes_spaces_only(spark):
    assert values(spark, text.trimmed("v"), "  a b ", "\ta ", None) == ["a b", "\ta", None]


def test_case(spark):
    assert values(spark, text.lower_trimmed("v"), " A@B.c ") == ["a@b.c"]
    assert values(spark, text.upper_trimmed("v"), " us ") == ["US"]


def test_strip_is_pythons(spark):
    every = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    samples = [f"{c}a{c}b{c}" for c in every] + ["".join(every), "", "x" + "\n" * 50_000 + "y"]
    assert values(spark, text.stripped("v"), *samples) == [s.strip() for s in samples]


@pytest.mark.parametrize(
    ("email", "masked", "strict"),
    [
        ("alice.martin@example.com", "a****@example.com", "a****@example.com"),
        ("ab@x.org", "a****@x.org", "a****@x.org"),
        ("a@example.com", "a@example.com", "a****@example.com"),
        ("no address", "no address", "no address"),
        ("@example.com", "@example.com", "@example.com"),
        ("two@at@signs", "t****@at@signs", "t****@at@signs"),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_mask(spark, email, masked, strict):
    assert values(spark, text.masked_email("v"), email) == [masked]
    assert values(spark, text.masked_email("v", strict=True), email) == [strict]


def test_null_tokens(spark):
    found = values(spark, text.null_if_token("v"), "NA", "", "null", "Na", " NA", "0", None)
    assert found == [None, None, None, "Na", " NA", "0", None]


def test_rounding(spark):
    halves = values(spark, numbers.rounded_int("v"), "2.5", "3.5", "-2.5", "3.7", "45", None)
    assert halves == [2, 4, -2, 4, 45, None]
    cents = values(spark, numbers.money("v").cast("string"), "-0.125", "0.125", "7")
    assert cents == ["-0.13", "0.13", "7.00"]


def test_mean_of_nothing(spark):
    df = spark.createDataFrame([], "v decimal(10,2)")
    assert df.agg(numbers.mean_of(F.sum("v"), F.count("v"))).first()[0] is None
