"""Decimal text against Python's own formatting, which rounds the exact binary value."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.decimals import fixed

GOLDEN = {0.0625: "0.062", 0.3125: "0.312", -0.0625: "-0.062", -0.3125: "-0.312", 0.1875: "0.188", 1.0005: "1.000", 2.5: "2.500"}


def written(spark, values, places, signed):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", fixed(F.col("v"), places, signed).alias("t")).collect()
    return [r["t"] for r in sorted(rows)]


def test_golden(spark):
    assert written(spark, list(GOLDEN), 3, False) == list(GOLDEN.values())


@pytest.mark.parametrize("places", [1, 2, 3, 5])
def test_like_python(spark, places):
    rng = random.Random(places)
    values = [n / 32 for n in range(-200, 200)] + [n / 2000 for n in range(-300, 300)] + [n / 2**k for n in (1, 3, 5) for k in range(1, 80)]
    values += [rng.uniform(-1, 1) for _ in range(2000)] + [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(2000)]
    values += [0.9995, 0.99949999, 0.9999999, 1 - 2**-53, 2.0**52 - 0.5, 0.0, -0.0, 1e-300, -1e-7, float("nan"), float("inf"), -float("inf")]
    assert written(spark, values, places, False) == [f"{v:.{places}f}" for v in values]
    assert written(spark, values, places, True) == [f"{v:+.{places}f}" for v in values]


def test_null(spark):
    assert written(spark, [None, 1.0], 3, True) == [None, "+1.000"]
