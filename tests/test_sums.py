"""Order-free sums."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tapeworks.functions.sums import exact_avg, exact_sum


def total(spark, values, scale=4, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum(F.col("x"), scale).alias("s")).first().s


def test_nothing_and_nulls(spark):
    assert total(spark, []) is None
    assert total(spark, [None, None]) is None
    assert total(spark, [None, 1.25]) == 1.25


def test_cents_are_exact(spark):
    values = [0.1] * 10 + [0.01] * 7 + [-0.2]
    assert total(spark, values) == 0.87


def test_order_does_not_matter(spark):
    rng = random.Random(1)
    values = [round(rng.uniform(-1e6, 1e6), 4) for _ in range(3000)]
    results = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        results.add(total(spark, values, parts=parts))
    wanted = sum((Fraction(round(v * 10000), 10000) for v in values), Fraction(0))
    assert results == {float(wanted)}


def test_fine_and_huge_values_are_not_rounded_away(spark):
    assert math.isclose(total(spark, [0.00000123, 0.00000001]), 0.00000124, rel_tol=1e-12)
    assert total(spark, [1e300, 1e300]) == 2e300
    assert total(spark, [1e300, 1.5, -1e300]) in (0.0, 1.5)
    assert total(spark, [float("inf"), 1.0]) == math.inf
    assert math.isnan(total(spark, [float("nan"), 1.0]))
    assert math.isnan(total(spark, [float("inf"), float("-inf")]))


@pytest.mark.parametrize("value", [1e-13, 100000000.00003, 1234567.8900005, 2e-20, 3.14159265358979])
def test_no_digit_is_cut_off(spark, value):
    true = float(Fraction(value) * 1000)
    for parts in (1, 3, 7):
        got = total(spark, [value] * 1000, parts=parts)
        assert abs(got - true) <= math.ulp(true)
    assert math.isclose(total(spark, [1e-25] * 1000), 1e-22, rel_tol=1e-12)


def test_many_large_units_do_not_overflow(spark):
    big = 900000000000.0
    df = spark.range(200000).select(F.lit(big).alias("x"))
    assert df.agg(exact_sum(F.col("x")).alias("s")).first().s == big * 200000


def test_average(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, x double")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_avg(F.col("x")).alias("m")).collect()}
    assert got == {"a": 0.15, "b": None}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e12, 1e12, allow_nan=False), max_size=30))
def test_close_to_the_true_sum(spark, values):
    got = total(spark, values, parts=2) if values else 0.0
    true = sum((Fraction(v) for v in values), Fraction(0))
    size = sum(abs(v) for v in values) + len(values)
    assert abs(Fraction(got) - true) <= Fraction(size) * Fraction(1e-11)
