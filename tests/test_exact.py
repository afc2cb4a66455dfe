import math
import random

import pytest
from pyspark.sql import functions as F

from sunledger.functions import exact_mean, exact_sum, same_or_mean


def total(spark, values, partitions=4):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return df.agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()


RNG = random.Random(5)
SETS = {
    "full precision": [RNG.uniform(-1e3, 1e3) for _ in range(1000)],
    "seven decimals": [RNG.randrange(10**9) / 1e7 for _ in range(1000)],
    "ties of six decimals": [(2 * RNG.randrange(10**6) + 1) / 2e6 for _ in range(1000)],
    "very small": [RNG.random() * 1e-9 for _ in range(1000)],
    "equal and small": [4e-7] * 1000,
    "of all sizes": [RNG.choice([-1, 1]) * 10 ** RNG.uniform(-9, 9) for _ in range(1000)],
    "cancelling": [1e9 + 0.25, -1e9, 1e-12] * 300 + [-0.25] * 300,
    "negative": [-0.1] * 999,
    "large": [2.0**60 + 2**10, -(2.0**60), 0.3],
    "zeros": [0.0, -0.0],
}


@pytest.mark.parametrize("name", SETS)
def test_any_order_gives_the_bits_of_the_true_sum(spark, name):
    values = list(SETS[name])
    expected = math.fsum(values)
    for partitions in (1, 3, 8):
        RNG.shuffle(values)
        got = total(spark, values, partitions)
        assert abs(got.s - expected) <= math.ulp(expected) and got.m == got.s / len(values)
        assert total(spark, values, partitions).s == got.s


def test_what_lies_under_the_last_digit_is_rounded(spark):
    """The stated bound: 2^-101 for each reading."""
    assert abs(total(spark, [1e-17] * 10).s - 1e-16) <= 10 * 2.0**-101
    assert total(spark, [-1e-40] * 3).s == 0.0


def test_values_that_agree_pass_through(spark):
    df = spark.createDataFrame([(1, 25.184316133333333)] * 3 + [(2, 6.27e-7), (2, None), (3, 1.0), (3, 2.0), (4, None)], "k int, x double")
    got = {r.k: r.x for r in df.groupBy("k").agg(same_or_mean("x").alias("x")).collect()}
    assert got == {1: 25.184316133333333, 2: 6.27e-7, 3: 1.5, 4: None}


def test_what_a_double_sum_gets_wrong(spark):
    assert total(spark, [0.1] * 10).s == 1.0
    assert total(spark, [1e15, 0.25, -1e15]).s == 0.25


def test_nulls(spark):
    df = spark.createDataFrame([(1, 2.5), (1, None), (1, 3.5), (2, None)], "k int, x double")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}
    assert got == {1: (6.0, 3.0), 2: (None, None)}


def test_agrees_with_a_sum_of_wide_integers(spark):
    """Twenty thousand rows and their exact sum in units of 2^-60, where all of them are whole."""
    df = spark.range(20_000).select((F.col("id") % 7).alias("k"), (F.col("id") * 0.0137 - 90.5).alias("x"))
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    rows = [tuple(r) for r in df.collect()]
    assert got == {k: sum(int(x * 2.0**60) for j, x in rows if j == k) / 2**60 for k in range(7)}


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), 1e19])
def test_what_has_no_exact_sum_fails(spark, bad):
    with pytest.raises(Exception, match="OVERFLOW"):
        total(spark, [1.0, bad])


def test_a_session_that_began_without_ansi_mode(spark):
    from sunledger.session import configure

    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        configure(spark)
        with pytest.raises(Exception, match="OVERFLOW"):
            total(spark, [float("nan"), 1.0])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
