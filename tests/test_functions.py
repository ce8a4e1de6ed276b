"""Scalar functions and classification ladders at their boundaries."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelyze.functions import numeric as N
from panelyze.functions import rules as C
from panelyze.functions.rules import classify


def one_col(spark, values, name="x", typ="double"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} {typ}")


def labels(spark, values, rules_fn, default=C.UNKNOWN):
    df = one_col(spark, values)
    out = df.select("x", classify(rules_fn("x"), default).alias("c")).collect()
    return {r.x: r.c for r in out}


def test_safe_divide_and_round(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0), (1.005, 1.0), (-2.675, 1.0)], "a double, b double")
    out = df.select(N.safe_divide("a", "b").alias("q"), N.round_half_up(N.safe_divide("a", "b"), 2).alias("r")).collect()
    assert [r.q for r in out[:3]] == [None, None, 1.5]
    # decimal rounding: 1.005 -> 1.01, -2.675 -> -2.68 (half away from zero)
    assert out[3].r == 1.01 and out[4].r == -2.68


def test_exact_sum_independent_of_order(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.6]
    a = one_col(spark, vals).agg(N.exact_sum("x").alias("s")).first().s
    b = one_col(spark, list(reversed(vals))).repartition(3).agg(N.exact_sum("x").alias("s")).first().s
    assert a == b == 1000000.01


def test_exact_sum_beyond_a_long_of_cents(spark):
    n = 30000
    df = spark.range(n).select((F.lit(9.9e12) + F.col("id") / 4).alias("x"))
    want = sum(Decimal(9900000000000) + Decimal(i) / 4 for i in range(n))
    assert df.agg(N.exact_sum("x")).first()[0] == float(want)
    minus = df.select((-F.col("x")).alias("x"))
    assert minus.agg(N.exact_sum_decimal("x")).first()[0] == -want
    assert df.unionByName(minus).agg(N.exact_sum("x")).first()[0] == 0.0


def test_sums_and_averages_of_numbers_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    for values, total in (([1.0, nan], nan), ([1.0, inf], inf), ([-inf, 2.5], -inf), ([inf, -inf], nan), ([None, inf], inf)):
        got = one_col(spark, values).agg(N.exact_sum("x").alias("s"), N.exact_avg("x").alias("a")).first()
        assert repr(got.s) == repr(total) and repr(got.a) == repr(total)
    got = one_col(spark, [None, 1.0, 0.1 + 0.2]).agg(N.exact_sum("x").alias("s"), N.exact_avg("x").alias("a")).first()
    assert (got.s, got.a) == (1.3, 0.65)
    none = one_col(spark, [None, None]).agg(N.exact_sum("x").alias("s"), N.exact_avg("x").alias("a")).first()
    assert (none.s, none.a) == (None, None)


def test_cagr_and_pct_change(spark):
    df = spark.createDataFrame([(121.0, 100.0, 2022, 2020), (50.0, 100.0, 2020, 2020), (10.0, 0.0, 2021, 2020)],
                               "v double, b double, t int, t0 int")
    out = df.select(N.round_half_up(N.cagr_pct("v", "b", "t", "t0"), 2).alias("g"),
                    N.round_half_up(N.pct_change("v", "b"), 2).alias("p")).collect()
    assert out[0].g == 10.0 and out[0].p == 21.0
    assert out[1].g is None  # base year
    assert out[2].g is None and out[2].p is None  # base value 0


def test_intensity_guards(spark):
    df = spark.createDataFrame([(10.0, 2.0, 5.0), (10.0, -2.0, 5.0), (10.0, 0.0, 5.0)], "e double, g double, p double")
    out = df.select(N.intensity_guarded("e", "g", "p").alias("a"), N.intensity_nullif("e", "g", "p").alias("b")).collect()
    assert out[0].a == 10.0 / (2.0 * 5.0 / 1e6)
    assert out[1].a is None and out[1].b == 10.0 / (-2.0 * 5.0 / 1e6)
    assert out[2].a is None and out[2].b is None


def test_income_ladder(spark):
    got = labels(spark, [1145.99, 1146, 4515, 4515.5, 4516, 14005, 14005.01, None], C.income_rules)
    assert got == {
        1145.99: "Low income",
        1146: "Lower-middle income",
        4515: "Lower-middle income",
        4515.5: "Unknown",
        4516: "Upper-middle income",
        14005: "Upper-middle income",
        14005.01: "High income",
        None: "Unknown",
    }


def test_inequality_poverty_employment_education_life(spark):
    assert labels(spark, [39.9, 40, 40.1, None], C.inequality_rules) == {
        39.9: "Moderate or low inequality", 40: "Unknown", 40.1: "High inequality", None: "Unknown"}
    assert labels(spark, [4.9, 5, 19.9, 20, None], C.poverty_rules) == {
        4.9: "Low Poverty", 5: "Moderate Poverty", 19.9: "Moderate Poverty", 20: "Severe Poverty", None: "Unknown"}
    assert labels(spark, [4.9, 5, 14.9, 15, None], C.employment_rules) == {
        4.9: "Low Unemployment", 5: "Moderate Unemployment", 14.9: "Moderate Unemployment",
        15: "High Unemployment", None: "Unknown"}
    assert labels(spark, [59.9, 60, 89.9, 90, None], C.education_rules) == {
        59.9: "Low enrollment", 60: "Medium enrollment", 89.9: "Medium enrollment", 90: "High enrollment",
        None: "Unknown"}
    assert labels(spark, [59.9, 60, 74.9, 75, None], C.life_expectancy_rules) == {
        59.9: "Low life Expectancy", 60: "Medium life expectancy", 74.9: "Medium life expectancy",
        75: "High life expectancy", None: "Unknown"}


def test_intensity_ladder(spark):
    assert labels(spark, [999999, 1e6, 99999999, 1e8, None], C.intensity_rules) == {
        999999: "Low Emitters", 1e6: "Medium Emitters", 99999999: "Medium Emitters", 1e8: "High Emitters",
        None: "Unknown"}


def test_trend_ladder(spark):
    got = labels(spark, [-2.01, -2, -0.5, 0.5, 2, 2.01, None], C.trend_rules, C.TREND_DEFAULT)
    assert got == {
        -2.01: "Rapid decrease", -2: "Moderate decrease", -0.5: "Moderate decrease", 0.5: "Stable",
        2: "Moderate increase", 2.01: "Rapid increase", None: "Insufficient data"}


def test_composition_and_impact(spark):
    df = spark.createDataFrame(
        [(70.0, 10.0, 20.0), (70.1, 10.0, 19.9), (10.0, 50.0, 40.0), (10.0, 50.1, 39.9), (0.0, 0.0, 0.0)],
        "co2 double, ch4 double, n2o double")
    total = F.col("co2") + F.col("ch4") + F.col("n2o")
    out = df.select(classify(C.composition_rules("co2", "ch4", total), C.COMPOSITION_LABELS[2]).alias("c")).collect()
    assert [r.c for r in out] == ["Mixed Emissions", "CO₂-Dominant", "Mixed Emissions", "Methane-Dominant",
                                  "Mixed Emissions"]
    imp = spark.createDataFrame([(101.0, 100.0), (100.0, 100.0), (97.0, 100.0), (90.0, 100.0), (None, 100.0)],
                                "s double, l double")
    out = imp.select(classify(C.impact_rules("s", "l"), C.UNKNOWN).alias("c")).collect()
    assert [r.c for r in out] == ["Fast Warming Country", "Balanced Warming", "Balanced Warming",
                                  "Slow Warming Country", "Unknown"]


@pytest.mark.parametrize(
    "g,e,full,five",
    [
        (1.0, -1.0, "Absolute decoupling", "Absolute decoupling"),
        (2.0, 1.0, "Relative decoupling", "Relative decoupling"),
        (1.0, 1.0, "No decoupling", "No decoupling"),
        (1.0, 2.0, "No decoupling", "No decoupling"),
        (-1.0, -2.0, "Recession with larger emissions reduction", "Other"),
        (-2.0, -1.0, "Recession with smaller emissions reduction", "Other"),
        (-1.0, -1.0, "Recession with smaller emissions reduction", "Other"),
        (0.0, 1.0, "Other", "Other"),
        (None, 1.0, "Other", "Other"),
        (-1.0, 1.0, "Other", "Other"),
    ],
)
def test_decoupling(spark, g, e, full, five):
    df = spark.createDataFrame([(g, e)], "g double, e double")
    r = df.select(
        classify(C.decoupling_rules("g", "e"), C.OTHER).alias("a"),
        classify(C.decoupling_rules("g", "e", with_recession=False), C.OTHER).alias("b"),
    ).first()
    assert (r.a, r.b) == (full, five)


def test_relationship(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (1.0, 2.0), (2.0, 1.0), (2.0, 2.0), (0.0, 1.0)], "e double, g double")
    out = df.select(classify(C.relationship_rules("e", "g"), C.OTHER).alias("c")).collect()
    assert [r.c for r in out] == ["Decoupling", "Relative decoupling", "No decoupling", "No decoupling", "Other"]
